"""Command line: grade stored generations and write their scores, or check configurations.

    python -m evalyard.cli score TASK.yaml GENERATIONS.jsonl GRADES_DIR SCORES.yaml
    python -m evalyard.cli check TASK.yaml...
    python -m evalyard.cli describe DATA NAME GRADER OUT.yaml --average-over 1 4 --pass-at 1
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .configs import Task, describe_dataset, load_task, render
from .functions.parsers import parse_all
from .operators import graders, rows
from .session import get_session
from .sources import readers, writers


def grade_task(task: Task, generations: DataFrame) -> DataFrame:
    """Parsed and graded rows of a task's generations; rows without generations are graded by what they have."""
    if "generations" in generations.columns:
        generations = generations.withColumn("parsed_generations", parse_all(task.parser, "generations"))
    if (tokenizer := task.meta.get("truncate_tokenizer")) and task.grader == "ruler":
        generations = graders.within_budgets(generations, tokenizer)
    return graders.grade_or_report(generations, task.grader)


def score_task(task: Task, graded: DataFrame) -> DataFrame:
    """The scores of the task's grader: overall, and each group's with its value before the name where the grader has flags."""
    return graders.score(graded, task.grader, graders.Options(task.average_over, task.pass_at, task.by))


def run(spark: SparkSession, task: Task, generations: str, grades: str, scores: str) -> None:
    """Grade what isn't graded yet, append it, and write the scores of all grades."""
    todo = rows.resume(spark.read.json(generations), readers.completed_ids(spark, grades))
    writers.append_records(grade_task(task, todo), grades)
    writers.write_scores(score_task(task, spark.read.json(grades)), scores)


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = top.add_subparsers(dest="command", required=True)
    score = sub.add_parser("score")
    for name in ("task", "generations", "grades", "scores"):
        score.add_argument(name)
    check = sub.add_parser("check")
    check.add_argument("task", nargs="+")
    describe = sub.add_parser("describe")
    for name in ("data", "name", "grader", "out"):
        describe.add_argument(name)
    for name in ("--average-over", "--pass-at"):
        describe.add_argument(name, type=int, nargs="+", default=[1])
    describe.add_argument("--version", default="1.0.0")
    describe.add_argument("--records", type=int)
    args = top.parse_args(argv)
    if args.command == "describe":
        config = describe_dataset(get_session(), args.data, args.name, args.grader, args.average_over, args.pass_at, args.version, args.records)
        with open(args.out, "w", encoding="ascii") as f:
            f.write(render(config))
        return 0
    if args.command == "check":
        bad = 0
        for path in args.task:
            try:
                load_task(path)
            except (ValueError, OSError) as e:
                bad += 1
                print(e, file=sys.stderr)
        return int(bad > 0)
    run(get_session(), load_task(args.task), args.generations, args.grades, args.scores)
    return 0


if __name__ == "__main__":
    sys.exit(main())
