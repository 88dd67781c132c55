"""Task and model configurations: YAML files, checked before anything runs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import yaml

from .functions.parsers import list_parsers
from .operators.graders import list_graders


@dataclass(frozen=True)
class Task:
    """One dataset to evaluate; ``average_over`` and ``pass_at`` may not exceed ``num_generations``."""

    name: str
    data_path: str
    grader: str
    num_generations: int = 1
    average_over: tuple[int, ...] = (1,)
    pass_at: tuple[int, ...] = (1,)
    parser: str = "passthrough"
    tag: str = "any"
    by: tuple[str, ...] = ()
    meta: dict = field(default_factory=dict)


KEYS = {"name", "data_path", "grader", "num_generations", "average_over", "pass_at", "parser", "tag", "by", "meta"}


def problems(config: dict) -> list[str]:
    """What is wrong with a task configuration; empty if nothing is."""
    if not isinstance(config, dict):
        return ["not a mapping"]
    out = [f"missing {k}" for k in ("name", "data_path", "grader") if not config.get(k)]
    out += [f"unknown key {k}" for k in sorted(set(config) - KEYS)]
    if config.get("grader") and config["grader"] not in list_graders():
        out.append(f"unknown grader {config['grader']}")
    if config.get("parser", "passthrough") not in list_parsers():
        out.append(f"unknown parser {config['parser']}")
    n = config.get("num_generations", 1)
    for key in ("average_over", "pass_at"):
        values = config.get(key, [1])
        if not isinstance(values, list) or not all(isinstance(v, int) and not isinstance(v, bool) and 1 <= v <= n for v in values):
            out.append(f"{key} must list numbers from 1 to num_generations")
    return out


def load_task(path: str) -> Task:
    with open(path, encoding="utf-8") as f:
        config = yaml.safe_load(f)
    if found := problems(config):
        raise ValueError(f"{path}: {'; '.join(found)}")
    lists = {k: tuple(config[k]) for k in ("average_over", "pass_at", "by") if k in config}
    return Task(**{k: v for k, v in config.items() if k not in lists}, **lists)


def describe_dataset(spark, data_path: str, name: str, grader: str, average_over: list[int], pass_at: list[int], version: str = "1.0.0", records: int | None = None, meta: dict | None = None) -> dict:
    """The configuration of a dataset of JSON lines: its records are counted unless ``records`` says how many."""
    from .sources.readers import count_records, exists

    if not exists(spark, data_path):
        raise FileNotFoundError(data_path)
    pattern = data_path if data_path.endswith(".jsonl") else f"{data_path.rstrip('/')}/*.jsonl"
    out = {"uuid": str(uuid.uuid4()), "grader": {"type": grader}, "average_over": average_over, "pass_at": pass_at, "dataset_name": name, "data_path": pattern, "semantic_version": version, "num_generations": count_records(spark, pattern) if records is None else records}
    return out | ({"meta": meta} if meta else {})


def render(config: dict) -> str:
    """A configuration as YAML in the order of its keys, ASCII only."""
    return yaml.safe_dump(config, sort_keys=False, allow_unicode=False, default_flow_style=False)
