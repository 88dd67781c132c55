"""Dataset building: benchmark rows from source tables, as projections and ordinary joins.

Each builder takes rows with a ``row`` number (see ``rows.row_numbers``) and gives the core
columns row, completion_input, chat_input and ground_truth; choice tasks also the scoring columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import regex, strip
from .choice import labels
from .rows import clean_text, row_numbers, seeded_shuffle

# The instructions that benchmark prompts begin with.
ASSISTANT = "You are a helpful assistant."
CHOOSE = "The following are multiple choice questions (with answers). Choose the correct answer from the options."
SCIENCE = "The following are multiple choice science questions. Choose the correct answer from the options and answer with the correct letter."
FINAL_ONLY = "Provide only your final answer."
SHOT_INTRO = "The following are multiple choice questions (with answers) about %s. "
STEP_BY_STEP = 'Think step by step and then finish your answer with "the answer is (X)" where X is the correct letter choice.'
LETTER_ONLY = "Answer with only the correct letter."
PROGRAMMER = "You are an expert Python programmer."
COMPLETE_FUNCTION = "Complete the implementation for the following Python function:\n\n```python\n%s\n```\n\nWrap your complete implementation in a python code block (i.e. ```python\nyour code here```)."
ABOUT = "The following are multiple choice questions about %s.\n\n"
ABOUT_ANSWERED = "The following are multiple choice questions (with answers) about %s."
REASON_THEN_LETTER = "You are a helpful assistant. To answer the user's question, you first think about the reasoning process and then provide the user with the answer. The reasoning process and answer are enclosed within <reasoning> </reasoning> and <answer> </answer> tags, respectively, i.e., <reasoning> reasoning process here </reasoning><answer> answer here </answer>. Provide a single letter (A, B, C, ...) as the answer, for example, <answer> C </answer>. Now the user asks you to answer a multiple choice question.\n\nUser: %s\nAssistant:\n<reasoning>"
LETTER_IN_TAGS = "%s\nProvide a single letter (A, B, C, ...) as the answer enclosed within the <answer> </answer> tags. For example, <answer> C </answer>."
THINK_THEN_BOX = "The user asks a question, and the Assistant solves it. The assistant first thinks about the reasoning process in the mind and then provides the user with the final answer. The reasoning process and answer are enclosed within <think> </think> and <answer> </answer> tags, respectively, i.e., <think> reasoning process here </think><answer> answer here </answer>. In the answer, box your final answer using \\boxed{} notation. Now the user asks you to solve a math reasoning problem.\n\nUser:%s\nAssistant: <think>"
NAMED = "\nThe function should be named `%s`."


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def option_lines(texts: Column) -> Column:
    """A. first, B. second, ... one to a line."""
    return F.array_join(F.zip_with(labels(F.size(texts)), texts, lambda k, t: F.concat(k, F.lit(". "), t)), "\n")


def scoring_columns(n: Column) -> dict[str, Column]:
    return {"scoring_mode": F.lit("choice_scoring"), "scoring_completions": labels(n), "scoring_completion_labels": labels(n)}


def label_letter(c: Column) -> Column:
    """Source labels 1 to 5 or A to E as letters; others are an error."""
    up = F.upper(strip(c.cast("string")))
    letter = F.when(up.isin(*"12345"), F.translate(up, "12345", "ABCDE")).when(up.isin(*"ABCDE"), up)
    return F.coalesce(letter, F.raise_error(F.concat(F.lit("unknown choice label "), F.coalesce(up, F.lit("null")))).cast("string"))


def _core(df: DataFrame, system: Column, user: Column, truth: Column, *more: str | Column) -> DataFrame:
    return df.select("row", F.concat(system, user).alias("completion_input"), F.array(message("system", system), message("user", user)).alias("chat_input"), truth.alias("ground_truth"), *more)


#: Examples that one prompt may hold.
MOST_SHOTS = 256


def science_choice(df: DataFrame, shots: DataFrame | None = None, shot_order: str = "row") -> DataFrame:
    """Rows of question, labels, texts and answer; ``shots``, a few rows of the same shape, go before each question.

    Labels must be distinct and hold the answer. All questions share one prefix, aggregated to one row; more than
    ``MOST_SHOTS`` examples are an error, as a prompt holds them all.
    """
    names = F.transform("labels", label_letter)
    at = F.array_position(names, label_letter(F.col("answer")))
    bad = (F.size("texts") != F.size("labels")) | (F.size(F.array_distinct(names)) != F.size("labels")) | (at == 0) | (F.size("texts") < 2)
    letter = F.when(bad, F.raise_error(F.lit("choices and answer don't fit")).cast("string")).otherwise(F.char(64 + at))
    block = F.concat(F.lit("Question:\n"), strip(F.col("question")), F.lit("\nChoices:\n"), option_lines(F.col("texts")), F.lit("\nAnswer:"))
    df = df.withColumns({"_block": block, "_letter": letter})
    if shots is not None:
        if shots.count() > MOST_SHOTS:
            raise ValueError(f"more than {MOST_SHOTS} examples before each question")
        before = shots.select(F.struct(shot_order, F.concat(block, F.lit(" "), letter).alias("b")).alias("s")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: F.concat(s["b"], F.lit("\n\n"))), "").alias("_before"))
        df = df.join(F.broadcast(before)).withColumn("_block", F.concat("_before", "_block"))
    out = _core(df, F.lit(f"{ASSISTANT}\n\n{SCIENCE}\n\n"), F.col("_block"), F.col("_letter"), F.size("texts").alias("_n"))
    return out.withColumns(scoring_columns(F.col("_n"))).drop("_n")


def source_text(c: Column) -> Column:
    """Trimmed text without bracketed notes; a title mark becomes a full stop; null is empty."""
    t = F.replace(strip(F.coalesce(c, F.lit(""))), F.lit(" [title]"), F.lit(". "))
    return F.replace(F.regexp_replace(t, regex(r"\[.*?\]"), ""), F.lit("  "), F.lit(" "))


def shuffled_choice(df: DataFrame, seed: int = 0) -> DataFrame:
    """Rows of question, correct and incorrect (three texts): options in a seeded order that depends on the row."""
    tagged = F.concat(F.transform("incorrect", lambda t: F.concat(F.lit("0"), source_text(t))), F.array(F.concat(F.lit("1"), source_text(F.col("correct")))))
    df = df.withColumn("_s", seeded_shuffle(seed)("row", tagged))
    texts = F.transform("_s", lambda t: F.substring(t, 2, 1 << 30))
    at = F.array_position(F.transform("_s", lambda t: F.left(t, F.lit(1))), "1")
    user = F.concat(source_text(F.col("question")), F.lit("\n"), option_lines(texts), F.lit("\nAnswer:"))
    return _core(df, F.lit(f"{ASSISTANT}\n\n{CHOOSE}\n\n"), user, F.char(64 + at))


def filled_in(pattern: str, value: Column) -> Column:
    """A fixed text with a value in the place of its mark."""
    before, after = pattern.split("%s")
    return F.concat(F.lit(before), value, F.lit(after))


def category_choice(test: DataFrame, validation: DataFrame, order: str = "row", k: int = 5) -> DataFrame:
    """Rows of category, question, options, answer (and cot in ``validation``), with the first ``k`` worked examples of their category before them."""
    nth = F.row_number().over(Window.partitionBy("category").orderBy(order))
    validation = validation.withColumn("_nth", nth).where(F.col("_nth") <= k)
    topic = F.replace(F.col("category"), F.lit("_"), F.lit(" "))
    ask = F.concat(F.lit("Question:\n"), strip(F.col("question")), F.lit("\nOptions:\n"), option_lines(F.col("options")), F.lit("\nAnswer: "))
    worked = F.struct(order, F.concat(ask, F.regexp_replace("cot", r"\AA: ", "")).alias("full"), F.concat(ask, F.col("answer")).alias("short"))
    shots = validation.select("category", worked.alias("s")).groupBy("category").agg(F.array_sort(F.collect_list("s")).alias("_s"))
    df = test.join(shots, "category", "left").withColumn("_s", F.coalesce("_s", F.array()))
    intro = F.concat(F.lit(SHOT_INTRO.split("%s")[0]), topic, F.lit(SHOT_INTRO.split("%s")[1]))
    whole = lambda part, end: F.array_join(F.concat(F.transform("_s", lambda s: s[part]), F.array(end)), "\n\n")
    return df.select(
        "row",
        F.concat(intro, F.lit(STEP_BY_STEP + "\n"), whole("full", F.concat(ask, F.lit("Let's think step by step.")))).alias("completion_input"),
        F.col("answer").alias("ground_truth"),
        F.concat(intro, F.lit(LETTER_ONLY + "\n"), whole("short", F.regexp_replace(ask, r" \z", ""))).alias("scoring_prompt_prefix"),
        F.size("options").alias("_n"),
    ).withColumns(scoring_columns(F.col("_n"))).drop("_n")


def zero_shot_choice(df: DataFrame) -> DataFrame:
    """Rows of category, question, options and answer: prompts without examples, and the scoring form's."""
    topic = F.replace(F.col("category"), F.lit("_"), F.lit(" "))
    block = F.concat(F.lit("Question:\n"), strip(F.col("question")), F.lit("\nOptions:\n"), option_lines(F.col("options")))
    intro = filled_in(SHOT_INTRO, topic)
    return df.select(
        "row",
        F.concat(intro, F.lit(STEP_BY_STEP + "\n"), block, F.lit("\nAnswer: Let's think step by step.")).alias("completion_input"),
        F.array(message("user", F.concat(intro, F.lit(STEP_BY_STEP + "\n"), block))).alias("chat_input"),
        F.col("answer").alias("ground_truth"),
        F.concat(intro, F.lit(LETTER_ONLY + "\n"), block, F.lit("\nAnswer:")).alias("scoring_prompt_prefix"),
        F.size("options").alias("_n"),
    ).withColumns(scoring_columns(F.col("_n"))).drop("_n")


def reasoning_choice(df: DataFrame) -> DataFrame:
    """Rows of category, question, options and answer: zero-shot prompts that ask for reasoning and a letter in tags."""
    topic = F.replace(F.col("category"), F.lit("_"), F.lit(" "))
    quiz = F.concat(filled_in(ABOUT, topic), strip(F.col("question")), F.lit("\n"), option_lines(F.col("options")))
    return df.select("row", filled_in(REASON_THEN_LETTER, quiz).alias("completion_input"), F.array(message("user", filled_in(LETTER_IN_TAGS, quiz))).alias("chat_input"), F.col("answer").alias("ground_truth"))


def reasoning_problem(df: DataFrame) -> DataFrame:
    """Core rows with completion prompts that begin a thought; the problem is the first user message, else the old prompt."""
    return df.withColumn("completion_input", filled_in(THINK_THEN_BOX, _problem()))


def function_completion(df: DataFrame) -> DataFrame:
    """Rows of prompt, test and entry_point: the prompt alone, a chat that asks to complete it, and a truth of all three as JSON."""
    truth = F.to_json(F.struct("test", "entry_point", "prompt"))
    chat = F.array(message("system", F.lit(PROGRAMMER)), message("user", filled_in(COMPLETE_FUNCTION, F.col("prompt"))))
    return df.select("row", F.col("prompt").alias("completion_input"), chat.alias("chat_input"), truth.alias("ground_truth"))


def subject_choice(df: DataFrame, shots: DataFrame, k: int = 5) -> DataFrame:
    """Rows of subject, question, choices, answer (from 0) and correct_answer, with their subject's first ``k`` shots (same shape, by row).

    The chat has each shot as a question and a reply; the truth is the corrected letter.
    """
    name = F.lower(F.replace("subject", F.lit("_"), F.lit(" ")))
    body = F.concat("question", F.lit("\n"), option_lines(F.col("choices")), F.lit("\nAnswer:"))
    nth = F.row_number().over(Window.partitionBy("subject").orderBy("row"))
    shot = F.struct("nth", body.alias("ask"), F.char(65 + F.col("answer")).alias("letter"))
    before = shots.withColumn("nth", nth).where(F.col("nth") <= k).groupBy("subject").agg(F.array_sort(F.collect_list(shot)).alias("_s"))
    df = df.join(before, "subject", "left").withColumn("_s", F.coalesce("_s", F.array()))
    intro = filled_in(ABOUT_ANSWERED, name)
    worked = F.transform("_s", lambda s: F.concat(s["ask"], F.lit(" "), s["letter"], F.lit("\n\n")))
    talk = F.flatten(F.transform("_s", lambda s: F.array(message("user", s["ask"]), message("assistant", s["letter"]))))
    return df.select(
        "row",
        F.concat(intro, F.lit("\n\n"), F.array_join(worked, ""), body).alias("completion_input"),
        F.concat(F.array(message("system", intro)), talk, F.array(message("user", body))).alias("chat_input"),
        corrected_letter(F.col("answer"), F.col("correct_answer")).alias("ground_truth"),
    )


def without_quotes(prompt: Column) -> Column:
    """A docstring's content."""
    return strip(F.regexp_replace(strip(prompt), r'\A"""|"""\z', ""))


def description(prompt: Column) -> Column:
    """What a docstring says before its first assert."""
    return strip(F.regexp_replace(without_quotes(prompt), regex(r"\nassert\s.*", "s"), ""))


def function_prompts(df: DataFrame, suffix: str = "") -> DataFrame:
    """Rows of prompt and entry_point: completion_input that ends in the function's open head, completion_prefix, and the chat's request."""
    head = F.concat(F.lit("def "), "entry_point", F.lit("("))
    ask = F.concat(without_quotes(F.col("prompt")), filled_in(NAMED, F.col("entry_point")), F.lit(f"\n\n{suffix}" if suffix else ""))
    return df.withColumns({"completion_input": F.concat("prompt", F.lit("\n"), head), "completion_prefix": head, "chat_input": F.array(message("user", ask))})


def task_name(c: Column, prefix: str = "") -> Column:
    """A name of lower-case letters, digits and single underscores; & is "and"."""
    plain = F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", "_")
    return F.concat(F.lit(prefix), F.regexp_replace(plain, "^_+|_+$", ""))


def judged_query(prompt: Column) -> Column:
    """The question of a long prompt: after its last question mark line, without the closing answer mark."""
    question = F.regexp_replace(F.substring_index(prompt, "\n=== QUESTION ===\n", -1), r"\n\nAnswer:\z", "")
    return F.regexp_replace(question, r"\A[ \n]+|[ \n]+\z", "")


def text_questions(df: DataFrame) -> DataFrame:
    """Rows without an image, by answer type: a choice prompt, or a request for the final answer only."""
    df = df.where("image is null or image = ''")
    many = F.col("answer_type") == "multipleChoice"
    q = strip(F.col("question"))
    system = F.when(many, f"{ASSISTANT}\n\n{CHOOSE}").otherwise(f"{ASSISTANT}\n\n{FINAL_ONLY}")
    user = F.when(many, F.concat(q, F.lit("\nAnswer:"))).otherwise(q)
    out = _core(df, system, user, F.col("answer"), "answer_type", "category", "id")
    return out.withColumn("completion_input", F.concat(F.element_at("chat_input", 1)["content"], F.lit("\n\n"), F.element_at("chat_input", 2)["content"]))


def corrected_letter(answer: Column, corrected: Column) -> Column:
    """Letter of a zero-based answer, or of its correction where that is a letter or an index."""
    raw = strip(corrected)
    return F.coalesce(F.when(raw.rlike("^[A-D]$"), raw), F.when(raw.rlike("^[0-3]$"), F.char(65 + raw.try_cast("int"))), F.char(65 + answer))


def topic_choice(df: DataFrame, options: list[str]) -> DataFrame:
    """Rows of Question, Context, Subject, Level, Answer and option columns; blank options are left out."""
    texts = F.filter(F.array(*[clean_text(F.col(c)) for c in options]), lambda t: t.isNotNull())
    topic = F.when(clean_text(F.col("Level")).isNotNull(), F.concat(clean_text(F.col("Subject")), F.lit(" ("), clean_text(F.col("Level")), F.lit(")"))).otherwise(clean_text(F.col("Subject")))
    body = F.concat_ws("\n", F.concat(F.lit("Context: "), clean_text(F.col("Context"))), clean_text(F.col("Question")))
    user = F.concat(F.lit("The following are multiple choice questions (with answers) about "), topic, F.lit(".\n\n"), body, F.lit("\n"), option_lines(texts), F.lit("\nAnswer:"))
    out = df.select("row", user.alias("completion_input"), F.array(message("user", user)).alias("chat_input"), F.col("Answer").alias("ground_truth"), F.size(texts).alias("_n"))
    return out.withColumns(scoring_columns(F.col("_n"))).drop("_n")


def _problem() -> Column:
    user = F.try_element_at(F.filter("chat_input", lambda m: m["role"] == "user"), F.lit(1))["content"]
    return F.coalesce(user, F.regexp_replace("completion_input", rf"\A\Q{ASSISTANT}\E\n\n", ""))


def few_shot_problem(df: DataFrame, preamble: str) -> DataFrame:
    """Completion prompts for problems: the preamble, the first user message (else the old prompt), and a solution mark."""
    return df.withColumn("completion_input", F.concat(F.lit(preamble), F.lit("Problem: "), _problem(), F.lit("\nSolution:")))


def choice_target(target: Column, choices: Column) -> Column:
    """Text of the right choice: a literal match first, then an index; else an error."""
    t = strip(target)
    literal = F.try_element_at(F.filter(choices, lambda c: c == t), F.lit(1))
    index = t.try_cast("int")
    by_index = F.when(index >= 0, F.try_element_at(choices, index + 1))
    return F.coalesce(literal, by_index, F.raise_error(F.lit("the target is no choice")).cast("string"))


def merge_instances(completions: DataFrame, chats: DataFrame, key: str = "doc_id") -> DataFrame:
    """Completion rows with the chat messages of the same document where there are any."""
    return completions.join(chats.select(key, "chat_input"), key, "left")


def short_checks(df: DataFrame, column: str, most: int = 10_000) -> DataFrame:
    """Assert lists without the checks that are longer than ``most`` characters."""
    return df.withColumn(column, F.filter(column, lambda a: F.length(a) <= most))


def by_number(df: DataFrame, column: str) -> DataFrame:
    """Rows numbered by the digits at the end of an identifier."""
    keyed = df.withColumn("_k", F.regexp_extract(column, r"(\d+)\z", 1).cast("bigint"))
    return row_numbers(keyed, ["_k", column]).drop("_k")
