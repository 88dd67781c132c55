import pytest
from pyspark.sql import functions as F

from evalyard.operators import datasets as D


def test_shuffled_choice_has_the_known_order(spark):
    rows = [(0, "Q1?", "Correct 1", ["Wrong 1a", "Wrong 1b", "Wrong 1c"]), (1, "Q2?", "Correct 2", ["Wrong 2a", "Wrong 2b", "Wrong 2c"])]
    got = D.shuffled_choice(spark.createDataFrame(rows, "row int, question string, correct string, incorrect array<string>")).orderBy("row").collect()
    assert [r.ground_truth for r in got] == ["D", "A"]
    assert got[0].chat_input[1].content == "Q1?\nA. Wrong 1c\nB. Wrong 1a\nC. Wrong 1b\nD. Correct 1\nAnswer:"
    assert got[1].completion_input.endswith("Q2?\nA. Correct 2\nB. Wrong 2a\nC. Wrong 2c\nD. Wrong 2b\nAnswer:")


def test_science_choice(spark):
    schema = "row int, question string, labels array<string>, texts array<string>, answer string"
    df = spark.createDataFrame([(0, " q ", ["1", "2"], ["x", "y"], "2")], schema)
    shots = spark.createDataFrame([(1, "s", ["A", "B"], ["u", "v"], "a")], schema)
    r = D.science_choice(df, shots).first()
    assert r.ground_truth == "B" and r.scoring_completions == ["A", "B"]
    assert r.chat_input[1].content == "Question:\ns\nChoices:\nA. u\nB. v\nAnswer: A\n\nQuestion:\nq\nChoices:\nA. x\nB. y\nAnswer:"
    with pytest.raises(Exception, match="fit"):
        D.science_choice(spark.createDataFrame([(0, "q", ["1", "2"], ["x", "y"], "3")], schema)).collect()


def test_category_choice(spark):
    test = spark.createDataFrame([(0, "a_b", "q", ["x", "y"], "A"), (1, "c", "r", ["z", "w"], "B")], "row int, category string, question string, options array<string>, answer string")
    val = spark.createDataFrame([(5, "a_b", "s", ["k", "l"], "B", "A: so B")], "row int, category string, question string, options array<string>, answer string, cot string")
    a, c = D.category_choice(test, val).orderBy("row").collect()
    assert "about a b. " in a.completion_input and "Answer: so B\n\nQuestion:\nq" in a.completion_input
    assert a.scoring_prompt_prefix.endswith("Answer: B\n\nQuestion:\nq\nOptions:\nA. x\nB. y\nAnswer:")
    assert "Question:\nr" in c.completion_input and c.completion_input.count("Question:") == 1


def test_small_pieces(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c).first()[0]
    assert pick(D.corrected_letter(F.lit(0), F.lit(" 2 "))) == "C" and pick(D.corrected_letter(F.lit(1), F.lit("none"))) == "B" and pick(D.corrected_letter(F.lit(1), F.lit(None).cast("string"))) == "B"
    assert pick(D.choice_target(F.lit("1"), F.array(F.lit("a"), F.lit("b")))) == "b" and pick(D.choice_target(F.lit("a"), F.array(F.lit("a"), F.lit("b")))) == "a"
    assert pick(D.source_text(F.lit(" a [title]b [x] c"))) == "a. b c"
    images = spark.createDataFrame([(0, "q", "A", "multipleChoice", "c", "i", None), (1, "q", "A", "exactMatch", "c", "i", "img"), (2, " q", "z", "exactMatch", "c", "i", "")], "row int, question string, answer string, answer_type string, category string, id string, image string")
    got = D.text_questions(images).orderBy("row").collect()
    assert [r.row for r in got] == [0, 2] and got[0].chat_input[1].content == "q\nAnswer:" and got[1].completion_input.endswith(f"{D.FINAL_ONLY}\n\nq")
    topic = spark.createDataFrame([(0, "Q", " ", "S", "L", "A", "x", "", "y")], "row int, Question string, Context string, Subject string, Level string, Answer string, o1 string, o2 string, o3 string")
    assert D.topic_choice(topic, ["o1", "o2", "o3"]).first().completion_input.endswith("about S (L).\n\nQ\nA. x\nB. y\nAnswer:")
    assert [r.row for r in D.by_number(spark.createDataFrame([("t/10",), ("t/9",)], "id string"), "id").orderBy("id").collect()] == [1, 0]
    assert D.short_checks(spark.createDataFrame([(["a", "b" * 11],)], "t array<string>"), "t", 10).first().t == ["a"]
