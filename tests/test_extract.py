from pyspark.sql import functions as F

from evalyard.functions import extract as E


def pick(spark, c, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(c).collect()]


def test_tool_calls_and_arguments(spark):
    t = 'a <tool_call>{"name": "f", "arguments": {"x": 1}}</tool_call><tool_call>bad</tool_call> <tool_call>{"name": ""}</tool_call><tool_call>{"name": "g"}</tool_call>'
    a, b = pick(spark, E.tool_calls(F.col("t")), t, "none")
    assert [tuple(x) for x in a] == [("call_0", "f", '{"x":1}'), ("call_3", "g", "{}")] and b == []
    got = pick(spark, E.argument_pairs(F.col("t")), "f <arg_key>k</arg_key><arg_value> 1 </arg_value> <arg_key>k</arg_key>\n<arg_value>2</arg_value>")
    assert got == [{"k": "2"}]


def test_split_think(spark):
    got = pick(spark, E.split_think(F.col("t")), "<think>\na\n</think>\n\nb", "a</think_fast>b", "plain", None)
    assert [tuple(x) for x in got] == [("a", "b"), ("a", "b"), ("", "plain"), ("", "")]


def test_code(spark):
    assert pick(spark, E.fenced_code(F.col("t")), "x\n```py\na\n```\n```\nb\n```", "```\nopen", "none") == ["a", "open", ""]
    assert pick(spark, E.function_body(F.col("t"), "f"), 'def f(a) -> int:\n    """doc"""\n    return 1', "    return 2") == ["    return 1", "    return 2"]


def test_formulas(spark):
    cases = {"\\text{ yes}": "yes", "x = 5": "5", "\\dfrac12": "\\frac{1}{2}", "3/4": "\\frac{3}{4}", "0.5": "\\frac{1}{2}", ".5": "\\frac{1}{2}", "\\sqrt3": "\\sqrt{3}", "5\\text{ cm}": "5", "90^\\circ": "90", "2 \\left( x \\right)": "2(x)"}
    assert dict(zip(cases, pick(spark, E.normal_formula(F.col("t")), *cases))) == cases
    assert pick(spark, E.tuple_parts(F.col("t")), "(1, 2]", "x") == [["1", "2"], ["x"]]


def test_job_names(spark):
    assert tuple(pick(spark, E.job_parts(F.col("t")), "m-1--7")[0]) == ("m-1", "7")
