import re

import pytest
from pyspark.sql import functions as F

from siglake.functions import numbers, text
from siglake.model import nan_to_null, with_keys_present


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_like_folds_ascii_only_and_has_no_escape(spark):
    like = lambda pattern: (lambda c: text.ascii_like(c, pattern))
    assert evaluate(spark, ["CBR:Vector", "cbx"], like("cbr%")) == [True, False]
    assert evaluate(spark, ["Ä", "ä"], like("ä")) == [False, True]
    assert evaluate(spark, ["a\\b", "a\\%b", "a_b"], like("a\\%b")) == [True, True, False]


def test_pattern_is_searched_with_python_semantics(spark):
    pattern = text.Pattern(r"Distance_(?P<index>[0-9]{1,2})(-(?P<part_no>\d+))?:vector")
    names = ["PdrDistance_7:vector", "Distance_12-3:vector", "other"]
    assert evaluate(spark, names, pattern.found) == [True, True, False]
    assert evaluate(spark, names, lambda c: pattern.group(c, "index")) == ["7", "12", None]
    expected = [
        "pdr_{index}_{part_no}".format(**m.groupdict()) for m in map(re.compile(pattern.source).search, names[:2])
    ]
    assert evaluate(spark, names[:2], lambda c: pattern.format(c, "pdr_{index}_{part_no}")) == expected
    assert expected[0] == "pdr_7_None"


def test_pattern_group_that_may_be_empty_stays_empty(spark):
    pattern = text.Pattern("a(?P<x>[0-9]*)b")
    assert evaluate(spark, ["ab", "a1b"], lambda c: pattern.format(c, "<{x}>")) == ["<>", "<1>"]


@pytest.mark.parametrize("source", [r"[[a]+", r"[a&&b]x", r"é\d", r"(?P<a>x)(?P=a)1?$", r"end\Z", "a.c"])
def test_pattern_agrees_with_python(spark, source):
    values = ["[a", "&x", "é٣", "xx1", "xx", "the end", "end\n", "a\rc", "a\nc", "bx"]
    expected = [re.search(source, v) is not None for v in values]
    assert evaluate(spark, values, text.Pattern(source).found) == expected


def test_template_with_format_spec_is_rejected():
    with pytest.raises(ValueError):
        text.Pattern("(?P<x>a)").format(F.lit("a"), "{x:>5}")


def test_natural_order(spark):
    values = ["a10", "x-0.5", "a2", "10", "1.5", "9", "a", "007", "7", "b-2 c", "b-10 c", "a.b", "Z"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    ordered = [r[0] for r in df.orderBy(text.natural_key(F.col("v")), "v").collect()]
    assert ordered == ["1.5", "007", "7", "9", "10", "Z", "a", "a2", "a10", "a.b", "b-2 c", "b-10 c", "x-0.5"]


def test_fields(spark):
    values = ["a_b_c", "abc"]
    assert evaluate(spark, values, lambda c: text.field(c, "_", 1)) == ["b", None]
    assert evaluate(spark, values, lambda c: text.field(c, "_", -1)) == ["c", "abc"]
    assert evaluate(spark, ['"x"', "x"], lambda c: text.strip(c, '"')) == ["x", "x"]
    assert evaluate(spark, ["5s+3s"], lambda c: text.remove(c, "s")) == ["5+3"]


def test_eval_sum(spark):
    values = ["5", "5+3", "5-3", "2.5+1", "-5", "a", "1+2+3", "", "3 + 4", None]
    assert evaluate(spark, values, numbers.eval_sum) == [5, 8, 2, 3.5, None, None, None, None, 7, None]


def test_parsing_numbers(spark):
    values = ["1.5", " 2 ", "1e3", "x", "1.5f", "-.5", "nan", "inf", None]
    assert evaluate(spark, values, numbers.to_double) == [1.5, 2, 1000, None, None, -0.5, None, float("inf"), None]
    assert evaluate(spark, ["5", " -7 ", "5.0", "x"], numbers.to_long) == [5, -7, None, None]


def test_bins_are_cut_toward_zero(spark):
    values = [-0.5, 0.5, -1.0, 7.9, -7.9]
    assert evaluate(spark, values, lambda c: numbers.truncated_bin(c, 2.0), "double") == [0, 0, 0, 6, -6]
    assert evaluate(spark, [250_000_000_000, -1], lambda c: numbers.time_bucket(c), "long") == [0.2, 0.0]
    assert evaluate(spark, [5 * 10**12], numbers.simtime_seconds, "long") == [5.0]


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, k string")
    assert [r.x for r in nan_to_null(df).orderBy("k").collect()] == [1.0, None, None]
    assert [r.k for r in with_keys_present(df, ["x"]).collect()] == ["a"]
