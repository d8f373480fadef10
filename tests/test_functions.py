"""Text, number and rounding rules on hand-computed cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrose.functions import numeric, text
from windrose.functions.quantiles import grouped_quantiles


def one_column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("c", kind)]))


def applied(spark, values, kind, function):
    rows = one_column(spark, values, kind).select(function(F.col("c")).alias("r")).collect()
    return [r.r for r in rows]


def test_strip_removes_every_unicode_space(spark):
    given = ["\t a b \xa0", "　x ", "\x1cx\x85", "  ", None]
    assert applied(spark, given, T.StringType(), text.strip) == ["a b", "x", "x", "", None]
    every_space = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
    assert set(text.WHITESPACE) == set(every_space)


def test_strip_equals_python(spark):
    rng = random.Random(6)
    given = ["".join(rng.choices(" \t\xa0\u3000ab", k=rng.randrange(6))) for _ in range(500)]
    assert applied(spark, given, T.StringType(), text.strip) == [x.strip() for x in given]
    # The list of all white space is only for texts that a plain trim leaves with some.
    plan = spark.range(1).select(text.strip(F.col("id").cast("string")))._jdf.queryExecution().toString()
    assert "trim(cast(id" in plan and "CASE WHEN" in plan


def test_numbers_reject_what_is_not_decimal(spark):
    given = ["1", " 2.5 ", "-3e2", "inf", "-Infinity", "1d", "2F", "0x1p3", "nan", "n/a", "", None]
    expected = [1.0, 2.5, -300.0, math.inf, -math.inf] + [None] * 7
    assert applied(spark, given, T.StringType(), text.number) == expected


def test_truthy_follows_json_scalars(spark):
    given = ["true", "false", "0", "0.0", "1", "2", "", None]
    expected = [True, False, False, False, True, True, False, False]
    assert applied(spark, given, T.StringType(), text.truthy) == expected


def test_csv_flags_accept_only_true(spark):
    given = ["True", "true", "False", "1", "yes", None]
    expected = [True, True, False, False, False, False]
    assert applied(spark, given, T.StringType(), text.csv_flag) == expected


def test_flag_words(spark):
    given = [" T ", "Yes", "y", "1", "TRUE", "1.0", "on", "no", "", None]
    expected = [True] * 5 + [False] * 5
    assert applied(spark, given, T.StringType(), text.flag_word) == expected


def test_missing_tokens(spark):
    given = ["NA", "None", "", "null", "Namibia", "na", None]
    expected = [None, None, None, None, "Namibia", "na", None]
    assert applied(spark, given, T.StringType(), text.csv_null) == expected


def test_rounding_rules_differ_on_ties(spark):
    given = [0.125, 0.375, 1.005, -0.125, None]

    def rounded(rule):
        return applied(spark, given, T.DoubleType(), lambda c: rule(c, 2))

    assert rounded(numeric.half_even) == [0.12, 0.38, 1.0, -0.12, None]
    assert rounded(numeric.half_up) == [0.13, 0.38, 1.0, -0.13, None]


def test_half_even_equals_numpy(spark):
    random.seed(1)
    given = [random.randrange(-10**7, 10**7) / 1000 for _ in range(3000)]
    ours = applied(spark, given, T.DoubleType(), lambda c: numeric.half_even(c, 2))
    assert ours == list(np.round(given, 2))


@pytest.mark.parametrize(
    "values, expected",
    [
        ([0.1] * 10, 0.1), ([1.5, None, 2.5], 2.0), ([None], None), ([1e21, 1e21, -2e21], 0.0),
        ([1.0, math.inf], math.inf), ([1.0, math.nan], "nan"), ([math.inf, -math.inf], "nan"),
    ],
)
def test_exact_mean(spark, values, expected):
    df = one_column(spark, values, T.DoubleType())
    found = df.agg(numeric.exact_mean(F.col("c")).alias("m")).first().m
    assert math.isnan(found) if expected == "nan" else found == expected


def test_sums_fail_on_what_they_cannot_hold(spark):
    for value in (1e22, -1e300, math.inf, math.nan):
        with pytest.raises(Exception, match="No exact sum"):
            one_column(spark, [1.0, value], T.DoubleType()).agg(numeric.exact_sum(F.col("c"))).collect()


def test_clip_keeps_null(spark):
    ours = applied(spark, [-1.0, 50.0, 101.0, None], T.DoubleType(), lambda c: numeric.clip(c, 0, 100))
    assert ours == [0.0, 50.0, 100.0, None]


def test_quantiles_equal_numpy(spark):
    random.seed(2)
    rows = []
    for group in range(12):
        for _ in range(random.randrange(1, 300)):
            value = random.choice(
                [None, random.gauss(0, 1e4), float(random.randrange(5)), random.uniform(-1e-6, 1e-6)]
            )
            rows.append((group, value))
    df = spark.createDataFrame(rows, "g int, v double")
    measures = {"p90": (F.col("v"), 0.9), "mid": (F.col("v"), 0.5), "least": (F.col("v"), 0.0)}
    ours = {r.g: r for r in grouped_quantiles(df, ["g"], measures).collect()}
    for group in range(12):
        values = [v for g, v in rows if g == group and v is not None]
        if not values:
            assert group not in ours
            continue
        for name, p in (("p90", 0.9), ("mid", 0.5), ("least", 0.0)):
            assert ours[group][name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_of_a_measure_without_values(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 4.0, None)], "g int, a double, b double")
    measures = {"a": (F.col("a"), 0.5), "b": (F.col("b"), 0.5)}
    assert [tuple(r) for r in grouped_quantiles(df, ["g"], measures).collect()] == [(1, 3.0, None)]


def test_quantiles_with_infinities(spark):
    values = [-math.inf, 1.0, 2.0, math.inf, math.inf]
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    measures = {f"p{i}": (F.col("v"), i / 4) for i in range(5)}
    ours = grouped_quantiles(df, ["g"], measures).drop("g").first()
    assert list(ours) == values
