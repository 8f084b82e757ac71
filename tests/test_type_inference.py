"""Type rules T0-T5: thresholds at and around their limits, order of the rules, empty columns."""

import datetime as dt

import pytest

from starforge import config as C
from starforge.operators import infer
from starforge.operators.clean import na_tokens


def _infer(spark, values, markers=False):
    df = spark.createDataFrame([(v,) for v in values], "cell string")
    typed, labels = infer.infer_and_cast(na_tokens(df) if markers else df, cfg=C.Config.load())
    return [r[0] for r in typed.collect()], labels["cell"], typed.schema["cell"].dataType.typeName()


@pytest.mark.parametrize("numbers, label", [(7, "numeric"), (6, "string")])
def test_numeric_threshold(spark, numbers, label):
    """Seven of ten values must be numbers."""
    values = [str(k * 1.25 + 0.5) for k in range(numbers)] + ["pear", "plum", "fig", "kiwi"][:10 - numbers]
    got, found, _ = _infer(spark, values)
    assert found == label
    if label == "numeric":
        assert sum(v is None for v in got) == 10 - numbers


@pytest.mark.parametrize("dates, label", [(7, "datetime"), (6, "string")])
def test_datetime_threshold(spark, dates, label):
    values = [f"1999-1{k % 3}-0{k + 1}" for k in range(dates)] + ["soon", "later", "never", "maybe"][:10 - dates]
    assert _infer(spark, values)[1] == label


@pytest.mark.parametrize("flags, label", [(18, "boolean"), (17, "string")])
def test_boolean_threshold(spark, flags, label):
    """Nine of ten values must be in the vocabulary."""
    values = ["yes" if k % 2 else "no" for k in range(flags)] + ["perhaps"] * (20 - flags)
    if _infer(spark, ["yes", "no"])[1] != "boolean":
        values = [{"yes": "TRUE", "no": "false"}.get(v, v) for v in values]
    assert _infer(spark, values)[1] == label


def test_markers_do_not_count(spark):
    got, label, _ = _infer(spark, ["-3", "NULL", "n/a", "18", "", "0"], markers=True)
    assert label == "numeric" and got == [-3, None, None, 18, None, 0]


def test_numbers_win_over_dates(spark):
    """Eight digits could be a day; a column of them is numeric."""
    got, label, kind = _infer(spark, ["20191231", "20200229", "19700101"])
    assert (label, kind) == ("numeric", "long") and got[1] == 20200229


def test_fraction_makes_the_column_double(spark):
    assert _infer(spark, ["4", "5", "6.5"])[2] == "double"
    assert _infer(spark, ["4", "5", "6"])[2] == "long"


def test_long_identifiers_keep_their_digits(spark):
    got, label, kind = _infer(spark, ["9223372036854775807", "-9223372036854775808", "12"])
    assert (label, kind) == ("numeric", "long") and got[0] == 9223372036854775807 and got[1] == -9223372036854775808


def test_day_first_only_where_month_first_fails(spark):
    got, label, _ = _infer(spark, ["31/12/2001", "01/02/2003"])
    assert label == "datetime" and got == [dt.datetime(2001, 12, 31), dt.datetime(2003, 1, 2)]


def test_month_first_in_mixed_shapes(spark):
    got, label, _ = _infer(spark, ["2011-10-09", "07/04/2012", "2013-02-28"])
    assert label == "datetime" and got[1] == dt.datetime(2012, 7, 4)


def test_empty_text_is_not_null(spark):
    got, label, _ = _infer(spark, ["rain", "", "snow and hail"])
    assert label == "string" and got[1] == ""


def test_nothing_known_is_empty(spark):
    assert _infer(spark, [None] * 4)[1] == "empty"


def test_counting_by_value_or_by_cell_gives_one_result(spark):
    """Columns of repeated, of all different and of no values, on either path."""
    from pyspark.sql import functions as F
    df = spark.range(3_000).select(
        F.element_at(F.array(*[F.lit(x) for x in ("true", " no ", "7", "2026-01-02", "x", "1e3", "9999999999999999999", "June 3, 2020")]), (F.col("id") % 8 + 1).cast("int")).alias("few"),
        F.concat(F.lit("2026-01-01 00:00:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"), F.lit("."), F.col("id").cast("string")).alias("all"),
        F.lit(None).cast("string").alias("none"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("holes"))
    rows = lambda repeated: sorted(map(tuple, infer.column_stats(df, cfg=C.Config.load(), repeated=repeated).collect()))
    assert rows([]) == rows([0, 1, 2, 3]) == rows([0]) == rows([2, 3])
    days = df.select("few", "all", F.concat(F.lit("2026-01-"), F.lpad((F.length("all") % 28 + 1).cast("string"), 2, "0")).alias("day"))
    assert infer.repeated_dates([(df, df.columns), (days, days.columns)]) == [[], [2]]
    few = next(r for r in rows([]) if r[0] == "few")
    assert few[2:] == (3_000, 3_000, 750, 1_125, 375, 750)
