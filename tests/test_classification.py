"""Classification C1/C2 on column catalogs, natural id C3."""

import pytest

from starforge.operators import star

SCHEMA = "domain string, entity string, column string, position int, type_class string, null_free boolean"


def _classes(spark, tables, overrides=None):
    rows = [("yard", e, n, i, t, free) for e, cols in tables.items() for i, (n, t, free) in enumerate(cols)]
    ov = None if overrides is None else spark.createDataFrame(overrides, "domain string, entity string, forced string")
    return {r["entity"]: r["class"] for r in star.classify(spark.createDataFrame(rows, SCHEMA), ov).collect()}


def _cols(*spec):
    return [(n, t, True) for n, t in spec]


def test_rules_at_their_limits(spark):
    got = _classes(spark, {
        "one_id": _cols(("berth_id", "string"), ("side", "string")),
        "two_ids": _cols(("berth_id", "string"), ("crane_id", "string")),
        "numeric_id": _cols(("berth_id", "numeric"), ("side", "string")),
        "one_number": _cols(("berth_id", "string"), ("depth", "numeric")),
        "one_date": _cols(("side", "string"), ("built", "datetime")),
        "two_dates": _cols(("built", "datetime"), ("closed", "datetime")),
        "lineage_only": _cols(("side", "string"), ("_source_id", "string"), ("_n", "numeric")),
    })
    assert got == {"one_id": "dimension", "two_ids": "fact", "numeric_id": "dimension", "one_number": "fact",
                   "one_date": "dimension", "two_dates": "fact", "lineage_only": "dimension"}


def test_boolean_is_a_measure_only_without_nulls(spark):
    got = _classes(spark, {"whole": [("berth_id", "string", True), ("lit", "boolean", True)],
                           "holes": [("berth_id", "string", True), ("lit", "boolean", False)]})
    assert got == {"whole": "fact", "holes": "dimension"}


@pytest.mark.parametrize("override, want", [
    (("yard", "calls", "dimension"), "dimension"), (("yard", "other", "dimension"), "fact"),
    (("harbour", "calls", "dimension"), "fact"), (("yard", "calls", "table"), "fact")])
def test_overrides(spark, override, want):
    tables = {"calls": _cols(("ship_id", "string"), ("berth_id", "string"))}
    assert _classes(spark, tables, [override]) == {"calls": want}


def test_natural_id(spark):
    df = spark.createDataFrame([("x", "y", "z")], "side string, crane_id string, berth_id string")
    assert star.natural_id(df) == "crane_id"
    assert star.natural_id(df.select("side")) == "side"
