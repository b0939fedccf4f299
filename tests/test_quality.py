"""Gate checks over one wide batch: each case changes the batch or the rules and names what must be reported."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tidepool.operators import quality

SCHEMA = "sku string, lot int, weight double, cost decimal(12,2), grade string, packed_on date"
DAY = dt.date(2023, 5, 4)
BATCH = [("k1", 1, 0.5, decimal.Decimal("10.00"), "A", DAY), ("k1", 2, 7.25, decimal.Decimal("0.01"), "B", DAY),
         ("k2", 1, 3.0, decimal.Decimal("99.99"), "A", None), ("k3", 9, 12.0, None, "C", DAY)]
RULES = {"columns": [c.split()[0] for c in SCHEMA.split(", ")], "not_null": ["sku", "lot"], "unique": ["sku", "lot"],
         "checks": [{"type": "min_value", "column": "cost", "min": 0}, {"type": "min_value", "column": "weight", "min": 0.25},
                    {"type": "accepted_values", "column": "grade", "values": ["A", "B", "C"]}]}
CLEAN = {"columns": ("PASS", "6 columns match"), "row_count": ("PASS", "4 rows match"),
         "not_null": ("PASS", "no nulls in required columns"), "unique": ("PASS", "['sku', 'lot'] unique"),
         "min_value.cost": ("PASS", "all >= 0"), "min_value.weight": ("PASS", "all >= 0.25"),
         "accepted_values.grade": ("PASS", "all values accepted")}


def report(spark, rows, rules, change=None, source=None):
    df = spark.createDataFrame(rows, SCHEMA)
    checks = quality.gate(change(df) if change else df, "parcels", rules, source)
    return {r.check_name: (r.status, r.detail) for r in checks.collect()}


def changed(**rules):
    return {**RULES, **rules}


# name, rows, rules, change to the frame, checks that differ from CLEAN
CASES = [
    ("clean", BATCH, RULES, None, {}),
    ("column gone and column too many", BATCH, changed(columns=["sku", "lot", "weight", "cost", "grade", "origin"]), None,
     {"columns": ("FAIL", "missing=['origin'] unexpected=['packed_on']")}),
    ("no column list", BATCH, changed(columns=None), None,
     {"columns": ("FAIL", "missing=[] unexpected=['cost', 'grade', 'lot', 'packed_on', 'sku', 'weight']")}),
    ("nulls in two columns", BATCH, changed(not_null=["sku", "cost", "packed_on", "no_such"]), None,
     {"not_null": ("FAIL", "nulls found in ['cost', 'packed_on']")}),
    ("NaN is a null", BATCH + [("k4", 1, float("nan"), None, None, None)], changed(not_null=["weight"]), None,
     {"row_count": ("PASS", "5 rows match"), "not_null": ("FAIL", "nulls found in ['weight']")}),
    ("repeated key", BATCH + BATCH[:2], RULES, None,
     {"row_count": ("PASS", "6 rows match"), "unique": ("FAIL", "duplicates in ['sku', 'lot']")}),
    ("null keys are equal", BATCH + [(None, None, 1.0, None, None, None)] * 2, changed(not_null=[]), None,
     {"row_count": ("PASS", "6 rows match"), "not_null": None, "unique": ("FAIL", "duplicates in ['sku', 'lot']")}),
    ("half a key may repeat", BATCH, changed(unique=["lot", "weight"]), None, {"unique": ("PASS", "['lot', 'weight'] unique")}),
    ("no key", BATCH, changed(unique=[]), None, {"unique": None}),
    ("too small, nulls aside", BATCH, RULES, lambda d: d.withColumn("cost", -F.col("cost")),
     {"min_value.cost": ("FAIL", "3 rows < 0")}),
    ("fraction below its bound", BATCH, RULES, lambda d: d.withColumn("weight", F.col("weight") / 4),
     {"min_value.weight": ("FAIL", "1 rows < 0.25")}),
    ("values outside a list", BATCH, changed(checks=[{"type": "accepted_values", "column": "grade", "values": ["B"]},
                                                     {"type": "accepted_values", "column": "lot", "values": [1, 2]}]), None,
     {"min_value.cost": None, "min_value.weight": None, "accepted_values.grade": ("FAIL", "3 rows outside ['B']"),
      "accepted_values.lot": ("FAIL", "1 rows outside [1, 2]")}),
    ("rules on absent columns, unknown rule", BATCH,
     changed(checks=[{"type": "min_value", "column": "height", "min": 1}, {"type": "accepted_values", "column": "hue", "values": []},
                     {"type": "regex", "column": "sku"}]), None,
     {"min_value.cost": None, "min_value.weight": None, "accepted_values.grade": None,
      "min_value.height": ("FAIL", "column height missing"), "accepted_values.hue": ("FAIL", "column hue missing"),
      "unknown_check.regex": ("FAIL", "unknown rule type")}),
    ("empty batch", [], RULES, None, {"row_count": ("PASS", "0 rows match")}),
]


@pytest.mark.parametrize("rows,rules,change,differs", [c[1:] for c in CASES], ids=[c[0] for c in CASES])
def test_gate(spark, rows, rules, change, differs):
    want = {k: v for k, v in {**CLEAN, **differs}.items() if v is not None}
    assert report(spark, rows, rules, change) == want


@pytest.mark.parametrize("source,detail", [(4, "4 rows match"), (11, "source=11 extracted=4")])
def test_rows_against_the_source(spark, source, detail):
    status = "PASS" if source == 4 else "FAIL"
    assert report(spark, BATCH, RULES, source=source)["row_count"] == (status, detail)
    assert report(spark, BATCH, RULES, source=spark.range(source))["row_count"] == (status, detail)


def test_key_that_is_not_there(spark):
    with pytest.raises(quality.GateError):
        report(spark, BATCH, changed(unique=["barcode"]))


@pytest.mark.parametrize("rules,overall,failed", [(None, "SKIPPED", []), ({}, "SKIPPED", []), (RULES, "PASS", []),
                                                  (changed(not_null=["cost"]), "FAIL", ["not_null"])])
def test_verdict(spark, rules, overall, failed):
    got, checks = quality.verdict(quality.gate(spark.createDataFrame(BATCH, SCHEMA), "parcels", rules, 4), rules)
    assert got == overall and [c["check_name"] for c in checks if c["status"] != "PASS"] == failed


def test_summary_lists_failures_in_order(spark):
    rules = changed(not_null=["cost"], checks=[{"type": "regex"}])
    row = quality.overall(quality.gate(spark.createDataFrame(BATCH, SCHEMA), "parcels", rules, 9)).first()
    assert (row.overall, row.failed_checks) == ("FAIL", "row_count, not_null, unknown_check.regex")
