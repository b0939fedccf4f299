"""Semantic hazards: null order, ties, gate-vs-suite uniqueness, CSV dialect,
abort on a bad value, calendar edge, natural-key duplicates, members fan-out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepool.operators import constraints, quality
from tidepool.plans import dims, marts
from tidepool.plans.models import Models
from tidepool.sources import lake

CONTACT = "customer_phone string, customer_name string, email string, created_at timestamp"


def test_latest_customer_null_created_at_wins(spark):
    df = spark.createDataFrame([("p1", "old", "a@x", dt.datetime(2024, 1, 1)), ("p1", "nul", None, None)], CONTACT)
    rows = dims.latest_customers(df).collect()
    assert [(r.customer_phone, r.customer_name) for r in rows] == [("p1", "nul")]


def test_latest_customer_tie_breaks_on_email(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("p1", "b", None, ts), ("p1", "a", "a@x", ts)], CONTACT)
    assert dims.latest_customers(df).collect()[0].email == "a@x"


def test_unique_gate_vs_suite_nulls(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id long")
    gate = [r for r in quality.gate(df, "t", {"unique": ["id"]}).collect() if r.check_name == "unique"][0]
    assert gate.status == "FAIL"
    suite = constraints.run_suite(spark, {"t": df}, [("", "t", "id", "unique", None)]).collect()[0]
    assert suite.failing_rows == 0 and suite.status == "PASS"


def test_csv_dialect_roundtrip(spark, workdir, tmp_path):
    path = tmp_path / "raw" / "f.csv"
    path.parent.mkdir(parents=True)
    path.write_text('id,name,price,ok\n1,"a ""q"" x\nline2",10.0,True\n2,,,\n3,"",NULL,False\n4,short\n'
                    '5,x,7,True,extra\n')
    df = lake.read_csv_text(spark, str(path.parent), ["id", "name", "price", "ok"])
    rows = {r.id: r for r in df.collect()}
    assert len(rows) == 5
    assert rows["1"].name == 'a "q" x\nline2'
    assert rows["2"].name is None and rows["2"].price is None
    assert rows["3"].name is None and rows["3"].price is None and rows["3"].ok == "False"
    assert rows["4"].name == "short" and rows["4"].price is None
    assert rows["5"].ok == "True"


def test_bad_value_aborts_load_and_keeps_previous(spark, workdir):
    from tidepool.plans import jobs
    from tidepool.schema import CONTRACTS
    cols = CONTRACTS["site_settings"].fieldNames()
    good = spark.createDataFrame([("1", "k", "v", None, "2024-01-01 00:00:00")], ", ".join(f"{c} string" for c in cols))
    jobs.ingest(spark, {"site_settings": good}, workdir, "b1", rules={}, fmt="csv",
                    ingest_date=dt.date(2026, 8, 9))
    ok = jobs.load_staging(spark, workdir, ["site_settings"], "b1", fmt="csv")
    assert ok[0]["status"] == "SUCCESS" and ok[0]["rows_loaded"] == 1
    bad = good.withColumn("updated_at", F.lit("abc"))
    jobs.ingest(spark, {"site_settings": bad}, workdir, "b2", rules={}, fmt="csv",
                    ingest_date=dt.date(2026, 8, 10))
    rec = jobs.load_staging(spark, workdir, ["site_settings"], "b2", fmt="csv")[0]
    assert rec["status"] == "FAILED" and "rows_loaded" not in rec
    served = spark.read.parquet(jobs.staging_path(workdir, "site_settings")).collect()
    assert len(served) == 1 and served[0].updated_at == dt.datetime(2024, 1, 1)


def test_outside_calendar_gets_null_date(spark):
    fact = spark.createDataFrame([(20350101, "treatment", 1, 1, 2)],
                                 "date_key int, source string, gross_amount long, discount_amount long, net_amount long")
    dd = dims.dim_date(spark, "2020-01-01", 3650)
    row = marts.mart_revenue_daily(fact, dd).collect()[0]
    assert row.transaction_date is None
    suite = constraints.run_suite(spark, {"m": marts.mart_revenue_daily(fact, dd)},
                                  [("", "m", "transaction_date", "not_null", None)]).collect()[0]
    assert suite.status == "FAIL"


def test_default_calendar_shape(spark):
    dd = dims.dim_date(spark)
    assert dd.count() == 3650
    last = dd.orderBy(F.col("date_key").desc()).first()
    assert last.full_date == dt.date(2029, 12, 28) and last.date_key == 20291228
    first = dd.orderBy("date_key").first()
    assert (first.month_name, first.day_of_week, first.quarter) == ("Jan", "Wed", 1)


def test_natural_key_duplicates_in_lineitem(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    r = [x for x in quality.gate(li, "lineitem", {"unique": ["l_orderkey", "l_linenumber"]}).collect()
         if x.check_name == "unique"][0]
    assert r.status == "FAIL"
    distinct = li.select("l_orderkey", "l_linenumber").distinct().count()
    assert distinct < li.count()


def test_members_fan_out(spark):
    ts = dt.datetime(2024, 1, 1)
    bg = spark.createDataFrame([("g1", "ann", "p1", "a@x", ts)],
                               "id string, customer_name string, customer_phone string, email string, created_at timestamp")
    tx = spark.createDataFrame([], "customer_phone string, customer_name string, created_at timestamp")
    members = spark.createDataFrame([("m1", "p1", ts, 3), ("m2", "p1", ts, 4)],
                                    "id string, phone string, joined_date timestamp, total_visits long")
    dc = dims.dim_customer(bg, tx, members)
    assert dc.count() == 2
    r = constraints.run_suite(spark, {"dim_customer": dc}, [("", "dim_customer", "customer_phone", "unique", None)]) \
        .collect()[0]
    assert r.status == "FAIL" and r.failing_rows == 1


def test_null_discount_makes_gross_null(spark):
    from tidepool.plans import facts
    tx = spark.createDataFrame([("1", "p", 100, None, "treatment", ts := dt.datetime(2024, 1, 2))],
                               "id string, customer_phone string, total_price long, discount_amount long, "
                               "source string, created_at timestamp")
    row = facts.fact_transactions(tx).collect()[0]
    assert row.gross_amount is None and row.net_amount == 100 and row.date_key == 20240102 and ts


def test_recency_counts_calendar_days(spark):
    dc = spark.createDataFrame([("k", "p", "n", None, False, None, None)],
                               "customer_key string, customer_phone string, customer_name string, email string, "
                               "is_member boolean, member_joined_date timestamp, total_visits long")
    ft = spark.createDataFrame([("k", 1, 1, 1, dt.datetime(2023, 12, 31, 23, 59))],
                               "customer_key string, gross_amount long, discount_amount long, net_amount long, "
                               "transaction_timestamp timestamp")
    row = marts.mart_customer_analytics(dc, ft, "2024-01-01").collect()[0]
    assert row.days_since_last_transaction == 1 and row.avg_transaction_value == 1.0


def test_models_reuse_one_plan_per_model(spark):
    m = Models(spark, {})
    assert m["dim_date"] is m["dim_date"]


@pytest.mark.parametrize("policy,expected", [("continue", 3), ("stop", 1)])
def test_error_policy(spark, workdir, policy, expected):
    from tidepool.plans import jobs
    df = spark.createDataFrame([(1,)], "id long")
    sources = {t: df for t in ["a", "b", "c"]}
    rules = {t: {"columns": ["nope"]} for t in sources}
    recs = jobs.ingest(spark, sources, workdir, "p", rules=rules, error_policy=policy)
    assert len(recs) == expected and all(r["status"] == "VALIDATION_FAILED" for r in recs)


def test_operations_mart_meets_repeated_bookings(spark):
    """An id that is delivered twice: each activity meets both rows, as a join does."""
    from tidepool.plans import facts
    ts = dt.datetime(2024, 1, 2)
    logs = spark.createDataFrame([("7", "treatment", "/a", "booked", "g", 10, "x", ts, "t"), ("7", "treatment", "/a", "booked", "g", 10, "x", ts, "t")],
                                 "id string, item_type string, source_page string, status string, group_id string, price long, "
                                 "guest_name string, scheduled_date timestamp, treatment_id string")
    groups = spark.createDataFrame([("g", "+1")], "id string, customer_phone string")
    mart = marts.mart_operations_booking(facts.fact_treatment_activities(logs, groups), logs, dims.dim_date(spark)).collect()
    assert [(r.booking_count, r.booking_revenue) for r in mart] == [(4, 40)]


def test_suite_unique_treats_signed_zero_as_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "x double")
    got = constraints.run_suite(spark, {"m": df}, [("", "m", "x", "unique", None)]).first()
    assert got.failing_rows == 1   # 0.0 and -0.0 are one value, on two rows


def test_date_keys_use_the_pinned_utc_zone(spark):
    """H6: date keys come from UTC calendar days, whatever zone the session had."""
    from tidepool.functions import date_key
    from tidepool.session import configure
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
        configure(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        df = spark.createDataFrame([("2024-01-01 23:30:00",)], "ts string").select(F.col("ts").cast("timestamp").alias("ts"))
        assert df.select(date_key("ts").alias("k")).first().k == 20240101
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
