"""One key holding a third of all rows: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators import constraints, quality
from tidepool.plans import dims, marts


def _skewed(spark, n=3000):
    # every third row belongs to phone "hot"
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id").cast("string")))
        .alias("customer_phone"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("customer_name"),
        F.lit(None).cast("string").alias("email"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp") + F.make_interval(secs=F.col("id"))).alias("created_at"))


def test_latest_row_on_hot_key(spark):
    out = dims.latest_customers(_skewed(spark)).where(F.col("customer_phone") == "hot").collect()
    assert len(out) == 1 and out[0].customer_name == "n2997"


def test_aggregates_on_hot_key(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("customer_key"),
        F.lit(1).cast("long").alias("gross_amount"), F.lit(0).cast("long").alias("discount_amount"),
        F.lit(2).cast("long").alias("net_amount"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp").alias("transaction_timestamp"))
    hot = marts.customer_agg(fact).where(F.col("customer_key") == "hot").first()
    assert hot.transaction_count == 1000 and hot.total_net == 2000


def test_gate_and_suite_on_hot_key(spark):
    df = _skewed(spark)
    rows = {r.check_name: r for r in quality.gate(df, "t", {"unique": ["customer_phone"]}).collect()}
    assert rows["unique"].status == "FAIL" and rows["unique"].bad_rows == 1
    suite = constraints.run_suite(spark, {"m": df}, [("", "m", "customer_phone", "unique", None)]).first()
    assert suite.failing_rows == 1   # one value, on 1000 rows


def test_hot_group_join_is_split_by_aqe(spark):
    """One booking group holds a third of the bookings: AQE splits that partition of
    the sort-merge join (the broadcast path is switched off to force the shuffle join)."""
    from tidepool.plans import facts
    n = 30000
    bookings = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.lit("treatment").alias("item_type"),
        F.when(F.col("id") % 3 == 0, F.lit("g-hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5000).cast("string")))
        .alias("group_id"),
        F.lit(100).cast("long").alias("price"), F.lit("guest").alias("guest_name"), F.lit("booked").alias("status"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp").alias("scheduled_date"),
        (F.col("id") % 40).cast("string").alias("treatment_id"))
    groups = spark.range(5000).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("id"),
                                      F.concat(F.lit("+62"), F.col("id").cast("string")).alias("customer_phone")) \
        .unionByName(spark.createDataFrame([("g-hot", "+62hot")], "id string, customer_phone string"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = facts.fact_treatment_activities(bookings, groups)
        rows = fact.groupBy(F.col("customer_key").isNull().alias("orphan")).count().collect()
        qe = fact._jdf.queryExecution()
        qe.toRdd().count()                       # run this very plan so AQE finalises it
        plan = qe.executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan, plan
        assert {r.orphan: r["count"] for r in rows} == {False: n}
        hot = fact.where(F.col("customer_key") == F.md5(F.lit("+62hot"))).count()
        assert hot == n // 3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
