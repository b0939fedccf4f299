"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables at ``sf_dir`` through the fixture
bindings, so its work grows with the data. ``ORACLE`` holds the matching
DuckDB statement for each key (absent only where no SQL equivalent exists).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import oracle
from tidepool.config import load_rules, load_tests
from tidepool.functions import date_key, surrogate_key
from tidepool.operators import calendar, constraints, quality, uniqueness
from tidepool.operators.joins import HOT_SHARE
from tidepool.plans import dims, facts, jobs, marts
from tidepool.plans.models import (ALL_MODELS, FIXTURE_AS_OF, FIXTURE_CALENDAR_DAYS, FIXTURE_CALENDAR_START,
                                   fixture_models, selected)
from tidepool.schema import CONTRACTS, SOURCE_TABLES
from tidepool.session import configure, scratch_path
from tidepool.sources import audit, catalog, lake
from tidepool.sources.bindings import BINDINGS, bind, bind_all, scan_table
from tidepool.sources.profile import profile
from tidepool.sources.staging import apply_contract, contract_drift, contract_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _require(ok: bool, context) -> None:
    """Stop a write-path query whose job did not end as expected (never silently)."""
    if not ok:
        raise RuntimeError(f"job did not end as expected: {context}")
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _models(spark: SparkSession, sf_dir: str):
    configure(spark)
    return fixture_models(spark, bind_all(spark, sf_dir))


def _model_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _models(spark, sf_dir)[name]
    run.__name__ = f"q_{name}"
    return run


for _m in ALL_MODELS:
    if _m != "dim_date":
        register(f"q_{_m}", oracle.model(_m))(_model_query(_m))


@register("q_dim_date", oracle.model("dim_date"))
def q_dim_date(spark, sf_dir):
    """M1/G1 over the facts' own years: the window is part of the plan, no job runs while it is built."""
    configure(spark)
    return calendar.calendar_of(calendar.covering_spine([
        bind(spark, sf_dir, "transactions").select("created_at"),
        bind(spark, sf_dir, "completed_items").select("created_at"),
        bind(spark, sf_dir, "booking_logs").select("scheduled_date")]))


# ---------------------------------------------------------------------------
# Primitive queries over the model building blocks
# ---------------------------------------------------------------------------


@register("q_surrogate_keys", oracle.compose(
    "SELECT id, md5(id) AS transaction_key, md5(customer_phone) AS customer_key FROM transactions"))
def q_surrogate_keys(spark, sf_dir):
    """MD5 surrogate keys of the transactions (NULL phone -> NULL customer key)."""
    configure(spark)
    t = bind(spark, sf_dir, "transactions")
    return t.select("id", surrogate_key("id").alias("transaction_key"),
                    surrogate_key("customer_phone").alias("customer_key"))


@register("q_date_keys", oracle.compose(
    "SELECT date_key, CAST(count(*) AS BIGINT) AS n FROM ("
    "SELECT CAST(strftime(CAST(scheduled_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key FROM booking_logs "
    "UNION ALL SELECT CAST(strftime(CAST(created_at AS DATE), '%Y%m%d') AS INTEGER) AS date_key "
    "FROM completed_items) k GROUP BY date_key"))
def q_date_keys(spark, sf_dir):
    """yyyyMMdd date keys of bookings and completed items, counted per key."""
    configure(spark)
    bl = bind(spark, sf_dir, "booking_logs").select(date_key("scheduled_date").alias("date_key"))
    ci = bind(spark, sf_dir, "completed_items").select(date_key("created_at").alias("date_key"))
    return bl.unionByName(ci).groupBy("date_key").agg(F.count(F.lit(1)).alias("n"))


@register("q_customer_union", oracle.compose("SELECT * FROM customer_contacts"))
def q_customer_union(spark, sf_dir):
    """Every customer sighting - booking groups plus transactions (typed NULL email)."""
    configure(spark)
    return dims.customer_contacts(bind(spark, sf_dir, "booking_groups"), bind(spark, sf_dir, "transactions"))


@register("q_customer_latest", oracle.compose("SELECT * FROM latest_customers"))
def q_customer_latest(spark, sf_dir):
    """One row per phone, the latest sighting (NULLs first, deterministic ties)."""
    configure(spark)
    return dims.latest_customers(dims.customer_contacts(bind(spark, sf_dir, "booking_groups"),
                                                        bind(spark, sf_dir, "transactions")))


@register("q_customer_agg", oracle.compose("SELECT * FROM customer_agg"))
def q_customer_agg(spark, sf_dir):
    """A2: per-customer transaction aggregate (partial/final hash aggregate)."""
    return marts.customer_agg(_models(spark, sf_dir)["fact_transactions"])


@register("q_item_sales", oracle.compose("SELECT * FROM item_sales"))
def q_item_sales(spark, sf_dir):
    """A3: per-item units and revenue after the NULL-key filter (treatments included)."""
    return marts.item_sales(_models(spark, sf_dir)["fact_completed_items"])


@register("q_treatment_agg", oracle.compose("SELECT * FROM treatment_agg"))
def q_treatment_agg(spark, sf_dir):
    """A4: per-treatment conditional counts and sums."""
    return marts.treatment_agg(_models(spark, sf_dir)["fact_treatment_activities"])


# ---------------------------------------------------------------------------
# Quality gate
# ---------------------------------------------------------------------------
RULES = load_rules()

# A deliberately strict rule set for the transactions feed: it exercises
# every check kind and every failure path on real data (a missing and an
# unexpected column, NULLs in required columns, a non-unique "key", a range
# and an enumeration violation, a rule on an absent column, an unknown rule).
PROBE_TABLE = "transactions_probe"
PROBE_RULES = {
    "columns": [c for c in CONTRACTS["transactions"].fieldNames() if c != "gift_card_id"] + ["loyalty_tier"],
    "not_null": ["id", "customer_phone", "discount_amount", "coupon_code"],
    "unique": ["customer_name"],
    "checks": [
        {"type": "min_value", "column": "total_price", "min": 0},
        {"type": "min_value", "column": "discount_amount", "min": 100000},
        {"type": "accepted_values", "column": "source", "values": ["gift_card", "membership", "treatment"]},
        {"type": "min_value", "column": "total", "min": 0},
        {"type": "accepted_values", "column": "channel", "values": ["web", "desk"]},
        {"type": "mystery", "column": "id"},
    ],
}


def _gate_oracle(items) -> str:
    """items: [(view, table_name, rules, source)] -> one statement with all check rows."""
    extra, selects = {}, []
    for k, (view, table, rules, source) in enumerate(items):
        e, s = oracle.gate_sql(view, table, rules, CONTRACTS[view].fieldNames(), source, tag=f"g{k}")
        extra.update(e)
        selects.append(s)
    return oracle.compose("\nUNION ALL\n".join(selects), extra)


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _gate_probe(spark, sf_dir):
    configure(spark)
    return quality.gate(bind(spark, sf_dir, "transactions"), PROBE_TABLE, PROBE_RULES)


def _raw_rows(spark, sf_dir, t):
    """A row per row of the raw table behind feed ``t``: the source side of the row_count check."""
    return scan_table(spark, sf_dir, BINDINGS[t].source).select(F.lit(1).alias("_one"))


def _gate_all(spark, sf_dir):
    configure(spark)
    return _union([quality.gate(bind(spark, sf_dir, t), t, RULES.get(t), source=_raw_rows(spark, sf_dir, t), prefilter=True)
                   for t in SOURCE_TABLES])


register("q_gate_table", _gate_oracle([("transactions", PROBE_TABLE, PROBE_RULES, None)]))(_gate_probe)
register("q_gate_all", _gate_oracle([(t, t, RULES[t], BINDINGS[t].source) for t in SOURCE_TABLES]))(_gate_all)


def _summary_oracle() -> str:
    checks = _gate_oracle([("transactions", PROBE_TABLE, PROBE_RULES, None)] +
                          [(t, t, RULES[t], BINDINGS[t].source) for t in SOURCE_TABLES])
    return (f"SELECT table_name, CASE WHEN count_if(status <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall, "
            f"CASE WHEN count_if(status <> 'PASS') = 0 THEN NULL ELSE "
            f"string_agg(CASE WHEN status <> 'PASS' THEN check_name END, ', ' ORDER BY check_order) END "
            f"AS failed_checks FROM (\n{checks}\n) c GROUP BY table_name")


@register("q_gate_summary", _summary_oracle())
def q_gate_summary(spark, sf_dir):
    """Q11: per-table verdict and failed-check list for the probe gate and the eleven feeds."""
    return quality.overall(_gate_probe(spark, sf_dir).unionByName(_gate_all(spark, sf_dir)))


# ---- single checks -----------------------------------------------------------

def _row_count_oracle() -> str:
    parts = []
    for t in SOURCE_TABLES:
        src = BINDINGS[t].source
        parts.append(
            f"SELECT {oracle._lit(t)} AS table_name, 'row_count' AS check_name, "
            f"CASE WHEN s = n THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"CASE WHEN s = n THEN CAST(n AS VARCHAR) || ' rows match' "
            f"ELSE 'source=' || CAST(s AS VARCHAR) || ' extracted=' || CAST(n AS VARCHAR) END AS detail "
            f"FROM (SELECT (SELECT CAST(count(*) AS BIGINT) FROM {src}) AS s, "
            f"(SELECT CAST(count(*) AS BIGINT) FROM {t}) AS n) x")
    return oracle.compose("\nUNION ALL\n".join(parts))


@register("q_check_row_count", _row_count_oracle())
def q_check_row_count(spark, sf_dir):
    """Did the extract deliver every source row? Source = raw driver table, batch = bound feed."""
    configure(spark)
    frames = [quality.gate(bind(spark, sf_dir, t), t, {"columns": CONTRACTS[t].fieldNames()},
                           source=_raw_rows(spark, sf_dir, t))
              for t in SOURCE_TABLES]
    return _union(frames).where(F.col("check_name") == "row_count").select(
        "table_name", "check_name", "status", "detail")


def _single_check(spark, df, table, rules, name, bad_alias):
    configure(spark)
    return quality.gate(df, table, rules).where(F.col("check_name") == name).select(
        "check_name", "status", "detail", F.col("bad_rows").alias(bad_alias))


_UNIQUE_RULES = {"unique": ["l_orderkey", "l_linenumber"]}
_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_MIN_RULES = {"checks": [{"type": "min_value", "column": "c_acctbal", "min": 0}]}
_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_ACCEPTED_RULES = {"checks": [{"type": "accepted_values", "column": "source",
                               "values": ["gift_card", "membership", "treatment"]}]}


def _plain_check_oracle(view, columns, rules, name, bad_alias):
    e, s = oracle.gate_sql(view, view, rules, columns, None, tag="c")
    return oracle.compose(f"SELECT check_name, status, detail, bad_rows AS {bad_alias} FROM (\n{s}\n) q "
                          f"WHERE check_name = {oracle._lit(name)}", e)


_NOT_NULL_RULES = {"not_null": ["id", "customer_phone", "discount_amount"]}


@register("q_check_not_null", _plain_check_oracle("transactions", CONTRACTS["transactions"].fieldNames(), _NOT_NULL_RULES,
                                                  "not_null", "null_cells"))
def q_check_not_null(spark, sf_dir):
    """Q3: the gate's own check over three transaction columns."""
    return _single_check(spark, bind(spark, sf_dir, "transactions"), "transactions", _NOT_NULL_RULES, "not_null", "null_cells")


@register("q_check_unique", _plain_check_oracle("lineitem", _LINEITEM_COLS, _UNIQUE_RULES, "unique",
                                                "duplicate_groups"))
def q_check_unique(spark, sf_dir):
    """Q4: composite-key duplicates in the line items (NULL equals NULL)."""
    return _single_check(spark, scan_table(spark, sf_dir, "lineitem"), "lineitem", _UNIQUE_RULES, "unique",
                         "duplicate_groups")


@register("q_check_min_value", _plain_check_oracle("customer", _CUSTOMER_COLS, _MIN_RULES, "min_value.c_acctbal",
                                                   "bad_rows"))
def q_check_min_value(spark, sf_dir):
    """Q5: account balances below zero."""
    return _single_check(spark, scan_table(spark, sf_dir, "customer"), "customer", _MIN_RULES,
                         "min_value.c_acctbal", "bad_rows")


@register("q_check_accepted_values", _plain_check_oracle("transactions", CONTRACTS["transactions"].fieldNames(),
                                                         _ACCEPTED_RULES, "accepted_values.source", "bad_rows"))
def q_check_accepted_values(spark, sf_dir):
    """Q6: transaction sources outside the mart's list."""
    return _single_check(spark, bind(spark, sf_dir, "transactions"), "transactions", _ACCEPTED_RULES,
                         "accepted_values.source", "bad_rows")


# ---------------------------------------------------------------------------
# Constraint suite
# ---------------------------------------------------------------------------
SUITE = load_tests()


# Beside the shipped suite: a column whose values do repeat, so that values and rows differ.
REPEATED = [("staging", "transactions", "customer_name", "unique", None)]


def _suite_frames(spark, sf_dir, specs):
    """The tested tables; each model that is needed is computed once and read back."""
    m = _models(spark, sf_dir)
    tested = list(dict.fromkeys(model for _layer, model, *_ in specs))

    def write(name, frame):
        path = scratch_path(spark, "suite", name)
        frame.write.options(**lake.PARQUET_WRITE).parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    jobs.materialise(m, selected([f"+{name}" for name in ALL_MODELS if name in tested]), write, jobs.DEFAULT_PARALLELISM).check()
    return {name: m[name] if name in ALL_MODELS else bind(spark, sf_dir, name) for name in tested}


def _suite_query(kind: str | None):
    cols = ["model", "column_name", "test", "failing_rows", "status"] if kind is None else \
        ["model", "column_name", "failing_rows"]
    specs = [s for s in SUITE if kind is None or s[3] == kind] + (REPEATED if kind == "unique" else [])

    def run(spark, sf_dir):
        return constraints.run_suite(spark, _suite_frames(spark, sf_dir, specs), specs).select(*cols)

    sql = oracle.compose(f"SELECT {', '.join(cols)} FROM (\n{oracle.suite_sql(specs)}\n) t")
    return run, sql


for _key, _kind in [("q_test_not_null", "not_null"), ("q_test_unique", "unique"),
                    ("q_test_accepted_values", "accepted_values"), ("q_test_suite", None)]:
    _fn, _sql = _suite_query(_kind)
    register(_key, _sql)(_fn)


# ---------------------------------------------------------------------------
# Sources, lake, staging, audit
# ---------------------------------------------------------------------------


_DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


@register("q_scan_table", oracle.compose("SELECT * FROM booking_logs"))
def q_scan_table(spark, sf_dir):
    """Full scan of a feed, all columns in contract order."""
    configure(spark)
    return bind(spark, sf_dir, "booking_logs")


@register("q_source_row_count", oracle.compose("\nUNION ALL\n".join(
    f"SELECT {oracle._lit(t)} AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in SOURCE_TABLES)))
def q_source_row_count(spark, sf_dir):
    """Row count of each of the eleven feeds."""
    configure(spark)
    return _union([bind(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(t).alias("table_name"), "row_count") for t in SOURCE_TABLES])


def _profile_sql(t: str) -> str:
    cols = CONTRACTS[t].fieldNames()
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    return (f"SELECT {oracle._lit(t)} AS table_name, CAST(count(*) AS BIGINT) AS row_count, "
            f"CAST({len(cols)} AS INTEGER) AS column_count, CAST({nulls} AS BIGINT) AS null_cells FROM {t}")


@register("q_source_profile", oracle.compose("\nUNION ALL\n".join(_profile_sql(t) for t in SOURCE_TABLES)))
def q_source_profile(spark, sf_dir):
    """Per table rows, columns and NULL cells; one aggregate per table."""
    configure(spark)
    return profile({t: bind(spark, sf_dir, t) for t in SOURCE_TABLES})


def _contract_text(spark, sf_dir):
    """completed_items as delivered text: prices like 150000.0 on some parts, unparseable ones on others."""
    b = BINDINGS["completed_items"]
    text = scan_table(spark, sf_dir, b.source).selectExpr(*b.exprs, "l_partkey AS _pk")
    cols = CONTRACTS["completed_items"].fieldNames()
    price = F.col("price").cast("string")
    delivered = (F.when(F.col("_pk") % 97 == 0, F.lit("abc")).when(F.col("_pk") % 5 == 0, F.concat(price, F.lit(".0")))
                 .otherwise(price))
    return text.select(*[(delivered if c == "price" else F.col(c).cast("string")).alias(c) for c in cols])


def _contract_oracle() -> str:
    b = BINDINGS["completed_items"]
    contract = CONTRACTS["completed_items"]
    cols = contract.fieldNames()
    text = ", ".join(f"CASE WHEN _pk % 97 = 0 THEN 'abc' WHEN _pk % 5 = 0 THEN CAST({c} AS VARCHAR) || '.0' "
                     f"ELSE CAST({c} AS VARCHAR) END AS {c}" if c == "price"
                     else f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    body = (f"SELECT {text} FROM (SELECT {', '.join(b.exprs)}, l_partkey AS _pk FROM {b.source}) s")
    parts = [f"SELECT {oracle._lit(f.name)} AS column_name, CAST(count_if({f.name} IS NOT NULL AND "
             f"TRY_CAST({f.name} AS {_DUCK_TYPES[f.dataType.simpleString()]}) IS NULL) AS BIGINT) AS uncastable_rows "
             f"FROM ci_text" for f in contract.fields]
    return oracle.compose("\nUNION ALL\n".join(parts), {"ci_text": body})


@register("q_schema_contract", _contract_oracle())
def q_schema_contract(spark, sf_dir):
    """S3: per contract column, non-NULL text values that would not cast."""
    configure(spark)
    return contract_report(_contract_text(spark, sf_dir), CONTRACTS["completed_items"])


INGEST_DATE = _dt.date(2026, 8, 9)


@register("q_raw_roundtrip", oracle.compose(
    "SELECT '2026' AS \"year\", '08' AS \"month\", '09' AS \"day\", source, CAST(count(*) AS BIGINT) AS n, "
    "CAST(sum(total_price) AS BIGINT) AS total FROM transactions GROUP BY source"))
def q_raw_roundtrip(spark, sf_dir):
    """Gate + publish transactions as CSV under the ingestion-date partition, then read it back."""
    configure(spark)
    root = scratch_path(spark, "raw_roundtrip")
    recs = jobs.ingest(spark, {"transactions": bind(spark, sf_dir, "transactions")}, root,
                           batch_id="20260809_023000", fmt="csv", ingest_date=INGEST_DATE)
    _require(recs[0]["status"] == "SUCCESS", recs[0])
    cols = CONTRACTS["transactions"].fieldNames() + ["year", "month", "day"]
    raw = (spark.read.schema(", ".join(f"`{c}` string" for c in cols)).options(**lake.CSV_READ)
           .csv(jobs.published(spark, lake.table_path(root, "transactions"))))
    return raw.groupBy("year", "month", "day", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("total_price").cast("long")).alias("total"))


@register("q_snapshot_replace", oracle.compose("SELECT * FROM transactions WHERE source = 'treatment'"))
def q_snapshot_replace(spark, sf_dir):
    """Two batches into one table folder: only the later snapshot is served."""
    configure(spark)
    root = scratch_path(spark, "snapshot_replace")
    tx = bind(spark, sf_dir, "transactions")
    first = jobs.ingest(spark, {"transactions": tx}, root, "20260808_010000", ingest_date=_dt.date(2026, 8, 8))
    second = jobs.ingest(spark, {"transactions": tx.where(F.col("source") == "treatment")}, root,
                             "20260809_010000", ingest_date=INGEST_DATE)
    _require(first[0]["status"] == second[0]["status"] == "SUCCESS", (first, second))
    return spark.read.parquet(jobs.published(spark, lake.table_path(root, "transactions"))).drop(
        "year", "month", "day")


# Review comments as delivered, by event: what the CSV dialect must keep, and what it reads as NULL.
_COMMENTS = """CASE CAST(id AS BIGINT) % 9 WHEN 0 THEN ' lead' WHEN 1 THEN 'trail ' WHEN 2 THEN '   '
 WHEN 3 THEN 'says "so", twice' WHEN 4 THEN {line_break} WHEN 5 THEN 'NULL' WHEN 6 THEN '' WHEN 7 THEN '""' ELSE comment END"""
# Rows that arrive without their last two fields, and rows with one field too many.
_SHORT, _LONG = "CAST(id AS BIGINT) % 50 = 11", "CAST(id AS BIGINT) % 50 = 12"


@register("q_csv_format_scan", oracle.compose(
    f"SELECT id, booking_group_id, customer_name, rating, CASE WHEN c IN ('', 'NULL') THEN NULL ELSE c END AS comment, "
    f"CASE WHEN NOT ({_SHORT}) THEN created_at END AS created_at, CASE WHEN NOT ({_SHORT}) THEN guest_index END AS guest_index "
    f"FROM (SELECT *, {_COMMENTS.format(line_break="'one' || chr(10) || 'two'")} AS c FROM reviews) r"))
def q_csv_format_scan(spark, sf_dir):
    """Reviews through the CSV lake and back: blanks, quotes, line breaks, NULL words, short and long rows."""
    configure(spark)
    root = scratch_path(spark, "csv_scan")
    comment = F.expr(_COMMENTS.format(line_break="'one' || chr(10) || 'two'"))
    feed = bind(spark, sf_dir, "reviews").withColumn("comment", comment)
    recs = jobs.ingest(spark, {"reviews": feed.where(f"NOT ({_SHORT}) AND NOT ({_LONG})")}, root, "20260809_023000",
                           fmt="csv", ingest_date=INGEST_DATE)
    _require(recs[0]["status"] == "SUCCESS", recs[0])
    contract = CONTRACTS["reviews"]
    raw = jobs.published(spark, lake.table_path(root, "reviews"))
    short = feed.where(_SHORT).select(*contract.fieldNames()[:-2])
    long = feed.where(_LONG).withColumn("surplus", F.lit("x"))
    for name, ragged in (("short", short), ("long", long)):   # files as another writer might deliver them
        ragged.write.options(**lake.CSV_WRITE).csv(f"{raw}/ragged_{name}")
    return apply_contract(lake.read_csv_text(spark, raw, contract.fieldNames()), contract)


@register("q_stage_load", oracle.compose("SELECT * FROM completed_items"))
def q_stage_load(spark, sf_dir):
    """completed_items, prices delivered as 150000.0: CSV lake -> positional ANSI cast -> staging table."""
    configure(spark)
    root = scratch_path(spark, "stage_load")
    feed = bind(spark, sf_dir, "completed_items").withColumn("price", F.col("price").cast("decimal(20,1)"))
    jobs.ingest(spark, {"completed_items": feed}, root, "20260809_023000", fmt="csv", ingest_date=INGEST_DATE)
    recs = jobs.load_staging(spark, root, ["completed_items"], "20260809_023000", fmt="csv")
    _require(recs[0]["status"] == "SUCCESS", recs[0])
    return spark.read.parquet(jobs.published(spark, jobs.staging_path(root, "completed_items")))


def _audit_frame(spark, root):
    return audit.read_audit(spark, root)


@register("q_load_verify", oracle.compose("\nUNION ALL\n".join(
    f"SELECT {oracle._lit(t)} AS table_name, CAST(count(*) AS BIGINT) AS source_rows, "
    f"CAST(count(*) AS BIGINT) AS loaded_rows, TRUE AS matches FROM {t}" for t in SOURCE_TABLES)))
def q_load_verify(spark, sf_dir):
    """All eleven feeds: extract (CSV lake) then load; compare extracted and loaded counts."""
    configure(spark)
    root = scratch_path(spark, "load_verify")
    sources = {t: bind(spark, sf_dir, t) for t in SOURCE_TABLES}
    jobs.ingest(spark, sources, root, "20260809_023000", fmt="csv", ingest_date=INGEST_DATE)
    jobs.load_staging(spark, root, SOURCE_TABLES, "20260809_023000", fmt="csv")
    a = _audit_frame(spark, root)
    return a.groupBy(F.col("source_table").alias("table_name")).agg(
        F.max(F.when(F.col("job") == "extract", F.col("rows_extracted"))).alias("source_rows"),
        F.max(F.when(F.col("job") == "load", F.col("rows_loaded"))).alias("loaded_rows"),
    ).select("table_name", "source_rows", "loaded_rows",
             F.coalesce(F.col("source_rows") == F.col("loaded_rows"), F.lit(False)).alias("matches"))


AUDIT_TABLES = ["treatments", "spa_products", "booking_groups", "booking_logs", "transactions", "completed_items",
                "members"]
FAILING_FEED = "spa_products"


def _audit_oracle() -> str:
    parts = []
    for t in AUDIT_TABLES:
        failing = t == FAILING_FEED
        status = "'VALIDATION_FAILED'" if failing else "'SUCCESS'"
        loaded = "CAST(0 AS BIGINT)" if failing else "CAST(count(*) AS BIGINT)"
        why = "'validation failed: min_value.price'" if failing else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT {oracle._lit(t)} AS source_table, {status} AS status, {why} AS error_message, "
                     f"CAST(count(*) AS BIGINT) AS rows_extracted, {loaded} AS rows_loaded FROM {t}")
    return oracle.compose("\nUNION ALL\n".join(parts))


def _bad_products(df):
    """A broken upstream batch: every price sign-flipped."""
    return df.withColumn("price", -F.col("price"))


@register("q_batch_audit", _audit_oracle())
def q_batch_audit(spark, sf_dir):
    """Ingest seven feeds; the spa_products batch arrives broken and is blocked by the gate."""
    configure(spark)
    root = scratch_path(spark, "batch_audit")
    sources = {t: bind(spark, sf_dir, t) for t in AUDIT_TABLES}
    sources[FAILING_FEED] = _bad_products(sources[FAILING_FEED])
    jobs.ingest(spark, sources, root, "20260809_023000", ingest_date=INGEST_DATE)
    return _audit_frame(spark, root).select("source_table", "status", "error_message", "rows_extracted", "rows_loaded")


@register("q_gate_publish", oracle.compose("SELECT * FROM spa_products"))
def q_gate_publish(spark, sf_dir):
    """A clean batch is published; the next, broken batch is refused and the clean one stays served."""
    configure(spark)
    root = scratch_path(spark, "gate_publish")
    clean = bind(spark, sf_dir, "spa_products")
    ok = jobs.ingest(spark, {"spa_products": clean}, root, "20260808_010000", ingest_date=_dt.date(2026, 8, 8))
    bad = jobs.ingest(spark, {"spa_products": _bad_products(clean)}, root, "20260809_010000",
                          ingest_date=INGEST_DATE)
    _require(ok[0]["status"] == "SUCCESS" and bad[0]["status"] == "VALIDATION_FAILED", (ok, bad))
    return spark.read.parquet(jobs.published(spark, lake.table_path(root, "spa_products"))).drop(
        "year", "month", "day")


# ---------------------------------------------------------------------------
# End to end
# ---------------------------------------------------------------------------


@register("q_end_to_end_run", oracle.compose(
    f"SELECT model, column_name, test, failing_rows, status FROM (\n{oracle.suite_sql(SUITE)}\n) t"))
def q_end_to_end_run(spark, sf_dir):
    """ingest -> staging load -> model build (written tables) -> constraint suite, read back."""
    configure(spark)
    root = scratch_path(spark, "end_to_end")
    summary = jobs.run_pipeline(spark, {t: bind(spark, sf_dir, t) for t in SOURCE_TABLES}, root,
                                    FIXTURE_CALENDAR_START, FIXTURE_CALENDAR_DAYS, FIXTURE_AS_OF,
                                    batch_id="20260809_023000")
    _require(summary["status"] in ("SUCCESS", "TESTS_FAILED"), summary.get("status"))
    return spark.read.parquet(summary["tests_path"])


def _extract_checks_oracle() -> str:
    checks = _gate_oracle([(t, t, RULES[t], None) for t in SOURCE_TABLES])
    return f"SELECT table_name, check_order, check_name, status, detail FROM (\n{checks}\n) g"


@register("q_extract_checks", _extract_checks_oracle())
def q_extract_checks(spark, sf_dir):
    """The gate as the extract job runs it (row-level sums observed during the batch
    write, key checks on the written batch), read back from the audit records."""
    configure(spark)
    root = scratch_path(spark, "extract_checks")
    jobs.ingest(spark, {t: bind(spark, sf_dir, t) for t in SOURCE_TABLES}, root, "20260809_023000",
                ingest_date=INGEST_DATE)
    a = _audit_frame(spark, root)
    return a.select("source_table", F.posexplode("validation").alias("pos", "check")).select(
        F.col("source_table").alias("table_name"), (F.col("pos") + 1).cast("int").alias("check_order"),
        F.col("check.name").alias("check_name"), F.col("check.status").alias("status"),
        F.col("check.detail").alias("detail"))


# ---------------------------------------------------------------------------
# Catalog, selection, reruns, located errors, drift
# ---------------------------------------------------------------------------

#: Databases of the fixture run: schema names of their own, used as they are.
FIXTURE_DATABASES = catalog.Databases("FIXTURE_WAREHOUSE", {"staging": "FIXTURE_STAGING", "mart": "FIXTURE_MART"})


@register("q_catalog_mart", oracle.compose(
    "SELECT * FROM mart_customer_analytics"))
def q_catalog_mart(spark, sf_dir):
    """A mart built with its ancestors only, then read by database and table name."""
    configure(spark)
    jobs.build_models(spark, scratch_path(spark, "catalog"), FIXTURE_CALENDAR_START, FIXTURE_CALENDAR_DAYS, FIXTURE_AS_OF,
                      staging=bind_all(spark, sf_dir), select=["+mart_customer_analytics"], databases=FIXTURE_DATABASES)
    return spark.sql("SELECT m.* FROM FIXTURE_MART.mart_customer_analytics m "
                     "JOIN FIXTURE_WAREHOUSE.dim_customer d ON m.customer_key = d.customer_key")


def _rerun_oracle() -> str:
    parts = [f"SELECT 'extract' AS job, {oracle._lit(t)} AS source_table, 'SUCCESS' AS status, CAST(count(*) AS BIGINT) AS rows_loaded, "
             f"{'FALSE' if t == FAILING_FEED else 'TRUE'} AS resumed FROM {t}" for t in AUDIT_TABLES]
    return oracle.compose("\nUNION ALL\n".join(parts))


@register("q_resume_batch", _rerun_oracle())
def q_resume_batch(spark, sf_dir):
    """A batch with a broken feed, resumed once it is mended; each table has one record, finished ones are not read again."""
    configure(spark)
    root = scratch_path(spark, "resume_batch")
    sources = {t: bind(spark, sf_dir, t) for t in AUDIT_TABLES}
    broken = sources | {FAILING_FEED: _bad_products(sources[FAILING_FEED])}
    first = jobs.ingest(spark, broken, root, "20260809_023000", ingest_date=INGEST_DATE)
    _require([r["source_table"] for r in first if r["status"] != "SUCCESS"] == [FAILING_FEED], first)
    again = jobs.ingest(spark, sources, root, "20260809_023000", ingest_date=INGEST_DATE, resume=True)
    kept = [r["source_table"] for r in again if r.get("resumed")]
    return _audit_frame(spark, root).select("job", "source_table", "status", "rows_loaded", F.col("source_table").isin(kept).alias("resumed"))


# Cells of completed_items as a broken source delivers them.
_DELIVERED = {"price": ("CASE WHEN {n} % 97 = 0 THEN 'abc' WHEN {n} % 89 = 0 THEN '12,5' ELSE CAST(price AS {text}) END"),
              "created_at": ("CASE WHEN {n} % 101 = 0 THEN 'soon' WHEN {n} % 103 = 0 THEN '' ELSE CAST(created_at AS {text}) END")}


def _delivered(number: str, text: str) -> str:
    b = BINDINGS["completed_items"]
    cols = ", ".join(f"{_DELIVERED[c].format(n='_pk', text=text)} AS {c}" if c in _DELIVERED else f"CAST({c} AS {text}) AS {c}"
                     for c in CONTRACTS["completed_items"].fieldNames())
    return f"SELECT {cols} FROM (SELECT {', '.join(b.exprs)}, {number} AS _pk FROM {b.source}) s"


@register("q_bad_cells", oracle.compose(
    "SELECT column_name, value, expected, CAST(count(*) AS BIGINT) AS cells FROM ("
    "SELECT 'price' AS column_name, price AS value, 'bigint' AS expected FROM sent WHERE price IN ('abc', '12,5') "
    "UNION ALL SELECT 'created_at', created_at, 'timestamp' FROM sent WHERE created_at = 'soon') c GROUP BY ALL",
    {"sent": _delivered("l_partkey", "VARCHAR")}))
def q_bad_cells(spark, sf_dir):
    """Cells of a CSV batch that the staging contract can't take; the load is refused and names the first."""
    configure(spark)
    root = scratch_path(spark, "bad_cells")
    b = BINDINGS["completed_items"]
    feed = scan_table(spark, sf_dir, b.source).selectExpr(*b.exprs, "l_partkey AS _pk")
    feed = feed.selectExpr(*[f"{_DELIVERED[c].format(n='_pk', text='STRING')} AS {c}" if c in _DELIVERED else f"CAST({c} AS STRING) AS {c}"
                             for c in CONTRACTS["completed_items"].fieldNames()])
    jobs.ingest(spark, {"completed_items": feed}, root, "20260809_023000", fmt="csv", ingest_date=INGEST_DATE, validate=False)
    load = jobs.load_staging(spark, root, ["completed_items"], "20260809_023000", fmt="csv")[0]
    _require(load["status"] == "FAILED" and " in column " in load["error_message"], load)
    return (jobs.bad_cells(spark, "completed_items", root, "csv").groupBy("column_name", "value", "expected")
            .agg(F.count(F.lit(1)).alias("cells")))


@register("q_contract_drift", oracle.compose(
    "SELECT 'gift_card_id' AS column_name, 'missing' AS change, 'string' AS expected, CAST(NULL AS VARCHAR) AS found, "
    "CAST(count(*) AS BIGINT) AS affected_rows FROM transactions "
    "UNION ALL SELECT 'loyalty_tier', 'added', NULL, 'string', CAST(count(source) AS BIGINT) FROM transactions "
    "UNION ALL SELECT 'total_price', 'retyped', 'bigint', 'string', CAST(count_if(total_price % 2 = 0) AS BIGINT) FROM transactions"))
def q_contract_drift(spark, sf_dir):
    """S3: a transactions feed with a column less, a new one and a retyped one, against its contract."""
    configure(spark)
    feed = bind(spark, sf_dir, "transactions").withColumns({
        "total_price": F.when(F.col("total_price") % 2 == 0, F.lit("n/a")).otherwise(F.col("total_price").cast("string")),
        "loyalty_tier": F.col("source")}).drop("gift_card_id")
    return contract_drift(feed, CONTRACTS["transactions"])


@register("q_salted_join", oracle.model("fact_treatment_activities"))
def q_salted_join(spark, sf_dir):
    """J1 with the bookings of hot groups salted: the same rows as the plain join."""
    configure(spark)
    return facts.fact_treatment_activities(bind(spark, sf_dir, "booking_logs"), bind(spark, sf_dir, "booking_groups"), HOT_SHARE)


@register("q_repeated_keys", "SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1")
def q_repeated_keys(spark, sf_dir):
    """The key values on more than one line item, through hash slots."""
    configure(spark)
    return uniqueness.repeated(scan_table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])
