"""Bind the driver's generic tables to the eleven staging contracts.

Each binding is a declarative projection over one driver table: a source
table, an optional filter, and SQL expressions in contract column order.
The text is valid in both Spark SQL and DuckDB, so the very same binding
feeds ``selectExpr`` on the Spark side and the CTEs of the SQL oracle.
Bindings are narrow (scan -> filter -> project) and push their filters
and column sets into the parquet scan.

The few predicates here derive *which entities exist* from a generic table:
parts split into treatments (``p_partkey % 4 <> 0``) and retail products
(the rest, so every part is one or the other), and one customer in three
holds a membership, so that most customers have none. All other feeds hold
every row of their table: a gift card per order, a review per event, a
consultation per conversation turn.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Binding:
    source: str
    exprs: tuple[str, ...]
    where: str | None = None

    def sql(self) -> str:
        text = "SELECT " + ",\n       ".join(self.exprs) + f"\nFROM {self.source}"
        if self.where:
            text += f"\nWHERE {self.where}"
        return text


_TS_2024 = "CAST(DATE '2024-01-01' AS TIMESTAMP)"
_TS_1999 = "CAST(DATE '1999-01-01' AS TIMESTAMP)"
_PHONE = "'+62' || lpad(CAST({k} AS STRING), 9, '0')"
_CUSTOMER = "'Customer#' || lpad(CAST({k} AS STRING), 9, '0')"

_PART_HEAD = (
    "CAST(p_partkey AS STRING) AS id",
    "replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS STRING) AS slug",
    "p_name AS name",
    "CAST(NULL AS STRING) AS short_description",
    "CAST(NULL AS STRING) AS full_description",
    "CAST(round(p_retailprice * 100) AS BIGINT) AS price",
)
_PART_TAIL = (
    "CAST(NULL AS STRING) AS image_url",
    "'{\"size\":' || CAST(p_size AS STRING) || '}' AS details",
    "p_size > 40 AS is_featured",
    "CAST(p_size AS BIGINT) AS featured_order",
    "p_size % 10 <> 0 AS is_active",
    f"{_TS_2024} AS created_at",
    f"{_TS_2024} AS updated_at",
)

BINDINGS: dict[str, Binding] = {
    "treatments": Binding("part", _PART_HEAD + (
        "CAST(30 + 15 * (p_size % 5) AS STRING) || ' min' AS duration",
        "p_type AS category",
    ) + _PART_TAIL + (
        "CASE WHEN p_partkey % 3 = 0 THEN 'conditional' ELSE 'static' END AS price_type",
    ), "p_partkey % 4 <> 0"),
    "spa_products": Binding("part", _PART_HEAD + ("p_brand AS category",) + _PART_TAIL, "p_partkey % 4 = 0"),
    "booking_groups": Binding("customer", (
        "'g' || CAST(c_custkey AS STRING) AS id",
        "c_name AS customer_name",
        "CASE WHEN c_custkey % 50 = 49 THEN NULL ELSE " + _PHONE.format(k="c_custkey") + " END AS customer_phone",
        "lower(c_mktsegment) || CAST(c_custkey AS STRING) || '@example.com' AS email",
        "CAST(DATE '2000-01-01' + CAST(c_custkey % 600 AS INT) AS TIMESTAMP) AS created_at",
    )),
    "booking_logs": Binding("events", (
        "CAST(event_id AS STRING) AS id",
        "CASE WHEN event_id % 10 = 0 THEN 'product' WHEN event_id % 10 = 1 THEN 'membership' ELSE 'treatment' END AS item_type",
        "'item-' || CAST(event_id % 40 AS STRING) AS item_name",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE '/page/' || CAST(event_id % 5 AS STRING) END AS source_page",
        "CAST(ts AS TIMESTAMP) AS created_at",
        "CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'click' THEN 'booked' WHEN 'error' THEN 'cancelled' "
        "WHEN 'signup' THEN 'no_show' ELSE CASE WHEN event_id % 2 = 0 THEN 'arrived' ELSE 'approved' END END AS status",
        "'g' || CAST(user_id AS STRING) AS group_id",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS price",
        "event_id % 3 AS guest_index",
        "CAST(ts AS TIMESTAMP) AS scheduled_date",
        "CAST(NULL AS STRING) AS notes",
        "'guest-' || CAST(event_id % 3 AS STRING) AS guest_name",
        "CASE WHEN event_id % 10 > 1 THEN CAST(4 * (event_id % 40) + 1 + event_id % 3 AS STRING) END AS treatment_id",
        "CASE WHEN event_id % 10 = 0 THEN CAST(4 * (event_id % 50) AS STRING) END AS product_id",
    )),
    "transactions": Binding("orders", (
        "CAST(o_orderkey AS STRING) AS id",
        _CUSTOMER.format(k="o_custkey") + " AS customer_name",
        "CASE WHEN o_custkey % 50 = 49 THEN NULL ELSE " + _PHONE.format(k="o_custkey") + " END AS customer_phone",
        "CAST(round(o_totalprice * 100) AS BIGINT) AS total_price",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'treatment' WHEN '2-HIGH' THEN 'membership' WHEN '3-MEDIUM' THEN 'gift_card' "
        "WHEN '4-NOT SPECIFIED' THEN 'treatment' ELSE 'product' END AS source",
        "CAST(NULL AS STRING) AS notes",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at",
        "CAST(o_orderdate AS TIMESTAMP) AS updated_at",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(floor(round(o_totalprice * 100) / 20) AS BIGINT) END AS discount_amount",
        "CAST(NULL AS STRING) AS gift_card_id",
    )),
    "completed_items": Binding("lineitem", (
        "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' "
        "|| CAST(l_suppkey AS STRING) || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) || '-' "
        "|| CAST(CAST(l_shipdate AS DATE) AS STRING) AS id",
        "CAST(l_orderkey AS STRING) AS transaction_id",
        "'part-' || CAST(l_partkey AS STRING) AS item_name",
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_partkey AS STRING) END AS item_id",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS price",
        "CAST(NULL AS STRING) AS booking_log_id",
        "CAST(l_shipdate AS TIMESTAMP) AS created_at",
    )),
    "members": Binding("customer", (
        "'m' || CAST(c_custkey AS STRING) AS id",
        "c_name AS name",
        _PHONE.format(k="c_custkey") + " AS phone",
        "CAST(NULL AS STRING) AS email",
        "CAST(DATE '1999-01-01' + CAST(c_custkey % 365 AS INT) AS TIMESTAMP) AS joined_date",
        "c_acctbal > 0 AS is_active",
        f"{_TS_1999} AS created_at",
        f"{_TS_1999} AS updated_at",
        "CAST(DATE '2002-01-01' AS TIMESTAMP) AS membership_expiry",
        "c_custkey % 20 AS total_visits",
    ), "c_custkey % 3 = 0"),
    "gift_cards": Binding("orders", (
        "CAST(o_orderkey AS STRING) AS id",
        "'GC-' || CAST(o_orderkey AS STRING) AS gift_code",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'treatment' ELSE 'nominal' END AS type",
        "CAST(round(o_totalprice * 100) AS BIGINT) AS gift_value",
        "CASE WHEN o_orderkey % 2 = 0 THEN CAST(4 * (o_orderkey % 40) + 1 AS STRING) END AS item_id",
        "CAST(NULL AS STRING) AS item_name",
        _CUSTOMER.format(k="o_custkey") + " AS sender_name",
        _PHONE.format(k="o_custkey") + " AS sender_phone",
        "'recipient-' || CAST(o_orderkey AS STRING) AS recipient_name",
        "CAST(NULL AS STRING) AS recipient_phone",
        "CAST(NULL AS STRING) AS personal_message",
        "o_orderkey % 3 = 0 AS physical_card",
        "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2500 ELSE 0 END AS BIGINT) AS physical_card_fee",
        "CASE o_orderstatus WHEN 'P' THEN 'booked' WHEN 'F' THEN 'completed' ELSE 'approved' END AS order_status",
        "CAST(DATE '2002-01-01' AS TIMESTAMP) AS expires_at",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at",
        "CAST(o_orderdate AS TIMESTAMP) AS updated_at",
        "'active' AS voucher_status",
        "CAST(0 AS BIGINT) AS discount_amount",
    )),
    "reviews": Binding("events", (
        "CAST(event_id AS STRING) AS id",
        "'g' || CAST(user_id AS STRING) AS booking_group_id",
        _CUSTOMER.format(k="user_id") + " AS customer_name",
        "1 + event_id % 5 AS rating",
        "props AS comment",
        "CAST(ts AS TIMESTAMP) AS created_at",
        "event_id % 3 AS guest_index",
    )),
    "spa_consultations": Binding("conversations", (
        "CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS id",
        "CAST(conv_id AS STRING) AS booking_log_id",
        "CASE WHEN conv_id % 2 = 0 THEN 'yes' ELSE 'no' END AS first_visit",
        "'[\"a\",\"b\"]' AS medical_conditions",
        "text AS medical_details",
        "'[]' AS current_conditions",
        "CAST(NULL AS STRING) AS current_details",
        "'no' AS medication",
        "CAST(NULL AS STRING) AS medication_detail",
        "'no' AS family_history",
        "CAST(NULL AS STRING) AS family_history_detail",
        "'no' AS surgery_history",
        "CAST(NULL AS STRING) AS surgery_history_detail",
        "'[\"dry\"]' AS skin_types",
        "CAST(NULL AS STRING) AS skin_other",
        "'[]' AS body_concerns",
        "CAST(NULL AS STRING) AS body_other",
        "'medium' AS massage_pressure",
        "CAST(NULL AS STRING) AS expectations",
        f"{_TS_2024} AS created_at",
        f"{_TS_2024} AS updated_at",
        "'{\"turn\":' || CAST(turn AS STRING) || '}' AS custom_responses",
    )),
    "site_settings": Binding("region", (
        "CAST(r_regionkey AS STRING) AS id",
        "lower(r_name) AS key",
        "'v' || CAST(r_regionkey AS STRING) AS value",
        "CAST(NULL AS STRING) AS description",
        f"{_TS_2024} AS updated_at",
    )),
}


_SCANS: dict[str, tuple[SparkSession, DataFrame]] = {}


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table. The driver tables are read-only inputs, so one
    scan (file listing + footer schema) per session is reused by every query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cached = _SCANS.get(path)
    if cached is None or cached[0] is not spark:
        cached = _SCANS[path] = (spark, spark.read.parquet(path))
    return cached[1]


def bind(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A staging-shaped DataFrame for ``table`` over the driver tables."""
    b = BINDINGS[table]
    df = scan_table(spark, sf_dir, b.source)
    if b.where:
        df = df.where(b.where)   # reaches the parquet scan
    return df.selectExpr(*b.exprs)


class LazyBindings(Mapping):
    """``table -> bound DataFrame``, bound on first access (a query only plans
    and lists the driver tables it actually reads)."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables=None):
        self._spark, self._dir = spark, sf_dir
        self._tables = list(tables or BINDINGS)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            raise KeyError(table)
        if table not in self._cache:
            self._cache[table] = bind(self._spark, self._dir, table)
        return self._cache[table]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def bind_all(spark: SparkSession, sf_dir: str, tables=None) -> Mapping[str, DataFrame]:
    return LazyBindings(spark, sf_dir, tables)
