"""Business marts.

Every mart aggregates its fact *before* joining: the partial/final hash
aggregate combines map-side, so a hot key (one date, one customer, one
treatment holding a third of the rows) collapses to one partial row per
map task before the shuffle. Dimension lookups then join the small
aggregate. The calendar join is a broadcast whose size is bounded by the
calendar window's day count (a parameter, or the years the facts cover),
never by the number of fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import days_between, safe_ratio
from tidepool.operators.joins import salted_left_join


def _with_date(counted: DataFrame, dim_date: DataFrame, key: str, name: str) -> DataFrame:
    """Look up the calendar date of ``key``; the calendar has a declared number of days and is broadcast."""
    days = dim_date.select(F.col("date_key").alias(key), F.col("full_date").alias(name))
    return counted.join(F.broadcast(days), key, "left")


def mart_revenue_daily(fact_transactions: DataFrame, dim_date: DataFrame) -> DataFrame:
    daily = fact_transactions.groupBy("date_key", "source").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("gross_amount").alias("gross_revenue"),
        F.sum("discount_amount").alias("total_discount"),
        F.sum("net_amount").alias("net_revenue"),
    )
    return _with_date(daily, dim_date, "date_key", "transaction_date").select(
        "date_key", "transaction_date", "source", "transaction_count", "gross_revenue", "total_discount",
        "net_revenue", safe_ratio("net_revenue", "transaction_count").alias("avg_order_value"))


def customer_agg(fact_transactions: DataFrame) -> DataFrame:
    return fact_transactions.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("gross_amount").alias("total_gross"),
        F.sum("discount_amount").alias("total_discount"),
        F.sum("net_amount").alias("total_net"),
        F.min("transaction_timestamp").alias("first_transaction_at"),
        F.max("transaction_timestamp").alias("last_transaction_at"),
    )


def mart_customer_analytics(dim_customer: DataFrame, fact_transactions: DataFrame, as_of: str) -> DataFrame:
    """``as_of`` replaces the wall clock so recency is reproducible."""
    a = customer_agg(fact_transactions).alias("a")
    c = dim_customer.alias("c")
    zero = F.lit(0)
    return c.join(a, F.col("c.customer_key") == F.col("a.customer_key"), "left").select(
        F.col("c.customer_key"), F.col("c.customer_phone"), F.col("c.customer_name"), F.col("c.email"),
        F.col("c.is_member"), F.col("c.member_joined_date"), F.col("c.total_visits"),
        F.coalesce(F.col("a.transaction_count"), zero).alias("transaction_count"),
        F.coalesce(F.col("a.total_gross"), zero).alias("total_gross"),
        F.coalesce(F.col("a.total_discount"), zero).alias("total_discount"),
        F.coalesce(F.col("a.total_net"), zero).alias("total_net"),
        safe_ratio(F.col("a.total_net"), F.col("a.transaction_count")).alias("avg_transaction_value"),
        F.col("a.first_transaction_at"), F.col("a.last_transaction_at"),
        days_between(F.col("a.last_transaction_at"), F.lit(as_of).cast("date")).alias("days_since_last_transaction"),
    )


def mart_operations_booking(activities: DataFrame, booking_logs: DataFrame, dim_date: DataFrame,
                            hot_share: float | None = None) -> DataFrame:
    """Bookings by day, source page and status; a booking id that is delivered twice meets both of its rows.

    ``hot_share``: salt the booking ids that hold more than this share of the activities (None: no salting).
    """
    src = booking_logs.select(F.col("id").alias("_bid"), "source_page")
    own = activities.select("booking_id", "scheduled_date_key", "status", "price")
    if hot_share is None:
        joined = own.join(src, F.col("booking_id") == F.col("_bid"), "left")
    else:
        joined = salted_left_join(own, src, "booking_id", "_bid", hot_share)
    counted = (
        joined.groupBy("scheduled_date_key", F.coalesce(F.col("source_page"), F.lit("unknown")).alias("source_page"),
                 "status")
        .agg(F.count(F.lit(1)).alias("booking_count"), F.sum("price").alias("booking_revenue"))
    )
    dated = _with_date(counted, dim_date, "scheduled_date_key", "scheduled_date")
    return dated.select("scheduled_date_key", "scheduled_date", "source_page", "status", "booking_count",
                         "booking_revenue")


def item_sales(fact_completed_items: DataFrame) -> DataFrame:
    return (fact_completed_items.where(F.col("item_key").isNotNull())
            .groupBy(F.col("item_key").alias("product_key"))
            .agg(F.count(F.lit(1)).alias("units_sold"), F.sum("price").alias("item_revenue")))


def mart_product_analytics(dim_product: DataFrame, fact_completed_items: DataFrame) -> DataFrame:
    s = item_sales(fact_completed_items).alias("s")
    p = dim_product.alias("p")
    return p.join(s, F.col("p.product_key") == F.col("s.product_key"), "left").select(
        F.col("p.product_key"), F.col("p.product_id"), F.col("p.product_name"), F.col("p.category"),
        F.col("p.price"),
        F.coalesce(F.col("s.units_sold"), F.lit(0)).alias("units_sold"),
        F.coalesce(F.col("s.item_revenue"), F.lit(0)).alias("item_revenue"),
    )


def treatment_agg(activities: DataFrame) -> DataFrame:
    status = F.col("status")
    return activities.groupBy("treatment_key").agg(
        F.count(F.lit(1)).alias("total_bookings"),
        F.count_if(status == "completed").alias("completed_bookings"),
        F.count_if(status == "cancelled").alias("cancelled_bookings"),
        F.count_if(status == "booked").alias("booked_bookings"),
        F.count_if(status == "no_show").alias("no_show_bookings"),
        F.sum("price").alias("booking_revenue"),
        F.sum(F.when(status == "completed", F.col("price")).otherwise(F.lit(0))).alias("completed_revenue"),
    )


def mart_treatment_analytics(dim_treatment: DataFrame, activities: DataFrame) -> DataFrame:
    a = treatment_agg(activities).alias("a")
    t = dim_treatment.alias("t")
    zero = F.lit(0)
    measures = ["total_bookings", "completed_bookings", "cancelled_bookings", "booked_bookings",
                "no_show_bookings", "booking_revenue", "completed_revenue"]
    return t.join(a, F.col("t.treatment_key") == F.col("a.treatment_key"), "left").select(
        F.col("t.treatment_key"), F.col("t.treatment_id"), F.col("t.treatment_name"), F.col("t.category"),
        F.col("t.price").alias("list_price"), F.col("t.duration"), F.col("t.is_active"),
        *[F.coalesce(F.col(f"a.{m}"), zero).alias(m) for m in measures],
        safe_ratio(F.col("a.cancelled_bookings"), F.col("a.total_bookings")).alias("cancellation_rate"),
    )
