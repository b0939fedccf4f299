"""Fact models. All three are narrow projections except the booking fact's
lookup of the booking group, a left equi-join on the group id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import date_key, surrogate_key
from tidepool.operators.joins import salted_left_join


def fact_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        surrogate_key("id").alias("transaction_key"),
        F.col("id").alias("transaction_id"),
        surrogate_key("customer_phone").alias("customer_key"),
        date_key("created_at").alias("date_key"),
        # NULL discount makes gross NULL on purpose (no coalesce in the fact).
        (F.col("total_price") + F.col("discount_amount")).alias("gross_amount"),
        "discount_amount",
        F.col("total_price").alias("net_amount"),
        "source",
        F.col("created_at").alias("transaction_timestamp"),
    )


def fact_completed_items(completed_items: DataFrame) -> DataFrame:
    return completed_items.select(
        surrogate_key("id").alias("completed_item_key"),
        surrogate_key("transaction_id").alias("transaction_key"),
        surrogate_key("item_id").alias("item_key"),
        date_key("created_at").alias("date_key"),
        "price",
        "item_name",
        "booking_log_id",
        F.col("created_at").alias("completed_timestamp"),
    )


def fact_treatment_activities(booking_logs: DataFrame, booking_groups: DataFrame, hot_share: float | None = None) -> DataFrame:
    """``hot_share``: salt the groups that hold more than this share of the bookings (None: no salting)."""
    bl = booking_logs.where(F.col("item_type") == "treatment").select(
        "id", "group_id", "treatment_id", "scheduled_date", "price", "guest_name", "status")
    bg = booking_groups.select(F.col("id").alias("_group"), F.col("customer_phone").alias("_phone"))
    # Left equi-join on the group id: AQE broadcasts the groups side when its
    # measured size is small, otherwise sort-merge with skew splitting of a hot
    # group on the (streamed) bookings side.
    if hot_share is None:
        joined = bl.join(bg, F.col("group_id") == F.col("_group"), "left")
    else:
        joined = salted_left_join(bl, bg, "group_id", "_group", hot_share)
    return joined.select(
        surrogate_key("id").alias("activity_key"),
        F.col("id").alias("booking_id"),
        surrogate_key("_phone").alias("customer_key"),
        surrogate_key("treatment_id").alias("treatment_key"),
        date_key("scheduled_date").alias("scheduled_date_key"),
        "price",
        "guest_name",
        "status",
        "scheduled_date",
    )
