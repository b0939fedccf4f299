"""Dimension models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import null_as, surrogate_key
from tidepool.operators import calendar
from tidepool.operators.dedup import latest_per_key


def dim_date(spark: SparkSession, start: str = calendar.DEFAULT_START,
             days: int = calendar.DEFAULT_DAYS) -> DataFrame:
    return calendar.dim_date(spark, start, days)


def dim_product(spa_products: DataFrame) -> DataFrame:
    return spa_products.select(
        surrogate_key("id").alias("product_key"),
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        "price",
    )


def dim_treatment(treatments: DataFrame) -> DataFrame:
    return treatments.select(
        surrogate_key("id").alias("treatment_key"),
        F.col("id").alias("treatment_id"),
        F.col("name").alias("treatment_name"),
        "category",
        "price",
        "duration",
        "is_active",
    )


def customer_contacts(booking_groups: DataFrame, transactions: DataFrame) -> DataFrame:
    """Every customer sighting: booking groups plus transactions (no email there)."""
    cols = ["customer_phone", "customer_name", "email", "created_at"]
    bg = booking_groups.select(*cols)
    tx = transactions.select("customer_phone", "customer_name", null_as("string").alias("email"), "created_at")
    return bg.unionByName(tx)


def latest_customers(contacts: DataFrame) -> DataFrame:
    """One row per phone: the most recent sighting wins whole.

    created_at DESC with NULLs first (the warehouse convention), then email and
    name ascending with NULLs last as tie-breakers so the pick is deterministic.
    """
    return latest_per_key(
        contacts.where(F.col("customer_phone").isNotNull()),
        ["customer_phone"],
        [F.col("created_at").desc_nulls_first(),
         F.col("email").asc_nulls_last(),
         F.col("customer_name").asc_nulls_last()],
    ).select("customer_phone", "customer_name", "email")


def dim_customer(booking_groups: DataFrame, transactions: DataFrame, members: DataFrame) -> DataFrame:
    c = latest_customers(customer_contacts(booking_groups, transactions)).alias("c")
    m = members.select("id", "phone", "joined_date", "total_visits").alias("m")
    return c.join(m, F.col("c.customer_phone") == F.col("m.phone"), "left").select(
        surrogate_key(F.col("c.customer_phone")).alias("customer_key"),
        F.col("c.customer_phone"),
        F.col("c.customer_name"),
        F.col("c.email"),
        F.col("m.id").isNotNull().alias("is_member"),
        F.col("m.joined_date").alias("member_joined_date"),
        F.col("m.total_visits"),
    )
