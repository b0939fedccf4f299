"""Latest-row-per-key deduplication (QUALIFY ROW_NUMBER() ... = 1).

Expressed as ``row_number() over (partition by key order by ...) = 1``.
Catalyst rewrites this shape into a partial ``WindowGroupLimit`` that runs
*before* the shuffle, so every map task forwards at most one row per key:
a key that holds a third of all rows costs one row per map task on the
wire, not a third of the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` must spell out null ordering and end in enough tie-breakers to
    make the pick deterministic; Spark's defaults differ from other engines
    (DESC puts NULLs last in Spark).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
