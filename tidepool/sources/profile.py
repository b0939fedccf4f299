"""Source profile (S4): per table, rows, columns and NULL cells.

One aggregate per table (map-side partials, a one-row result each); the
tables' results are unioned, so the whole profile is one Spark job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_table(name: str, df: DataFrame) -> DataFrame:
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), nulls.cast("long").alias("null_cells")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"), "null_cells")


def profile(frames: Mapping[str, DataFrame]) -> DataFrame:
    parts = [profile_table(name, df) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
