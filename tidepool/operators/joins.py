"""Left join whose hot keys are spread by salting.

A key is hot if it holds more than ``share`` of the left rows, which fewer than 1/share
keys can: they are found by counting and broadcast. Rows of a hot key are dealt into
``salts`` parts by a hash of the whole row, so that a task that runs again deals the same
way; the right rows of those keys, and only those, are repeated once for each part. The
result is that of the plain left join, NULL keys (which match nothing and may be hot,
too) and repeated keys on the right included.

Adaptive execution splits a skewed partition only above its size threshold and only where
the join's operators allow it; this join does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 256
SALTS = 64


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """The values of ``key`` (as column _hot) on more than ``share`` of the rows: fewer than 1/share, NULL included."""
    counted = rows.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > rows.agg(F.count(F.lit(1))).scalar() * share).select("_hot", F.lit(True).alias("_is_hot"))


def salted_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, share: float = HOT_SHARE,
                     salts: int = SALTS) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``left_key`` = ``right_key``: the columns of both; names must not clash."""
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are on both sides")
    hot = F.broadcast(hot_keys(left, left_key, share))
    part = F.when(F.col("_is_hot"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts))).otherwise(F.lit(0))
    dealt = left.join(hot, F.col(left_key).eqNullSafe(F.col("_hot")), "left").withColumn("_part", part.cast("int")).drop("_hot", "_is_hot")
    parts = F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = (right.where(F.col(right_key).isNotNull()).join(hot, F.col(right_key) == F.col("_hot"), "left")
              .withColumn("_copy", F.explode(parts)).drop("_hot", "_is_hot"))
    return (dealt.join(copies, (F.col(left_key) == F.col(right_key)) & (F.col("_part") == F.col("_copy")), "left")
            .drop("_part", "_copy"))
