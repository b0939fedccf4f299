"""Post-build constraint tests (not_null, unique, accepted_values).

Failures counted per test:
  not_null        rows where the column is NULL;
  unique          *values* (not rows) that occur more than once; NULLs are
                  ignored, unlike in the pre-publish gate where NULL == NULL;
  accepted_values rows whose non-NULL value is outside the list.

Row-level tests (not_null, accepted_values) scan each model once, and only the failing
cells are counted, in the map tasks: one row a task reaches the fold. Columns under a unique
test are scanned once a model, too, and shuffled as hashes
that combine map-side, so a hot value is one hash per task; only values whose hash occurs
twice are grouped as (test, value) pairs (``uniqueness``). Each test has its own share of the
sieve, so the values of a column that fails don't let those of others through.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import uniqueness

SUITE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("test", T.StringType(), False),
    T.StructField("failing_rows", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
])


def _as_key(df: DataFrame, c: str):
    """The tested value as text for grouping. Text equality must match SQL
    equality: -0.0 and 0.0 are one value (session time zone is pinned to UTC, so
    timestamps render injectively)."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        col = F.when(col == 0, F.lit(0.0)).otherwise(col)
    return col.cast("string")


def _row_level(frames: Mapping[str, DataFrame], tests: dict[str, list[tuple[int, str, str, list | None]]]) -> DataFrame:
    """(g, failing) of the row-level tests of all models: one scan a model, and one fold of the failing cells."""
    parts = []
    for model, own in tests.items():
        flags = []
        for g, c, kind, values in own:
            col = F.col(c)
            bad = col.isNull() if kind == "not_null" else col.isNotNull() & ~col.isin(list(values))
            flags.append(F.struct(F.lit(g).alias("g"), bad.alias("bad")))
        parts.append(frames[model].select(F.inline(F.filter(F.array(*flags), lambda flag: flag["bad"]))).select("g"))
    numbers = [g for own in tests.values() for g, *_ in own]
    counts = _union(parts).agg(*[F.count_if(F.col("g") == g).alias(f"_t{g}") for g in numbers])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(g).alias("g"), F.col(f"_t{g}").alias("failing")) for g in numbers])))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _repeated(frames: Mapping[str, DataFrame], tests: dict[str, list[tuple[int, str]]], spark: SparkSession) -> DataFrame:
    """(g, failing) of the unique tests: how many values occur more than once. One scan a model holds all its tested columns."""
    values = _union([frames[model].select(F.inline(F.array(*[F.struct(F.lit(g).alias("g"), _as_key(frames[model], c).alias("v")) for g, c in own])))
                     for model, own in tests.items()])
    tests_at_most = 1 + max(g for own in tests.values() for g, _ in own)
    dup = (uniqueness.repeated(values.where(F.col("v").isNotNull()), ["g", "v"], apart=("g", tests_at_most))
           .groupBy("g").agg(F.count(F.lit(1)).alias("failing")))
    none = spark.createDataFrame([(g, 0) for own in tests.values() for g, _ in own], "g int, failing long")
    return dup.unionByName(none).groupBy("g").agg(F.max("failing").alias("failing"))   # a test without values has its row


def run_suite(spark: SparkSession, frames: Mapping[str, DataFrame], specs, kinds=None) -> DataFrame:
    """The whole suite as one plan, a row per test.

    ``specs`` = [(layer, model, column, test, values)]; ``frames`` maps model -> DataFrame.
    """
    tests = [(m, c, t, v) for _layer, m, c, t, v in specs if not kinds or t in kinds]
    if not tests:
        return spark.createDataFrame([], SUITE_SCHEMA)
    row_level: dict[str, list] = {}
    unique: dict[str, list] = {}
    for g, (model, c, kind, values) in enumerate(tests):
        if kind == "unique":
            unique.setdefault(model, []).append((g, c))
        else:
            row_level.setdefault(model, []).append((g, c, kind, values))
    counted = _union(([_row_level(frames, row_level)] if row_level else []) + ([_repeated(frames, unique, spark)] if unique else []))

    def name(i: int):
        return F.element_at(F.array(*[F.lit(t[i]) for t in tests]), F.col("g") + 1)

    failing = F.col("failing").cast("long")
    return counted.select(
        name(0).alias("model"), name(1).alias("column_name"), name(2).alias("test"), failing.alias("failing_rows"),
        F.when(failing == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))
