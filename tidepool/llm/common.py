"""Helpers shared by the operators: text rules, shared-folder tables, sieves, ranks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.session import scratch_path
from tidepool.sources import fs

#: Words are maximal runs of anything but the six ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows per Arrow batch for texts. A batch is held by one Python worker, and texts can be long.
TEXT_BATCH_ROWS = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Keep Arrow batches small enough for long texts, unless the session asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` rows for what runs inside the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Folders that ``written`` made, oldest first.
_MADE: list[str] = []


def written(df: DataFrame, what: str, hashes: Iterable[str] = ()) -> DataFrame:
    """Write to the cluster's shared folder and read again: lineage ends at files every executor sees.

    ``hashes``: columns whose values seldom repeat, so that a dictionary of them would only cost time and space.
    """
    path = scratch_path(df.sparkSession, "llm", what)
    df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in hashes}).parquet(path)
    _MADE.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def helpers() -> Iterator[list[str]]:
    """The folders of the tables that are written inside the block (filled in at its end)."""
    before, found = len(_MADE), []
    yield found
    found += _MADE[before:]


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Remove tables that nothing reads any more: what was made from them is written."""
    for folder in folders:
        fs.delete(spark, folder)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries made inside the block remove their shuffle files when they end, instead of when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that working columns beside it cannot clash with their names."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def carried(keep: list[Column] | None) -> Column:
    """Columns to hand through as one struct, whose names then cannot clash with working columns."""
    return F.struct(*keep) if keep else F.struct(F.lit(0).alias("nothing"))


def released(keep: list[Column] | None, struct: str = "kept") -> list[Column]:
    """The columns of ``carried`` again."""
    return [F.col(f"{struct}.*")] if keep else []


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


#: Slots of a sieve. The broadcast holds at most this many long values, whatever the input.
SIEVE_SLOTS = 1 << 20


def slot(keys: Iterable[Column], slots: int = SIEVE_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots).cast("long"))


def sieve(keys: DataFrame, slots: int = SIEVE_SLOTS) -> DataFrame:
    """The hash slots that the rows of ``keys`` fall into: at most ``slots`` rows.

    A row whose slot is missing certainly has no match, so it can be left out of a
    shuffle; a row whose slot is there still has to be matched exactly.
    """
    return keys.select(slot([F.col(c) for c in keys.columns], slots).alias("slot")).distinct()


def chunk_count(rows: int, rows_per_chunk: int = 1000) -> int:
    return max(1, -(-rows // rows_per_chunk))


def with_ranks(df: DataFrame, group: list[str], order: list[str], weight: str | None, out: str, rows: int) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (or the number) of the rows before this one in its group.

    A group may hold any share of the rows: each is cut into chunks by a hash of
    ``order``, the window runs inside (group, chunk), and a second window runs over one
    row per chunk. The order is by chunk, then ``order``; it is the same on every run.
    Rows that agree in all of ``order`` are interchangeable. The group's columns must not be null.
    """
    chunk = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(chunk_count(rows)).cast("long"))
    amount = F.col(weight) if weight else F.lit(1).cast("long")
    cut = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (cut.groupBy(*group, "_chunk").agg(F.sum(amount).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0).cast("long")))
              .select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_chunk").alias("_g_chunk"), "_before"))
    inside = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0).cast("long")))
    same = F.col("_chunk") == F.col("_g_chunk")
    for c in group:
        same = same & (F.col(c) == F.col(f"_g_{c}"))
    return (ranked.join(chunks, same).withColumn(out, F.col("_before") + F.col("_inside"))
            .drop("_chunk", "_before", "_inside", "_g_chunk", *[f"_g_{c}" for c in group]))
