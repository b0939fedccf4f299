"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after every run of ASCII blanks is
replaced by one space (null counts as empty). Each level looks only at rows whose
key of the level before occurs at least twice:

1. lengths are counted;
2. rows of repeated lengths are counted by (length, hash of a prefix);
3. rows of repeated (length, prefix hash) get the SHA-256 of the full text.

What survives a level is passed on as a sieve: the hash slots of its keys, a
broadcast of at most ``SIEVE_SLOTS`` longs. A false positive costs one hash and is
settled by the next level; a row that the sieve holds back is certainly unique, so
its content is neither hashed nor shuffled. Groups of any size are only ever
aggregated with map-side combine.

Defined results: null and empty texts are equal to each other (and to nothing
else but blank-only texts normalise to one space); rows that repeat both id and text
are separate members of their group, of which one stays; null ids sort last; an
empty table gives an empty result; other columns are carried unchanged whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, sieve, slot, whole_row, written

#: Characters of a text that the second level hashes.
PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text."""
    return F.sha2(normalised(text).cast("binary"), 256)


def _levels(rows: DataFrame) -> DataFrame:
    """``rows`` has a column norm; adds the keys of the first two levels."""
    return (rows.withColumn("n", F.length("norm").cast("long"))
            .withColumn("prefix", F.xxhash64(F.substring("norm", 1, PREFIX_CHARS))))


def suspects(docs: DataFrame, text: str = "text") -> DataFrame:
    """Levels one and two: the sieve of (length, prefix hash) pairs that occur more than once."""
    cheap = written(_levels(docs.select(normalised(F.col(text)).alias("norm"))).select("n", "prefix"), "lengths")
    repeated = cheap.groupBy("n").count().filter("count > 1").select("n")
    among = cheap.withColumn("slot", slot([F.col("n")])).join(F.broadcast(sieve(repeated)), "slot", "left_semi")
    pairs = among.groupBy("n", "prefix").count().filter("count > 1").select("n", "prefix")
    return written(sieve(pairs), "suspects")


def _flagged(docs: DataFrame, found: DataFrame, text: str, *columns: Column) -> DataFrame:
    """Rows with their level-two keys and whether the sieve lets them pass."""
    base = _levels(docs.select(*columns, normalised(F.col(text)).alias("norm")))
    return (base.withColumn("slot", slot([F.col("n"), F.col("prefix")]))
            .join(F.broadcast(found.withColumn("passed", F.lit(True))), "slot", "left"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Level three: one row per set of equal texts with at least two members.

    Columns: n, prefix, sha256, keep_id (smallest id), group_size.
    """
    rows = _flagged(docs, suspects(docs, text), text, F.col(doc_id).alias("id")).filter("passed")
    return (rows.select("id", "n", "prefix", F.sha2(F.col("norm").cast("binary"), 256).alias("sha256"))
            .groupBy("n", "prefix", "sha256")
            .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
            .filter("group_size > 1"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without copies: of equal texts, the row with the smallest id stays.

    Rows that the sieve holds back go straight through. The others are ranked inside
    their group, and Spark limits each group to its first row before the shuffle.
    """
    found = suspects(docs, text)
    rows = _flagged(docs, found, text, whole_row(docs).alias("row"), F.col(doc_id).alias("id"))
    alone = rows.filter(F.col("passed").isNull()).select("row.*")
    first = Window.partitionBy("n", "prefix", "sha256").orderBy(F.col("id").asc_nulls_last(), "tie")
    kept = (rows.filter("passed")
            .withColumn("sha256", F.sha2(F.col("norm").cast("binary"), 256))
            .withColumn("tie", F.xxhash64("row"))
            .select("row", "id", "n", "prefix", "sha256", "tie")
            .withColumn("place", F.row_number().over(first)).filter("place = 1").select("row.*"))
    return alone.unionByName(kept)
