"""Repeated key values, found without shuffling every key.

1. Rows are counted by the ``BITS``-bit hash of their key: what is shuffled is one hash a key
   and map task, whatever the key's columns are (of a billion keys, some thousands share theirs).
2. The hashes that occur more than once fall into the slots of a sieve, which is
   broadcast: one bit a slot, at most ``SLOTS`` longs of 64 slots at any size of the table.
3. Only rows whose slot is among them are grouped by the key itself.

A repeated key always has a repeated hash, so nothing is lost; a hash or slot that
distinct keys share only lets a row through to the exact grouping. Where far more than
2^26 keys repeat, all rows pass, and the grouping is the plain one.

Where the rows of several tables are counted at once, each table has its own share of the
sieve (``apart``): one whose keys repeat lets no rows of the others through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longs of the sieve, the bits of a hash, and the most of them that say whose share a key falls into.
SLOTS = 1 << 20
BITS = 48
SHARES = 10


def _word(hashed: Column, share_bits: int) -> Column:
    """The long that the hash's slot is in: the shares lie one behind the other."""
    own = F.lit(max(1, SLOTS >> share_bits)).cast("long")
    return hashed.bitwiseAND(F.lit((1 << share_bits) - 1).cast("long")) * own + F.pmod(F.shiftright(hashed, share_bits + 6), own)


def _bit(hashed: Column, share_bits: int) -> Column:
    return F.shiftright(hashed, share_bits).bitwiseAND(F.lit(63).cast("long")).cast("int")


def repeated(rows: DataFrame, key: list[str], apart: tuple[str, int] | None = None) -> DataFrame:
    """The values of ``key`` on more than one row, with their number ``n``. NULL equals NULL.

    ``apart``: a column of ``key`` with whole numbers, and how many (from 0) there are; each
    has its own share of the sieve.
    """
    share_bits = min(SHARES, (apart[1] - 1).bit_length()) if apart else 0
    low = (1 << share_bits) - 1   # the hash's lowest bits are the share
    hashed = F.xxhash64(*[F.col(c) for c in key]).bitwiseAND(F.lit((1 << BITS) - 1 - low).cast("long"))
    if apart:
        hashed = hashed.bitwiseOR(F.col(apart[0]).cast("long").bitwiseAND(F.lit(low).cast("long")))
    hashed = rows.select(*key, hashed.alias("_hash"))
    twice = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sieve = (twice.select(_word(F.col("_hash"), share_bits).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("_hash"), share_bits)).alias("_bits"))
             .groupBy("_word").agg(F.bit_or("_bits").alias("_bits")))
    inside = F.call_function("shiftright", F.col("_bits"), _bit(F.col("_hash"), share_bits)).bitwiseAND(F.lit(1).cast("long")) == 1
    left = hashed.join(F.broadcast(sieve), (_word(F.col("_hash"), share_bits) == F.col("_word")) & inside, "left_semi")
    return left.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
