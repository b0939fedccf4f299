"""Mixing sources to target weights by block indices.

1. Targets: sources sorted by code point (null last) weigh 5, 2, 1 in turn and share
   ``share`` times all words. A target stops at ``most`` times its source's size, and
   what it leaves is shared again by weight until no target is above its stop.
2. The words of each source, its documents end to end, are cut into blocks of a fixed
   length. A source gets as many slots as blocks of mean length make up its target.
3. Its slots fall on the output shards by a multinomial draw, so that the source counts
   of a shard are multinomial given its size, and each source's total is exactly its
   number of slots.
4. Slot k of a source with n blocks takes block permutation(k mod n) of epoch k div n:
   a keyed pseudorandom permutation of the indices that is computed, not stored. Every
   block is taken once per full epoch, so none more than ``most`` times.
5. Slots and documents meet by a join on (source, block index).

A source may hold any share of the documents: positions are summed in chunks (see
``common.with_ranks``), and joins and counts are per block. All draws come from hashes
of the seed and the source's name: reruns agree, and so does a recomputed partition.

Defined results: null and blank-only texts have size 0 and nothing is taken of them;
a null source is a source of its own, after all others; rows that repeat id and text
are separate members; if there are no words at all, targets are 0; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_batches, whole_row, with_ranks, word_count, written
from .hashing import mix as scrambled

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
#: Mean number of slots of an output shard.
SHARD_SLOTS = 1 << 14
#: Slots that one task numbers.
TASK_SLOTS = 1 << 17
SEED = 20_250


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Narrow rows: id, who and tag (hashes of id with source, and of the text), source, own (never null, sorts like source with null last), size."""
    own = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(doc_id, source).alias("who"), F.xxhash64(text).alias("tag"), F.col(source).alias("source"),
                       own.alias("own"), word_count(F.col(text)).alias("size"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """A row per source: own, source_size, target."""
    spark = rows.sparkSession
    sizes = rows.groupBy("own").agg(F.sum("size").alias("source_size")).orderBy("own")
    ranked = spark.createDataFrame(sizes.rdd.zipWithIndex().map(lambda x: (x[0]["own"], x[0]["source_size"], x[1])),
                                   "own string, source_size long, place long")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    known = written(ranked.select("own", "source_size", weight.cast("long").alias("weight")), "sources")
    stop = most * F.col("source_size")
    total = known.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:   # each round adds at least one stopped source, and sums are of whole numbers
        above = F.col("weight") * level > stop
        stopped, free = known.agg(F.sum(F.when(above, stop).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        before, level = level, (share * total - stopped) / free if free else level
    return known.select("own", "source_size", F.least(F.col("weight") * level, stop.cast("double")).alias("target"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1, evaluated at ``index``: four Feistel rounds, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype("uint64") + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, going = index.astype("uint64"), np.ones(len(index), bool)
    size, key = size.astype("uint64"), key.astype("int64").view("uint64")
    while going.any():
        h, m, k = half[going], mask[going], key[going]
        left, right = out[going] >> h, out[going] & m
        for turn in range(4):
            left, right = right, left ^ (scrambled(right + k + np.uint64(turn << 56)) & m)
        out[going] = (left << h) | right
        going[going] = out[going] >= size[going]
    return out.astype("int64")


def _throws(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, blocks, slots, seed in zip(batch["own"], batch["blocks"], batch["slots"], batch["seed"]):
                counts = np.random.Generator(np.random.PCG64(seed & 0xFFFFFFFFFFFFFFFF)).multinomial(slots, [1 / shards] * shards)
                yield pd.DataFrame({"own": own, "blocks": blocks, "shard": np.arange(shards),
                                    "first": np.cumsum(counts) - counts, "count": counts})
    return run


def _permute(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for k, blocks, key in batches:
        yield pd.Series(permuted((k % blocks).to_numpy(), blocks.to_numpy(), key.to_numpy()))


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """A row per slot of the mix: own, shard, k (number within the source), block, place (its order in the shard)."""
    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.round(F.col("target") * blocks / F.col("source_size")).cast("long")
    plan = written(sources.filter("source_size > 0")
                   .select("own", blocks.alias("blocks"), wanted.alias("slots"), F.xxhash64(F.lit(seed), "own").alias("seed")), "plan")
    total = int(plan.agg(F.sum("slots")).first()[0] or 0)
    shards = max(1, -(-total // shard_slots))
    drawn = plan.mapInPandas(_throws(shards), "own string, blocks long, shard long, first long, count long").filter("count > 0")
    each = (drawn.repartition(max(1, -(-total // TASK_SLOTS)), "own", "shard")
            .withColumn("k", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1))))
    epoch = F.floor(F.col("k") / F.col("blocks"))
    permute = F.pandas_udf(_permute, "long")
    return (each.withColumn("key", F.xxhash64(F.lit(seed), "own", epoch))
            .select("own", "shard", "k", permute("k", "blocks", "key").alias("block"), F.xxhash64("key", "k").alias("place")))


def spans(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document and block it reaches into: own, block, id, tag, start, size, from_word, to_word (of the document)."""
    full = rows.filter("size > 0")
    count = full.count()
    placed = with_ranks(full, ["own"], ["id", "tag"], "size", "start", count)
    last = F.col("start") + F.col("size")
    return (placed.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))))
            .withColumn("from_word", F.greatest(F.lit(0).cast("long"), F.col("block") * block_words - F.col("start")))
            .withColumn("to_word", F.least(last, (F.col("block") + 1) * block_words) - F.col("start"))
            .select("own", "block", "id", "who", "tag", "start", "size", "from_word", "to_word"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """A row per document: id, size, source_size and target of its source, taken (words the mix takes of it)."""
    rows = written(sized(docs, doc_id, text, source), "sized")
    sources = written(targets(rows), "targets")
    used = slots(sources, block_words, seed).groupBy("own", "block").agg(F.count("*").alias("times"))
    reach = spans(rows, block_words).join(used.hint("merge"), ["own", "block"], "left")   # estimated from the tiny plan table
    words = F.col("to_word") - F.col("from_word")
    taken = (reach.groupBy("own", "start", "id", "size")
             .agg(F.sum(words * F.coalesce("times", F.lit(0))).alias("taken")).select("own", "id", "size", "taken"))
    none = rows.filter("size = 0").select("own", "id", "size", F.lit(0).cast("long").alias("taken"))
    return (taken.unionByName(none).join(sources.withColumnRenamed("own", "s"), F.col("own") == F.col("s"))
            .select("id", "size", "source_size", "target", "taken"))


def _cut(texts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    word = re.compile(WORD)
    for text, first, last in texts:
        out = []
        for t, begins, ends in zip(text, first, last):
            at = [m.span() for m in word.finditer(t)]
            out.append([t[at[b][0]:at[e - 1][1]] for b, e in zip(begins, ends)])
        yield pd.Series(out)


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", n_chars: str = "n_chars",
          block_words: int = 256, seed: int = SEED) -> DataFrame:
    """The mix itself: a row per slot and document in its block, with the document's columns and its text cut to that part.

    ``n_chars``, where there is such a column, becomes the part's length. Within a shard the
    mix is ordered by a hash of (source, epoch, slot). Each text is shuffled once.
    """
    text_batches(docs.sparkSession)
    rows = written(sized(docs, doc_id, text, source), "sized")
    sources = written(targets(rows), "targets")
    parts = (slots(sources, block_words, seed).hint("merge").join(spans(rows, block_words), ["own", "block"])
             .groupBy("who", "tag").agg(F.collect_list(F.struct("shard", "place", "from_word", "to_word")).alias("parts")))
    whole = (docs.select(whole_row(docs).alias("row"), F.xxhash64(doc_id, source).alias("who"),
                         F.xxhash64(text).alias("tag"), F.col(text).alias("text")).dropDuplicates(["who", "tag"]))
    cut = F.pandas_udf(_cut, "array<string>")
    met = whole.join(parts, ["who", "tag"]).withColumn("pieces", cut("text", "parts.from_word", "parts.to_word"))
    each = met.select("row", F.explode(F.arrays_zip("parts", "pieces")).alias("p"))
    changed = {text: F.col("p.pieces"), n_chars: F.length("p.pieces").cast("long")}
    return each.select(*[(changed[c].cast(docs.schema[c].dataType) if c in changed else F.col("row")[c]).alias(c) for c in docs.columns])
