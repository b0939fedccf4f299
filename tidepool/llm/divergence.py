"""Audit of how sources of a language differ: exact term probabilities, compared by one-hot products.

A language keeps the terms that at least ``min_docs`` of its documents hold. In a group
(language, source) a kept term's probability depends only on its level, the number of its
occurrences there: p = 1 + floor(scale * (level + smoothing) / (N + smoothing * V)). So
the distance of two groups is a sum over pairs of levels of the number of terms that have
level a in one and b in the other, times |p(a) - p(b)|. Those joint tables are products
of one-hot matrices: X has a row per term and an indicator column per (group, level), and
X^T X holds the joint table of every two groups.

X is cut into blocks of terms with alike totals and of ``TILE_GROUPS`` groups; a task
builds two blocks of X (a term that a group lacks has level 0 there), multiplies them,
prices the joint tables and returns one partial sum per pair of groups. Everything is
whole numbers: a product counts at most ``TILE_TERMS`` terms, which float32 holds exactly.

Counting is combined in the tasks (per language and source) before anything is shuffled;
all joins are plain, so that hot groups may be split. A language's groups, not its terms
or documents, are what a pair of groups is made from.

Defined results: null language, source and text count as ''; rows that repeat count each;
a group without kept terms has level 0 everywhere; a language without kept terms has
value 0 for all pairs and no term rows; a language of one source has no pairs; an empty
table gives no rows; long texts are counted whole; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import LETTERS, utf8, words
from .common import text_batches, with_ranks, written

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Terms and groups of a tile, and the columns of X that a task multiplies at once.
TILE_TERMS = 1024
TILE_GROUPS = 32
TILE_COLUMNS = 2048
#: Distinct (language, source, term) that a counting task holds before it hands them on.
HELD_TERMS = 1 << 17


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def counted() -> pd.DataFrame:
        rows = [(lang, source, term, n, docs[term]) for (lang, source), (uses, docs) in held.items() for term, n in uses.items()]
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"]).astype({"n": "int64", "docs": "int64"})

    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["body"]):
            own = words(text, LETTERS)
            uses, docs = held.setdefault((lang, source), (Counter(), Counter()))
            uses.update(own)
            docs.update(set(own))
        if sum(len(uses) for uses, _ in held.values()) > HELD_TERMS:
            yield counted()
            held.clear()
    yield counted()


def probability(level: Column, total: Column, terms: Column, smoothing: int = SMOOTHING, scale: int = SCALE) -> Column:
    """1 + floor(scale * (level + smoothing) / (total + smoothing * terms)), exactly."""
    above = (level + smoothing).cast("decimal(20,0)") * F.lit(scale).cast("decimal(18,0)")
    below = (total + smoothing * terms).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """Occurrences and documents of every term by language and source."""
    text_batches(docs.sparkSession)
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(named(lang).alias("lang"), named(source).alias("source"), utf8(F.col(text)).alias("body"))
    return (rows.mapInPandas(_count, "lang string, source string, term binary, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .withColumn("term", F.col("term").cast("string")))


def _onehot(levels: np.ndarray, price: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indicator matrix, price of each column, first column of each group) of a block: levels and prices by term and group."""
    parts, prices, starts, width = [], [], [], 0
    for group in range(levels.shape[1]):
        _, first, column = np.unique(levels[:, group], return_index=True, return_inverse=True)
        parts.append(column.reshape(-1) + width)
        prices.append(price[first, group])
        starts.append(width)
        width += len(first)
    x = np.zeros((len(levels), width), np.float32)
    for columns in parts:
        x[np.arange(len(levels)), columns] = 1
    return x, np.concatenate(prices), np.array(starts)


def distances(levels_a: np.ndarray, price_a: np.ndarray, levels_b: np.ndarray, price_b: np.ndarray, columns: int = TILE_COLUMNS) -> np.ndarray:
    """Sum over terms of |price a - price b| for every group of a and of b, by the joint tables of their levels."""
    if len(levels_a) > 1 and max(sum(len(np.unique(level)) for level in levels.T) for levels in (levels_a, levels_b)) > columns:
        half = len(levels_a) // 2
        return sum(distances(levels_a[cut], price_a[cut], levels_b[cut], price_b[cut], columns) for cut in (slice(None, half), slice(half, None)))
    xa, pa, sa = _onehot(levels_a, price_a)
    xb, pb, sb = _onehot(levels_b, price_b)
    joint = (xa.T @ xb).astype(np.int64)
    priced = joint * np.abs(pa[:, None] - pb[None, :])
    return np.add.reduceat(np.add.reduceat(priced, sa, axis=0), sb, axis=1)


def _tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of a tile. Rows without a term tell of the tile's groups: p is the price of level 0, n the block's number of terms.

    Terms of the block that none of the tile's groups has are at level 0 in all of them.
    """
    lang, i, j = key[0], key[3], key[4]
    groups, terms = rows[rows["t"] < 0], rows[rows["t"] >= 0]
    number = {t: k for k, t in enumerate(np.unique(terms["t"]))}
    sides = []
    for side in (i, j):
        own = groups[groups["g"] // TILE_GROUPS == side].sort_values("g")
        place = {g: k for k, g in enumerate(own["g"])}
        here = terms[terms["g"] // TILE_GROUPS == side]
        at = (here["t"].map(number).to_numpy(int), here["g"].map(place).to_numpy(int))
        levels = np.zeros((len(number), len(own)), np.int64)
        price = np.tile(own["p"].to_numpy(np.int64), (len(number), 1))
        levels[at], price[at] = here["n"].to_numpy(np.int64), here["p"].to_numpy(np.int64)
        sides.append((own["g"].to_numpy(), levels, price))
    (ga, la, pa), (gb, lb, pb) = sides
    free = [groups.set_index("g")["p"][g].to_numpy(np.int64) for g in (ga, gb)]
    value = (int(groups["n"].max()) - len(number)) * np.abs(free[0][:, None] - free[1][None, :])
    if len(number):
        value += distances(la, pa, lb, pb)
    a, b = np.meshgrid(ga, gb, indexing="ij")
    out = pd.DataFrame({"lang": lang, "g": a.ravel(), "h": b.ravel(), "value": value.ravel()})
    return out if i == j else pd.concat([out, out.rename(columns={"g": "h", "h": "g"})])


def _pair_sums(entries: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, g, h, value for every two groups of a language that keeps a term."""
    band = kept.withColumn("band", F.floor(F.log2("total")).cast("long"))
    ranked = with_ranks(band, ["lang", "band"], ["total", "term"], None, "t", max(1, kept.count()))
    placed = written(ranked.withColumn("block", F.expr(f"t div {TILE_TERMS}")).select("lang", "term", "band", "block", "t"), "places")
    tiles = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(groups - 1) div {TILE_GROUPS}")))
    side = F.expr(f"g div {TILE_GROUPS}")
    of_tile = ["lang", "band", "block", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")]
    terms = (entries.join(placed, ["lang", "term"]).withColumn("side", side).withColumn("other", tiles)
             .select(*of_tile, "t", "g", "n", "p"))
    blocks = placed.groupBy("lang", "band", "block").agg(F.count("*").alias("n"))
    marks = (groups.join(blocks, "lang").withColumn("side", side).withColumn("other", tiles)
             .select(*of_tile, F.lit(-1).cast("long").alias("t"), "g", "n",
                     probability(F.lit(0).cast("long"), F.col("mass"), F.col("terms")).alias("p")))
    return (terms.unionByName(marks).groupBy("lang", "band", "block", "i", "j").applyInPandas(_tile, "lang string, g long, h long, value long")
            .groupBy("lang", "g", "h").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: distances to the language's other sources, and its most overused terms."""
    counted = written(counts(docs, lang, source, text), "counts")
    kept = written(counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
                   .filter(F.col("docs") >= min_docs).select("lang", "term", "total"), "kept")
    known = written(counted.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "known")
    sizes = known.groupBy("lang", "source").agg(F.sum("n").alias("mass"))
    langs = kept.groupBy("lang").agg(F.sum("total").alias("all"), F.count("*").alias("terms"))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = (docs.select(named(lang).alias("lang"), named(source).alias("source")).distinct()
             .join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
             .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("mass", "terms", "all")]))
    found = written(found, "groups")
    ranked = with_ranks(found, ["lang"], ["source"], None, "g", max(1, found.count()))
    in_lang = ranked.groupBy("lang").agg(F.count("*").alias("groups"))
    groups = written(ranked.join(in_lang, "lang"), "groups")
    entries = written(known.join(groups, ["lang", "source"]).withColumn("p", probability(F.col("n"), F.col("mass"), F.col("terms")))
                      .withColumn("q", probability(F.col("total"), F.col("all"), F.col("terms")))
                      .select("lang", "source", "term", "g", "groups", "n", "p", "q"), "entries")

    other = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h"))
    pairs = (groups.select("lang", "source", "g").join(other, "lang").filter(F.col("g") != F.col("h"))
             .join(_pair_sums(entries.drop("source"), groups, kept), ["lang", "g", "h"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (entries.filter(F.col("p") > F.col("q"))
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top))
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(terms)
