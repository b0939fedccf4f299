"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: its words (A-Z lowered, ASCII punctuation
dropped), pairs of neighbours, and pairs with one word between, hashed into
``BUCKETS`` weights. Training runs FTRL-proximal with per-coordinate rates and an L1
term, which leaves most weights at exactly 0.

All labelled rows take part: they are dealt by a hash of the id into shards of about
``SHARD_ROWS`` rows, each shard trains on its own rows (a task holds their feature
indices, no texts), and the weights are averaged. Inside a shard rows go by their key, text
and label, not by arrival, and averages are sums of whole numbers, so any order of the
rows, and a task that runs again, gives the same model. The averages that aren't 0 are the
model, at most ``BUCKETS`` numbers whatever the corpus size; that bounds the
broadcast. Averaging shrinks margins, so a slope and an offset are then fitted to a
histogram of the training rows' margins (at most 2 x ``BINS`` counts).

Defined results: null, empty and blank-only texts have no features and score the
model's base rate; rows without a label teach nothing; with no labelled row every score
is 0.5; repeated rows count as often as they occur; columns beside those named are not
looked at.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, released, sieve, slot, text_batches, written
from .hashing import WordHashes, coefficients, mix

BITS = 20
BUCKETS = 1 << BITS
SHARD_ROWS = 12_000
EPOCHS = 3
#: FTRL-proximal: rate scale, rate offset, L1, L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
BINS = 400
#: Weights are summed as multiples of 1/UNIT.
UNIT = 1 << 40
#: Width of a margin bin.
BIN = 0.1

_TO_BLANK = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_SINGLE, _FIRST, _SECOND, _SKIP = coefficients(4)


def features(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Bucket numbers, possibly repeated."""
    words = text.lower().translate(_TO_BLANK).split() if text else []
    ids = hashes.of(words)
    found = [mix(ids * _SINGLE), mix(ids[:-1] * _FIRST + ids[1:] * _SECOND), mix(ids[:-2] * _FIRST + ids[2:] * _SKIP)]
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype("int64")


def ftrl(rows: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over the rows (distinct bucket numbers each); the last one is the bias."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    l1 = np.full(BUCKETS + 1, L1)
    l1[BUCKETS] = 0

    def weights(at: Any) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) <= l1[at], 0.0, -(own - np.sign(own) * l1[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            slope = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            rate = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / ALPHA
            z[at] += slope - rate * w
            n[at] += slope * slope
    return weights(slice(None))


def _train_shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, shards = WordHashes(), {}
    for batch in batches:
        for shard, key, text, label in zip(batch["shard"], batch["key"], batch["text"], batch["label"]):
            row = np.append(np.unique(features(text, hashes)), BUCKETS).astype("int32")
            shards.setdefault(shard, []).append((key, hashlib.sha1(text or b"").digest(), int(label), row))
        hashes.trim()
    for own in shards.values():
        own.sort(key=lambda r: r[:3])
        weights = ftrl([r[3] for r in own], [r[2] for r in own])
        at = np.flatnonzero(weights)
        yield pd.DataFrame({"bucket": at, "weight": np.round(weights[at] * UNIT).astype("int64")})


def _margins(batches: Iterator[pd.Series], weights: np.ndarray) -> Iterator[pd.Series]:
    hashes = WordHashes()
    for batch in batches:
        out = np.empty(len(batch))
        for i, text in enumerate(batch):
            at = features(text, hashes)
            at = np.unique(at[weights[at] != 0])
            out[i] = weights[at].sum() + weights[BUCKETS]
        hashes.trim()
        yield pd.Series(out)


def _with_margin(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def margin(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _margins(batches, shared.value)

    return rows.withColumn("margin", margin("text"))


def _calibrated(bins: list, slope: float = 1.0, offset: float = 0.0) -> tuple[float, float]:
    """Newton steps for p = 1 / (1 + exp(-(slope * margin + offset))) on (bin, label, count) rows.

    Each label gets one more case at the mean margin, which keeps the fit finite when
    the training rows are separated.
    """
    if not bins:
        return 0.0, 0.0
    x, y, n = (np.array(c, "float64") for c in zip(*[(b["bin"] * BIN, b["label"], b["count"]) for b in bins]))
    middle = float((x * n).sum() / n.sum())
    x, y, n = np.append(x, [middle, middle]), np.append(y, [0, 1]), np.append(n, [1, 1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -35, 35)))
        e, v = n * (p - y), n * p * (1 - p) + 1e-9
        gradient = np.array([(e * x).sum() + 1e-3 * (slope - 1), e.sum()])
        curve = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 1.0 / np.abs(step).max(initial=1e-12))
        slope, offset = slope - step[0], offset - step[1]
    return max(0.0, float(slope)), float(offset)


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id, text and label of the documents that have a label.

    Texts whose id is not among the labels' hash slots are not shuffled. The join is planned the
    same way at every size.
    """
    known = labels.select(F.col(doc_id).alias("labelled"), F.col(label).alias(label)).dropna()
    near = (docs.select(doc_id, text).withColumn("slot", slot([F.col(doc_id)]))
            .join(F.broadcast(sieve(known.select("labelled"))), "slot", "left_semi"))
    return near.join(known.hint("merge"), F.col(doc_id) == F.col("labelled")).select(doc_id, text, label)


def train(rows: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> dict[str, Any]:
    """Learn from labelled rows: weights (bias last), slope and offset of the score."""
    text_batches(rows.sparkSession)
    own = written(rows.select(F.xxhash64(doc_id).alias("key"), F.col(text).cast("binary").alias("text"),
                              F.col(label).cast("int").alias("label")).filter("label in (0, 1)"), "labelled")
    shards = max(1, round(own.count() / SHARD_ROWS))
    dealt = own.withColumn("shard", F.pmod("key", F.lit(shards).cast("long"))).repartition(shards, "shard")
    averaged = (dealt.mapInPandas(_train_shard, "bucket long, weight long")
                .groupBy("bucket").agg((F.sum("weight") / (shards * UNIT)).alias("weight")).toPandas())
    weights = np.zeros(BUCKETS + 1, "float32")
    weights[averaged["bucket"].to_numpy(dtype="int64")] = averaged["weight"].to_numpy()
    place = F.greatest(F.lit(-BINS // 2), F.least(F.lit(BINS // 2), F.round(F.col("margin") / BIN))).cast("int")
    bins = _with_margin(own, weights).groupBy(place.alias("bin"), "label").count().collect()
    slope, offset = _calibrated(bins)
    return {"weights": weights, "slope": slope, "offset": offset}


def score(docs: DataFrame, model: dict[str, Any], text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """Columns ``keep`` and score: the probability of label 1."""
    text_batches(docs.sparkSession)
    rows = docs.select(carried(keep).alias("kept"), F.col(text).cast("binary").alias("text"))
    margin = F.greatest(F.lit(-35.0), F.least(F.lit(35.0), F.col("margin") * model["slope"] + model["offset"]))
    return _with_margin(rows, model["weights"]).select(*released(keep), (1 / (1 + F.exp(-margin))).alias("score"))
