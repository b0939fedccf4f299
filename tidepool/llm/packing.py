"""Packing by non-negative least squares over shallow length combinations.

1. Every text is tokenised (its ids, then an end id 0) and cut at multiples of the
   window. Whole windows are sequences of their own; of each document at most one
   shorter remainder is left.
2. The remainders' histogram has one bin per length below the window, whatever the
   corpus size. All pairs and triples of lengths that fill the window exactly are
   enumerated; repeat counts are solved for by non-negative least squares against the
   histogram (multiplicative updates), and rounded within what the bins hold.
3. What is left of the histogram is packed greedily, largest lengths first.
4. Pieces of a length are ranked (in chunks, so a length may hold any share of the
   rows), and the rank picks the pattern, the repeat and the place in it from a table
   whose size depends on the window only.

Tokens: ids are those of ``tokenizers`` for the given file. Texts are cut at spaces
first, and the ids of each part are kept, because byte-level pieces never reach across a space that
follows a non-blank; the few texts with a blank on both sides of a space, or with the
text of a special token, are encoded whole. Parts seen for the first time are encoded
from the same vocabulary's ranks, which gives the same ids (tested) at a fraction of
the cost.

Defined results: null and empty texts are the end id alone; repeated rows are packed
as often as they occur; columns beside id and text are not looked at; an empty table
gives an empty result. Very long texts are encoded whole, one at a time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, with_ranks, written

WINDOW = 1024
END_ID = 0
ROUNDS = 200
#: Parts whose ids a worker keeps.
KEPT_PARTS = 400_000
#: A space with a blank before it and a blank or the end after it: only there does a run of blanks reach across a cut.
ACROSS = re.compile(r"\s (?:\s|$)")


@cache
def _encoders(vocabulary: str, ranks: str | None):
    """(whole text -> ids, part -> ids) of a worker."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    if ranks is None:
        return whole, None
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        pieces = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return whole, tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pieces, special_tokens={})


class Tokens:
    """ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str, ranks: str | None = None):
        self.whole, self.parts = _encoders(vocabulary, ranks)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.kept: dict[str, bytes] = {}

    def _first_seen(self, part: str) -> bytes:
        ids = self.parts.encode_ordinary(part) if self.parts else self.whole.encode(part, add_special_tokens=False).ids
        value = np.array(ids, "<u4").tobytes()
        if len(self.kept) >= KEPT_PARTS:
            self.kept.clear()
        self.kept[part] = value
        return value

    def __call__(self, text: str) -> bytes:
        if ACROSS.search(text) or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        found = [self.kept.get(first) or self._first_seen(first)] if first else []
        known = self.kept.get
        found += [known(p) or self._first_seen(p) for p in map(" ".__add__, rest)]
        return b"".join(found)


@cache
def packed_type(vocabulary: str) -> str:
    """The numpy type of packed ids."""
    whole, _ = _encoders(vocabulary, None)
    return "<u2" if whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text",
           window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens (and ids, packed), cut at multiples of the window.

    Packed ids are little-endian unsigned integers of 2 bytes, or 4 for a vocabulary of more than 2^16.
    """
    text_batches(docs.sparkSession)
    narrow = packed_type(vocabulary)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens(vocabulary, ranks)
        for batch in batches:
            out = []
            for name, t in zip(batch["id"], batch["text"]):
                ids = (tokens(t) if t else b"") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start:4 * (start + window)]
                    out.append((name, start, len(part) // 4, zlib.crc32(part), total) + ((np.frombuffer(part, "<u4").astype(narrow).tobytes(),) if with_ids else ()))
            yield pd.DataFrame(out, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:5 + with_ids])

    kind = docs.select(F.col(doc_id).alias("id")).schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInPandas(cut, schema)


def combinations(window: int = WINDOW) -> np.ndarray:
    """All pairs and triples of lengths that fill the window; a pair has a third length of 0."""
    a = np.arange(0, window // 3 + 1)
    low, mid = np.meshgrid(a, np.arange(1, window // 2 + 1), indexing="ij")
    low, mid = low.ravel(), mid.ravel()
    high = window - low - mid
    fits = (low <= mid) & (mid <= high)
    return np.stack([high, mid, low], 1)[fits]


def solve(histogram: np.ndarray, rows: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring sum(x * rows) near the histogram in least squares.

    Multiplicative updates keep x non-negative: x times A'h over A'Ax.
    """
    weight = (rows > 0).astype("float64")
    goal = histogram.astype("float64").copy()
    goal[0] = 0
    up = (goal[rows] * weight).sum(1)
    x = np.where((goal[rows] > 0).all(1, where=rows > 0), 1.0, 0.0)
    for _ in range(rounds):
        made = np.bincount(rows.ravel(), (x[:, None] * weight).ravel(), minlength=len(histogram))
        x *= up / np.maximum((made[rows] * weight).sum(1), 1e-12)
    return x


def patterns(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[list[int], int]]:
    """(lengths in a sequence, repeats) that together use up the histogram exactly."""
    left = [int(n) for n in histogram]
    out: list[tuple[list[int], int]] = []

    def take(lengths: list[int], most: int) -> None:
        repeats = min([most, *(left[n] // lengths.count(n) for n in set(lengths))])
        if repeats > 0:
            out.append((lengths, repeats))
            for n in lengths:
                left[n] -= repeats

    rows = combinations(window)
    x = solve(histogram, rows)
    order = np.argsort(-x, kind="stable")
    order = order[x[order] > 1e-3]
    for rounded in (np.floor, np.ceil):
        for i in order:
            if (n := int(rounded(x[i]))) > 0:
                take([int(v) for v in rows[i] if v], n)
    for largest in range(window, 0, -1):   # the residual: largest first, filled with the largest that fits
        while left[largest]:
            lengths, room = [largest], window - largest
            own = {largest: 1}
            fit = min(room, largest)
            while fit > 0:
                if left[fit] - own.get(fit, 0) > 0:
                    lengths.append(fit)
                    own[fit] = own.get(fit, 0) + 1
                    room -= fit
                    fit = min(fit, room)
                else:
                    fit -= 1
            take(lengths, left[largest])
    return out


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds sequence_id and offset to written pieces (see ``pieces``)."""
    counts = cut.groupBy("length").count().collect()   # one row per length: at most ``window``
    histogram = np.zeros(window + 1, "int64")
    for r in counts:
        histogram[r["length"]] = r["count"]
    rows, at = [], 0
    used = np.zeros(window + 1, "int64")
    for lengths, repeats in patterns(histogram, window):
        offset = 0
        for n in lengths:
            rows.append((n, used[n], at, offset))
            used[n] += repeats
            offset += n
        at += repeats
    table = np.array(sorted(rows), "int64").reshape(-1, 4)
    starts = table[:, 0] << 48 | table[:, 1]
    shared = cut.sparkSession.sparkContext.broadcast((starts, table))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        begins, own = shared.value
        for length, rank in batches:
            row = own[np.searchsorted(begins, (length.to_numpy() << 48) | rank.to_numpy(), "right") - 1]
            yield pd.DataFrame({"sequence_id": row[:, 2] + rank.to_numpy() - row[:, 1], "offset": row[:, 3]})

    ranked = with_ranks(cut, ["length"], ["id", "start", "ids_crc32", "doc_tokens"], None, "rank", int(histogram.sum()))
    return ranked.withColumn("placed", place("length", "rank")).select(*cut.columns, "placed.*")


def packed(docs: DataFrame, vocabulary: str, ranks: str | None = None, doc_id: str = "doc_id", text: str = "text",
           window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: a row per piece with its sequence and offset (and ids)."""
    found = pack(written(pieces(docs, vocabulary, ranks, doc_id, text, window, with_ids), "pieces"), window)
    if not with_ids:
        return found
    narrow = packed_type(vocabulary)

    @F.pandas_udf("array<long>")
    def unpacked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda ids: np.frombuffer(ids, narrow).astype("int64"))

    return found.withColumn("ids", unpacked("ids"))   # after the shuffle
