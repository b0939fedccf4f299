"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The test strings are the windows of ``WINDOW`` consecutive words of every item (an item
of fewer words, but not none, is one window). Windows of one length form one search:

* SHIFT: for each block of two consecutive words (one, for windows of one word), how far
  the search may advance when the block ends at its place: the block's least distance
  from the end of a window; blocks of no window allow the largest advance, so most of a
  clean text is never looked at;
* HASH: windows by their last block, where the shift is 0, then by their first words;
* the windows found there are compared word by word.

Items are searched in blocks of ``blocks.BLOCK_CHARS`` characters; a block's tables are
broadcast, each block is a pass over all documents, and the passes are merged by document.
Only rows of (id, hash of the text) with their hits are shuffled, never texts.

Defined results: a null or empty text has no words and no hits; an item without words has
no windows; a null item id counts as the empty id; rows that repeat id and text are
reported once each, and so are rows with null ids; long texts are searched whole; an
empty table of items leaves every document clean, an empty table of documents gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.session import scratch_path

from .blocks import BLOCK_CHARS, in_blocks, utf8, words
from .common import text_batches, whole_row

WINDOW = 10


class Search:
    """Windows of one length; ``names`` are the items in which each window occurs."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[int]]] = {}
        self.windows: list[tuple] = []
        self.names: list[set[str]] = []
        self._numbers: dict[tuple, int] = {}

    def add(self, window: tuple, name: str) -> None:
        number = self._numbers.setdefault(window, len(self.windows))
        if number < len(self.windows):
            self.names[number].add(name)
            return
        self.windows.append(window)
        self.names.append({name})
        for end in range(self.block, self.length + 1):
            key = window[end - self.block:end]
            self.shift[key] = min(self.shift.get(key, self.far), self.length - end)
        self.buckets.setdefault(window[-self.block:], {}).setdefault(window[:self.block], []).append(number)

    def done(self) -> Search:
        self._numbers = {}
        return self

    def find(self, text: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, number of the window) of every occurrence, in order."""
        length, block, far, shift = self.length, self.block, self.far, self.shift
        end = length
        while end <= len(text):
            last = tuple(text[end - block:end])
            step = shift.get(last, far)
            if step:
                end += step
                continue
            start = end - length
            candidates = self.buckets[last].get(tuple(text[start:start + block]))
            if candidates:
                here = tuple(text[start:end])
                for number in candidates:
                    if self.windows[number] == here:
                        yield start, number
            end += 1


def searches(items: list[tuple[str, bytes]], window: int) -> list[Search]:
    """A search for each length of window among the items (id, text)."""
    by_length: dict[int, Search] = {}
    for name, text in items:
        own = words(text)
        if own:
            length = min(window, len(own))
            search = by_length.setdefault(length, Search(length))
            for start in range(len(own) - length + 1):
                search.add(tuple(own[start:start + length]), name)
    return [by_length[k].done() for k in sorted(by_length)]


def joined(spans: list[tuple[int, int]]) -> list[list[int]]:
    """The union of spans of words, as separate spans in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _pass(tables, first: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows of the first pass are all documents; later passes give those with hits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep, lengths, spans, names = [], [], [], []
            for place, text in enumerate(batch["body"]):
                own = words(text)
                found, items = [], set()
                for search in tables.value:
                    numbers = set()
                    for start, number in search.find(own):
                        found.append((start, start + search.length))
                        numbers.add(number)
                    items.update(*[search.names[n] for n in numbers])
                if first or found:
                    keep.append(place)
                    lengths.append(len(own))
                    spans.append(joined(found))
                    names.append(sorted(items))
            rows = batch.drop(columns="body").iloc[keep]
            yield rows.assign(copies=int(first), n_words=lengths, hits=pd.Series(spans, index=rows.index, dtype=object),
                              items=pd.Series(names, index=rows.index, dtype=object))
    return run


def _keys(docs: DataFrame, id: str, text: str) -> list[Column]:
    """What tells rows apart: rows that agree in all of it have the same result."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.col(id).cast("string").alias("id"), F.xxhash64(body).alias("tag"), F.length(body).alias("chars")]


def _merged(docs: DataFrame, items: DataFrame, id: str, text: str, item_id: str, item_text: str, window: int, block_chars: int) -> DataFrame:
    """Hits by key of rows, and the number of rows with that key."""
    spark = docs.sparkSession
    text_batches(spark)
    queries = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.coalesce(item_text, F.lit("")).alias("words"))
    queries, passes = in_blocks(queries.withColumn("weight", (F.length("words") + 1).cast("long")), "weight", ["name", "words"], block_chars)
    rows = docs.select(*_keys(docs, id, text), utf8(F.col(text)).alias("body"))
    path = scratch_path(spark, "llm", "hits")
    for number in range(max(1, passes)):
        block = queries.filter(F.col("block") == number).select("name", utf8(F.col("words")).alias("words")).collect()
        tables = spark.sparkContext.broadcast(searches([(r["name"], bytes(r["words"])) for r in block], window))
        (rows.mapInPandas(_pass(tables, number == 0), "id string, tag long, chars int, copies int, n_words long, hits array<array<long>>, items array<string>")
         .write.mode("append").parquet(path))
        tables.unpersist()
    return (spark.read.parquet(path).groupBy("id", "tag", "chars")
            .agg(F.sum("copies").alias("copies"), F.max("n_words").alias("n_words"), F.flatten(F.collect_set("hits")).alias("hits"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))


def occurrences(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document: id, n_words, hits (spans of words [start, end) inside occurrences, apart and in order), items (ids with occurrences, sorted)."""
    return (_merged(docs, items, id, text, item_id, item_text, window, block_chars)
            .withColumn("hits", _union(F.col("hits")))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(F.col("id").cast(docs.schema[id].dataType).alias(id), "n_words", "hits", "items"))


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without a hit, whole. A row goes by its own text, also where ids repeat or are null."""
    dirty = (_merged(docs, items, id, text, item_id, item_text, window, block_chars).filter(F.size("hits") > 0)
             .select(F.struct("id", "tag", "chars").alias("who")))
    return (docs.select(F.struct(*_keys(docs, id, text)).alias("mine"), whole_row(docs).alias("row"))
            .join(dirty, F.col("mine").eqNullSafe(F.col("who")), "left_anti").select("row.*"))


def _union(spans: Column) -> Column:
    """The spans of all passes, joined where they touch."""
    none = F.array().cast("array<array<bigint>>")
    last = lambda done: F.element_at(done, -1)

    def add(done: Column, span: Column) -> Column:
        touches = (F.size(done) > 0) & (F.coalesce(F.try_element_at(done, F.lit(-1))[1], F.lit(-1)) >= span[0])
        wider = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                         F.array(F.array(last(done)[0], F.greatest(last(done)[1], span[1]))))
        return F.when(touches, wider).otherwise(F.concat(done, F.array(span)))
    return F.aggregate(F.array_sort(spans), none, add)


def hit_words(hits: Column) -> Column:
    """Number of words in the spans of ``occurrences``."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, span: n + span[1] - span[0])
