"""Ranked lexical search of many queries at once, with shared subexpressions evaluated once.

A document's score for an item is a sum over the item's terms, so items that share a set
of terms share that set's partial sum. The operator

1. reduces every document to its postings (number of terms, and number of occurrences of
   each term that some item has) in one pass; document frequencies come from them;
2. mines shared term sets among the items: in rounds, the pairs of nodes that most items
   hold together become new nodes (each node in at most one pair a round, chosen by the
   number of items; a term that an item repeats is that many elements), until no pair is
   held by two items. This gives a DAG whose leaves are terms and whose inner nodes are
   sums of two nodes; an item is the sum of the nodes it is left with;
3. evaluates the DAG over the postings: for a batch of documents the leaves' contributions
   are filled in, each shared node's partial sum is made once, and the items combine
   theirs. A task keeps the best ``top`` documents of each item and returns only those.

Items are handled in blocks of ``blocks.BLOCK_CHARS`` characters, each with its own
vocabulary, DAG (mined by a task) and pass; nothing larger than a block is broadcast or
held by a task. Scores are 64-bit integers, so they don't depend on the order of sums.

Defined results: a null text has no terms; documents without terms count neither in N nor
in a ranking; an item without terms, or whose terms occur nowhere, has no rows; rows that
repeat item id and text are one item, rows that share only the id (or a null id) are
ranked apart; equal scores go by ascending document id, null last; rows that repeat a
document are ranked each; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import scratch_path

from .blocks import BLOCK_CHARS, in_blocks, utf8, words
from .common import text_batches, written

TOP = 20
#: The most used nodes that a round of mining looks at.
MINED_NODES = 1024
ROUNDS = 64
#: Cells (node or item times document) that a task holds at once.
CELLS = 1 << 22
#: First ranking of the tasks' candidates: parts of an item's candidates.
PARTS = 64


def mine(items: list[list[tuple]], nodes: int = MINED_NODES, rounds: int = ROUNDS) -> tuple[list[tuple], list[tuple[int, int, int]], list[list[int]]]:
    """(leaves, inner nodes as (round, left, right), nodes of each item). Node numbers: leaves first, then inner nodes in order."""
    leaves = sorted({e for item in items for e in item})
    number = {e: k for k, e in enumerate(leaves)}
    own = [{number[e] for e in item} for item in items]
    users: dict[int, set[int]] = {}
    for k, item in enumerate(own):
        for node in item:
            users.setdefault(node, set()).add(k)
    inner: list[tuple[int, int, int]] = []
    for turn in range(1, rounds + 1):
        busy = sorted((n for n, u in users.items() if len(u) > 1), key=lambda n: (-len(users[n]), n))[:nodes]
        if len(busy) < 2:
            break
        held = np.zeros((len(own), len(busy)), np.float32)
        for column, node in enumerate(busy):
            held[list(users[node]), column] = 1
        together = np.triu(held.T @ held, 1)
        left, right = np.nonzero(together >= 2)
        taken = np.zeros(len(busy), bool)
        made = 0
        for pair in np.argsort(-together[left, right], kind="stable"):
            a, b = left[pair], right[pair]
            if taken[a] or taken[b]:
                continue
            taken[a] = taken[b] = True
            a, b = busy[a], busy[b]
            new = len(leaves) + len(inner)
            inner.append((turn, a, b))
            users[new] = users[a] & users[b]
            for item in users[new]:
                own[item] -= {a, b}
                own[item].add(new)
            users[a] = users[a] - users[new]
            users[b] = users[b] - users[new]
            made += 1
        if not made:
            break
    return leaves, inner, [sorted(item) for item in own]


def elements(text: bytes) -> list[tuple[bytes, int]]:
    """A text's terms; the k-th occurrence of a term is the element (term, k)."""
    return [(term, k) for term, n in sorted(Counter(words(text)).items()) for k in range(n)]


_DAG = "block long, items array<long>, terms array<binary>, leaves array<int>, rounds array<int>, `left` array<int>, `right` array<int>, nodes array<array<int>>"


def _dags(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("item")
    listed = [(item, e) for item, text in zip(block["item"], block["body"]) if (e := elements(text))]
    leaves, inner, nodes = mine([e for _, e in listed])
    terms = sorted({t for t, _ in leaves})
    place = {t: k for k, t in enumerate(terms)}
    return pd.DataFrame([{"block": block["block"].iloc[0], "items": [i for i, _ in listed], "terms": terms, "leaves": [place[t] for t, _ in leaves],
                          "rounds": [r for r, _, _ in inner], "left": [a for _, a, _ in inner], "right": [b for _, _, b in inner], "nodes": nodes}])


def _postings(vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            sizes, terms, counts, keep = [], [], [], []
            for place, text in enumerate(batch.column("body")):
                own = words(text.as_py())
                if own:
                    found = Counter(map(number.get, own))
                    found.pop(None, None)
                    keep.append(place)
                    sizes.append(len(own))
                    terms.append(list(found))
                    counts.append(list(found.values()))
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("missing"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], names=["id", "missing", "n", "terms", "counts"])
    return run


class _Best:
    """The best ``top`` candidates of each item so far; candidates wait until there are many."""

    def __init__(self, items: int, top: int):
        self.top, self.floor, self.rows, self.waiting = top, np.ones(items, np.int64), [], 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.floor[:, None])   # ties with the last one stay: a smaller id may win
        self.rows.append(pd.DataFrame({"place": item, "score": scores[item, doc], "missing": missing[doc], "id": ids[doc]}))
        self.waiting += len(item)
        if self.waiting > max(4 * self.top * len(self.floor), 1 << 16):
            self.rows = [self.best()]
            self.waiting = len(self.rows[0])
            last = self.rows[0].groupby("place")["score"].agg(["size", "min"])
            full = last[last["size"] >= self.top]
            self.floor[full.index.to_numpy()] = full["min"].to_numpy()

    def best(self) -> pd.DataFrame:
        rows = pd.concat(self.rows, ignore_index=True).sort_values(["place", "score", "missing", "id"], ascending=[True, False, True, True])
        return rows.groupby("place", sort=False).head(self.top)


def contributions(weight: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * counts) // (1000 * counts + 12 * m))


def _evaluate(shared, top: int, cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag = shared.value
        leaves, items, steps = dag["leaves"], dag["items"], dag["steps"]
        nodes = len(leaves) + sum(len(a) for a, _ in steps)
        width = max(1, cells // (nodes + len(dag["terms"]) + len(dag["flat"]) + len(items)))
        best = _Best(len(items), top)
        schema = None
        for batch in batches:
            schema = batch.schema
            for start in range(0, batch.num_rows, width):
                part = batch.slice(start, width)
                lists = part.column("terms")
                of = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                term = lists.flatten().to_numpy()
                leaf = np.zeros((len(dag["terms"]), part.num_rows), np.int64)
                leaf[term, of] = contributions(dag["weights"][term], part.column("counts").flatten().to_numpy(), part.column("m").to_numpy()[of])
                sums = np.empty((nodes, part.num_rows), np.int64)
                sums[:len(leaves)] = leaf[leaves]
                done = len(leaves)
                for left, right in steps:
                    np.add(sums[left], sums[right], out=sums[done:done + len(left)])
                    done += len(left)
                scores = np.add.reduceat(sums[dag["flat"]], dag["starts"], axis=0)
                best.add(scores, part.column("id").to_numpy(zero_copy_only=False), part.column("missing").to_numpy(zero_copy_only=False))
        if best.rows:
            found = best.best()
            yield pa.RecordBatch.from_arrays(
                [pa.array(items[found["place"].to_numpy()], pa.int64()), pa.array(found["id"], schema.field("id").type),
                 pa.array(found["missing"], pa.bool_()), pa.array(found["score"], pa.int64())], names=["item", "id", "missing", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           top: int = TOP, block_chars: int = BLOCK_CHARS, cells: int = CELLS) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank (from 1), the document's id, score."""
    spark = docs.sparkSession
    text_batches(spark)
    kind = docs.schema[id].dataType.simpleString()
    queries = (items.select(F.col(item_id).alias("item_id"), F.coalesce(item_text, F.lit("")).alias("words")).distinct()
               .withColumn("weight", (F.length("words") + 1).cast("long")))
    queries, passes = in_blocks(queries, "weight", ["item_id", "words"], block_chars)
    queries = written(queries.withColumn("item", F.monotonically_increasing_id()), "items")
    dags = written(queries.select("block", "item", utf8(F.col("words")).alias("body")).groupBy("block").applyInPandas(_dags, _DAG), "dags")
    rows = docs.select(F.coalesce(F.col(id), F.lit("0").cast(kind)).alias("id"), F.col(id).isNull().alias("missing"), utf8(F.col(text)).alias("body"))
    path = scratch_path(spark, "llm", "candidates")
    candidate = f"item long, id {kind}, missing boolean, score long"
    spark.createDataFrame([], candidate).write.parquet(path)
    for block in range(passes):
        dag = dags.filter(F.col("block") == block).first()
        if dag is None or not dag["items"]:
            continue
        vocabulary = spark.sparkContext.broadcast({bytes(t): k for k, t in enumerate(dag["terms"])})
        postings = written(rows.mapInArrow(_postings(vocabulary), f"id {kind}, missing boolean, n long, terms array<int>, counts array<long>"), "postings")
        vocabulary.unpersist()
        documents, total = postings.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        df = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()   # at most the block's vocabulary
        shared = spark.sparkContext.broadcast(_prepared(dag, documents, {r["term"]: r["count"] for r in df}))
        length = F.expr(f"75 + (25 * n * {documents}L) div {total}L")
        (postings.filter(F.size("terms") > 0).withColumn("m", length).mapInArrow(_evaluate(shared, top, cells), candidate)
         .write.mode("append").parquet(path))
        shared.unpersist()
    return _ranked(spark.read.parquet(path), queries, top).select("item_id", "rank", F.when(~F.col("missing"), F.col("id")).alias(id), "score")


def _prepared(dag, documents: int, df: dict[int, int]) -> dict:
    frequency = np.array([df.get(k, 0) for k in range(len(dag["terms"]))], np.float64)
    rounds = np.array(dag["rounds"], np.int64)
    left, right = np.array(dag["left"], np.int64), np.array(dag["right"], np.int64)
    return {"items": np.array(dag["items"], np.int64), "terms": range(len(dag["terms"])), "leaves": np.array(dag["leaves"], np.int64),
            "weights": np.floor(1000 * np.log((2 * documents + 2) / (2 * frequency + 1))).astype(np.int64),
            "steps": [(left[rounds == r], right[rounds == r]) for r in np.unique(rounds)],
            "flat": np.array([n for nodes in dag["nodes"] for n in nodes], np.int64),
            "starts": np.cumsum([0, *[len(nodes) for nodes in dag["nodes"]]])[:-1]}


def _ranked(found: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """Every task gives at most ``top`` rows an item; they are ranked in parts, then the parts' best."""
    order = [F.col("score").desc(), F.col("missing"), F.col("id")]
    parts = found.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    first = (parts.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
             .filter(F.col("rank") <= top))
    last = (first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .filter(F.col("rank") <= top))
    return last.join(queries.select("item", "item_id"), "item")
