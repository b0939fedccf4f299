import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidepool.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes):
    """Targets by hand: (source -> words) in code-point order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {**out, **{s: weight[s] * level for s in open_}}
        for s in over:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= over


def test_targets_and_taken_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "source", "text").collect()
    sizes, source = Counter(), {}
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
        source[r["doc_id"]] = r["source"]
    want = shares(sizes)
    found = mixing.mix(docs).collect()
    taken = Counter()
    for r in found:
        s = source[r["id"]]
        taken[s] += r["taken"]
        assert r["target"] == pytest.approx(want[s]) and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 2 * r["size"]
    assert len(found) == len(rows) and all(abs(taken[s] - want[s]) <= 2 * mixing.BLOCK_WORDS for s in want)
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(docs).collect()))


def test_permutations_are_permutations():
    for size in (1, 2, 3, 17, 64, 1000):
        at = np.arange(size)
        for key in (0, -5, 2 ** 62):
            got = mixing.permuted(at, np.full(size, size), np.full(size, key))
            assert sorted(got) == list(range(size))
    assert not np.array_equal(mixing.permuted(at, np.full(size, size), np.full(size, 1)), mixing.permuted(at, np.full(size, size), np.full(size, 2)))


def test_mix_and_plan_agree(spark):
    """The rows of the mix hold each document's taken words, in pieces of at most a block, repeats included."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r["doc_id"]: WORD.findall(r["text"]) for r in docs.collect()}
    rows = mixing.mixed(docs, block_words=64)
    assert rows.columns == docs.columns
    words = defaultdict(int)
    for r in rows.collect():
        own = WORD.findall(r["text"])
        words[r["doc_id"]] += len(own)
        assert 1 <= len(own) <= 64 and r["n_chars"] == len(r["text"])
        assert " ".join(own) in " ".join(text[r["doc_id"]])
    plan = {r["id"]: r["taken"] for r in mixing.mix(docs, block_words=64).collect()}
    assert {k: v for k, v in plan.items() if v} == dict(words)


def test_edges(edges, no_rows):
    found = mixing.mix(edges).collect()
    assert len(found) == edges.count() and sum(r["taken"] for r in found if r["size"] == 0) == 0
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    mixed = mixing.mixed(edges)
    assert mixed.columns == edges.columns and mixed.count() > 0
    assert mixing.mix(no_rows).count() == 0 and mixing.mixed(no_rows).count() == 0
    blank = edges.filter("doc_id in (3, 4, 5)")
    assert {(r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(0.0, 0)}
