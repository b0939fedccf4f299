import random
import re

import pytest
from pyspark.sql import functions as F

from tidepool.llm import wu_manber
from tidepool.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    """(number of words, hit places, ids) by comparing every place with every window."""
    own, hit, ids = words(text), set(), set()
    for name, item in items:
        w = words(item)
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if size else ():
            for k in range(len(own) - size + 1):
                if own[k:k + size] == w[i:i + size]:
                    hit.update(range(k, k + size))
                    ids.add("" if name is None else str(name))
    return len(own), hit, sorted(ids)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], sorted(p for a, b in r["hits"] for p in range(a, b)), list(r["items"])) for r in df.collect()), key=str)


def expected(docs, items, window=10):
    out = []
    for r in docs.collect():
        n, hit, ids = brute(r["text"], items, window)
        out.append((r["doc_id"], n, sorted(hit), ids))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [1, 2, 3, 5])
def test_search_finds_every_occurrence(length):
    rng = random.Random(length)
    search = wu_manber.Search(length)
    windows = {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(length)) for _ in range(6)}
    for k, w in enumerate(sorted(windows)):
        search.add(w, f"i{k}")
    search.done()
    for _ in range(200):
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(30))]
        direct = [(i, search.windows.index(tuple(text[i:i + length]))) for i in range(len(text) - length + 1) if tuple(text[i:i + length]) in windows]
        assert list(search.find(text)) == direct


def test_clean_text_is_mostly_skipped():
    class Counted(list):
        looks = 0

        def __getitem__(self, at):
            Counted.looks += 1
            return super().__getitem__(at)

    search = wu_manber.searches([("1", b"a b c d e f g h i j")], 10)[0]
    assert list(search.find(Counted([b"x"] * 9000))) == []
    assert Counted.looks == 999   # one block in nine words


PASSAGE = "Alpha beta, gamma 4 delta epsilon zeta eta theta iota kappa lambda!"


def test_edges_against_brute_force(spark, edges):
    items = [(1, PASSAGE), (2, "one"), (3, None), (4, "..."), (None, "le chat de"), (5, "the quick brown fox jumps over the lazy dog and runs"),
             (6, "the quick brown fox jumps over the lazy dog and runs"), (7, "word1 of the word2 of the word3 of the word4"), (7, "The QUICK Brown"), (8, "É é")]
    extra = spark.createDataFrame([(20, "so " + PASSAGE.upper() + " " + PASSAGE + " end"), (20, "alpha beta gamma"), (21, "x1 one two" * 3), (22, "\U0001f600 é")],
                                  "doc_id long, text string")
    docs = edges.unionByName(extra, allowMissingColumns=True)
    bench = spark.createDataFrame(items, ITEMS)
    right = expected(docs, items)
    assert found(wu_manber.occurrences(docs, bench)) == right
    assert found(wu_manber.occurrences(docs, bench, block_chars=30)) == right   # several passes, merged by document
    kept = wu_manber.clean(docs, bench, block_chars=30)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _, hit, _ in right if not hit)


def test_hits_of_overlapping_windows_join(spark):
    docs = spark.createDataFrame([("a", "0 1 2 3 4 5 6 7 8 9")], "doc_id string, text string")
    items = spark.createDataFrame([(1, "1 2 3"), (2, "2 3 4"), (3, "7 8"), (4, "4 5")], ITEMS)
    for size in (1, 1000):
        row = wu_manber.occurrences(docs, items, window=3, block_chars=size).withColumn("n", wu_manber.hit_words(F.col("hits"))).first()
        assert (row["doc_id"], [list(s) for s in row["hits"]], row["n"], list(row["items"])) == ("a", [[1, 6], [7, 9]], 7, ["1", "2", "3", "4"])


def test_empty_tables(spark, edges, no_rows):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, PASSAGE)], ITEMS)
    assert wu_manber.occurrences(no_rows, some).count() == 0
    clean = wu_manber.occurrences(edges, none).collect()
    assert len(clean) == edges.count() and not any(r["hits"] or r["items"] for r in clean)


def test_query_of_hot_copies(spark, workdir):
    """A third of all rows share a null id and a leaked text: each is reported."""
    rows = [(None, PASSAGE)] * 40 + [(k, f"text number {k} is clean") for k in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame([(9, PASSAGE), (10, PASSAGE)], ITEMS).write.parquet(f"{workdir}/benchmark.parquet")
    out = QUERIES["op12_decontamination"](spark, workdir).collect()
    assert len(out) == 120
    assert {(r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in out if r["doc_id"] is None} == {(12, 12, 2, True)}
    assert not any(r["contaminated"] for r in out if r["doc_id"] is not None)
