import math
import random
import re
from collections import Counter

from tidepool.llm import ranked_search
from tidepool.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    own = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in own]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in own for t in c)
    out = []
    for name, text in items:
        scores = []
        for (doc, c), size in zip(own, sizes):
            if size:
                m = 75 + (25 * size * n) // total
                scores.append((-sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                                    for t in words(text)), doc is None, doc))
        ranked = sorted(s for s in scores if s[0] < 0)[:top]
        out += [(name, k + 1, doc, -score) for k, (score, _, doc) in enumerate(ranked)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def expanded(leaves, inner, nodes):
    """The leaves that each item's nodes add up to."""
    of = [Counter([leaf]) for leaf in leaves]
    for _, a, b in inner:
        of.append(of[a] + of[b])
    return [sum((of[n] for n in item), Counter()) for item in nodes]


def test_mined_nodes_add_up_to_the_items_and_save_sums():
    rng = random.Random(1)
    vocabulary = [f"w{k}".encode() for k in range(60)]
    items = [ranked_search.elements(b" ".join(rng.choices(vocabulary, weights=range(60, 0, -1), k=30))) for _ in range(40)]
    leaves, inner, nodes = ranked_search.mine(items)
    assert expanded(leaves, inner, nodes) == [Counter(item) for item in items]
    plain = sum(len(item) - 1 for item in items)
    shared = len(inner) + sum(len(item) - 1 for item in nodes)
    assert shared < 0.6 * plain
    assert ranked_search.mine([]) == ([], [], [])


def test_edges_against_brute_force(spark, edges):
    items = [(1, "the quick fox the lazy dog the"), (2, "word3 word5 of the end"), (3, None), (4, "?!"), (5, "nowhere to be seen1"),
             (6, "le chat é la table"), (None, "one fox"), (7, "HUNTER2HUNTER2 password")]
    bench = spark.createDataFrame(items + [items[0]], ITEMS)   # a repeated row is the same item
    right = brute(rows(edges), items)
    assert found(ranked_search.search(edges, bench)) == right
    assert found(ranked_search.search(edges, bench, block_chars=20, cells=64)) == right
    assert found(ranked_search.search(edges, bench, top=2)) == brute(rows(edges), items, top=2)


def test_an_id_with_two_texts_is_two_items(spark, edges):
    bench = spark.createDataFrame([(1, "fox"), (1, "chat")], ITEMS)
    assert found(ranked_search.search(edges, bench)) == brute(rows(edges), [(1, "fox"), (1, "chat")])


def test_ties_of_a_large_group_of_copies_go_by_id(spark):
    docs = [(k, "same words here") for k in range(500)] + [(None, "same words here"), (1000, "other")]
    random.Random(0).shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "words same")], ITEMS)
    assert [(r["rank"], r["doc_id"]) for r in ranked_search.search(frame, items).orderBy("rank").collect()] == [(k + 1, k) for k in range(20)]


def test_best_keeps_ties_below_the_floor_out_and_smaller_ids_in(spark):
    """Many batches: the floor rises, and a later equal score with a smaller id still wins."""
    import numpy as np

    best = ranked_search._Best(1, 3)
    for start in range(90_000, 0, -1000):
        ids = np.arange(start, start - 1000, -1)
        best.add(np.full((1, 1000), 7), ids, np.zeros(1000, bool))
    assert best.best()["id"].tolist() == [1, 2, 3]


def test_text_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame([("b", "x y", 1), ("a", "x y", 2), (None, "x", 3)], "name string, body string, item_id int")
    items = spark.createDataFrame([("q", "x y z", 0)], "q string, t string, doc_id int")
    out = ranked_search.search(docs, items, id="name", text="body", item_id="q", item_text="t").orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["name"]) for r in out] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


def test_empty_tables(spark, edges, no_rows):
    some, none = spark.createDataFrame([(1, "fox")], ITEMS), spark.createDataFrame([], ITEMS)
    assert ranked_search.search(no_rows, some).count() == 0
    assert ranked_search.search(edges, none).count() == 0
    assert ranked_search.search(edges, spark.createDataFrame([(1, "..."), (2, None)], ITEMS)).count() == 0


def test_query_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert found(QUERIES["op11_ranked_search"](spark, small)) == brute(rows(docs), items)
