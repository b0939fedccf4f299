import random
import re
from collections import Counter, defaultdict

import numpy as np

from tidepool.llm import divergence

DOCS = "doc_id long, text string, lang string, source string"


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, min_docs, top=50):
    by_group, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        own = terms(text)
        by_group[lang or "", source or ""].update(own)
        docs[lang or ""].update(set(own))
    out = []
    for lang in {g[0] for g in by_group}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {g[1]: c for g, c in by_group.items() if g[0] == lang}
        whole = sum(groups.values(), Counter())

        def p(c, t):
            return 1 + (10 ** 9 * (c[t] + 5)) // (sum(c[x] for x in kept) + 5 * len(kept))
        price = {s: {t: p(c, t) for t in kept} for s, c in groups.items()}
        q = {t: p(whole, t) for t in kept}
        for s, c in groups.items():
            pairs = [(-sum(abs(price[s][t] - price[o][t]) for t in kept), o) for o in groups if o != s]
            over = [(q[t] - price[s][t], t.encode()) for t in kept if c[t] and price[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(sorted(over)[:top])]
    return sorted(out)


def found(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def triples(docs):
    return [(r["text"], r["lang"], r["source"]) for r in docs.select("text", "lang", "source").collect()]


def test_joint_tables_give_the_distances():
    rng = np.random.default_rng(3)
    levels = rng.zipf(1.6, (300, 7)) % 90
    price = levels * 1_000_003 + np.arange(7)   # a price for each (group, level)
    direct = np.abs(price[:, :3, None] - price[:, None, 3:]).sum(axis=0)
    for columns in (4, 40, 10_000):   # halves of the block give the same sums
        got = divergence.distances(levels[:, :3], price[:, :3], levels[:, 3:], price[:, 3:], columns)
        assert (got == direct).all()


def test_edges_against_brute_force(edges):
    for least in (1, 2, 30):
        assert found(divergence.audit(edges, min_docs=least)) == brute(triples(edges), least)


def corpus(spark, sources, seed=5):
    rng = random.Random(seed)
    names = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    rows = []
    for k in range(sources * 12):
        lang, source = rng.choice(["en", "en", "fr", None]), (f"s{k % sources}" if rng.random() < 0.7 else "hot")
        rows.append((k, " ".join(rng.choices(names, weights=[3 + (j * (k % 5 + 1)) % 17 for j in range(120)], k=rng.randrange(40))), lang, source))
    return spark.createDataFrame(rows, DOCS)


def test_many_sources_take_several_tiles(spark):
    docs = corpus(spark, 40)
    assert found(divergence.audit(docs, min_docs=3, top=7)) == brute(triples(docs), 3, top=7)


def test_blocks_of_terms_add_up(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_TERMS", 8)
    docs = corpus(spark, 5, seed=6)
    assert found(divergence.audit(docs, min_docs=2)) == brute(triples(docs), 2)


def test_counting_in_pieces(spark, monkeypatch):
    docs = corpus(spark, 5, seed=7)
    import pandas as pd

    batch = docs.toPandas().assign(lang="en", body=lambda d: d["text"].str.encode("utf-8"))
    whole = pd.concat(divergence._count(iter([batch])))
    monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    parts = pd.concat(divergence._count(iter([batch.iloc[k:k + 9] for k in range(0, len(batch), 9)])))
    keys = ["lang", "source", "term"]
    assert parts.groupby(keys).sum(numeric_only=True).equals(whole.groupby(keys).sum(numeric_only=True))
    assert len(parts) > len(whole)


def test_probability_of_large_counts_is_exact(spark):
    from pyspark.sql import functions as F

    n, mass, v = 7_000_000_000_000, 9_000_000_000_001, 12345
    got = spark.range(1).select(divergence.probability(F.lit(n), F.lit(mass), F.lit(v)).alias("p")).first()["p"]
    assert got == 1 + (10 ** 9 * (n + 5)) // (mass + 5 * v)


def test_languages_without_kept_terms_and_empty_tables(spark, no_rows):
    docs = spark.createDataFrame([(1, "a b", "xx", "s1"), (2, None, "xx", None), (3, "", None, "only")], DOCS)
    assert found(divergence.audit(docs)) == [("xx", "", "pair", "s1", 0, 1), ("xx", "s1", "pair", "", 0, 1)]
    assert divergence.audit(no_rows).count() == 0
