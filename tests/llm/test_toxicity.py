import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import toxicity
from tidepool.llm.queries import QUERIES


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op3_toxicity"](spark, sf).filter("held_out").join(docs, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit >= 0.65 * sum(r["toxic"] for r in rows) and hit >= 0.9 * sum(r["predicted"] for r in rows)


def test_ftrl_is_the_coordinate_by_coordinate_one():
    rng = np.random.default_rng(1)
    rows = [np.append(np.unique(rng.integers(0, 50, 12)), toxicity.BUCKETS).astype("int32") for _ in range(60)]
    labels = [int(r[0] % 2) for r in rows]
    got = toxicity.ftrl(rows, labels, 2)
    z, n = {}, {}

    def weight(i):
        l1 = 0 if i == toxicity.BUCKETS else toxicity.L1
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - np.sign(v) * l1) / ((toxicity.BETA + n.get(i, 0.0) ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for epoch in range(2):
        for at in np.random.default_rng(epoch).permutation(len(rows)):
            own = {int(i): weight(int(i)) for i in rows[at]}
            slope = 1 / (1 + np.exp(-sum(own.values()))) - labels[at]
            for i, w in own.items():
                before = n.get(i, 0.0)
                n[i] = before + slope ** 2
                z[i] = z.get(i, 0.0) + slope - (n[i] ** 0.5 - before ** 0.5) / toxicity.ALPHA * w
    for i in [*range(50), toxicity.BUCKETS]:
        assert got[i] == pytest.approx(weight(i), abs=1e-9)
    assert (got == 0).sum() > toxicity.BUCKETS - 60   # sparse


def test_learns_from_a_few_rows_and_scores_edges(spark, edges, no_rows):
    words = ["alpha beta gamma", "delta of epsilon", "zeta and eta"]
    rows = spark.createDataFrame([(i, f"{words[i % 3]} {'vile' if i % 2 else 'kind'} {i}", i % 2) for i in range(400)],
                                 "doc_id long, text string, toxic int")
    model = toxicity.train(rows)
    texts = spark.createDataFrame([("so vile it is",), ("so kind it is",)], "text string")
    high, low = [r["score"] for r in toxicity.score(texts, model).collect()]
    assert high > 0.7 > 0.3 > low
    found = toxicity.score(edges, model, keep=[F.col("doc_id"), F.col("text")]).collect()
    assert len(found) == edges.count() and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if not (r["text"] or "").strip()}) == 1
    nothing = toxicity.train(rows.limit(0))
    assert {r["score"] for r in toxicity.score(edges, nothing).collect()} == {0.5}
    assert toxicity.score(no_rows, model).count() == 0
    assert toxicity.train(rows.withColumn("toxic", F.lit(None).cast("int")))["slope"] == 0


def test_the_order_of_rows_does_not_matter(spark, monkeypatch):
    """Shuffled input in one or many partitions, in one shard or several: the same weights to the last bit."""
    rng = np.random.default_rng(5)
    rows = [(int(i % 500), " ".join(f"w{k}" for k in rng.integers(0, 80, 15)) + (" vile" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(600)]
    schema = "doc_id long, text string, toxic int"
    for shard_rows in (toxicity.SHARD_ROWS, 150):
        monkeypatch.setattr(toxicity, "SHARD_ROWS", shard_rows)
        first = toxicity.train(spark.createDataFrame(rows, schema).coalesce(1))
        for parts in (1, 7):
            order = rng.permutation(len(rows))
            again = toxicity.train(spark.createDataFrame([rows[i] for i in order], schema).repartition(parts))
            assert (again["weights"] == first["weights"]).all()
            assert (again["slope"], again["offset"]) == pytest.approx((first["slope"], first["offset"]), rel=1e-9)
        assert np.count_nonzero(first["weights"]) > 1


def test_training_against_a_restatement(spark, monkeypatch):
    """Shards, FTRL in them, averages: from plain dictionaries."""
    import hashlib

    monkeypatch.setattr(toxicity, "SHARD_ROWS", 60)
    rows = [(i, f"a{i % 7} b{i % 5} {'vile' if i % 2 else 'kind'} c{i % 3}", i % 2) for i in range(180)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df)
    keys = {r["doc_id"]: r["k"] for r in df.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    hashes, total = toxicity.WordHashes(), np.zeros(toxicity.BUCKETS + 1)
    for shard in range(3):
        own = sorted((keys[i], hashlib.sha1(t.encode()).digest(), y, t) for i, t, y in rows if keys[i] % 3 == shard)
        feats = [np.append(np.unique(toxicity.features(t.encode(), hashes)), toxicity.BUCKETS).astype("int32") for *_, t in own]
        total += toxicity.ftrl(feats, [y for _, _, y, _ in own])
    assert np.allclose(model["weights"], total / 3, atol=1e-6)
