import random

import numpy as np
import pytest

from tidepool.llm import minhash
from tidepool.llm.components import components
from tidepool.llm.hashing import WordHashes, mix, multiple


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def corpus(seed, groups, members):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 8, 60, 200]))]
        for _ in range(rng.randrange(1, members)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 40 + 2)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(500)}"
            rows.append(" ".join(words).title() if rng.random() < 0.2 else " ".join(words))
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_against_brute_force(spark, percent):
    rows = corpus(percent, 25, 9) + [(1000, None), (1001, ""), (1002, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, percent)
    assert sorted((r["id"], r["n"], r["component"]) for r in found.collect()) == brute(rows, percent)


def test_a_large_group_of_near_copies_is_whole(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(900):
        words = list(base)
        words[rng.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80)
    assert {r["component"] for r in found.collect()} == {0}


def test_signature_is_the_element_by_element_one():
    """Level by level over a batch gives what permuting element by element gives."""
    rng = np.random.default_rng(1)
    sets = [mix(rng.integers(0, 2 ** 63, n).astype("uint64")) for n in (1, 2, 7, 40, 900)]
    got = minhash.superminhash(np.concatenate(sets), np.array([len(s) for s in sets]), 16)
    for own, signature in zip(sets, got):
        want = [2 ** 64 - 1] * 16
        for element in own:
            places = list(range(16))
            for level in range(16):
                drawn = int(mix(np.array([element]) + multiple(level + 1))[0])
                k = level + ((drawn & 0xFFFFFFFF) * (16 - level) >> 32)
                places[level], places[k] = places[k], places[level]
                want[places[level]] = min(want[places[level]], level << 32 | drawn >> 32)
        assert want == [int(x) for x in signature]


def test_estimate_is_near_the_similarity():
    hashes = WordHashes()
    words = [f"w{i}".encode() for i in range(400)]
    a, b = minhash.shingles(b" ".join(words), hashes), minhash.shingles(b" ".join(words[60:]), hashes)
    signature = minhash.superminhash(np.concatenate([a, b]), np.array([len(a), len(b)]))
    real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature[0] == signature[1]).mean() - real) < 0.15


def test_edges(edges, no_rows):
    found = sorted((str(r["id"]), r["n"], str(r["component"])) for r in minhash.near_duplicates(edges).collect())
    assert ("3", 0, "3") in found and ("4", 0, "4") in found and ("5", 0, "5") in found and ("10", 1, "10") in found
    assert [f for f in found if f[0] == "2"] == [("2", 10, "1")] * 2
    assert [f for f in found if f[0] == "8"][0][2] == "7"
    kept = minhash.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "None", "9", "10", "11"])
    assert minhash.near_duplicates(no_rows).count() == 0 and minhash.keep_one(no_rows).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    assert roots == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}


def test_a_chain_through_non_central_members_is_found(spark):
    """Neighbours are linked, ends are not: no star from one member reaches all."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i:6 * i + 110])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["id"], r["n"], r["component"]) for r in minhash.near_duplicates(docs, 80).collect())
    assert got == brute(rows, 80) and {c for _, _, c in got} == {0}


def test_many_similar_but_unlinked_copies(spark):
    """A group whose members are near the threshold: brute force agrees, whatever the estimate lets through."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["id"], r["n"], r["component"]) for r in minhash.near_duplicates(docs, 85).collect()) == brute(rows, 85)


def test_shared_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 5000, n)) for n in (1, 10, 900, 3000, 4000)]
    got = minhash.shared_counts(sets[:2], sets)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:2]]


def test_null_ids_are_linked_and_one_stays(spark):
    """Near copies without ids: linked like others, and one of them stays; an id goes before none."""
    base = [f"w{k}" for k in range(60)]
    near = [" ".join(base), " ".join([*base[:-1], "x"]), " ".join(["y", *base[1:]])]
    other = " ".join(f"v{k}" for k in range(60))
    docs = spark.createDataFrame([(None, t) for t in near] + [(None, other), (None, ""), (None, None)], "doc_id long, text string")
    kept = [r["text"] for r in minhash.keep_one(docs, 80).collect()]
    assert len(kept) == 4 and sum(t in near for t in kept) == 1 and other in kept and "" in kept and None in kept
    numbered = spark.createDataFrame([(None, near[0]), (9, near[1]), (7, near[2]), (8, other), (7, other + " z")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in minhash.keep_one(numbered, 80).collect()) == [(7, other + " z"), (7, near[2])]
    found = {(r["id"], r["component"]) for r in minhash.near_duplicates(numbered, 80).collect()}
    assert found == {(None, 7), (9, 7), (7, 7), (8, 7)}
