import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidepool.llm import packing
from tidepool.llm.queries import tokenizer_files

FILES = tokenizer_files()


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(FILES[0])


def check(rows, ids_of, window=1024):
    """Every id in exactly one piece; sequences gapless from 0."""
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        seen[r["id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, ids in ids_of.items():
        at = 0
        for r in sorted(seen[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
    return sum(window - sum(n for _, n in parts) for parts in sequences.values())


def test_round_trip(spark, whole):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = {r["doc_id"]: whole.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    rows = packing.packed(docs, *FILES, with_ids=True).collect()
    padding = check(rows, ids)
    assert padding < 0.08 * sum(map(len, ids.values()))
    for r in rows:
        assert r["ids"] == ids[r["id"]][r["start"]:r["start"] + r["length"]]


AWKWARD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \nb", "a\n  b", "x \t y", "it's we'll  'twas", "<|endoftext|> a",
           "tab\tq  \n\n z ", "  nbsp   em", "é ü \U0001f600 \U0001f600", "12345 67,89", "a\u0085 b", "\x1c \x1d", "a ​ b", "\r\n \r\n"]


@pytest.mark.parametrize("ranks", [FILES[1], None])
def test_parts_give_the_ids_of_the_whole(whole, ranks):
    tokens = packing.Tokens(FILES[0], ranks)
    for text in AWKWARD + [a + b for a in AWKWARD for b in AWKWARD]:
        assert np.frombuffer(tokens(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t ab'é1."), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_of_any_text(text):
    tokens = packing.Tokens(*FILES)
    assert np.frombuffer(tokens(text), "<u4").tolist() == tokens.whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_patterns_use_the_histogram_up(lengths):
    histogram = np.bincount(lengths, minlength=65)
    used = np.zeros(65, int)
    for own, repeats in packing.patterns(histogram, 64):
        assert sum(own) <= 64 and repeats > 0
        for n in own:
            used[n] += repeats
    assert used.tolist() == histogram.tolist()


def test_least_squares_fits_a_solvable_histogram():
    rows = packing.combinations(64)
    rng = np.random.default_rng(0)
    x = rng.integers(0, 30, len(rows))
    histogram = np.bincount(rows.ravel(), np.repeat(x, 3), minlength=65)
    histogram[0] = 0
    made = np.bincount(rows.ravel(), np.repeat(packing.solve(histogram, rows), 3), minlength=65)
    made[0] = 0
    assert np.abs(made - histogram).sum() < 0.02 * histogram.sum()


def test_edges(edges, no_rows, whole):
    rows = packing.packed(edges, *FILES).collect()
    texts = {r["doc_id"]: r["text"] for r in edges.collect() if r["doc_id"] not in (2, None)}
    check(rows, {})
    ids = {k: whole.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    for k, own in ids.items():
        assert sum(r["length"] for r in rows if r["id"] == k) == len(own)
    assert len([r for r in rows if r["id"] == 2]) == 2 and len([r for r in rows if r["id"] is None]) == 1
    places = [(r["sequence_id"], r["offset"]) for r in rows]
    assert len(set(places)) == len(places)
    assert packing.packed(no_rows, *FILES).count() == 0
