import os
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidepool.llm import minhash
from tidepool.llm.common import written
from tidepool.llm.oracle import ORACLE
from tidepool.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
STAGES = dict(corpus_pipeline.STAGES)


def test_every_stage_on_the_rows_before_it(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stage = lambda name, d: written(STAGES[name](spark, d, small), name)
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
    named = stage("language_id", docs)
    rejected = set(ids(docs)) - set(ids(named))
    assert len(rejected) <= 0.02 * docs.count() and named.columns == docs.columns
    exact = stage("exact_dedup", named)
    least = {}
    for r in named.collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"])
        least[key] = min(r["doc_id"], least.get(key, r["doc_id"]))
    assert ids(exact) == sorted(least.values()) and exact.columns == docs.columns
    near = stage("near_dedup", exact)
    from test_minhash import brute
    assert ids(near) == [d for d, _, c in brute([(r["doc_id"], r["text"]) for r in exact.collect()], 80) if d == c]
    mixed = stage("mixing", near)
    assert mixed.columns == docs.columns and set(ids(mixed)) <= set(ids(near))
    sizes = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in near.collect())
    taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in mixed.collect())
    assert abs(taken - 1.5 * sizes) < 0.1 * sizes
    packed = stage("packing", mixed).collect()
    want = Counter(r["doc_id"] for r in mixed.collect())
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == want
    ends = defaultdict(int)
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]] and len(r["ids"]) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 1024


def test_stages_on_edge_rows(spark, edges, small):
    docs = edges
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), name)
        if name != "packing":
            assert docs.columns == edges.columns
    assert docs.count() > 0


def test_stages_on_no_rows(spark, no_rows, small):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_rows, small).count() == 0, name


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')")
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    rows = QUERIES[name](spark, small)
    assert sorted(rows.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in rows.select(*names).collect()))) == sorted(map(str, want.fetchall()))


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_entry_works_without_the_subpackage():
    """An import hook hides the subpackage and the pipeline, as if their files were gone."""
    code = ("import sys\nclass Hide:\n    def find_spec(self, name, path=None, target=None):\n"
            "        if name.split('.')[0] == 'corpus_pipeline' or name.startswith('tidepool.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\nsys.meta_path.insert(0, Hide())\n"
            "import __spark_entry__ as e\nassert 'q_dim_date' in e.queries() and not any(n.startswith('op') for n in e.queries())\n"
            "assert 'pipeline' not in e.queries()\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
    assert minhash.BANDS * minhash.BAND_ROWS == minhash.POSITIONS
