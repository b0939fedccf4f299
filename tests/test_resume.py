"""Reruns: audit records of a batch are replaced, finished steps of a stopped batch stay."""

import glob
import json

import pytest

from tidepool.plans import jobs
from tidepool.schema import SOURCE_TABLES
from tidepool.session import local_path
from tidepool.sources import audit, fs, lake
from tidepool.sources.bindings import bind

SF = "/root/testdata/sf0.001"
PARAMETERS = ("1995-01-01", 10958, "2002-01-01")


def sources(spark):
    return {t: bind(spark, SF, t) for t in SOURCE_TABLES}


def records(spark, root):
    return sorted((r.batch_id, r.job, r.source_table, r.status) for r in audit.read_audit(spark, root).collect())


def test_a_rerun_replaces_exactly_its_own_records(spark, workdir):
    one, two = spark.range(3), spark.range(4)
    jobs.ingest(spark, {"t": one, "u": two}, workdir, "20260809", rules={})
    jobs.ingest(spark, {"t": one}, workdir, "20260810", rules={})
    audit.write_audit(spark, [audit.finish(audit.new_record("load", "lake", "t", "20260809"), status="SUCCESS")], workdir, "load", "20260809")
    before = records(spark, workdir)
    assert before == [("20260809", "extract", "t", "SUCCESS"), ("20260809", "extract", "u", "SUCCESS"),
                      ("20260809", "load", "t", "SUCCESS"), ("20260810", "extract", "t", "SUCCESS")]
    jobs.ingest(spark, {"t": one, "u": two}, workdir, "20260809", rules={})
    assert records(spark, workdir) == before                       # not doubled
    broken = spark.range(1).selectExpr("raise_error('gone') AS id")
    jobs.ingest(spark, {"u": broken}, workdir, "20260809", rules={})
    assert records(spark, workdir) == [("20260809", "extract", "u", "FAILED"), ("20260809", "load", "t", "SUCCESS"),
                                       ("20260810", "extract", "t", "SUCCESS")]
    manifest = json.load(open(glob.glob(f"{local_path(workdir)}/manifests/extract_log_20260809.json")[0]))
    assert [t["source_table"] for t in manifest["tables"]] == ["u"]   # the manifest is the batch's last run, too


def test_a_snapshot_carries_its_record(spark, workdir):
    for mode in jobs.PUBLISH_MODES:
        root = f"{workdir}/{mode}"
        rec = jobs.ingest(spark, {"t": spark.range(3)}, root, "b1", rules={}, publish_mode=mode)[0]
        kept = jobs.served_record(spark, lake.table_path(root, "t"), "extract", "b1")
        assert kept["status"] == "SUCCESS" and kept["rows_loaded"] == 3 and kept["file_path"] == rec["file_path"]
        assert jobs.served_record(spark, lake.table_path(root, "t"), "extract", "b2") is None
        assert jobs.served_record(spark, lake.table_path(root, "t"), "load", "b1") is None
        assert jobs.served_record(spark, lake.table_path(root, "ghost"), "extract", "b1") is None
        assert spark.read.parquet(jobs.published(spark, lake.table_path(root, "t"))).count() == 3   # no reader sees the record


@pytest.mark.parametrize("mode", jobs.PUBLISH_MODES)
def test_a_run_killed_between_load_and_build_goes_on_there(spark, workdir, monkeypatch, mode):
    """The driver goes after the load and a part of the build; the rerun does only the rest."""
    real = jobs._publish

    def dies(spark_, staged, target, *more, **named):
        if target.endswith("mart_revenue_daily"):
            raise KeyboardInterrupt
        return real(spark_, staged, target, *more, **named)

    monkeypatch.setattr(jobs, "_publish", dies)
    with pytest.raises((KeyboardInterrupt, RuntimeError)):
        jobs.run_pipeline(spark, sources(spark), workdir, *PARAMETERS, batch_id="k1", publish_mode=mode)

    published = []

    def counted(spark_, staged, target, *more, **named):
        published.append(target.rpartition("/")[2])
        return real(spark_, staged, target, *more, **named)

    monkeypatch.setattr(jobs, "_publish", counted)
    summary = jobs.run_pipeline(spark, sources(spark), workdir, *PARAMETERS, batch_id="k1", publish_mode=mode, resume=True)
    assert "mart_revenue_daily" in published and set(published) <= set(summary["models"])   # no table again, no finished model again
    assert "fact_transactions" not in published and "dim_date" not in published
    assert all(r["resumed"] for r in summary["extract"] + summary["load"])
    assert len(summary["models"]) == 12
    whole = jobs.run_pipeline(spark, sources(spark), f"{workdir}/whole", *PARAMETERS, batch_id="k1", publish_mode=mode)
    rows = lambda s: sorted(tuple(r) for r in spark.read.parquet(s["tests_path"]).collect())
    assert rows(summary) == rows(whole) and summary["status"] == whole["status"]
    assert [(r.source_table, r.status) for r in audit.read_audit(spark, workdir).where("job = 'load'").collect()].count(("members", "SUCCESS")) == 1


def test_only_the_failed_table_is_extracted_again(spark, workdir):
    feeds = {"a": spark.range(3), "b": spark.range(1).selectExpr("raise_error('down') AS id")}
    assert [r["status"] for r in jobs.ingest(spark, feeds, workdir, "r1", rules={})] == ["SUCCESS", "FAILED"]
    feeds["a"] = feeds["b"]                       # reading it again would fail
    feeds["b"] = spark.range(5)
    again = jobs.ingest(spark, feeds, workdir, "r1", rules={}, resume=True)
    assert [(r["source_table"], r["status"], r["rows_loaded"]) for r in again] == [("a", "SUCCESS", 3), ("b", "SUCCESS", 5)]
    assert records(spark, workdir) == [("r1", "extract", "a", "SUCCESS"), ("r1", "extract", "b", "SUCCESS")]


def test_what_another_batch_serves_is_not_taken_for_ones_own(spark, workdir):
    members = bind(spark, SF, "members")
    jobs.ingest(spark, {"members": members}, workdir, "b1", rules={})
    jobs.load_staging(spark, workdir, ["members"], "b1")
    jobs.ingest(spark, {"members": members.limit(2)}, workdir, "b2", rules={})     # the raw table is now b2's
    extract = jobs.ingest(spark, {"members": members.limit(9)}, workdir, "b1", rules={}, resume=True)
    assert not extract[0].get("resumed")
    load = jobs.load_staging(spark, workdir, ["members"], "b1", resume=True, redo=jobs._anew(extract))   # its input is new
    assert not load[0].get("resumed") and load[0]["rows_loaded"] == 9
    assert jobs.load_staging(spark, workdir, ["members"], "b1", resume=True)[0]["resumed"]


def test_models_are_built_anew_for_other_parameters_or_inputs(spark, workdir):
    staging = {t: bind(spark, SF, t) for t in SOURCE_TABLES}
    build = lambda *parameters, **more: jobs.build_models(spark, workdir, *parameters, staging=staging, batch_id="m1",
                                                          select=["+mart_revenue_daily"], resume=True, **more)
    build(*PARAMETERS)
    stamp = lambda name: fs.read_text(spark, f"{jobs.model_path(workdir, name)}/{fs.RECORD}")
    first = {n: stamp(n) for n in ("dim_date", "fact_transactions", "mart_revenue_daily")}
    build(*PARAMETERS)
    assert {n: stamp(n) for n in first} == first
    build(*PARAMETERS, redo={"transactions"})       # a fresh staging table: what reads it goes again, the calendar stays
    assert {n for n in first if stamp(n) != first[n]} == {"fact_transactions", "mart_revenue_daily"}
    build("1995-01-01", 10958, "2003-01-01")
    assert all(stamp(n) != first[n] for n in first)
