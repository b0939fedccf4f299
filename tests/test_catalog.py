"""Layers as catalog databases."""

import uuid

import pytest

from tidepool.plans import jobs
from tidepool.schema import SOURCE_TABLES
from tidepool.sources import catalog
from tidepool.sources.bindings import bind, bind_all

SF = "/root/testdata/sf0.001"
PARAMETERS = ("1995-01-01", 10958, "2002-01-01")


@pytest.fixture
def databases(spark):
    """Names of their own, so that tests don't meet."""
    tag = uuid.uuid4().hex[:8].upper()
    made = catalog.Databases(f"WAREHOUSE_{tag}", {"staging": f"STAGING_{tag}", "mart": f"MART_{tag}"})
    yield made
    for layer in catalog.LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {made.database(layer)} CASCADE")


def test_schema_names():
    assert catalog.schema_name("MART", "WAREHOUSE") == "MART"          # verbatim, no target in front
    assert catalog.schema_name(None, "WAREHOUSE") == catalog.schema_name("", "WAREHOUSE") == "WAREHOUSE"
    own = catalog.Databases.configured()
    assert [own.database(layer) for layer in catalog.LAYERS] == ["STAGING", "WAREHOUSE", "MART"]
    assert catalog.Databases("dev").database("mart") == "dev"
    assert catalog.Databases("a`b").table("mart", "t") == "`a``b`.`t`"
    with pytest.raises(KeyError):
        own.database("lake")


@pytest.mark.parametrize("mode", jobs.PUBLISH_MODES)
def test_pipeline_serves_every_table_by_name(spark, workdir, databases, mode):
    sources = {t: bind(spark, SF, t) for t in SOURCE_TABLES}
    summary = jobs.run_pipeline(spark, sources, workdir, *PARAMETERS, batch_id="c1", publish_mode=mode, databases=databases)
    assert summary["status"] == "TESTS_FAILED"   # the two expected failures at sf0.001
    listed = catalog.tables(spark, databases)
    assert len(listed) == len(SOURCE_TABLES) + 12
    assert (databases.database("mart"), "mart_revenue_daily") in listed
    assert (databases.database("warehouse"), "dim_date") in listed
    by_name = spark.sql(f"SELECT count(*) AS n FROM {databases.table('mart', 'mart_revenue_daily')} m "
                        f"JOIN {databases.table('warehouse', 'dim_date')} d ON m.date_key = d.date_key").first()["n"]
    assert by_name > 1000
    suite = jobs.run_tests(spark, workdir, databases=databases)
    assert sorted(map(tuple, suite.collect())) == sorted(map(tuple, spark.read.parquet(summary["tests_path"]).collect()))


@pytest.mark.parametrize("mode", jobs.PUBLISH_MODES)
def test_a_new_snapshot_is_served_and_an_old_reader_goes_on(spark, workdir, databases, mode):
    name = databases.table("staging", "members")

    def load(batch, rows):
        jobs.ingest(spark, {"members": bind(spark, SF, "members").limit(rows)}, workdir, batch, rules={}, publish_mode=mode)
        return jobs.load_staging(spark, workdir, ["members"], batch, publish_mode=mode, databases=databases)[0]

    assert load("b1", 7)["status"] == "SUCCESS"
    reader = spark.table(name)
    assert reader.count() == 7
    assert load("b2", 9)["status"] == "SUCCESS"
    assert spark.table(name).count() == 9
    if mode == "pointer":
        assert reader.count() == 7   # planned on the batch before


def test_an_entry_follows_changed_columns(spark, workdir, databases):
    catalog.create_database(spark, databases.database("mart"), f"{workdir}/db")
    name = databases.table("mart", "t")
    for k, frame in enumerate([spark.range(3), spark.range(5), spark.range(2).selectExpr("id", "'x' AS v")]):
        frame.write.parquet(f"{workdir}/t{k}")
        catalog.publish(spark, name, f"{workdir}/t{k}", frame)
        assert spark.table(name).columns == frame.columns and spark.table(name).count() == frame.count()
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(f"{workdir}/t2").count() == 2   # external: the files stay


def test_a_failed_load_leaves_the_entry(spark, workdir, databases):
    feed = bind(spark, SF, "members")
    jobs.ingest(spark, {"members": feed}, workdir, "b1", rules={}, fmt="csv")
    assert jobs.load_staging(spark, workdir, ["members"], "b1", fmt="csv", databases=databases)[0]["status"] == "SUCCESS"
    before = spark.table(databases.table("staging", "members")).count()
    jobs.ingest(spark, {"members": feed.selectExpr("* except (created_at)", "'soon' AS created_at").select(feed.columns)}, workdir, "b2", rules={}, fmt="csv")
    assert jobs.load_staging(spark, workdir, ["members"], "b2", fmt="csv", databases=databases)[0]["status"] == "FAILED"
    assert spark.table(databases.table("staging", "members")).count() == before


def test_built_subset_joins_the_catalog(spark, workdir, databases):
    jobs.build_models(spark, workdir, *PARAMETERS, staging=bind_all(spark, SF), select=["+mart_revenue_daily"], databases=databases)
    assert [t for _, t in catalog.tables(spark, databases)] == ["mart_revenue_daily", "dim_date", "fact_transactions"]
