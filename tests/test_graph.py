"""The models' dependency graph: selection, and running what is ready."""

import threading
from graphlib import CycleError

import pytest

from tidepool.plans import graph, jobs
from tidepool.plans.models import ALL_MODELS, GRAPH, INPUTS, LAYER_OF, fixture_models, selected
from tidepool.schema import SOURCE_TABLES
from tidepool.sources import fs
from tidepool.sources.bindings import bind_all

SF = "/root/testdata/sf0.001"
PARAMETERS = ("1995-01-01", 10958, "2002-01-01")


def test_every_input_is_a_feed_or_a_model():
    assert {i for inputs in INPUTS.values() for i in inputs} - set(GRAPH) <= set(SOURCE_TABLES)
    place = {name: k for k, name in enumerate(graph.order(INPUTS))}
    assert set(place) == set(ALL_MODELS)
    assert all(place[i] < place[name] for name, inputs in INPUTS.items() for i in inputs if i in place)


def test_selection():
    assert selected() == graph.order(INPUTS)
    assert selected(["mart_revenue_daily"]) == ["mart_revenue_daily"]
    assert set(selected(["+mart_revenue_daily"])) == {"dim_date", "fact_transactions", "mart_revenue_daily"}
    assert selected(["+mart_revenue_daily"])[-1] == "mart_revenue_daily"
    assert set(selected(["fact_transactions+"])) == {"fact_transactions", "mart_revenue_daily", "mart_customer_analytics"}
    assert set(selected(["mart"])) == {m for m in ALL_MODELS if LAYER_OF[m] == "mart"}
    assert set(selected(["+mart"])) == set(ALL_MODELS)
    assert set(selected(["+fact_treatment_activities+"])) == {"fact_treatment_activities", "mart_operations_booking", "mart_treatment_analytics"}
    assert set(selected(["warehouse", "mart_revenue_daily"], exclude=["dim_customer", "fact_completed_items+"])) == \
        set(ALL_MODELS) - {m for m in ALL_MODELS if LAYER_OF[m] == "mart"} - {"dim_customer", "fact_completed_items"} | {"mart_revenue_daily"}
    with pytest.raises(KeyError, match="nowhere"):
        selected(["+nowhere"])


def test_a_cycle_is_an_error():
    loop = {"a": ["b"], "b": ["c"], "c": ["a"], "d": []}
    with pytest.raises(CycleError):
        graph.order(loop)
    with pytest.raises(CycleError):
        graph.run(loop, list(loop), lambda name: lambda: name)


def test_ready_nodes_run_beside_each_other_and_no_more_than_allowed():
    """b2 starts as soon as a2 has ended, while a1 is still at work: no barrier between layers."""
    inputs = {"a1": [], "a2": [], "b1": ["a1"], "b2": ["a2"], "c": ["b1", "b2"]}
    b2_ran, lock, now, most, order = threading.Event(), threading.Lock(), [0], [0], []

    def prepare(name):
        def job():
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            if name == "a1":
                assert b2_ran.wait(20)
            if name == "b2":
                b2_ran.set()
            with lock:
                now[0] -= 1
            return name.upper()
        return job

    out = graph.run(inputs, list(inputs), prepare, 2, lambda name, result: order.append((name, result)))
    assert out.done == {n: n.upper() for n in inputs} and not out.failed and not out.skipped
    place = {name: k for k, (name, _) in enumerate(order)}
    assert place["b2"] < place["a1"] < place["b1"] < place["c"] and most[0] == 2


def test_a_failure_keeps_back_only_what_reads_it():
    inputs = {"a": [], "b": ["a"], "c": ["b"], "d": [], "e": ["d"], "f": ["c", "e"]}

    def prepare(name):
        def job():
            if name == "b":
                raise ValueError("broken")
        return job

    out = graph.run(inputs, list(inputs), prepare)
    assert set(out.done) == {"a", "d", "e"} and list(out.failed) == ["b"] and set(out.skipped) == {"c", "f"}
    with pytest.raises(RuntimeError, match=r"failed: \['b'\].*broken"):
        out.check()


def test_what_lies_outside_the_selection_is_taken_as_there():
    out = graph.run({"a": [], "b": ["a"]}, ["b"], lambda name: lambda: 1)
    assert out.done == {"b": 1}


def test_subset_is_built_with_its_ancestors_only(spark, workdir):
    staging = bind_all(spark, SF)
    paths = jobs.build_models(spark, workdir, *PARAMETERS, staging=staging, select=["+mart_product_analytics"])
    assert set(paths) == {"dim_product", "fact_completed_items", "mart_product_analytics"}
    assert not fs.exists(spark, jobs.model_path(workdir, "dim_customer"))
    got = spark.read.parquet(jobs.published(spark, paths["mart_product_analytics"]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, fixture_models(spark, staging)["mart_product_analytics"].collect()), key=str)


def test_an_unselected_input_is_read_as_published(spark, workdir):
    staging = bind_all(spark, SF)
    jobs.build_models(spark, workdir, *PARAMETERS, staging=staging, select=["dim_product", "fact_completed_items"])
    spark.read.parquet(jobs.model_path(workdir, "dim_product")).limit(2).write.parquet(f"{workdir}/two")
    fs.publish(spark, f"{workdir}/two", jobs.model_path(workdir, "dim_product"))
    jobs.build_models(spark, workdir, *PARAMETERS, staging=staging, select=["mart_product_analytics"])
    assert spark.read.parquet(jobs.model_path(workdir, "mart_product_analytics")).count() == 2
    with pytest.raises(Exception, match="(?i)path"):   # never published
        jobs.build_models(spark, workdir, *PARAMETERS, staging=staging, select=["mart_treatment_analytics"])


def test_a_model_that_fails_leaves_the_others_built(spark, workdir):
    staging = dict(bind_all(spark, SF))
    staging["treatments"] = staging["treatments"].selectExpr("* except (id)", "raise_error('no treatments today') AS id")
    with pytest.raises(RuntimeError, match="no treatments today"):
        jobs.build_models(spark, workdir, *PARAMETERS, staging=staging, select=["+mart_treatment_analytics", "+mart_product_analytics"])
    assert fs.exists(spark, jobs.model_path(workdir, "mart_product_analytics"))
    assert fs.exists(spark, jobs.model_path(workdir, "fact_treatment_activities"))
    assert not fs.exists(spark, jobs.model_path(workdir, "mart_treatment_analytics"))
