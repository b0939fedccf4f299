import pytest
from pyspark.sql import types as T

from tidepool.schema import CONTRACTS, SOURCE_TYPE_MAP, UnmappedTypeError, contract_from_columns, map_source_type
from tidepool.sources.bindings import BINDINGS


def test_type_map_has_sixteen_entries_and_folds_case():
    assert len(SOURCE_TYPE_MAP) == 16
    assert map_source_type("JSONB") == T.StringType()
    assert map_source_type("  Text  ") == T.StringType()
    assert map_source_type("numeric") == T.DecimalType(38, 9)
    assert map_source_type("timestamp with time zone") == T.TimestampType()


def test_unknown_type_and_empty_contract_raise():
    with pytest.raises(UnmappedTypeError):
        map_source_type("geometry")
    with pytest.raises(UnmappedTypeError):
        contract_from_columns("t", [])


def test_contract_from_columns():
    c = contract_from_columns("t", [("id", "uuid"), ("amount", "numeric"), ("created_at", "timestamp without time zone")])
    assert [f.dataType for f in c.fields] == [T.StringType(), T.DecimalType(38, 9), T.TimestampNTZType()]


def test_eleven_contracts_match_bindings():
    assert len(CONTRACTS) == 11
    for table, binding in BINDINGS.items():
        names = [e.rsplit(" AS ", 1)[1] for e in binding.exprs]
        assert names == CONTRACTS[table].fieldNames(), table


def test_bindings_produce_contract_types(spark):
    from tidepool.sources.bindings import bind
    for table in BINDINGS:
        df = bind(spark, "/root/testdata/sf0.001", table)
        got = [(f.name, f.dataType) for f in df.schema.fields]
        want = [(f.name, f.dataType) for f in CONTRACTS[table].fields]
        assert got == want, table


def test_partition_sizing_has_no_ceiling(spark):
    from tidepool.session import SIZING_KEYS, size_for
    keep = {k: spark.conf.get(k, None) for k in SIZING_KEYS}
    try:
        big = size_for(spark, 100 * 1024 ** 4)   # 100 TB
        assert big["spark.sql.shuffle.partitions"] == "409600"
        assert size_for(spark, 100 * 1024 ** 4, 1024 ** 3)["spark.sql.shuffle.partitions"] == "102400"
        small = size_for(spark, 10 * 1024 ** 2)
        assert small["spark.sql.shuffle.partitions"] == str(4 * spark.sparkContext.defaultParallelism)
        assert {k: spark.conf.get(k) for k in SIZING_KEYS} == small
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_pipeline_config_lists_the_eleven_feeds():
    from tidepool.config import load_pipeline_config
    from tidepool.schema import SOURCE_TABLES
    cfg = load_pipeline_config()
    assert cfg["tables"] == SOURCE_TABLES and cfg["error_policy"] == "continue" and cfg["load_type"] == "full"
