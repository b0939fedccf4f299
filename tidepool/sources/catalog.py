"""Layers as catalog databases: staging tables and models under ``DATABASE.table``.

A layer with a schema name of its own has it verbatim as its database; a layer without
one goes to the target's database. Tables are external: an entry names the folder that a
publish left served, so publishing an entry copies nothing and dropping one deletes
nothing. An entry with the same columns is moved to the new folder in one step; readers
that have planned on the old folder go on reading it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidepool.config import load_pipeline_config

STAGING, WAREHOUSE, MART = LAYERS = ("staging", "warehouse", "mart")


def schema_name(custom: str | None, target: str) -> str:
    """A custom schema name is used as it is; without one, the target's."""
    return custom if custom else target


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Databases:
    """The database of each layer. ``custom`` maps a layer to a name of its own."""
    target: str = "WAREHOUSE"
    custom: Mapping[str, str | None] = field(default_factory=dict)

    @classmethod
    def configured(cls) -> Databases:
        """As ``config/pipeline.yaml`` has them."""
        own = load_pipeline_config().get("catalog", {})
        return cls(own.get("target", "WAREHOUSE"), own.get("schemas", {}))

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise KeyError(f"no layer {layer!r}; the layers are {LAYERS}")
        return schema_name(self.custom.get(layer), self.target)

    def table(self, layer: str, name: str) -> str:
        """The quoted name to use in SQL and ``spark.table``."""
        return f"{quoted(self.database(layer))}.{quoted(name)}"


def create_database(spark: SparkSession, name: str, location: str) -> None:
    """Create the database if it is missing. ``location`` is its folder; the tables' folders are their own."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)} LOCATION '{_literal(location)}'")


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def publish(spark: SparkSession, table: str, folder: str, frame: DataFrame) -> None:
    """Let the entry ``table`` serve the Parquet files of ``folder``, which have the columns of ``frame``."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in frame.schema.fields)
    if spark.catalog.tableExists(table):
        if [(f.name, f.dataType) for f in spark.table(table).schema.fields] == [(f.name, f.dataType) for f in frame.schema.fields]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{_literal(folder)}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")   # external: its files stay
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{_literal(folder)}'")


def read(spark: SparkSession, databases: Databases, layer: str, name: str) -> DataFrame:
    return spark.table(databases.table(layer, name))


def tables(spark: SparkSession, databases: Databases) -> list[tuple[str, str]]:
    """(database, table) of every entry of the layers."""
    names = dict.fromkeys(databases.database(layer) for layer in LAYERS)
    return sorted((name, t.name) for name in names if spark.catalog.databaseExists(quoted(name))
                  for t in spark.catalog.listTables(quoted(name)) if not t.isTemporary)
