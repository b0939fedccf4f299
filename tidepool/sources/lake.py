"""Raw lake: ingestion-date partitioned snapshots, CSV or Parquet.

Layout: ``<root>/raw/<table>/year=YYYY/month=MM/day=DD/part-*`` (zero-padded
strings, the ingestion date of the batch). Parquet is compressed with zstd; a CSV batch of
more than ``CSV_PLAIN_ROWS`` rows with gzip (``*.csv.gz``), a smaller one is plain ``*.csv``. A table folder always holds one
full snapshot: a new batch replaces it (optionally keeping the old one under
``_history``).

CSV dialect (what the warehouse file format expects): header row, fields
optionally enclosed in double quotes, embedded quotes doubled, NULL written
as an empty field and the empty string as ``""``. On read, empty, quoted
empty and the literal ``NULL`` all become NULL; short rows are padded with
NULLs and extra fields dropped (PERMISSIVE).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""',
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
             "dateFormat": "yyyy-MM-dd"}
CSV_READ = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE",
            "enforceSchema": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: CSV batches of more rows are compressed (a multi-line file is read by one task anyway), and all Parquet.
CSV_PLAIN_ROWS = 100_000
CSV_FILES = "*.{csv,csv.gz}"
PARQUET_WRITE = {"compression": "zstd"}
NULL_TOKENS = ("", "NULL")
# multiLine CSV cannot be split on read: one file = one read task. Bounding the
# rows per file keeps files (and read tasks) at a few hundred MB at most.
CSV_MAX_RECORDS_PER_FILE = 2_000_000


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/raw/{table}"


def partition_values(ingest: dt.date) -> dict[str, str]:
    return {"year": f"{ingest:%Y}", "month": f"{ingest:%m}", "day": f"{ingest:%d}"}


def partition_path(root: str, table: str, ingest: dt.date) -> str:
    return partition_path_under(table_path(root, table), ingest)


def partition_path_under(folder: str, ingest: dt.date) -> str:
    p = partition_values(ingest)
    return f"{folder.rstrip('/')}/year={p['year']}/month={p['month']}/day={p['day']}"


def csv_compression(rows: int) -> str:
    """How the jobs write a CSV batch of this size."""
    return "gzip" if rows > CSV_PLAIN_ROWS else "none"


def write_batch(df: DataFrame, path: str, ingest: dt.date, fmt: str = "parquet", csv_compression: str = "none") -> None:
    """Write one batch under ``path`` partitioned by its ingestion date."""
    p = partition_values(ingest)
    clash = [c for c in df.columns if c.lower() in p]
    if clash:
        raise ValueError(f"source columns {clash} collide with the ingest-date partition columns year/month/day")
    out = df.select("*", *[F.lit(v).alias(k) for k, v in p.items()])
    w = out.write.mode("errorifexists").partitionBy("year", "month", "day")
    if fmt == "csv":
        w.options(**CSV_WRITE, compression=csv_compression).option("maxRecordsPerFile", CSV_MAX_RECORDS_PER_FILE).csv(path)
    elif fmt == "parquet":
        w.options(**PARQUET_WRITE).parquet(path)
    else:
        raise ValueError(f"unsupported lake format {fmt!r}")


def _string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _null_rule(c: str) -> Column:
    return F.when(F.col(c).isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(F.col(c))


def apply_null_rules(df: DataFrame) -> DataFrame:
    """Empty / quoted empty / literal NULL -> NULL on every text column."""
    return df.select(*[_null_rule(c).alias(c) for c in df.columns])


def read_csv_text(spark: SparkSession, path: str, columns: list[str], recursive: bool = True) -> DataFrame:
    """Positional text read of every ``*.csv`` and ``*.csv.gz`` below ``path``; null rules applied.

    ``recursiveFileLookup`` reads all partition folders without turning
    year/month/day into columns; the header is skipped, columns bind by
    position to ``columns``.
    """
    r = spark.read.schema(_string_schema(columns)).options(**CSV_READ).option("pathGlobFilter", CSV_FILES)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return apply_null_rules(r.csv(path))


def read_csv_located(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``read_csv_text`` with each row's place: _file and _row (from 1, the header not counted).

    A multi-line file is read by one task in order, so a row's number is its id less the
    file's first one.
    """
    r = spark.read.schema(_string_schema(columns)).options(**CSV_READ).option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true")
    rows = r.csv(path).select(*columns, F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    first = rows.groupBy("_file").agg(F.min("_at").alias("_first"))
    return (rows.withColumns({c: _null_rule(c) for c in columns}).join(first, "_file")
            .withColumn("_row", F.col("_at") - F.col("_first") + 1).drop("_at", "_first"))


def read_parquet_located(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The Parquet files below ``path`` with each row's place: _file and _row (from 1)."""
    return spark.read.parquet(path).select(*columns, F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.row_index") + 1).alias("_row"))
