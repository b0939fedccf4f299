"""Batch audit records: one record per table per job run, in a parquet audit table
partitioned by batch id and job (plus a JSON manifest file per batch and job).

A rerun of a job of a batch replaces exactly its own records (dynamic partition overwrite);
other batches, and the batch's other jobs, keep theirs."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidepool.sources import fs

CHECK_STRUCT = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()),
])

AUDIT_SCHEMA = T.StructType([
    T.StructField("job", T.StringType(), False),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("load_type", T.StringType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows_extracted", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("validation_overall", T.StringType()),
    T.StructField("validation", T.ArrayType(CHECK_STRUCT)),
])


def new_record(job: str, source_system: str, table: str, batch_id: str) -> dict:
    return {"job": job, "source_system": source_system, "source_table": table, "batch_id": batch_id,
            "start_time": dt.datetime.now().isoformat(), "load_type": "full", "status": "PENDING"}


def finish(record: dict, started: dt.datetime | None = None, **fields) -> dict:
    end = dt.datetime.now()
    record.update(fields)
    record["end_time"] = end.isoformat()
    if started is not None and record.get("status") == "SUCCESS":
        record["duration_seconds"] = round((end - started).total_seconds(), 3)
    return record


def records_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    rows = []
    for r in records:
        v = r.get("validation") or {}
        rows.append({**{f.name: r.get(f.name) for f in AUDIT_SCHEMA.fields if f.name not in ("validation",
                                                                                            "validation_overall")},
                     "validation_overall": v.get("overall"),
                     "validation": [{"name": c.get("check_name", c.get("name")), "status": c["status"],
                                     "detail": c.get("detail")} for c in v.get("checks", [])]})
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/audit"


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """All records. The schema is given: a batch id of digits stays text."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path(root))


def write_audit(spark: SparkSession, records: list[dict], root: str, job: str, batch_id: str) -> str:
    """Replace the records of this job and batch in ``<root>/audit`` and its JSON manifest beside it."""
    path = audit_path(root)
    (records_frame(spark, records).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", "job").parquet(path))
    manifest = {"batch_id": batch_id, "generated_at": dt.datetime.now().isoformat(), "tables": records}
    text = json.dumps(manifest, indent=2, ensure_ascii=False, default=str)
    # one small driver-side document (one record per table): a single file write, no Spark job
    fs.write_text(spark, f"{root.rstrip('/')}/manifests/{job}_log_{batch_id}.json", text)
    return path
