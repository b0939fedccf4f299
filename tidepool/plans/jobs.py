"""Jobs: extract batch (R1), staging load (R2), model build (R3), tests, end-to-end run.

Each table is processed as its own set of Spark jobs; only per-table
metric rows (counts, check rows) reach the driver. Every write goes to a
fresh staged folder first and is published by rename (or by swapping a
``_CURRENT`` pointer on object stores), so a failed gate or a failed cast
leaves the previous snapshot intact.

A snapshot carries the record of the job that made it (``fs.RECORD``), published with
it in the same step. These records are the ledger of a batch: with ``resume`` a rerun
leaves alone what is served by the same batch, and does the rest.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidepool.config import load_pipeline_config, load_rules, load_tests
from tidepool.operators import constraints, quality
from tidepool.plans import graph
from tidepool.plans.models import ALL_MODELS, GRAPH, INPUTS, LAYER_OF, Models, selected
from tidepool.schema import CONTRACTS, JSON_COLUMNS, SOURCE_TABLES
from tidepool.session import SIZING_KEYS, configure, size_for
from tidepool.sources import audit, catalog, fs, lake, staging
from tidepool.sources.staging import apply_contract

EXTRACT_SYSTEM = load_pipeline_config().get("source_system", "operational_db")
LOAD_SYSTEM = "raw_lake"


def new_batch_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


DEFAULT_PARALLELISM = 8


def _for_each_table(tables: list[str], job: Callable[[str], dict], error_policy: str, parallelism: int) -> list[dict]:
    """Run one table job per table. ``stop`` is serial and halts at the first
    non-SUCCESS record; ``continue`` submits the tables' Spark jobs
    concurrently (small tables then run beside big ones instead of queueing
    behind them). Records come back in table order either way."""
    if error_policy == "stop" or parallelism <= 1 or len(tables) <= 1:
        records = []
        for table in tables:
            records.append(job(table))
            if records[-1]["status"] != "SUCCESS" and error_policy == "stop":
                break
        return records
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tables))) as pool:
        return list(pool.map(job, tables))


def _staged(root: str, *parts: str) -> str:
    """A fresh staging folder (unique per attempt, never reused)."""
    return "/".join([root.rstrip("/"), "_staged", *parts, uuid.uuid4().hex])


PUBLISH_MODES = ("rename", "pointer")


def _stage_dir(root: str, kind: str, name: str, target: str, mode: str, *extra: str) -> str:
    """Where a new snapshot is written before it is published."""
    if mode == "pointer":
        return fs.batch_dir(target, "_".join([*extra, uuid.uuid4().hex]))
    return _staged(root, kind, name, *extra)


def _publish(spark: SparkSession, staged: str, target: str, mode: str, record: dict, history: str | None = None) -> None:
    """Serve ``staged`` as ``target``; its record goes with it."""
    fs.write_text(spark, f"{staged.rstrip('/')}/{fs.RECORD}", json.dumps(record, default=str))
    if mode not in PUBLISH_MODES:
        raise ValueError(f"publish mode must be one of {PUBLISH_MODES}, got {mode!r}")
    if mode == "pointer":
        fs.publish_pointer(spark, staged, target, keep_history=history is not None)
    else:
        fs.publish(spark, staged, target, history)


def published(spark: SparkSession, target: str) -> str:
    """The folder currently served for ``target`` (either publish mode)."""
    return fs.resolve(spark, target)


def served_record(spark: SparkSession, target: str, job: str, batch_id: str) -> dict | None:
    """The record of what ``target`` serves, if this job of this batch published it."""
    path = f"{published(spark, target).rstrip('/')}/{fs.RECORD}"
    if not fs.exists(spark, path):
        return None
    record = json.loads(fs.read_text(spark, path))
    return record if (record.get("job"), record.get("batch_id")) == (job, batch_id) else None


def _write_observed(df: DataFrame, writer, metrics=()) -> dict:
    """Run ``writer(df')``; return the rows it wrote (``_rows``) and the given
    aggregate ``metrics``, all observed on the written rows (no extra pass; only
    successful task attempts count)."""
    obs = Observation()
    writer(df.observe(obs, F.count(F.lit(1)).alias("_rows"), *metrics))
    return dict(obs.get)


def _read_raw(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame:
    """Read back a batch we just wrote, with the schema we wrote it with (so an
    empty batch - no data files at all - reads as an empty frame)."""
    if fmt == "csv":
        return apply_contract(lake.read_csv_text(spark, path, schema.fieldNames()), schema)
    return spark.read.schema(schema).parquet(path).drop("year", "month", "day")


def _read_parquet_snapshot(spark: SparkSession, path: str, contract) -> DataFrame:
    """A published parquet snapshot; one without data files (an empty feed) reads
    as an empty frame of the contract."""
    try:
        return spark.read.parquet(path)
    except Exception as exc:
        if "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
        return spark.createDataFrame([], contract)


def extract_table(spark: SparkSession, source: DataFrame, table: str, root: str, batch_id: str,
                  ingest_date: dt.date, rules: dict | None, validate: bool = True, fmt: str = "parquet",
                  keep_history: bool = False, publish_mode: str = "rename",
                  count_source: Callable[[], int] | None = None, resume: bool = False) -> dict:
    """S1+S2+gate+publish for one table. Always returns an audit record.

    ``count_source`` gives the source-side row count; by default the source
    DataFrame is counted. JDBC sources should pass the database's own COUNT(*)
    (``jdbc.source_row_count``) instead of pulling every row to count it.
    """
    started = dt.datetime.now()
    record = audit.new_record("extract", EXTRACT_SYSTEM, table, batch_id)
    target = lake.table_path(root, table)
    if resume and (before := served_record(spark, target, "extract", batch_id)):
        return before | {"resumed": True}
    staged = _stage_dir(root, "raw", table, target, publish_mode, batch_id)
    try:
        source_count = count_source() if count_source else source.count()   # S2
        # S1 + S5: one pass writes the batch and sums the row-level rule violations
        # of the extracted rows (what the original gate saw before serialising)
        observed = _write_observed(source, lambda d: lake.write_batch(d, staged, ingest_date, fmt, lake.csv_compression(source_count)),
                                   quality.observed_metrics(source, rules) if validate else ())
        written = int(observed["_rows"])
        batch = _read_raw(spark, staged, fmt, source.schema)
        validation = {"overall": quality.SKIPPED, "checks": []}
        if validate:   # the gate's own pass reads only the key columns of the written batch
            checks_df = quality.gate(batch, table, rules, source=source_count, observed=observed, prefilter=True)
            overall, checks = quality.verdict(checks_df, rules)
            validation = {"overall": overall, "checks": checks}
        record["validation"] = validation
        if validation["overall"] == quality.FAIL:
            fs.delete(spark, staged)
            return audit.finish(record, status="VALIDATION_FAILED", rows_extracted=written, rows_loaded=0,
                                error_message="validation failed: " + ", ".join(
                                    c["check_name"] for c in checks if c["status"] != quality.PASS))
        history = f"{root.rstrip('/')}/_history/raw/{table}/{batch_id}" if keep_history else None
        path = lake.partition_path(root, table, ingest_date) if publish_mode == "rename" else \
            lake.partition_path_under(staged, ingest_date)
        audit.finish(record, started, status="SUCCESS", rows_extracted=written, rows_loaded=written,
                     file_path=path, destination=target)
        _publish(spark, staged, target, publish_mode, record, history)          # S6: snapshot replace
        return record
    except Exception as exc:  # recorded, the batch goes on with the next table
        fs.delete(spark, staged)
        return audit.finish(audit.new_record("extract", EXTRACT_SYSTEM, table, batch_id), status="FAILED", error_message=str(exc))


def ingest(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, batch_id: str | None = None,
           tables: list[str] | None = None, rules: dict | None = None, validate: bool = True,
           error_policy: str | None = None, fmt: str = "parquet", ingest_date: dt.date | None = None,
           keep_history: bool = False, parallelism: int = DEFAULT_PARALLELISM,
           publish_mode: str = "rename", source_counts: Mapping[str, Callable[[], int]] | None = None,
           resume: bool = False) -> list[dict]:
    """Extract every table, gate it, publish it; write the audit records.

    Defaults (feed order, error policy) come from ``config/pipeline.yaml``.
    """
    configure(spark)
    cfg = load_pipeline_config()
    error_policy = error_policy or cfg["error_policy"]
    if tables is None:
        tables = [t for t in cfg["tables"] if t in sources] + [t for t in sources if t not in cfg["tables"]]
    now = dt.datetime.now()
    batch_id = batch_id or new_batch_id(now)
    ingest_date = ingest_date or now.date()
    rules = load_rules() if rules is None else rules

    def job(table: str) -> dict:
        if table not in sources:   # an unknown feed fails on its own, like any source error
            return audit.finish(audit.new_record("extract", EXTRACT_SYSTEM, table, batch_id), status="FAILED",
                                error_message=f"no source configured for table {table!r}")
        return extract_table(spark, sources[table], table, root, batch_id, ingest_date, rules.get(table),
                             validate, fmt, keep_history, publish_mode, (source_counts or {}).get(table), resume)

    records = _for_each_table(list(tables or sources), job, error_policy, parallelism)
    audit.write_audit(spark, records, root, "extract", batch_id)
    return records


def staging_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/staging/{table}"


def load_table(spark: SparkSession, table: str, root: str, batch_id: str, fmt: str = "parquet",
               json_as_variant: bool = False, publish_mode: str = "rename",
               databases: catalog.Databases | None = None, resume: bool = False) -> dict:
    """S9+S10: positional read of the raw snapshot, ANSI cast to the contract,
    write, publish, count. A bad value raises during the write: nothing is
    published and the record carries no ``rows_loaded``. With
    ``json_as_variant`` the JSON columns are stored as VARIANT. A failed record names the
    first bad cell. With ``databases`` the table is also an entry of the staging database."""
    started = dt.datetime.now()
    record = audit.new_record("load", LOAD_SYSTEM, table, batch_id)
    target = staging_path(root, table)
    if resume and (before := served_record(spark, target, "load", batch_id)):
        _register(spark, databases, catalog.STAGING, table, target, root)
        return before | {"resumed": True}
    staged = _stage_dir(root, "staging", table, target, publish_mode, batch_id)
    try:
        contract = CONTRACTS[table]
        raw = published(spark, lake.table_path(root, table))
        if fmt == "csv":
            source = lake.read_csv_text(spark, raw, contract.fieldNames())
        else:
            source = _read_parquet_snapshot(spark, raw, contract).select(*contract.fieldNames())
        variants = JSON_COLUMNS[table] if json_as_variant else ()
        apply_contract(source, contract, variants).write.mode("errorifexists").options(**lake.PARQUET_WRITE).parquet(staged)
    except Exception as exc:
        fs.delete(spark, staged)
        return audit.finish(record, status="FAILED", error_message=_why(spark, table, root, fmt, json_as_variant, exc))
    try:
        loaded = _read_parquet_snapshot(spark, staged, contract).count()   # S10: counted on what is about to be served
        audit.finish(record, started, status="SUCCESS", rows_loaded=loaded, destination=target)
        _publish(spark, staged, target, publish_mode, record)
        _register(spark, databases, catalog.STAGING, table, target, root)
        return record
    except Exception as exc:
        fs.delete(spark, staged)
        return audit.finish(audit.new_record("load", LOAD_SYSTEM, table, batch_id), status="FAILED", error_message=str(exc).split("\n")[0])


def _why(spark: SparkSession, table: str, root: str, fmt: str, json_as_variant: bool, exc: Exception) -> str:
    """The first bad cell of the batch that would not load, or the error itself if no cell is to blame."""
    message = str(exc).split("\n")[0]
    try:
        cell = bad_cells(spark, table, root, fmt, json_as_variant)
        first = None if cell is None else staging.first_bad_cell(cell)
    except Exception:   # the batch can't be read at all: the load's own error says so
        return message
    return message if first is None else staging.located(first)


def bad_cells(spark: SparkSession, table: str, root: str, fmt: str = "parquet", json_as_variant: bool = False) -> DataFrame:
    """Every cell of the published raw batch that its staging contract can't take (see ``staging.bad_cells``)."""
    contract = CONTRACTS[table]
    raw = published(spark, lake.table_path(root, table))
    if fmt == "csv":
        located = lake.read_csv_located(spark, raw, contract.fieldNames())
    else:
        located = lake.read_parquet_located(spark, raw, contract.fieldNames())
    return staging.bad_cells(located, contract, JSON_COLUMNS[table] if json_as_variant else ())


def _register(spark: SparkSession, databases: catalog.Databases | None, layer: str, name: str, target: str, root: str) -> None:
    """Let the layer's database serve what ``target`` serves, under ``name``."""
    if databases is None:
        return
    database = databases.database(layer)
    folder = published(spark, target)
    catalog.create_database(spark, database, f"{root.rstrip('/')}/databases/{database}")
    catalog.publish(spark, databases.table(layer, name), folder, spark.read.parquet(folder))


def load_staging(spark: SparkSession, root: str, tables: list[str] | None = None, batch_id: str | None = None,
                 fmt: str = "parquet", error_policy: str | None = None,
                 parallelism: int = DEFAULT_PARALLELISM, json_as_variant: bool = False,
                 publish_mode: str = "rename", databases: catalog.Databases | None = None, resume: bool = False,
                 redo: Collection[str] = ()) -> list[dict]:
    """R2: full load of each table into staging; audit records written. With ``resume``, tables that
    this batch has published stay, except those in ``redo``."""
    configure(spark)
    cfg = load_pipeline_config()
    error_policy = error_policy or cfg["error_policy"]
    tables = tables or cfg["tables"]
    batch_id = batch_id or new_batch_id()
    records = _for_each_table(list(tables),
                              lambda t: load_table(spark, t, root, batch_id, fmt, json_as_variant, publish_mode, databases,
                                                   resume and t not in redo),
                              error_policy, parallelism)
    audit.write_audit(spark, records, root, "load", batch_id)
    return records


def read_staging(spark: SparkSession, root: str, tables=None) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(published(spark, staging_path(root, t))) for t in (SOURCE_TABLES if tables is None else tables)}


def model_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{LAYER_OF[name]}/{name}"


def materialise(models: Models, names: list[str], write: Callable[[str, DataFrame], DataFrame],
                threads: int = graph.THREADS) -> graph.Outcome:
    """Write the models, each as soon as what it reads is written; at most ``threads`` at once.

    ``write`` gives the written table, which replaces the model's lazy plan for those that
    read it (the write is the lineage cut).
    """
    def prepare(name: str) -> Callable[[], DataFrame]:
        frame = models[name]          # plans are made on the caller's thread; only the writes run beside each other
        return lambda: write(name, frame)

    return graph.run(INPUTS, names, prepare, threads, models.replace)


def build_models(spark: SparkSession, root: str, calendar_start: str, calendar_days: int, as_of: str,
                 staging: Mapping[str, DataFrame] | None = None,
                 parallelism: int = graph.THREADS, publish_mode: str = "rename",
                 frames_out: dict[str, DataFrame] | None = None, select: list[str] | None = None, exclude: list[str] = (),
                 databases: catalog.Databases | None = None, batch_id: str | None = None, resume: bool = False,
                 redo: Collection[str] = ()) -> dict[str, str]:
    """Build the selected models (all by default), each written as a table.

    A model that is not selected is read as it was last published. A failed model keeps
    back those that read it; the others are built, then the failure is raised. With
    ``databases`` every model is also an entry of its layer's database. With ``resume``
    models that this batch has published with the same parameters stay, unless they read
    one that is built anew or a staging table in ``redo``.
    """
    configure(spark)
    names = selected(select, exclude)
    reads = {i for n in names for i in INPUTS[n]}
    tables = [t for t in SOURCE_TABLES if t in reads]
    models = Models(spark, dict(staging or read_staging(spark, root, tables)), calendar_start, calendar_days, as_of)
    made_with = {"calendar_start": calendar_start, "calendar_days": calendar_days, "as_of": as_of}

    def served(name: str) -> DataFrame:
        return spark.read.schema(models[name].schema).parquet(published(spark, model_path(root, name)))

    todo = []
    for name in names:
        before = served_record(spark, model_path(root, name), "build", batch_id) if resume else None
        if before and before.get("parameters") == made_with and not any(i in todo or i in redo for i in INPUTS[name]):
            _register(spark, databases, LAYER_OF[name], name, model_path(root, name), root)
            models.replace(name, served(name))
        else:
            todo.append(name)
    for name in reads & set(GRAPH) - set(names):
        models.replace(name, spark.read.parquet(published(spark, model_path(root, name))))

    def write(name: str, frame: DataFrame) -> DataFrame:
        started = dt.datetime.now()
        record = audit.new_record("build", LAYER_OF[name], name, batch_id) | {"parameters": made_with}
        target = model_path(root, name)
        staged = _stage_dir(root, "models", name, target, publish_mode)
        frame.write.mode("errorifexists").options(**lake.PARQUET_WRITE).parquet(staged)
        _publish(spark, staged, target, publish_mode, audit.finish(record, started, status="SUCCESS", destination=target))
        _register(spark, databases, LAYER_OF[name], name, target, root)
        return spark.read.schema(frame.schema).parquet(published(spark, target))

    materialise(models, todo, write, parallelism).check()
    if frames_out is not None:   # the served staging tables and models, for the tests that follow
        frames_out.update(models.staging)
        frames_out.update({name: models[name] for name in names})
    return {name: model_path(root, name) for name in names}


def run_tests(spark: SparkSession, root: str, frames: Mapping[str, DataFrame] | None = None,
              databases: catalog.Databases | None = None) -> DataFrame:
    """The constraint suite over the published staging tables and models
    (``frames`` supplies already-opened ones), by their catalog names if ``databases`` are given."""
    frames = dict(frames or {})
    for layer, model, *_ in load_tests():
        if model not in frames and databases is not None:
            frames[model] = catalog.read(spark, databases, layer, model)
        elif model not in frames:
            frames[model] = spark.read.parquet(published(spark, model_path(root, model) if model in ALL_MODELS
                                                         else staging_path(root, model)))
    return constraints.run_suite(spark, frames, load_tests())


def run_pipeline(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, calendar_start: str,
                 calendar_days: int, as_of: str, fmt: str = "parquet", batch_id: str | None = None,
                 input_bytes: int | None = None, publish_mode: str = "rename",
                 source_counts: Mapping[str, Callable[[], int]] | None = None, validate: bool = True,
                 error_policy: str | None = None, sizing: bool = True, databases: catalog.Databases | None = None,
                 resume: bool = False) -> dict:
    """Ingest -> load -> build -> test. A failed table fails its step and blocks the next.

    Partition sizing follows the input volume (``session.size_for``) unless ``sizing`` is
    off; file sources are measured, other sources (JDBC) need ``input_bytes`` given.
    ``source_counts`` maps a table to its source system's own row count
    (e.g. ``jdbc.source_row_count``) for the gate's row-count check. ``resume`` goes on with
    a batch that stopped: tables and models that it has published, and still serves, stay.
    """
    configure(spark)
    if sizing and input_bytes is None:
        input_bytes = sum(fs.input_bytes(spark, df) for df in sources.values())
        if sources and not input_bytes:
            raise ValueError("the sources' volume can't be measured: give input_bytes, or sizing=False")
    batch_id = batch_id or new_batch_id()
    before = {k: spark.conf.get(k, None) for k in SIZING_KEYS}
    summary: dict = {"batch_id": batch_id, "sizing": size_for(spark, input_bytes) if sizing else {}}
    try:
        return _run_steps(spark, sources, root, calendar_start, calendar_days, as_of, fmt, batch_id, publish_mode,
                          summary, source_counts, validate, error_policy, databases, resume)
    finally:   # the sizing belongs to this run; the session goes back to what it was
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _anew(records: list[dict]) -> set[str]:
    """The tables that this run published itself."""
    return {r["source_table"] for r in records if not r.get("resumed")}


def _run_steps(spark, sources, root, calendar_start, calendar_days, as_of, fmt, batch_id, publish_mode,
               summary: dict, source_counts, validate: bool, error_policy: str | None,
               databases: catalog.Databases | None, resume: bool) -> dict:
    extract = ingest(spark, sources, root, batch_id, validate=validate, error_policy=error_policy, fmt=fmt,
                     publish_mode=publish_mode, source_counts=source_counts, resume=resume)
    summary["extract"] = extract
    if any(r["status"] != "SUCCESS" for r in extract):
        summary["status"] = "EXTRACT_FAILED"
        return summary
    loaded = load_staging(spark, root, list(sources), batch_id, fmt, error_policy, publish_mode=publish_mode,
                          databases=databases, resume=resume, redo=_anew(extract))
    summary["load"] = loaded
    if any(r["status"] != "SUCCESS" for r in loaded):
        summary["status"] = "LOAD_FAILED"
        return summary
    built: dict[str, DataFrame] = {}
    summary["models"] = build_models(spark, root, calendar_start, calendar_days, as_of,
                                     publish_mode=publish_mode, frames_out=built, databases=databases,
                                     batch_id=batch_id, resume=resume, redo=_anew(loaded))
    suite = run_tests(spark, root, built)
    suite_path = f"{root.rstrip('/')}/tests/{batch_id}"
    suite.write.mode("overwrite").parquet(suite_path)
    failed = spark.read.parquet(suite_path).where(F.col("status") != "PASS").count()
    summary["tests_path"] = suite_path
    summary["tests_failed"] = failed
    summary["status"] = "SUCCESS" if failed == 0 else "TESTS_FAILED"
    return summary
