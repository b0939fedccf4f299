"""Command line: ``spark-submit tidepool/cli.py <step> ...`` or ``python -m tidepool <step> ...``.

Steps mirror the scheduled pipeline: ``extract`` (R1), ``load`` (R2),
``build`` (R3), ``test`` and ``run`` (R4); ``profile`` (rows, columns and
NULL cells per source table) and ``contract`` (the staging contract each
source table maps to, as Spark DDL) inspect the sources. Sources are either the fixture
bindings over a directory of parquet tables (``--fixtures DIR``) or a JDBC
database (``--jdbc-url`` with ``--jdbc-user`` / ``--jdbc-password``). The
exit code is 1 when any table of the step did not succeed (or, for
``test``/``run``, any constraint test failed).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from tidepool.config import load_pipeline_config
from tidepool.plans import graph, jobs
from tidepool.operators.calendar import DEFAULT_DAYS, DEFAULT_START
from tidepool.session import configure
from tidepool.sources import catalog


def _sources(spark: SparkSession, args, tables: list[str]):
    if args.fixtures:
        from tidepool.sources.bindings import bind
        return {t: bind(spark, args.fixtures, t) for t in tables}
    if args.jdbc_url:
        from tidepool.sources import jdbc
        props = {k: v for k, v in {"user": args.jdbc_user, "password": args.jdbc_password,
                                   "driver": args.jdbc_driver}.items() if v}
        return {t: jdbc.read_source(spark, args.jdbc_url, t, props, **_split(args, t)) for t in tables}
    raise SystemExit("give --fixtures DIR or --jdbc-url URL")


def _split(args, table: str) -> dict:
    """How the scan of ``table`` is divided: ``--split table=column:lower:upper:partitions`` or
    ``--predicates table=file`` (a WHERE condition per line, one task each)."""
    for given in args.split or []:
        name, _, how = given.partition("=")
        if name == table:
            column, lower, upper, n = how.split(":")
            return {"partition_column": column, "lower": lower, "upper": upper, "num_partitions": int(n)}
    for given in args.predicates or []:
        name, _, path = given.partition("=")
        if name == table:
            with open(path) as lines:
                return {"predicates": [x.strip() for x in lines if x.strip()]}
    return {}


def _contract_ddl(spark: SparkSession, args, table: str) -> str:
    """The staging contract of ``table``: discovered from the live database's
    information_schema (strict type map), else the declared contract."""
    if args.jdbc_url:
        from tidepool.sources import jdbc
        props = {k: v for k, v in {"user": args.jdbc_user, "password": args.jdbc_password,
                                   "driver": args.jdbc_driver}.items() if v}
        schema = jdbc.discover_contract(spark, args.jdbc_url, table, props)
    else:
        from tidepool.schema import contract
        schema = contract(table)
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def _source_counts(spark: SparkSession, args, tables: list[str]):
    """Database-side COUNT(*) per table for JDBC sources (None: count the DataFrames)."""
    if not args.jdbc_url or args.fixtures:
        return None
    from tidepool.sources import jdbc
    props = {k: v for k, v in {"user": args.jdbc_user, "password": args.jdbc_password,
                               "driver": args.jdbc_driver}.items() if v}
    return {t: (lambda t=t: jdbc.source_row_count(spark, args.jdbc_url, t, props)) for t in tables}


def _failed(records) -> int:
    return sum(1 for r in records if r["status"] != "SUCCESS")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidepool", description=__doc__.splitlines()[0])
    p.add_argument("step", choices=["extract", "load", "build", "test", "run", "profile", "contract"])
    p.add_argument("--root", help="lake/warehouse root (shared file system or object store)")
    p.add_argument("--tables", help="comma-separated feeds (default: all configured feeds)")
    p.add_argument("--batch-id", help="batch id (default: YYYYMMDD_HHMMSS)")
    p.add_argument("--no-validate", action="store_true", help="skip the quality gate on extract")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="raw lake format")
    p.add_argument("--publish-mode", default="rename", choices=list(jobs.PUBLISH_MODES))
    p.add_argument("--error-policy", choices=["continue", "stop"])
    p.add_argument("--fixtures", help="directory of driver parquet tables (fixture bindings)")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--jdbc-driver")
    p.add_argument("--split", action="append", metavar="TABLE=COLUMN:LOWER:UPPER:N",
                   help="read a JDBC table in N ranges of a numeric or date column (repeatable)")
    p.add_argument("--predicates", action="append", metavar="TABLE=FILE",
                   help="read a JDBC table with one task per condition of FILE, e.g. ranges of created_at (repeatable)")
    p.add_argument("--input-bytes", type=int, help="volume of the sources, for partition sizing (JDBC can't be measured)")
    p.add_argument("--calendar-start", default=DEFAULT_START, help="first calendar day (default: %(default)s)")
    p.add_argument("--calendar-days", type=int, default=DEFAULT_DAYS, help="calendar length (default: %(default)s)")
    p.add_argument("--as-of", default=dt.datetime.now(dt.timezone.utc).date().isoformat(),
                   help="reference date for recency (default: today, UTC)")
    p.add_argument("--select", action="append", metavar="MODEL",
                   help="build: models to build, as name, +name, name+ or a layer (repeatable; default: all)")
    p.add_argument("--exclude", action="append", default=[], metavar="MODEL", help="build: models to leave out (repeatable)")
    p.add_argument("--threads", type=int, default=graph.THREADS, help="build: models written at once (default: %(default)s)")
    p.add_argument("--catalog", action="store_true", help="serve staging tables and models in the catalog's databases, too")
    p.add_argument("--resume", action="store_true", help="go on with --batch-id: what it has published stays")
    args = p.parse_args(argv)
    if args.resume and not args.batch_id:
        p.error("--resume needs the --batch-id to go on with")
    databases = catalog.Databases.configured() if args.catalog else None
    if args.step in ("run", "build", "test") and args.tables:
        p.error(f"{args.step} needs all feeds: the models read every staging table; --tables is for extract and load")
    if args.step == "run" and args.jdbc_url and args.input_bytes is None:
        p.error("run over JDBC needs --input-bytes: the volume can't be measured")

    if args.step not in ("profile", "contract") and not args.root:
        p.error("--root is required for this step")
    spark = configure(SparkSession.builder.appName(f"tidepool-{args.step}").getOrCreate())
    tables = args.tables.split(",") if args.tables else load_pipeline_config()["tables"]
    batch_id = args.batch_id or jobs.new_batch_id()
    out: dict = {"step": args.step, "batch_id": batch_id}
    failed = 0
    if args.step == "extract":
        recs = jobs.ingest(spark, _sources(spark, args, tables), args.root, batch_id, tables=tables,
                               validate=not args.no_validate, error_policy=args.error_policy, fmt=args.format,
                               publish_mode=args.publish_mode, source_counts=_source_counts(spark, args, tables),
                               resume=args.resume)
        out["records"], failed = recs, _failed(recs)
    elif args.step == "load":
        recs = jobs.load_staging(spark, args.root, tables, batch_id, args.format, args.error_policy,
                                     publish_mode=args.publish_mode, databases=databases, resume=args.resume)
        out["records"], failed = recs, _failed(recs)
    elif args.step == "build":
        out["models"] = jobs.build_models(spark, args.root, args.calendar_start, args.calendar_days, args.as_of,
                                              publish_mode=args.publish_mode, parallelism=args.threads, select=args.select,
                                              exclude=args.exclude, databases=databases, batch_id=batch_id, resume=args.resume)
    elif args.step == "test":
        rows = [r.asDict() for r in jobs.run_tests(spark, args.root, databases=databases).collect()]   # 72 rows
        out["tests"], failed = rows, sum(1 for r in rows if r["status"] != "PASS")
    elif args.step == "profile":
        from tidepool.sources.profile import profile
        out["profile"] = [r.asDict() for r in profile(_sources(spark, args, tables)).collect()]   # one row per table
    elif args.step == "contract":
        out["contracts"] = {t: _contract_ddl(spark, args, t) for t in tables}
    else:
        summary = jobs.run_pipeline(spark, _sources(spark, args, tables), args.root, args.calendar_start,
                                        args.calendar_days, args.as_of, args.format, batch_id,
                                        input_bytes=args.input_bytes, publish_mode=args.publish_mode,
                                        source_counts=_source_counts(spark, args, tables),
                                        validate=not args.no_validate, error_policy=args.error_policy,
                                        databases=databases, resume=args.resume)
        out["summary"], failed = summary, int(summary["status"] != "SUCCESS")
    print(json.dumps(out, default=str, indent=2))
    print(f"{args.step}: {failed} failed", file=sys.stderr)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
