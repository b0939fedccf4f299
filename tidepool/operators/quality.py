"""Pre-publish data-quality gate.

A rule spec per table (exact column set, required columns, primary key,
``min_value`` / ``accepted_values`` checks) compiles into ONE distributed
job over the batch:

* every per-row predicate becomes a 0/1 indicator column;
* with a primary key, rows are grouped by the key (map-side partial
  aggregation first, so a hot key is combined before the shuffle) and the
  groups are folded into a single metric row, duplicate groups included;
* without one, a plain global aggregate folds the indicators;
* with ``prefilter``, the indicators are a plain aggregate and only keys whose hash occurs
  twice are grouped (``uniqueness``): a second read of the key columns for a far smaller shuffle.

The metric row is turned into check rows in Spark (array of structs ->
inline), so the gate result is itself a DataFrame:
``(table_name, check_order, check_name, status, detail, bad_rows)``.
Only the one-row verdict is ever collected (``verdict``).

Check semantics (names and detail texts are part of the contract):
columns (set equality, metadata only), row_count (source vs extracted),
not_null (absent columns skipped), unique (NULL equals NULL), min_value
and accepted_values (NULLs ignored, absent column fails), unknown rule
types fail. No rules at all -> SKIPPED.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import uniqueness

PASS, FAIL, SKIPPED = "PASS", "FAIL", "SKIPPED"

CHECK_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("check_order", T.IntegerType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("detail", T.StringType(), False),
    T.StructField("bad_rows", T.LongType(), True),
])


class GateError(RuntimeError):
    """The gate itself cannot run (e.g. a primary-key column is absent)."""


def pylist(values) -> str:
    """Render a rule list the way the rule author wrote it: ['a', 'b'] / [1, 2]."""
    return str(list(values))


@dataclass
class _Check:
    name: str
    status: Column
    detail: Column
    bad_rows: Column


def _s(c: Column) -> Column:
    return c.cast("string")


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def _missing(c: str) -> Column:
    return F.lit(f"column {c} missing")


def indicators(df: DataFrame, rules: dict | None) -> dict[str, Column]:
    """Per-row 0/1 violation flags of the row-level rules (not_null, min_value,
    accepted_values), keyed by metric name. Summing them gives the bad-row counts;
    they can be summed by the gate's own pass or observed during the batch write."""
    if not rules:
        return {}
    present = set(df.columns)
    not_null = [c for c in rules.get("not_null", []) or [] if c in present]
    ind: dict[str, Column] = {}
    for i, c in enumerate(not_null):
        bad = F.col(c).isNull() | (F.isnan(F.col(c)) if _is_float(df, c) else F.lit(False))
        ind[f"_nn{i}"] = bad
    for j, rule in enumerate(list(rules.get("checks", []) or [])):
        rtype, c = rule.get("type"), rule.get("column")
        if c not in present or rtype not in ("min_value", "accepted_values"):
            continue
        value_ok = F.col(c).isNotNull() & (~F.isnan(F.col(c)) if _is_float(df, c) else F.lit(True))
        if rtype == "min_value":
            ind[f"_r{j}"] = value_ok & (F.col(c) < F.lit(rule["min"]))
        else:
            ind[f"_r{j}"] = value_ok & ~F.col(c).isin(list(rule["values"]))
    return {k: F.when(e, 1).otherwise(0).cast("long") for k, e in ind.items()}


def observed_metrics(df: DataFrame, rules: dict | None) -> list[Column]:
    """Aggregate expressions for ``DataFrame.observe``: the row-level bad-row sums."""
    return [F.sum(e).alias(k) for k, e in indicators(df, rules).items()]


def gate(df: DataFrame, table: str, rules: dict | None, source=None, observed: dict | None = None,
         prefilter: bool = False) -> DataFrame:
    """Check rows for one batch.

    ``source`` is the source-side row count: an int (already known), a
    DataFrame (counted in the same job), or None (the batch is its own
    source, e.g. a file-only feed).

    ``observed`` holds the row-level bad-row sums already collected while the
    batch was written (``observed_metrics``); the gate's own pass then reads
    only the key columns (row count, duplicates).

    ``prefilter`` looks for duplicates among keys whose hash occurs twice only; the
    result is the same.
    """
    spark = df.sparkSession
    if not rules:
        return spark.createDataFrame([], CHECK_SCHEMA)

    present = set(df.columns)
    not_null = [c for c in rules.get("not_null", []) or [] if c in present]
    unique = list(rules.get("unique", []) or [])
    missing_keys = [c for c in unique if c not in present]
    if missing_keys:
        raise GateError(f"unique columns {missing_keys} not in batch")
    rule_checks = list(rules.get("checks", []) or [])

    # ---- per-row 0/1 indicators (unless observed during the write) ---------
    all_ind = indicators(df, rules)
    ind = {} if observed is not None else all_ind
    fixed = {k: F.lit(int(observed.get(k) or 0)).cast("long").alias(k) for k in all_ind} if observed is not None \
        else {}

    keys = [] if prefilter else unique   # what the rows are grouped by
    rows = df.select(*[F.col(c) for c in keys], F.lit(0).alias("_side"), *[e.alias(k) for k, e in ind.items()])
    if isinstance(source, DataFrame):
        key_types = {f.name: f.dataType for f in df.schema.fields}
        rows = rows.unionByName(source.select(
            *[F.lit(None).cast(key_types[c]).alias(c) for c in keys], F.lit(1).alias("_side"),
            *[F.lit(0).cast("long").alias(k) for k in ind]))

    if keys:
        groups = rows.groupBy(*unique, "_side").agg(
            F.count(F.lit(1)).alias("_n"), *[F.sum(k).alias(k) for k in ind])
        metrics = groups.agg(
            F.coalesce(F.sum(F.when(F.col("_side") == 0, F.col("_n"))), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("_side") == 1, F.col("_n"))), F.lit(0)).alias("n_source"),
            F.count_if((F.col("_side") == 0) & (F.col("_n") > 1)).alias("dup_groups"),
            *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ind])
    else:
        metrics = rows.agg(
            F.count_if(F.col("_side") == 0).alias("n_rows"),
            F.count_if(F.col("_side") == 1).alias("n_source"),
            F.lit(0).cast("long").alias("dup_groups"),
            *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ind])

    if unique and prefilter:   # two rows of sums, folded into one
        dups = uniqueness.repeated(df, unique).agg(F.count(F.lit(1)).alias("dup_groups"))
        metrics = (metrics.unionByName(dups.select("dup_groups", *[F.lit(0).cast("long").alias(c) for c in metrics.columns if c != "dup_groups"]))
                   .agg(*[F.sum(c).alias(c) for c in metrics.columns]))

    if fixed:
        metrics = metrics.select("*", *fixed.values())

    n_rows = F.col("n_rows")
    if isinstance(source, DataFrame):
        n_source = F.col("n_source")
    elif source is None:
        n_source = n_rows
    else:
        n_source = F.lit(int(source)).cast("long")

    checks: list[_Check] = []
    # columns: metadata only
    expected = list(rules.get("columns", []) or [])
    miss, extra = sorted(set(expected) - present), sorted(present - set(expected))
    if miss or extra:
        checks.append(_Check("columns", F.lit(FAIL), F.lit(f"missing={miss} unexpected={extra}"),
                             F.lit(None).cast("long")))
    else:
        checks.append(_Check("columns", F.lit(PASS), F.lit(f"{len(expected)} columns match"),
                             F.lit(None).cast("long")))
    # row_count
    same = n_source == n_rows
    checks.append(_Check(
        "row_count", F.when(same, PASS).otherwise(FAIL),
        F.when(same, F.concat(_s(n_rows), F.lit(" rows match")))
         .otherwise(F.concat(F.lit("source="), _s(n_source), F.lit(" extracted="), _s(n_rows))),
        F.abs(n_source - n_rows)))
    # not_null
    if rules.get("not_null"):
        if not_null:
            bad_total = sum((F.col(f"_nn{i}") for i in range(len(not_null))), F.lit(0).cast("long"))
            names = F.concat_ws(", ", *[F.when(F.col(f"_nn{i}") > 0, F.lit(repr(c))) for i, c in enumerate(not_null)])
        else:
            bad_total, names = F.lit(0).cast("long"), F.lit("")
        checks.append(_Check(
            "not_null", F.when(bad_total > 0, FAIL).otherwise(PASS),
            F.when(bad_total > 0, F.concat(F.lit("nulls found in ["), names, F.lit("]")))
             .otherwise(F.lit("no nulls in required columns")),
            bad_total))
    # unique
    if unique:
        dup = F.col("dup_groups")
        checks.append(_Check(
            "unique", F.when(dup > 0, FAIL).otherwise(PASS),
            F.when(dup > 0, F.lit(f"duplicates in {pylist(unique)}")).otherwise(F.lit(f"{pylist(unique)} unique")),
            dup))
    # extra rules, in spec order
    for j, rule in enumerate(rule_checks):
        rtype, c = rule.get("type"), rule.get("column")
        if rtype == "min_value":
            name, lim = f"min_value.{c}", rule["min"]
            if c not in present:
                checks.append(_Check(name, F.lit(FAIL), _missing(c), F.lit(None).cast("long")))
                continue
            k = F.col(f"_r{j}")
            checks.append(_Check(name, F.when(k > 0, FAIL).otherwise(PASS),
                                 F.when(k > 0, F.concat(_s(k), F.lit(f" rows < {lim}")))
                                  .otherwise(F.lit(f"all >= {lim}")), k))
        elif rtype == "accepted_values":
            name = f"accepted_values.{c}"
            if c not in present:
                checks.append(_Check(name, F.lit(FAIL), _missing(c), F.lit(None).cast("long")))
                continue
            k = F.col(f"_r{j}")
            checks.append(_Check(name, F.when(k > 0, FAIL).otherwise(PASS),
                                 F.when(k > 0, F.concat(_s(k), F.lit(f" rows outside {pylist(rule['values'])}")))
                                  .otherwise(F.lit("all values accepted")), k))
        else:
            checks.append(_Check(f"unknown_check.{rtype}", F.lit(FAIL), F.lit("unknown rule type"),
                                 F.lit(None).cast("long")))

    structs = [F.struct(F.lit(table).alias("table_name"), F.lit(i + 1).alias("check_order"),
                        F.lit(ch.name).alias("check_name"), ch.status.alias("status"),
                        ch.detail.alias("detail"), ch.bad_rows.cast("long").alias("bad_rows"))
               for i, ch in enumerate(checks)]
    return metrics.select(F.inline(F.array(*structs)))


def overall(checks: DataFrame) -> DataFrame:
    """Per-table verdict and failure summary: (table_name, overall, failed_checks)."""
    failed = F.array_sort(F.collect_list(F.when(F.col("status") != PASS,
                                                F.struct("check_order", "check_name"))))
    return checks.groupBy("table_name").agg(
        F.when(F.count_if(F.col("status") != PASS) == 0, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("overall"),
        failed.alias("_failed"),
    ).select("table_name", "overall",
             F.when(F.col("overall") == FAIL,
                    F.coalesce(F.nullif(F.concat_ws(", ", F.col("_failed.check_name")), F.lit("")),
                               F.lit("unknown"))).alias("failed_checks"))


def verdict(checks: DataFrame, rules: dict | None) -> tuple[str, list[dict]]:
    """Collect the (small, bounded) check rows of one table: (overall, checks)."""
    if not rules:
        return SKIPPED, []
    rows = [r.asDict() for r in checks.orderBy("check_order").collect()]
    return (PASS if all(r["status"] == PASS for r in rows) else FAIL), rows
