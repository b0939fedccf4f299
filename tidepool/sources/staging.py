"""Typed staging: contract casts, pre-flight contract report, bad cells, schema drift.

The contract cast runs under ANSI mode, so one uncastable value aborts the
whole load (nothing is published, the previous staging snapshot stays).
``contract_report`` is the non-failing pre-flight: per column, how many
non-NULL values would not cast. ``bad_cells`` says which, by file, row and column;
``contract_drift`` says how a batch's columns differ from the contract's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.schema import UnmappedTypeError


def _typed(c: Column, source: T.DataType, target: T.DataType, cast: str = "cast") -> Column:
    """``c`` cast to the contract's type. Whole numbers that arrive as text may carry a fraction of
    zeros ("150000.0"), so text goes through a decimal without places."""
    if isinstance(source, T.StringType) and isinstance(target, T.LongType):
        c = getattr(c, cast)(T.DecimalType(38, 0))
    return getattr(c, cast)(target)


def apply_contract(df: DataFrame, contract: T.StructType, variant_columns=()) -> DataFrame:
    """Positional cast of ``df`` to ``contract`` names and types. More or fewer columns are an error
    (``contract_drift`` says which).

    ``variant_columns`` (JSON text in the contract) are parsed into VARIANT with
    ``parse_json``: malformed JSON raises and aborts the load like any other
    uncastable value.
    """
    if len(df.columns) != len(contract.fields):
        changes = [f"{change} {name}" for name, change, *_ in drift(df.schema, contract) if change in ("missing", "added")]
        raise UnmappedTypeError(f"batch has {len(df.columns)} columns, contract {len(contract.fields)}: {', '.join(changes)}")
    out = []
    for src, f in zip(df.columns, contract.fields):
        c = _typed(F.col(src), df.schema[src].dataType, f.dataType)
        if f.name in variant_columns:
            c = F.parse_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def contract_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """(column_name, uncastable_rows) in contract order, from ONE aggregate."""
    aggs = [F.count_if(F.col(f.name).isNotNull()
                       & _typed(F.col(f.name), df.schema[f.name].dataType, f.dataType, "try_cast").isNull()).cast("long").alias(f.name) for f in contract.fields]
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("uncastable_rows"))
            for f in contract.fields]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _uncastable(df: DataFrame, f: T.StructField, variant_columns) -> Column:
    """Whether a non-NULL value of the column is one that ``apply_contract`` raises on."""
    c = F.col(f.name)
    out = _typed(c, df.schema[f.name].dataType, f.dataType, "try_cast")
    if f.name in variant_columns:
        out = F.try_parse_json(out)
    return c.isNotNull() & out.isNull()


def bad_cells(located: DataFrame, contract: T.StructType, variant_columns=()) -> DataFrame:
    """A row per cell that the contract can't take: file, row, position, column_name, value, expected.

    ``located`` has the contract's columns as delivered, and where each row stands:
    _file and _row (see ``lake.read_csv_located``). One pass without a shuffle of rows.
    """
    cells = [F.when(_uncastable(located, f, variant_columns),
                    F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.col(f.name).cast("string").alias("value"),
                             F.lit("variant" if f.name in variant_columns else f.dataType.simpleString()).alias("expected")))
             for i, f in enumerate(contract.fields)]
    return (located.select(F.col("_file").alias("file"), F.col("_row").alias("row"), F.explode(F.array_compact(F.array(*cells))).alias("cell"))
            .select("file", "row", "cell.*"))


def first_bad_cell(cells: DataFrame) -> dict | None:
    """The first cell of ``bad_cells`` by file, row and column."""
    rows = cells.orderBy("file", "row", "position").limit(1).collect()
    return rows[0].asDict() if rows else None


def located(cell: dict) -> str:
    """What a failed load says about a bad cell."""
    return f"value {cell['value']!r} in column {cell['column_name']} is not {cell['expected']}: file {cell['file']}, row {cell['row']}"


def drift(found: T.StructType, contract: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column_name, change, expected, found) of every difference of a delivered schema from the contract.

    change is missing, added, retyped (expected and found are types) or moved (positions,
    from 1, counted among the columns that both have). Names are compared without case.
    """
    have = {f.name.lower(): f for f in found.fields}
    want = {f.name.lower(): f for f in contract.fields}
    rows = [(f.name, "missing", f.dataType.simpleString(), None) for k, f in want.items() if k not in have]
    rows += [(f.name, "added", None, f.dataType.simpleString()) for k, f in have.items() if k not in want]
    rows += [(want[k].name, "retyped", want[k].dataType.simpleString(), have[k].dataType.simpleString())
             for k in want if k in have and want[k].dataType != have[k].dataType]
    shared = [k for k in want if k in have]
    delivered = {k: i + 1 for i, k in enumerate(k for k in have if k in want)}
    rows += [(want[k].name, "moved", str(i + 1), str(delivered[k])) for i, k in enumerate(shared) if delivered[k] != i + 1]
    return rows


def contract_drift(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``drift`` of a batch as rows, each with the rows it touches, from one aggregate.

    affected_rows: of a missing column all rows, of an added one its non-NULL values, of a
    retyped one the values that would not cast, of a moved one the rows whose value a
    reading by position would not take for the contract's column (it is not castable there).
    """
    changes = drift(df.schema, contract)
    if not changes:
        return df.sparkSession.createDataFrame([], "column_name string, change string, expected string, found string, affected_rows long")
    types = {f.name.lower(): f for f in contract.fields}
    own = {c.lower(): c for c in df.columns}

    def touched(name: str, change: str, found: str | None) -> Column:
        if change == "missing":
            return F.lit(True)
        if change == "added":
            return F.col(f"`{name}`").isNotNull()
        source = own[name.lower()] if change == "retyped" else [c for c in df.columns if c.lower() in types][_place(contract, df, name) - 1]
        field = T.StructField(source, types[name.lower()].dataType)
        return _uncastable(df, field, ())

    counts = [F.count_if(touched(name, change, found)).alias(f"_{i}") for i, (name, change, _, found) in enumerate(changes)]
    rows = [F.struct(*[F.lit(v).cast("string").alias(c) for c, v in zip(("column_name", "change", "expected", "found"), change)],
                     F.col(f"_{i}").cast("long").alias("affected_rows")) for i, change in enumerate(changes)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def _place(contract: T.StructType, df: DataFrame, name: str) -> int:
    """The column's position, from 1, among the contract's columns that the batch has."""
    have = {c.lower() for c in df.columns}
    return [f.name.lower() for f in contract.fields if f.name.lower() in have].index(name.lower()) + 1
