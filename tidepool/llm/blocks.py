"""Rows of a query table in blocks of bounded weight, and the words of a text as bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_ranks, written

#: Characters of query texts in a block. What a task or a broadcast holds of a query table is a block.
BLOCK_CHARS = 1 << 21


def in_blocks(rows: DataFrame, weight: str, order: list[str], size: int) -> tuple[DataFrame, int]:
    """``rows`` with a column block, and the number of blocks.

    A block's rows weigh ``size`` together, plus at most one row; every row is in exactly one.
    """
    rows = written(rows, "queries")
    count, total = rows.agg(F.count("*"), F.sum(weight)).first()
    placed = with_ranks(rows.withColumn("_all", F.lit(0)), ["_all"], order, weight, "start", count)
    blocks = written(placed.withColumn("block", F.expr(f"start div {size}L")).drop("_all", "start"), "blocks")
    return blocks, -(-(total or 0) // size)


def _table(kept: bytes) -> bytes:
    """For bytes.translate: A-Z lower-cased, ``kept`` and all bytes of non-ASCII characters stay, the rest are blanks."""
    return bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in kept else 32 for c in range(256))


_LETTERS = bytes(range(ord("a"), ord("z") + 1))
LETTERS = _table(_LETTERS)
LETTERS_AND_DIGITS = _table(_LETTERS + b"0123456789")


def utf8(text: Column) -> Column:
    """The text's bytes; a null text has none."""
    return F.coalesce(text, F.lit("")).cast("binary")


def words(text: bytes, table: bytes = LETTERS_AND_DIGITS) -> list[bytes]:
    """The maximal runs of the table's characters, of the whole text."""
    return text.translate(table).split()
