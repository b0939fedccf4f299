"""Corpus pipeline: documents to packed training sequences, a stage per operator.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's docs.
So a stage's helper tables, which its result may still read, are removed when the next
stage is called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import exact_dedup, langid, minhash, mixing, packing
from tidepool.llm.common import discard, helpers, table, written
from tidepool.llm.queries import tokenizer_files

#: A text whose best language has a smaller posterior than this is rejected.
MIN_LANGUAGE_SCORE = 0.5


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders of the helper tables of the stage that was called last.
_HELPERS: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """Removes the helper tables of the stage before: its result, which is ``docs``, is written."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _HELPERS)
        with helpers() as own:
            result = stage(spark, docs, sf_dir)
        _HELPERS[:] = own
        return result
    return run


@_tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without a letter (null and empty ones too), and those no language claims."""
    model = langid.train(docs)
    scored = langid.predict(docs, model)
    claimed = F.col("score") >= MIN_LANGUAGE_SCORE if model["langs"] else F.lit(True)
    return scored.filter(F.col("has_letter") & claimed).select("row.*")


@_tidy
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to blanks, the row with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


@_tidy
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a word-shingle similarity of 0.8 or more, one of each group stays."""
    return minhash.keep_one(docs, percent=80)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per slot and document in its block, text and n_chars cut to that part."""
    return mixing.mixed(docs)


@_tidy
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed rows in sequences of at most 1024 tokens, with their ids."""
    return packing.packed(docs, *tokenizer_files(), with_ids=True).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language ID is a trained model and mixing draws pseudorandom numbers: no SQL equivalent.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        with helpers() as output:
            docs = written(result, name)
        discard(spark, before)   # the stage's input
        before = output
    return docs
