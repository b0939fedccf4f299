"""The registered ``opN_*`` queries: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import scratch_path

from . import (divergence, exact_dedup, langid, minhash, mixing, packing, ranked_search, secret_scan, spotsigs, suffix_tree, toxicity,
               warc, wu_manber)
from .common import remainder, table, written
from .ordering import with_next


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half comes from the next document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = docs.select("doc_id", F.xxhash64("text").alias("tie"),
                        F.struct("text", spotsigs.fingerprint_set(F.col("text")).alias("signatures")).alias("own"))
    half = F.floor(F.length("own.text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("own.text"), F.lit(1), F.length("own.text") - half),
                      F.substring(F.col("next.text"), F.lit(1), half))
    sets = (with_next(whole, "doc_id", "tie", "own", "next")
            .select("doc_id", F.length("own.text").cast("long").alias("n_chars"), F.col("own.signatures").alias("own"),
                    F.col("next.signatures").alias("following"), edited.alias("edited"))
            .select("doc_id", "n_chars", "own", "following", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    spotsigs.fingerprint_set(F.col("edited")).alias("other")))
    return sets.select("doc_id", "n_chars", "edited_sha256", spotsigs.as_text(F.col("own")).alias("fingerprint"),
                       spotsigs.as_text(F.col("other")).alias("edited_fingerprint"),
                       spotsigs.likeness(F.col("own"), F.col("other")).alias("near_edited"),
                       spotsigs.likeness(F.col("own"), F.col("following")).alias("near_next"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the id that stays, group size, kept, digest of the normalised text.

    The groups come from the operator. Every row's digest is part of the result, so the
    rows are matched to their group by it; groups with one row need no match.
    """
    docs = table(spark, sf_dir, "documents")
    found = exact_dedup.groups(docs).select(F.col("sha256").alias("text_sha256"), "keep_id", "group_size")
    copies = (docs.select("doc_id", exact_dedup.digest(F.col("text")).alias("text_sha256"))
              .groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies")))
    rows = (copies.join(found, "text_sha256", "left")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id", keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document: counts by pattern, digest of the patterns' spans, all spans."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs), keep=[F.col("doc_id")])
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back: a row per capture."""
    path = scratch_path(spark, "llm", "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    seen = warc.captures(warc.read(spark, path))
    rows = written(seen.select("capture", F.col("metadata.page_id").alias("page_id"), "response.payload_bytes", "response.payload_digest",
                               F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("refers")), "captures")
    first = rows.filter("record_type = 'response'").select(F.col("capture").alias("refers"), F.col("page_id").alias("refers_to"))
    return (rows.join(first.hint("merge"), "refers", "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of documents with remainder other than 1 of 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.train(toxicity.labelled(docs.filter(~held_out), table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model, keep=[F.col("doc_id"), held_out.alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes, with its source's size and target."""
    return mixing.mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def tokenizer_files() -> tuple[str, str]:
    """The vocabulary of the packing queries, and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of at most 1024 tokens."""
    found = packing.packed(table(spark, sf_dir, "documents"), *tokenizer_files())
    return found.withColumnRenamed("id", "doc_id")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size, component and whether the document stays, at a similarity of 0.85."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learned from those with remainder other than 2 of 7."""
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 7) == 2
    model, vocab = suffix_tree.train(docs.filter(~held_out))
    scored = suffix_tree.score(docs, model, vocab, keep=[F.col("doc_id"), held_out.alias("held_out")])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model["N"]).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those with remainder other than 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = langid.train(docs.filter(~held_out))
    found = langid.predict(docs, model, keep=[F.col("doc_id"), held_out.alias("held_out")])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark passages of 10 words, and the items they come from."""
    found = wu_manber.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = wu_manber.hit_words(F.col("hits"))
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and each source's overused terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op6_packing": op6_packing,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op7_fingerprints": op7_fingerprints,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_decontamination": op12_decontamination,
    "op13_divergence": op13_divergence,
}
