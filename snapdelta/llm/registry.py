"""Queries of the operators, for the driver: name to a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdelta.llm import oracles
from snapdelta.llm.common import table
from snapdelta.llm.decontaminate import contamination
from snapdelta.llm.html_text import extract_text
from snapdelta.llm.jaccard_join import jaccard_groups
from snapdelta.llm.lattice_dedup import lattice_groups
from snapdelta.llm.mixing import mix_sources
from snapdelta.llm.pii import KINDS, all_span_texts, personal_data
from snapdelta.llm.prefix_trie import RESULTS as TRIE, prefix_trie
from snapdelta.llm.quality_classifier import KEEP_FROM, held_out, score_texts, train
from snapdelta.llm.quality_rules import quality_rules
from snapdelta.llm.secrets import secret_spans
from snapdelta.llm.token_counts import length_histogram, read_vocabulary
from snapdelta.llm.url_filters import url_filter
from snapdelta.llm.vector_codes import vector_codes


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    q = F.col("quality")
    base_failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    return judged.select(
        "doc_id",
        *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed.alias("base_failed"),
        (~base_failed & q["kept"]).alias("kept"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    fixed, more = all_span_texts()
    texts = found.withColumn("_fixed", fixed).withColumn("_more", more)
    return texts.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.concat_ws(",", "_fixed"), 256).alias("base_sha256"),
        F.concat_ws(",", F.concat("_fixed", "_more")).alias("spans"),
        F.size("context").cast("long").alias("n_context"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted")
    )


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("secrets", lambda s: s["order"] < 3)
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("secrets")).alias("spans"),
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(table(spark, sf_dir, "documents").select("text"), read_vocabulary())


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), k=3, percent=90)
    return grouped.select("doc_id", "n_shingles", "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = lattice_groups(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return grouped.select("vec_id", "n_links", "component_id", "kept")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).select(*TRIE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
