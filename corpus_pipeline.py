"""Corpus preparation in stages; each calls one operator of ``snapdelta.llm`` on all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdelta.llm.common import free_name, kept, scratch, table
from snapdelta.llm.decontaminate import drop_contaminated
from snapdelta.llm.jaccard_join import one_per_group
from snapdelta.llm.mixing import mix_sources
from snapdelta.llm.quality_classifier import KEEP_FROM, score_texts, train
from snapdelta.llm.secrets import redact_secrets


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier rejects go. Null and empty texts are scored like others, repeated rows alike; where not both classes are
    labelled all stay. A column ``score`` of the documents stays as it is."""
    own = free_name(docs.columns, "score_of_documents")
    named = docs.withColumnRenamed("score", own)
    scored = score_texts(named, train(named, table(spark, sf_dir, "labels")))
    return scored.where(F.col("score") >= KEEP_FROM).drop("score").withColumnRenamed(own, "score").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id: five-word shingles, similarity 0.8 or more.
    Of repeated rows one stays; rows without a word all stay, null and empty texts among them."""
    return one_per_group(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a passage of the benchmark go, all of them where rows repeat. Null and empty texts hold none."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays. ``n_chars``, if there is one, is that of the masked text; a null text stays
    null, and so does its length."""
    masked = redact_secrets(docs)
    if "n_chars" in docs.columns:
        counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        masked = masked.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with what the mix takes of each: ``size`` and ``taken`` words, its source's ``source_size`` and ``target``.
    Null and empty texts have size 0; repeated rows are documents each. Columns of the documents named like these four are replaced."""
    return mix_sources(docs, keep_text=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near copies", near_copies),
    ("decontamination", decontamination),
    ("secret scans", secret_scans),
    ("source mixing", source_mixing),
]
#: SQL can express neither the trained classifier nor seeded block selection; a test compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table that the next stage reads. The last one has the texts to train on, with
    the words to take of each."""
    docs = table(spark, sf_dir, "documents")
    *before, (name, last) = STAGES
    with scratch(spark):
        for stage_name, stage in before:
            # What a stage keeps for itself goes as soon as its result is written, the results of all but the last at the end.
            with scratch(spark):
                docs = kept(stage(spark, docs, sf_dir), stage_name.replace(" ", "-"), result=True)
        return kept(last(spark, docs, sf_dir), name.replace(" ", "-"), result=True)
