"""A training-data pipeline over ``documents``: rules, near-duplicates, decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that
the stage before kept. All but the last return the columns of ``documents``. The last
stage's rows are the result: doc_id, n_tokens, the digests of ids and decoded text,
and the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm import decontamination, ngram_join, pii, quality, tokens
from assayline.llm.blocks import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows a text that a stage has changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or that the forest isolates go."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest id."""
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go; a document that is mostly one goes whole."""
    return _counted(decontamination.remove_hits(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _counted(pii.redact_all(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    import public_tokenizers

    return tokens.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("encode", encode),
]

#: A forest, a field and a tokenizer are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
