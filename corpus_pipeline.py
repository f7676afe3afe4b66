"""From raw documents to encoded training text: five stages, each written as Parquet and read again.

Toxic documents go; one document of each near-duplicate group stays; strings of 200 bytes that also start elsewhere are
cut out; sources are mixed to target weights, with whole and partial repetitions; the texts that are left are encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, mixing, neardup, sentencepiece, suffix, toxicity

#: The model of the last stage; another one is named by the setting ``spark.tidemark.model``.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def _counted(df: DataFrame, like: DataFrame) -> DataFrame:
    """With the number of characters brought up to date, where the table tells it."""
    if "n_chars" not in like.columns:
        return df
    return df.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(like.schema["n_chars"].dataType))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, common.table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.representatives(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(suffix.cleaned(docs), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed_rows(docs), docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = [c for c in ("doc_id", "lang", "source", "n_chars") if c in docs.columns]
    return sentencepiece.encode(docs, spark.conf.get("spark.tidemark.model", MODEL_PATH), keep=kept, ids_col="ids").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_dedup", suffix_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: Learned scores, sketches and segmentations aren't expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = common.scratch(spark, f"stage-{name}")
        with common.released():  # what a stage has set down for itself goes when it is written
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            common.remove(before)
        docs, before = spark.read.parquet(path), path
    return docs
