"""A training corpus from ``documents``: quality, line dedup, near-dedup, mixing, encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``docs``; each is written as Parquet and read again as the
next one's ``docs``.  ``run`` does that in the shared checkpoint folder.

SQL cannot express the classifier, the fingerprints and the tokenizer, so ``ORACLE_SQL`` is None;
``tests/llm/test_pipeline.py`` holds every stage's rows against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import line_dedup, mixing, quality, sentencepiece_codec, simhash_dedup
from ratewise.llm.common import table, unpacked
from ratewise.llm.queries import crc_mod
from ratewise.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; learned from labels of the training folds."""
    rows = quality.scored(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 5) != 0))
    return unpacked(rows.filter(F.col("score") >= quality.CUT), docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by three documents stay in the last of them; ``n_chars`` follows the text.

    A document that loses every line stays, with an empty text: this stage drops lines."""
    out = line_dedup.dedup_lines(docs).withColumn("_text", F.when(
        F.col("_row").getField("text").isNull(), F.lit(None).cast("string")).otherwise(F.col("kept_text")))
    own = {"text": F.col("_text"), "n_chars": F.char_length(F.coalesce("_text", F.lit(""))).cast("long")}
    return out.select(*[own.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return simhash_dedup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in a global random order."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; ``round_trip`` says that decoding gives the text back."""
    out = sentencepiece_codec.encoded(docs)
    return out.select(F.col("_row").getField("doc_id").alias("doc_id"), F.col("_row").getField("source").alias("source"),
                      "ids", "n_pieces", "round_trip")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mix_sources", mixing_stage),
    ("sentencepiece", encoding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "corpus")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
