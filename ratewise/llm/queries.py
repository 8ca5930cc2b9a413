"""Registered queries of this package: each applies one operator, with production parameters, to
its whole table and derives the contract's columns from the operator's result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewise.llm import (
    content_sort, imatch, language_mixture, line_dedup, mixing, nn_descent, quality, sentencepiece_codec, simhash_dedup,
    spelling_variants, suffix_dedup, threshold_clusters, url_filter,
)
from ratewise.llm.common import sha256_text, table


def crc_mod(column: str, m: int):
    """crc32 of an id as text, modulo m (null ids: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % m


def q_imatch(spark, d):
    return imatch.edited_pairs(table(spark, d, "documents"))


def q_url_filter(spark, d):
    return url_filter.judge(table(spark, d, "pages"))


def q_language(spark, d):
    docs = table(spark, d, "documents")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = language_mixture.fit(docs.filter(~held))
    return docs.select("doc_id", held.alias("held_out"), language_mixture.predict_column(F.col("text"), model).alias("o")).select(
        "doc_id", "held_out", "o.lang_pred", "o.score", "o.languages", "o.proportions")


def q_mix(spark, d):
    out = mixing.mix(table(spark, d, "documents"))
    return out.select("_row.doc_id", "_row.source", "copy", "shuffle_key",
                      F.char_length(F.coalesce("_row.text", F.lit(""))).cast("long").alias("n_chars"),
                      F.round("rate", 9).alias("rate"))


def q_simhash(spark, d):
    found = simhash_dedup.near_dedup(table(spark, d, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def q_line_dedup(spark, d):
    out = line_dedup.dedup_lines(table(spark, d, "documents"))
    return out.select("_row.doc_id", "n_lines", "n_dropped", sha256_text(F.col("kept_text")).alias("kept_sha256"))


def q_sentencepiece(spark, d):
    out = sentencepiece_codec.encoded(table(spark, d, "documents"), with_ids=False)
    return out.select("_row.doc_id", "n_pieces", "ids_sha256", "decoded_sha256", "round_trip")


def q_quality(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    out = quality.scored(docs, labels.filter(crc_mod("doc_id", 5) != 0), columns=["doc_id"])
    return out.select("_row.doc_id", F.coalesce(crc_mod("_row.doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def q_neighbours(spark, d):
    return nn_descent.nearest(table(spark, d, "embeddings"), F.col("id") % 20 == 0)


def q_suffix_dedup(spark, d):
    out = suffix_dedup.dedup_substrings(table(spark, d, "documents"))
    return out.select("_row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def q_content_sort(spark, d):
    out = content_sort.exact_groups(table(spark, d, "documents"), columns=["doc_id"])
    return out.select("_row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def q_clusters(spark, d):
    out = threshold_clusters.clusters(table(spark, d, "embeddings"))
    text = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                      sha256_text(text).alias("centroid_sha256"))


def q_spelling(spark, d):
    return spelling_variants.variants(table(spark, d, "documents"))


QUERIES = {
    "op1_imatch": q_imatch,
    "op2_mix_sources": q_mix,
    "op3_nn_descent": q_neighbours,
    "op4_url_filter": q_url_filter,
    "op5_language_mixture": q_language,
    "op6_simhash_near_dedup": q_simhash,
    "op7_line_dedup": q_line_dedup,
    "op8_sentencepiece": q_sentencepiece,
    "op9_quality": q_quality,
    "op10_suffix_dedup": q_suffix_dedup,
    "op11_threshold_clusters": q_clusters,
    "op12_exact_dedup": q_content_sort,
    "op13_spelling_variants": q_spelling,
}
