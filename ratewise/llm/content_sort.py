"""Exact dedup by content sort: every row learns the smallest id among the rows of equal text.

Method: sampled splitters range-partition the normalised texts, an external sort places equal texts
next to each other, full comparisons of neighbours find the runs, and the smallest id of a run
stays.  Everything on the path is a DataFrame function.

Plan
  1. A sample of the rows (``SAMPLE`` for each bucket) gives the splitters.  A row's key is its
     text's first ``PREFIX`` code points, a 64-bit hash of the whole text, its id, and a number that
     spreads rows of one id.  The hash stands for the rest of the bytes: texts that share a long
     opening still fall into different buckets and a splitter stays under 400 bytes.  As ids are
     part of the key, a text that a third of all rows hold is cut over a third of the buckets.
     Splitters are weighted by length, so buckets are even in bytes.
  2. Each row finds its bucket by binary search in the splitters (a constant of the plan, at most
     ``2 x spark.sql.shuffle.partitions`` keys) and is shuffled once, with its text.
  3. Within a bucket, Spark's external sort orders by (opening, hash, text, id); a text that
     differs from its predecessor's begins a run.  The text is dropped here.
  4. Only a bucket's first and last run can go on in another bucket.  These (two per bucket) are
     grouped by sha256 and sent back to the rows as a broadcast of at most two rows per bucket.

Cases
  * null text: the empty text, equal to other empty texts; white space counts as one space, so
    ``" a"`` and ``"a"`` differ;
  * null id: above every other id; if all ids of a group are null, so is ``keep_id``;
  * rows repeating an id: each is a row of its own; of equal ones exactly one is ``kept``;
  * empty table: empty result; one row: its own group; very long texts: moved and compared whole.
Extra columns are carried inside ``_row`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import quoted, sha256_text, unpacked
from ratewise.sources.tables import cut_lineage

#: Fixed value: the white space whose runs count as one space.
SPACES = r"[\x20\x09-\x0D]+"
PREFIX = 64               # code points of the opening in a sort key
BUCKETS_PER_PARTITION = 2
SAMPLE = 16               # sampled rows for each bucket
ROW_WEIGHT = 256          # bytes that a row weighs beside its text
SEED = 17

ORDER = ("_open", "_hash", "_norm", "_noid", "_id")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _keyed(rows: DataFrame) -> DataFrame:
    """``_row``, ``_norm`` and ``_key``, whose order is that of the sort as far as buckets go."""
    return rows.select(
        "_row", "_norm",
        F.struct(F.substring("_norm", 1, PREFIX).alias("o"), F.xxhash64("_norm").alias("h"), F.col("_id").isNull().alias("n"),
                 F.col("_id").alias("i"), F.xxhash64("_tie").alias("t")).alias("_key"))


def _splitters(rows: DataFrame, n_rows: int, buckets: int, seed: int) -> Column:
    """The sorted array of at most ``buckets - 1`` keys of even weight, as a constant."""
    share = min(1.0, SAMPLE * buckets / max(n_rows, 1))
    weight = (F.octet_length("_norm") + ROW_WEIGHT).cast("long")
    keys = _keyed(rows.sample(False, share, seed)).select("_key", weight.alias("_w"))
    # the sample is bounded (SAMPLE x buckets keys), so one task may rank it
    upto = F.sum("_w").over(Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = keys.select("_key", "_w", upto.alias("_upto"), (F.sum("_w").over(Window.partitionBy(F.lit(0))) / buckets).alias("_step"))
    cut = F.floor(F.col("_upto") / F.col("_step")) > F.floor((F.col("_upto") - F.col("_w")) / F.col("_step"))
    found = at.filter(cut & (F.col("_upto") < F.col("_step") * buckets)).agg(F.collect_list("_key").alias("s"))
    # higher-order functions take no subquery: the keys travel as one constant, sorted again after the way through JSON
    return F.array_sort(F.from_json(F.lit(found.select(F.to_json("s")).first()[0]), found.schema["s"].dataType))


def _bucket(key: Column, splitters: Column, buckets: int) -> Column:
    """The number of splitters not above ``key``, by binary search."""
    def found(k):
        def step(at, bit):
            there = at + F.call_function("shiftleft", F.lit(1), bit)
            return F.when(F.coalesce(F.get(splitters, there - 1) <= k, F.lit(False)), there).otherwise(at)
        return F.aggregate(F.sequence(F.lit(buckets.bit_length()), F.lit(0)), F.lit(0), step)
    return F.transform(F.array(key), found)[0]      # binds the key to a name: it is built once


def exact_groups(docs: DataFrame, columns: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = SEED) -> DataFrame:
    """``_row`` (the input's ``columns``, all by default), ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    columns = docs.columns if columns is None else columns
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.struct(*[quoted(c) for c in columns]).alias("_row"), quoted(id_col).alias("_id"),
        normalised(quoted(text_col)).alias("_norm"), F.monotonically_increasing_id().alias("_tie"))
    splitters = _splitters(rows, docs.count(), buckets, seed)
    dealt = _keyed(rows).select("_row", "_norm", "_key", _bucket(F.col("_key"), splitters, buckets).alias("_b")).select(
        "_row", "_norm", "_b", F.col("_key.o").alias("_open"), F.col("_key.h").alias("_hash"),
        F.col("_key.n").alias("_noid"), F.col("_key.i").alias("_id"))

    by = Window.partitionBy("_b").orderBy(*ORDER)
    seen = dealt.select("*", F.lag("_norm").over(by).alias("_before"))
    # neighbours are compared in full; from here on the digest stands for the text
    starts = seen.select(
        "_row", "_b", *[c for c in ORDER if c != "_norm"], sha256_text(F.col("_norm")).alias("_sha"),
        F.coalesce(F.col("_before") != F.col("_norm"), F.lit(True)).alias("_new"))
    return _runs(starts)


def _runs(starts: DataFrame) -> DataFrame:
    by = Window.partitionBy("_b").orderBy("_open", "_hash", "_sha", "_noid", "_id")
    everywhere = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = starts.withColumns({
        "_run": F.sum(F.col("_new").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_edge": (F.col("_hash") == F.first("_hash").over(everywhere)) | (F.col("_hash") == F.last("_hash").over(everywhere))})
    run = Window.partitionBy("_b", "_run")
    rows = cut_lineage(numbered.select(
        "_row", "_b", "_run", "_sha", "_new", "_edge", F.min("_id").over(run).alias("_keep"),
        F.count(F.lit(1)).over(run).alias("_n")))       # read twice below
    ends = rows.filter("_edge").select("_b", "_run", "_sha", "_keep", "_n").distinct()
    whole = (ends.groupBy("_sha").agg(F.min("_keep").alias("_keep"), F.sum("_n").alias("_n"), F.min("_b").alias("_first"),
                                      F.count(F.lit(1)).alias("_parts")).filter("_parts > 1").drop("_parts"))
    # at most two rows per bucket
    parts = ends.select("_b", "_run", "_sha").join(whole, "_sha").select(
        "_b", "_run", F.col("_keep").alias("_wkeep"), F.col("_n").alias("_wn"), "_first")
    out = rows.join(F.broadcast(parts), ["_b", "_run"], "left")
    spans = F.col("_first").isNotNull()
    return out.select(
        "_row", F.when(spans, F.col("_wkeep")).otherwise(F.col("_keep")).alias("keep_id"),
        F.when(spans, F.col("_wn")).otherwise(F.col("_n")).alias("group_size"),
        (F.col("_new") & (~spans | (F.col("_b") == F.col("_first")))).alias("kept"), F.col("_sha").alias("text_sha256"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text an earlier id holds."""
    return unpacked(exact_groups(docs, **options).filter("kept"), docs.columns)
