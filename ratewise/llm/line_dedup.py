"""Line dedup: drop lines whose normalised form occurs in several documents.

Method: explode normalised lines, hash, count distinct documents per hash, drop lines over the
threshold, reassemble by position.  Everything on the path is a DataFrame function.

Plan
  1. explode every line's position and 128-bit key hash (never the line itself);
  2. count rows per hash -- partial aggregation before the shuffle, so a line that a third of all
     documents share is one row per map task -- and keep the hashes seen often enough to matter;
  3. for those few: distinct documents per hash, in two aggregation steps (hash + document, then
     hash), and the largest document that holds it;
  4. positions to drop, gathered per document (bounded by the document's own lines), joined back
     to the text, which is shuffled once.

Cases
  * null or empty text: one empty line, never dropped; the kept text is ``""``;
  * null ``doc_id``: all such rows count as one document, below every other;
  * rows repeating a ``doc_id``: one document for the counts, each row keeps its own lines;
  * ties cannot occur: the surviving holder is the largest ``doc_id``;
  * empty table: empty result.
Extra columns are carried through unchanged whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import ascii_lower, packed, quoted
from ratewise.sources.tables import cut_lineage

#: Fixed value: the white space stripped at both ends of a line.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row`` (the input row as a struct), ``n_lines``, ``n_dropped``, ``kept_text``."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    base = docs.select(quoted(id_col).alias("_id"), quoted(text_col).alias("_text"))
    lines = (base.select("_id", F.xxhash64("_text").alias("_th"), F.posexplode(F.split(text, "\n")).alias("_pos", "_line"))
             .select("_id", "_th", "_pos", line_key(F.col("_line")).alias("_key"))
             .filter(F.char_length("_key") >= min_chars)
             .select("_id", "_th", "_pos", F.xxhash64("_key").alias("_k1"), F.xxhash64(F.lit(7), "_key").alias("_k2")))
    keys = ["_k1", "_k2"]
    # both small tables are written first: a join against a plain scan lets adaptive execution
    # split the rows of a hot line, which it cannot do against an aggregate on the same keys
    often = cut_lineage(lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_docs).select(*keys))
    hits = cut_lineage(lines.join(often, keys))        # read twice below
    drop = cut_lineage(
            hits.groupBy(*keys, "_id").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keep"))
            .filter(F.col("_docs") >= min_docs).select(*keys, "_keep"))
    gone = (hits.join(drop, keys).filter(~F.col("_id").eqNullSafe(F.col("_keep")))
            .groupBy(F.col("_id").alias("_gid"), F.col("_th").alias("_gth")).agg(F.collect_set("_pos").alias("_drop")))

    # the text goes through the join once, inside ``_row``
    rows = docs.select(packed(docs), quoted(id_col).alias("_id"), F.xxhash64(quoted(text_col)).alias("_th"))
    joined = rows.join(gone, rows["_id"].eqNullSafe(gone["_gid"]) & (rows["_th"] == gone["_gth"]), "left")
    text = F.coalesce(F.col("_row").getField(text_col), F.lit(""))
    out = joined.select("_row", "_drop", F.size(F.split(text, "\n")).cast("long").alias("n_lines"))
    left = F.array_except(F.sequence(F.lit(0), (F.col("n_lines") - 1).cast("int")), F.col("_drop"))
    # a one-element array binds the parts to a name: a lambda would split the text anew for every line
    bound = F.array(F.struct(F.split(text, "\n").alias("parts"), left.alias("left")))
    kept = F.transform(bound, lambda b: F.array_join(F.transform(b["left"], lambda i: F.get(b["parts"], i)), "\n"))[0]
    return out.select("_row", "n_lines", F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.when(F.col("_drop").isNull(), text).otherwise(kept).alias("kept_text"))
