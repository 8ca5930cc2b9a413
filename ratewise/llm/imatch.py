"""Document fingerprints: I-Match with randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a chosen band, that is whose
share of documents is between ``MIN_SHARE`` and ``MAX_SHARE``; frequencies are exact, over all
documents.  At most (mean distinct terms per document) / MIN_SHARE terms can be in it, whatever
the number of documents, so it is sent to the workers.  A document keeps its distinct terms in the
lexicon, sorted, and hashes them: once whole, and once for each randomised subset of the lexicon.
Subsets come at several rates, so their agreement tells small differences (dense subsets) from
large ones (sparse subsets).

Likeness of two fingerprints: 1 if they are equal, else the share of agreeing subset hashes among
those where either document has a term.

Cases: null is the empty text; texts without terms share one fingerprint; a text without a lexicon
term hashes all its terms (else all such texts would look equal); terms are runs of word
characters, lower-cased; equal texts have equal fingerprints; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import quoted, sha256_text, small_batches

MIN_SHARE = 0.001         # idf band as document shares: ln(1/share) from 3.0 to 6.9
MAX_SHARE = 0.05
RATES = (3, 6, 8, 10)      # subsets keep a term with probability 2 ** -rate
PER_RATE = 16
HELD_TERMS = 400_000      # distinct terms a counting task holds before it hands them on
_TERM = re.compile(r"\w+")
_ODD = (np.random.default_rng(11).integers(1, 2**63, len(RATES) * PER_RATE, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFT = np.repeat(np.array([64 - r for r in RATES], dtype=np.uint64), PER_RATE)


def terms(text: str | None) -> set[str]:
    return set(_TERM.findall(text.lower())) if text else set()


def term_hashes(text: str | None) -> list[int]:
    import xxhash

    h = xxhash.xxh64_intdigest
    return [h(t) for t in terms(text)]


def lexicon(docs: DataFrame, text_col: str = "text", low: float = MIN_SHARE, high: float = MAX_SHARE) -> np.ndarray:
    """Sorted hashes (uint64) of the terms in the band, from exact counts over all rows."""
    small_batches(docs.sparkSession)

    def count(batches):
        held: Counter = Counter()

        def out():
            yield pd.DataFrame({"h": np.fromiter(held.keys(), dtype=np.uint64, count=len(held)).view(np.int64),
                                "n": np.fromiter(held.values(), dtype=np.int32, count=len(held))})
            held.clear()

        for pdf in batches:
            for t in pdf["text"]:
                held.update(term_hashes(t))
                if len(held) > HELD_TERMS:
                    yield from out()
        yield from out()

    n = docs.count()
    found = (docs.select(quoted(text_col).alias("text")).mapInPandas(count, "h long, n int")
             .groupBy("h").agg(F.sum("n").alias("n"))
             .filter((F.col("n") >= low * n) & (F.col("n") <= high * n)).select("h").toPandas())
    return np.sort(found["h"].to_numpy(dtype=np.int64).view(np.uint64))


def fingerprint(text: str | None, band: np.ndarray) -> bytes:
    """A 64-bit hash of all kept terms, then 16 bits for each subset, 0 where a subset is empty."""
    import xxhash

    whole, out = 0, np.zeros(len(_ODD), dtype=">u2")
    h = np.sort(np.array(term_hashes(text), dtype=np.uint64))
    if len(h):
        at = np.searchsorted(band, h)
        inside = h[band[np.minimum(at, len(band) - 1)] == h] if len(band) else h[:0]
        h = inside if len(inside) else h
        whole = xxhash.xxh64_intdigest(h.tobytes())
        kept = (h[:, None] * _ODD[None, :]) >> _SHIFT[None, :] == 0
        for k in np.flatnonzero(kept.any(0)).tolist():
            out[k] = xxhash.xxh32_intdigest(h[kept[:, k]].tobytes(), k) % 65535 + 1
    return whole.to_bytes(8, "big") + out.tobytes()


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    x, y = np.frombuffer(a, dtype=">u2")[4:], np.frombuffer(b, dtype=">u2")[4:]
    told = (x != 0) | (y != 0)
    return float((x == y)[told].mean()) if told.any() else 0.0


def fingerprints(docs: DataFrame, band: np.ndarray, text_col: str = "text"):
    """Binary fingerprint of a text column under a lexicon."""
    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, band) for t in s], dtype=object)

    return run(quoted(text_col))


def with_next(rows: DataFrame, columns: list[str], id_col: str = "doc_id", tie: str = "th") -> DataFrame:
    """``rows`` with struct ``_next``: ``columns`` of the row that follows by descending id (after
    the last: the first); null ids come last, rows of one id are ordered by ``tie``.

    Ranges of ids (cut at approximate quantiles) are window partitions.  A row whose id is a
    range's lowest value also goes to the range below, where the row after it is found; the rows of
    the highest id also close the lowest range.
    """
    spark = rows.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    i = F.col(id_col)
    cuts, top = rows.agg(F.percentile_approx(i, [k / parts for k in range(1, parts)], 10 * parts), F.max(i)).first()
    cuts = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("struct<at:int,edge:boolean>")
    def place(s: pd.Series) -> pd.DataFrame:
        known = s.notna().to_numpy()
        ids = s.fillna(0).to_numpy(dtype=np.int64)
        at = np.searchsorted(cuts, ids, side="right")
        edge = known & (at > 0) & (cuts[np.maximum(at, 1) - 1] == ids) if len(cuts) else np.zeros(len(ids), dtype=bool)
        return pd.DataFrame({"at": np.where(known, at, 0).astype(np.int32), "edge": edge})

    placed = rows.withColumn("_p", place(i))
    spot = lambda at, tells, close: F.struct(at.cast("int").alias("at"), tells.alias("tells"), close.alias("close"))
    at, edge, no = F.col("_p.at"), F.col("_p.edge"), F.lit(False)
    spots = F.array_compact(F.array(
        spot(at, ~edge, no), F.when(edge, spot(at - 1, F.lit(True), no)),
        F.when(i.eqNullSafe(F.lit(top).cast("long")), spot(F.lit(0), no, F.lit(True)))))
    dealt = placed.select(*rows.columns, F.explode(spots).alias("_s"))
    w = Window.partitionBy("_s.at").orderBy(F.col("_s.close"), i.desc_nulls_last(), F.col(tie))
    # plain columns: a struct would be built, and moved, beside the columns themselves
    told = dealt.select("*", *[F.lead(c).over(w).alias(f"_next_{c}") for c in columns]).filter("_s.tells")
    return told.select(*rows.columns, F.struct(*[F.col(f"_next_{c}").alias(c) for c in columns]).alias("_next"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its text with the last half replaced by the start of
    the next document, and the likeness to the edited text's and to the next document's."""
    band = lexicon(docs, text_col)
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("th"), fingerprints(rows, band).alias("fp"))
    both = with_next(rows, ["text", "fp"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("_next.text", F.lit(1), half))
    made = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", F.col("_next.fp").alias("next_fp"))

    @F.pandas_udf("struct<fingerprint:string,edited_fingerprint:string,near_edited:double,near_next:double>")
    def run(edited: pd.Series, fp: pd.Series, next_fp: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(edited, fp, next_fp):
            e = fingerprint(t, band)
            out.append((a.hex(), e.hex(), likeness(a, e), likeness(a, b)))
        return pd.DataFrame(out, columns=["fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return made.select("doc_id", "n_chars", sha256_text(F.col("edited")).alias("edited_sha256"),
                       run("edited", "fp", "next_fp").alias("o")).select("doc_id", "n_chars", "edited_sha256", "o.*")
