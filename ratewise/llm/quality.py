"""Quality classifier: Bradley-Terry pairwise ranking.

Learns from preference pairs: a document labelled 1 is preferred to one labelled 0, with
probability sigmoid(w.x1 - w.x0).  That is logistic regression without intercept on feature
differences (Spark ML).  The ranking score w.x is then cut at a score quantile: the threshold is
the exact quantile of all training-labelled documents' scores at the share of label 0 among them.

``score`` maps w.x to 0..1 by a logistic curve that puts the threshold at ``CUT``.

The fit uses a bounded sample (``MAX_PER_LABEL`` rows of each label, the smallest md5 of the id),
a documented parameter; the threshold is taken over all training labels and every document is
scored on its whole text, once: ``ranked`` writes w.x of every row, the threshold is read from
there and the score is a column expression of it.  Features are text alone (never labels, lang,
source or ids): statistics of signs, lines and repeats, hashed word shapes and hashed words.  A long
word counts as pieces of ``PIECE`` code points, all of which take part.

Cases: null and empty texts have the features of an empty text; a document labelled twice gives
two training rows, conflicting labels cancel; null labels are left out; with no labels, or
one label value only, nothing can be ranked and every score is 1 (nothing is rejected); an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import batch_rows, quoted
from ratewise.session import scratch_path
from ratewise.sources.tables import cut_lineage

MAX_PER_LABEL = 4000      # sample bound of the fit, per label
PAIRS_PER_ROW = 4         # preference pairs drawn for each sampled row of label 1
CUT = 0.3                 # score >= CUT: label 1
BINS = 4096               # of one pass of the threshold's histogram
SHAPES = 64               # buckets of hashed word shapes
WORDS = 256               # buckets of hashed words
PIECE = 64                # code points of a word that are hashed at once
HEAD = 20                 # named statistics ahead of the buckets
DIM = HEAD + SHAPES + WORDS

_RUN = re.compile(r"(.)\1*")


def _buckets(word: str) -> list[int]:
    """Buckets of each piece of a word: its form (runs of upper, lower, digit and each other sign;
    letters unnamed) and itself."""
    out = []
    for a in range(0, len(word), PIECE):
        piece = word[a:a + PIECE]
        marks = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in piece)
        out.append(HEAD + zlib.crc32(_RUN.sub(r"\1", marks).encode("utf-8", "replace")) % SHAPES)
        out.append(HEAD + SHAPES + zlib.crc32(piece.lower().encode("utf-8", "replace")) % WORDS)
    return out


def features(text: str | None, cache: dict | None = None) -> np.ndarray:
    """Statistics of one whole text, all of order one."""
    x = np.zeros(DIM)
    t = text or ""
    n = len(t)
    words = t.split()
    m = len(words)
    x[0] = math.log1p(n) / 10
    x[1] = math.log1p(m) / 8
    if not m:
        x[2] = 1.0
        return x
    ascii_counts = np.bincount(np.frombuffer(t.encode("ascii", "ignore"), dtype=np.uint8), minlength=128)
    upper = int(ascii_counts[65:91].sum())
    lower = int(ascii_counts[97:123].sum())
    digits = int(ascii_counts[48:58].sum())
    spaces = int(ascii_counts[32] + ascii_counts[9:14].sum())
    wide = n - int(ascii_counts.sum())
    stops = int(ascii_counts[44] + ascii_counts[46])
    signs = n - upper - lower - digits - spaces - wide - stops
    x[3:9] = [upper / n, lower / n, digits / n * 5, wide / n, stops / n * 5, signs / n * 5]
    x[9] = n / m / 10
    distinct = len(set(words))
    x[10] = distinct / m
    x[11] = distinct / m * math.log1p(m) / 8
    x[12] = sum(a == b for a, b in zip(words, words[1:])) / m
    lines = t.split("\n")
    x[13] = len(set(lines)) / len(lines)
    x[14] = math.log1p(n / len(lines)) / 6
    x[15] = int(ascii_counts[124]) / m
    x[16] = int(ascii_counts[33]) / m
    x[17] = min(1.0, max(map(len, words)) / 100)
    x[18] = int(ascii_counts[35:39].sum() + ascii_counts[42]) / m
    x[19] = sum(w[0].isupper() for w in words) / m
    cache = {} if cache is None else cache
    found: list[int] = []
    for w in words:
        at = cache.get(w)
        if at is None:
            at = _buckets(w)
            if len(cache) < 200_000 and len(w) <= PIECE:
                cache[w] = at
        found += at
    counts = np.bincount(found, minlength=DIM)[HEAD:]
    x[HEAD:] = np.sqrt(counts * (2 / len(found)))       # shares of the pieces
    return x


def _rows(texts, cache) -> np.ndarray:
    return np.stack([features(t, cache) for t in texts]) if len(texts) else np.zeros((0, DIM))


def feature_array(text):
    """The features of a text column."""
    @F.pandas_udf("array<double>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(list(_rows(s, {})))

    return run(text)


def marked_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """The usable labels ``(_id, y)``."""
    return (labels.select(quoted(id_col).alias("_id"), quoted(label_col).cast("int").alias("y"))
            .filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1)))


def training_rows(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  label_col: str = "quality", max_per_label: int = MAX_PER_LABEL) -> DataFrame:
    """The sampled rows ``(y, o, x)``."""
    marked = marked_ids(labels, id_col, label_col)
    order = F.md5(F.concat(F.lit("bt:"), F.col("_id").cast("string")))
    picked = [marked.filter(F.col("y") == y).orderBy(order, "_id").limit(max_per_label) for y in (0, 1)]
    sample = cut_lineage(picked[0].unionByName(picked[1]))
    # at most 2 * max_per_label ids: a proven bound for the broadcast
    texts = docs.select(quoted(id_col).alias("_id"), quoted(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    return texts.select("y", F.md5(F.concat_ws(":", F.col("_id").cast("string"), F.lit("pair"))).alias("o"),
                        feature_array("_text").alias("x"))


def rank_column(text, w: list[float]):
    """The ranking score w.x of a text column."""
    cache: dict = {}

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(_rows(s, cache) @ np.array(w))

    return run(text)


def smallest(scores: DataFrame, k: int) -> float:
    """The k-th smallest ``s`` (from 1), exactly: each pass counts ``BINS`` bins and goes on in one."""
    lo, hi = scores.agg(F.min("s"), F.max("s")).first()
    while lo < hi:
        bin_of = F.least(F.floor((F.col("s") - F.lit(lo)) / F.lit((hi - lo) / BINS)), F.lit(BINS - 1))
        for b in (scores.filter(F.col("s").between(lo, hi)).groupBy(bin_of.alias("b"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("b").collect()):
            if k <= b["n"]:
                break
            k -= b["n"]
        if (b["lo"], b["hi"]) == (lo, hi):        # neighbouring numbers that no bin tells apart
            break
        lo, hi = b["lo"], b["hi"]
    return lo


def threshold(ranked: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> float:
    """The score quantile at the share of label 0, over all labelled documents of ``ranked`` (_id, _s)."""
    scores = cut_lineage(ranked.select("_id", F.col("_s").alias("s")).join(marked_ids(labels, id_col, label_col), "_id").select("y", "s"))
    below = scores.filter("y = 0").count()
    last = smallest(scores, below)
    above = scores.filter(F.col("s") > last).agg(F.min("s")).first()[0]
    return last if above is None else (last + above) / 2


def ranked(docs: DataFrame, model: dict | None, text_col: str = "text", id_col: str = "doc_id",
           columns: list[str] | None = None) -> DataFrame:
    """``(_row, _id, _s)``, written: the ranking score of every row, computed once; ``_row`` has ``columns``
    (all by default)."""
    kept = F.struct(*[quoted(c) for c in (docs.columns if columns is None else columns)]).alias("_row")
    s = F.lit(None).cast("double") if model is None else rank_column(quoted(text_col), model["w"])
    path = scratch_path(docs.sparkSession, "ranked")
    with batch_rows(docs.sparkSession):
        docs.select(kept, quoted(id_col).alias("_id"), s.alias("_s")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def scored(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
           columns: list[str] | None = None) -> DataFrame:
    """``(_row, score)`` of every row of ``docs``, learned from ``labels``."""
    model = fit(docs, labels, text_col, id_col, label_col)
    rows = ranked(docs, model, text_col, id_col, columns)
    if model is None:
        return rows.select("_row", F.lit(1.0).alias("score"))
    return rows.select("_row", score_of(F.col("_s"), model | {"tau": threshold(rows, labels, id_col, label_col)}).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
        label_col: str = "quality", max_per_label: int = MAX_PER_LABEL) -> dict | None:
    """Weights and slope; None if there are no pairs to learn from."""
    rows = training_rows(docs, labels, text_col, id_col, label_col, max_per_label)
    # ranks within the bounded sample
    with batch_rows(docs.sparkSession):
        rows = cut_lineage(rows.withColumn("rn", F.row_number().over(Window.partitionBy("y").orderBy("o")) - 1))
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    good = rows.filter("y = 1").select("rn", F.col("x").alias("xg"), F.explode(
        F.sequence(F.lit(0), F.lit(PAIRS_PER_ROW - 1))).alias("j"))
    good = good.withColumn("rn", F.pmod(F.xxhash64("rn", "j"), F.lit(n[0])))
    bad = rows.filter("y = 0").select(F.col("rn").cast("long").alias("rn"), F.col("x").alias("xb"))
    diff = good.join(bad, "rn").select("j", F.zip_with("xg", "xb", lambda a, b: a - b).alias("d"))
    # each pair enters as won or as lost, by turns: the same likelihood, both classes present
    won = (F.col("j") % 2 == 0)
    pairs = diff.select(F.when(won, 1.0).otherwise(0.0).alias("label"), array_to_vector(
        F.transform("d", lambda v: F.when(won, v).otherwise(-v))).alias("features"))
    model = LogisticRegression(fitIntercept=False, regParam=1e-3, maxIter=60).fit(pairs)
    w = model.coefficients.toArray()
    # the sample's medians give the slope alone
    got = [(r["y"], float(np.dot(w, r["x"]))) for r in rows.select("y", "x").collect()]
    y, s = np.array([g[0] for g in got]), np.array([g[1] for g in got])
    spread = float(np.median(s[y == 1]) - np.median(s[y == 0])) or 1.0
    return {"w": w.tolist(), "slope": 8.0 / max(abs(spread), 1e-6)}


def score_of(s: Column, model: dict) -> Column:
    """Score 0..1 of a ranking score; ``CUT`` at the threshold."""
    z = (s - F.lit(model["tau"])) * F.lit(model["slope"]) + F.lit(math.log(CUT / (1 - CUT)))
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
