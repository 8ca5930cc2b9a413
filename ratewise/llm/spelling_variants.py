"""Spelling variant grouping: words one edit apart, found through a variable-length gram index.

Method (a gram dictionary pruned by frequency, words decomposed into variable grams, per-word
bounds on the grams that an edit can affect, list merging, verification).

Dictionary.  Words are padded at both ends.  A gram of ``QMIN`` to ``QMAX - 1`` code points is
frequent if it occurs more than T times in all words; only a frequent gram is extended.  T is
``MIN_FREQUENT`` or, for large vocabularies, what keeps the dictionary under ``MAX_FREQUENT``
grams: that bounds what is sent to the workers and changes list lengths, never results.

Decomposition.  At each position the gram starts with QMIN code points and grows while it is
frequent, up to QMAX; a gram that ends no later than an earlier one is dropped.

Affected grams.  Let an edit lie between the first i and the last m - j code points of a padded
word.  A gram that ends at or before i stays, as its choice depends on its own code points alone.
A gram from j on is chosen alike too, but a longer gram grown across the edit may swallow it: it
has to end by the largest e' for which s[j:e'-1] is a proper suffix of a frequent gram.  So every
edit of a word leaves a known set of its grams, the same ones in both words, and at least one if
the padded word has 2 x QMAX code points (the padding sees to that).

List merging.  Two words one edit apart share all grams that this edit leaves: the lists of these
grams are intersected at once by joining on one hash of all of them (the text up to the last gram
kept on the left and from the first on the right).  A word has at most two such keys per code
point and usually one and a half; keys are computed by rolling hashes, so a very long word takes
linear time and its rows carry the few code points between the kept grams, not the word.

Verification.  A joined pair must be one edit apart between the kept grams (a row-wise test in the
join) and then, with the words themselves, as a whole.  No list is capped; a hot key is a hot join
key, which adaptive execution splits.

Cases: null texts have no words; null ids read ``null``; rows repeating an id are counted each;
no words, or an empty table: empty result; ties go to the smaller word in code-point order.
Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import LOWER, UPPER, batch_rows, quoted
from ratewise.sources.tables import cut_lineage

#: What a run of letters is, the divisor of the deletion rule.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DELETE_MOD = 97

MIN_CHARS = 5
MIN_COUNT = 3
QMIN, QMAX = 2, 4
MIN_FREQUENT = 100
MAX_FREQUENT = 1_000_000
FLUSH = 200_000             # distinct words that a task counts before it hands them on
START, END = "\x01", "\x02"     # padding; no run of letters holds them

_FOLD = str.maketrans(UPPER, LOWER)
_MOD = (1 << 61) - 1
_BASE, _LEFT, _RIGHT = 1_000_003, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def words_of(doc_id: int | str | None, text: str | None) -> Counter:
    """The folded runs of a text, each shortened by the deletion rule, with their counts."""
    if not text:
        return Counter()
    text = text.lower() if text.isascii() else text.translate(_FOLD)
    out: Counter = Counter()
    start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DELETE_MOD == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the whole table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            kept = [(w, n) for w, n in seen.items() if len(w) >= min_chars]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                               pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen.update(words_of(doc_id, text))
                if len(seen) >= FLUSH:
                    yield rows()
                    seen.clear()
        yield rows()

    parts = docs.select(quoted(id_col).cast("string").alias("i"), quoted(text_col).alias("t")).mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Grams:
    """The pruned dictionary: decomposition and the keys of a word's edits."""

    def __init__(self, frequent: Iterable[str], qmin: int = QMIN, qmax: int = QMAX, min_chars: int = MIN_CHARS):
        self.frequent = frozenset(frequent)
        self.tails = frozenset(g[k:] for g in self.frequent for k in range(1, len(g) + 1))
        self.qmin, self.qmax, self.pad = qmin, qmax, padding(qmax, min_chars)

    def padded(self, word: str) -> str:
        return START * self.pad + word + END * self.pad

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """Start and end of each gram of a padded word."""
        out, last, m = [], 0, len(s)
        for p in range(m - self.qmin + 1):
            e = p + self.qmin
            while e - p < self.qmax and e < m and s[p:e] in self.frequent:
                e += 1
            if e > last:
                out.append((p, e))
                last = e
        return out

    def swallowed(self, s: str, j: int) -> int:
        """Grams from j on that end by this may go if the code points before j change."""
        return next((e for e in range(min(len(s), j + self.qmax - 1), j, -1) if s[j:e - 1] in self.tails), j)

    def edits(self, s: str) -> set[tuple[int, int]]:
        """For each edit: the end of the last gram kept on its left, the start of the first on its right."""
        grams, m = self.decompose(s), len(s)
        first, last = self.pad, m - self.pad
        left, k, end = {}, 0, 0
        for i in range(first, last + 1):
            while k < len(grams) and grams[k][1] <= i:
                end = grams[k][1]
                k += 1
            left[i] = end
        right, k = {}, 0
        for j in range(first, last + 1):
            while k < len(grams) and grams[k][0] < j:
                k += 1
            gone, r = self.swallowed(s, j), k
            while r < len(grams) and grams[r][1] <= gone:
                r += 1
            right[j] = grams[r][0] if r < len(grams) else m
        # a code point inserted before i; code point i replaced or deleted
        return {(left[i], right[i]) for i in left} | {(left[i], right[i + 1]) for i in range(first, last)}

    def keys(self, word: str) -> list[tuple[int, str]]:
        """``(hash of the grams kept, code points between them)`` for each edit."""
        s = self.padded(word)
        from_start, from_end = [0], [0]
        for c in s:
            from_start.append((from_start[-1] * _BASE + ord(c)) % _MOD)
        for c in reversed(s):
            from_end.append((from_end[-1] * _BASE + ord(c)) % _MOD)
        out, m = [], len(s)
        for a, b in self.edits(s):
            h = (from_start[a] * _LEFT + from_end[m - b] * _RIGHT) & 0xFFFFFFFFFFFFFFFF
            out.append((h - (1 << 64) if h >> 63 else h, s[a:max(a, b)]))
        return out


def padding(qmax: int, min_chars: int) -> int:
    """Signs at each end that give the shortest word 2 x qmax code points (and the edits room)."""
    return max(1, (2 * qmax - min_chars + 1) // 2)


def frequent_grams(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, min_chars: int = MIN_CHARS,
                   min_frequent: int = MIN_FREQUENT, max_frequent: int = MAX_FREQUENT) -> list[str]:
    """The grams to extend, at most ``max_frequent``."""
    pad = padding(qmax, min_chars)
    padded = F.concat(F.lit(START * pad), F.col("word"), F.lit(END * pad))
    positions = words.agg(F.sum(F.char_length("word") + 2 * pad)).first()[0] or 0
    t = max(min_frequent, positions * (qmax - qmin) // max_frequent)
    grams = F.concat(*[F.transform(F.sequence(F.lit(1), F.char_length("s") - (q - 1)),
                                   lambda i, q=q: F.substring(F.col("s"), i, F.lit(q))) for q in range(qmin, qmax)])
    counted = (words.select(padded.alias("s")).select(F.explode(grams).alias("g"))
               .groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > t))
    return [r["g"] for r in counted.select("g").collect()]


def near_pairs(words: DataFrame, qmin: int = QMIN, qmax: int = QMAX, min_chars: int = MIN_CHARS, **limits) -> DataFrame:
    """``(a, na, b, nb)``: the words one edit apart, each pair in both orders.  ``words``: (id, word, n), written."""
    frequent = frequent_grams(words, qmin, qmax, min_chars, **limits)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(frequent, qmin, qmax, min_chars)

        def rows(found) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.string()))], names=["key", "id", "mid"])
        for b in batches:
            found: list[tuple[int, int, str]] = []
            for i, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found += [(key, i, mid) for key, mid in grams.keys(word)]
                if len(found) >= FLUSH:
                    yield rows(found)
                    found = []
            yield rows(found)

    index = words.select("id", "word").mapInArrow(keyed, "key bigint, id bigint, mid string")
    a, b = index.toDF("key", "ia", "ma"), index.toDF("key", "ib", "mb")
    joined = a.join(b, "key").filter((F.col("ia") < F.col("ib")) & (F.levenshtein("ma", "mb", 1) == 1)).select("ia", "ib").distinct()
    named = words.select("id", "word", "n")
    whole = (joined.join(named.toDF("ia", "a", "na"), "ia").join(named.toDF("ib", "b", "nb"), "ib")
             .filter(F.levenshtein("a", "b", 1) == 1).select("a", "na", "b", "nb"))
    return whole.select(F.explode(F.array(F.struct("a", "na", "b", "nb"), F.struct(
        F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: forms followed to the last, by pointer jumping.

    A form's count is at least twice its word's, so a path has at most 62 steps: six rounds."""
    paths = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        paths = cut_lineage(paths.join(on, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if not paths.filter("_moved").limit(1).count():
            return paths.drop("_moved")
        paths = paths.drop("_moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
             min_count: int = MIN_COUNT, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word of the table."""
    with batch_rows(docs.sparkSession):
        words = cut_lineage(count_words(docs, id_col, text_col, min_chars, min_count)
                            .select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    pairs = near_pairs(words, min_chars=min_chars, **options)
    # largest n first, then the smallest word
    best = pairs.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), F.col("b").alias("f"))).alias("best"))
    told = words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.m") >= 2 * F.col("n"), F.struct(F.col("best.f").alias("form"), (-F.col("best.m")).alias("form_n"))).alias("x"))
    told = cut_lineage(told.select("word", "n", "n_near", "x.form", "x.form_n"))        # read twice
    found = roots(told.filter("form IS NOT NULL").select("word", "form"))
    return told.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
