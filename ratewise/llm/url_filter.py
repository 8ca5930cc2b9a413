"""URL filters: rules, and a character language-model ratio for the rest.

Rules (host, path) decide the urls they fit.  The method learns from them: urls that a rule allows
are the accepted sample, urls that a rule blocks the rejected one.  For each a smoothed
variable-order Markov model of characters is counted over all its urls: contexts of 0 to ``ORDER``
characters, interpolated from the shortest to the longest by Witten-Bell weights.  Every n-gram
counts, however rare: the counts are a Spark table that grows with the input, and no model reaches
the driver or a worker.  The distinct n-grams of the urls to score are joined to it, level by level
from single characters to the longest contexts, and each batch of urls gets the values of its own
n-grams.  A url's score is the log-likelihood difference of the two models per character; the
threshold is calibrated on a held tenth of the rule-covered urls, where it maximises balanced
accuracy.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is
scored on its text (null: empty); an empty text scores 0; without accepted or rejected urls there
is no model and the rest is allowed; ties of rules cannot occur (distinct rules of one length
cannot both fit); repeated urls count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import ascii_lower, quoted, small_batches
from ratewise.session import scratch_path

#: (verdict, host, path) of the production rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 5
SCORED_ROWS = 4096        # urls scored together (divides 2**33, so a batch lies in one partition)
HELD_GRAMS = 300_000      # distinct n-grams a counting task holds before it hands them on
BINS = 400                # of the calibration histogram, over scores -4 to 4
START, END = "\x02", "\x03"


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null or no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; nulls if none does."""
    rule = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)) if rule is None else rule.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return rule, verdict


def _grams(url: str):
    t = START * ORDER + url + END
    for i in range(ORDER, len(t)):
        for k in range(ORDER + 1):
            yield t[i - k:i + 1]


def count_grams(urls: DataFrame) -> DataFrame:
    """``urls`` (url, accepted) -> ``(gram, n1, n0)``: context plus character, by class."""
    def count(batches):
        held: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def out():
            grams = list(held[True].keys() | held[False].keys())
            if grams:
                yield pd.DataFrame({"gram": grams, "n1": [held[True][g] for g in grams], "n0": [held[False][g] for g in grams]},
                                   columns=["gram", "n1", "n0"]).astype({"n1": "int64", "n0": "int64"})
            held[True].clear()
            held[False].clear()

        for pdf in batches:
            for url, accepted in zip(pdf["url"], pdf["accepted"]):
                held[bool(accepted)].update(_grams(url))
                if len(held[True]) + len(held[False]) > HELD_GRAMS:
                    yield from out()
        yield from out()

    return (urls.select("url", "accepted").mapInPandas(count, "gram string, n1 long, n0 long")
            .groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))


class Markov:
    """One class's model held in memory: what ``log_ratios`` computes, as the tests' brute force."""

    def __init__(self, grams: list[str], counts: list[int]):
        self.next: dict[str, dict[str, int]] = defaultdict(dict)
        for g, n in zip(grams, counts):
            if n:
                self.next[g[:-1]][g[-1]] = n
        self.total = {c: sum(d.values()) for c, d in self.next.items()}

    def probability(self, gram: str) -> float:
        """Of the last character after the others, from the shortest context to the longest."""
        c, p = gram[-1], 1 / 256
        for k in range(len(gram)):
            context = gram[len(gram) - 1 - k:-1]
            seen = self.next.get(context)
            if seen is None:
                break
            kinds = len(seen)
            p = (seen.get(c, 0) + kinds * p) / (self.total[context] + kinds)
        return p


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _longest(url: str) -> list[str]:
    """The n-gram of every position with its longest context."""
    t = START * ORDER + url + END
    return [t[i - ORDER:i + 1] for i in range(ORDER, len(t))]


def asked_grams(parts: DataFrame) -> DataFrame:
    """``parts`` (batch, url) -> ``(batch, gram)``: the distinct longest n-grams of each batch."""
    def run(batches):
        for pdf in batches:
            held: dict[int, set] = defaultdict(set)
            for b, url in zip(pdf["batch"], pdf["url"]):
                held[b].update(_longest(url) if url else ())
            for b, grams in held.items():
                yield pd.DataFrame({"batch": b, "gram": list(grams)}).astype({"batch": "int64", "gram": "object"})

    return parts.select("batch", "url").mapInPandas(run, "batch long, gram string").distinct()


def log_ratios(train: DataFrame, asked: DataFrame) -> DataFrame:
    """``train`` (url, accepted), ``asked`` (gram) -> ``(gram, x)``: the log of the two models' ratio.

    Joins go from a gram to the one without its first character, so a key meets at most as many rows
    as there are characters."""
    ends = asked.select("gram").distinct().select(
        F.explode(F.array(*[F.substring("gram", ORDER + 1 - k, k + 1) for k in range(ORDER + 1)])).alias("gram"))
    none = F.lit(0).cast("long")
    grams = (count_grams(train).withColumn("asked", F.lit(False))
             .unionByName(ends.distinct().select("gram", none.alias("n1"), none.alias("n0"), F.lit(True).alias("asked")))
             .groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.max("asked").alias("asked")))
    w = Window.partitionBy(F.expr("substring(gram, 1, char_length(gram) - 1)"))
    known = _written(grams.select("gram", "asked", "n1", "n0", *[
        f for c in "10" for f in (F.sum(f"n{c}").over(w).alias(f"t{c}"), F.sum((F.col(f"n{c}") > 0).cast("long")).over(w).alias(f"k{c}"))
    ]).filter("asked"), "grams")
    out = None
    for k in range(ORDER + 1):
        level = known.filter(F.char_length("gram") == k + 1)
        if out is None:
            level = level.withColumns({"p1": F.lit(1 / 256), "p0": F.lit(1 / 256)})
        else:
            level = level.withColumn("end", F.substring("gram", 2, k)).join(out.withColumnRenamed("gram", "end"), "end")
        out = level.select("gram", *[
            F.when(F.col(f"t{c}") > 0, (F.col(f"n{c}") + F.col(f"k{c}") * F.col(f"p{c}")) / (F.col(f"t{c}") + F.col(f"k{c}")))
            .otherwise(F.col(f"p{c}")).alias(f"p{c}") for c in "10"])
    return out.select("gram", F.log(F.col("p1") / F.col("p0")).alias("x"))


def scores(rows: DataFrame, train: DataFrame) -> DataFrame:
    """``rows`` (url and others) with ``s``, the length-normalised log-likelihood difference; written."""
    at = F.floor(F.monotonically_increasing_id() / SCORED_ROWS).cast("long")
    parts = _written(rows.withColumn("batch", at), "parts")
    asked = _written(asked_grams(parts), "asked")
    told = asked.join(log_ratios(train, asked), "gram")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        x = dict(zip(right["gram"].to_pylist(), right["x"].to_pylist()))
        s = [sum(x[g] for g in _longest(u)) / (len(u) + 1) if u else 0.0 for u in left["url"].to_pylist()]
        return left.append_column("s", pa.array(s, pa.float64()))

    kind = parts.withColumn("s", F.lit(0.0)).schema
    return _written(parts.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(score, kind), "scored")


def threshold(scored: DataFrame) -> float:
    """``scored`` (accepted, s) -> the middle of the cuts with the best balanced accuracy."""
    bins = scored.groupBy(F.floor((F.greatest(F.least("s", F.lit(4.0)), F.lit(-4.0)) + 4) / 8 * BINS).cast("int").alias("b")).agg(
        F.count_if("accepted").alias("n1"), F.count_if(~F.col("accepted")).alias("n0")).toPandas()
    n1, n0 = np.zeros(BINS + 1), np.zeros(BINS + 1)
    n1[bins["b"]], n0[bins["b"]] = bins["n1"], bins["n0"]
    if not n1.sum() or not n0.sum():
        return 0.0
    # accepted at or above a cut, rejected below it
    right = (n1.sum() - np.cumsum(n1) + n1) / n1.sum() + (np.cumsum(n0) - n0) / n0.sum()
    best = np.flatnonzero(right >= right.max() - 1e-9)
    return float((best[0] + best[-1]) / 2 / BINS * 8 - 4)


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)``: score is null where a rule decides."""
    url = quoted(url_col)
    host, path = parsed(url)
    base = pages.select(quoted(id_col).alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("*", rule.alias("rule"), verdict.alias("ruled"))
    ruled = F.col("ruled").isNotNull()
    held = F.pmod(F.xxhash64("url"), F.lit(10)) == 0
    accepted = (F.col("ruled") == "allow").alias("accepted")
    train = base.filter(ruled & ~held & F.col("url").isNotNull()).select("url", accepted)
    n = train.agg(F.count_if("accepted"), F.count_if(~F.col("accepted"))).first()
    if not n[0] or not n[1]:
        return base.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit("allow")).alias("verdict"),
                           F.lit(None).cast("double").alias("score"))
    small_batches(pages.sparkSession, SCORED_ROWS)
    scored = scores(base.filter(~ruled | (held & F.col("url").isNotNull())), train)
    cut = threshold(scored.filter(ruled).select(accepted, "s"))
    columns = ["page_id", "host", "path", "rule"]
    by_rule = base.filter(ruled).select(*columns, F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score"))
    by_model = F.when(F.col("s") >= cut, "allow").otherwise("block")
    return by_rule.unionByName(scored.filter(~ruled).select(*columns, by_model.alias("verdict"), F.col("s").alias("score")))
