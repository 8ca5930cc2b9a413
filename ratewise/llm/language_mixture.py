"""Language ID by multilingual mixture inference.

Each language is a smoothed distribution over hashed character trigrams, counted over all training
documents.  A document's language proportions are the mixture weights that maximise the likelihood
of its trigrams, found by expectation-maximisation.  The language set grows from the best single
language by the one that gains most, as long as the likelihood less a penalty for each language
improves; the concave likelihood lets a language be skipped at once when its derivative at
proportion zero is not positive.  The prediction is the language of largest proportion.

Counting is one pass with bounded arrays per task and a group-wise sum; the model has
``BUCKETS`` numbers a language and is the only thing that reaches the driver and the workers.

Cases: null text or no letter: ``und``, score 0, no languages; no training language: likewise;
null languages do not train; ties go to the language that sorts first; whole texts count, in
pieces of bounded size; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import quoted, small_batches

BUCKETS = 1 << 15
SMOOTHING = 0.5
PENALTY = 3.0          # per language beyond the first, times the log of the trigram count
MAX_STEPS = 100        # of one EM run (it stops when proportions move less than TOLERANCE)
TOLERANCE = 1e-4
PIECE = 1 << 19        # code points handled at once
HELD_LANGUAGES = 64    # languages a counting task holds before it hands its counts on
UND = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def trigram_counts(text: str | None) -> np.ndarray | None:
    """Counts by bucket of the trigrams of a text's words; None if it has no letter."""
    if not text:
        return None
    letters, total, found = _letters(), np.zeros(BUCKETS, dtype=np.int64), False
    carry = np.array([32, 32], dtype=np.uint32)
    for i in range(0, len(text), PIECE):
        codes = np.frombuffer(text[i:i + PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letters[codes]
        found = found or bool(is_letter.any())
        codes = np.concatenate((carry, np.where(is_letter, codes, np.uint32(32))))
        carry = codes[-2:]
        total += _bucketed(codes)
    total += _bucketed(np.concatenate((carry, np.array([32], dtype=np.uint32))))
    return total if found else None


def _bucketed(codes: np.ndarray) -> np.ndarray:
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    keep = (b != 32)         # a trigram is named by its middle letter
    h = (a[keep] * np.uint32(0x9E3779B1)) ^ (b[keep] * np.uint32(0x85EBCA6B)) ^ (c[keep] * np.uint32(0xC2B2AE35))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return np.bincount(h >> np.uint32(17), minlength=BUCKETS)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """``{"langs": sorted names, "logp": float32 [BUCKETS, languages]}`` from all given rows."""
    small_batches(docs.sparkSession)

    def count(batches):
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": n[at]})

        for pdf in batches:
            for t, lang in zip(pdf["text"], pdf["lang"]):
                n = trigram_counts(t)
                if n is None:
                    continue
                if lang in held:
                    held[lang] += n
                else:
                    if len(held) >= HELD_LANGUAGES:
                        yield from out()
                        held.clear()
                    held[lang] = n
        yield from out()

    rows = docs.select(quoted(text_col).alias("text"), quoted(lang_col).cast("string").alias("lang")).filter("lang is not null")
    got = (rows.mapInPandas(count, "lang string, bucket int, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    if not len(got):
        return None
    langs = sorted(got["lang"].unique())
    counts = np.zeros((BUCKETS, len(langs)))
    counts[got["bucket"].to_numpy(), got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()] = got["n"].to_numpy()
    p = (counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS)
    return {"langs": langs, "logp": np.log(p).astype(np.float32)}


def _em(p: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of a mixture; ``p`` [trigrams, languages of the set]."""
    pi, total = start, n.sum()
    for _ in range(MAX_STEPS):
        mass = p * pi
        new = (n / mass.sum(1)) @ mass / total
        moved = np.abs(new - pi).max()
        pi = new
        if moved < TOLERANCE:
            break
    return pi, float(n @ np.log(p @ pi))


def infer(counts: np.ndarray, logp: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The selected languages and their proportions."""
    at = np.flatnonzero(counts)
    n = counts[at].astype(np.float64)
    lp = logp[at].astype(np.float64)
    lp -= lp.max(1, keepdims=True)          # a factor per trigram changes no comparison
    p = np.exp(lp)
    single = n @ lp
    chosen = [int(np.argmax(single))]
    pi, best = np.ones(1), float(single[chosen[0]])
    cost = PENALTY * np.log(max(2.0, n.sum()))
    while len(chosen) < p.shape[1]:
        slope = (n / (p[:, chosen] @ pi)) @ p / n.sum()       # of the likelihood, at proportion zero
        tried = []
        for k in range(p.shape[1]):
            if k not in chosen and slope[k] > 1:
                cand = chosen + [k]
                w, ll = _em(p[:, cand], n, np.append(pi * 0.9, 0.1))
                tried.append((ll, -k, cand, w))
        if not tried:
            break
        ll, _, cand, w = max(tried, key=lambda x: x[:2])
        if ll - cost <= best:
            break
        chosen, pi, best = cand, w, ll - cost
    return chosen, pi


def predict_column(text, model: dict | None):
    """struct<lang_pred, score, languages, proportions> of a text column."""
    @F.pandas_udf("struct<lang_pred:string,score:double,languages:array<string>,proportions:array<double>>")
    def run(s: pd.Series) -> pd.DataFrame:
        out = []
        for t in s:
            n = trigram_counts(t) if model else None
            if n is None:
                out.append((UND, 0.0, [], []))
                continue
            chosen, pi = infer(n, model["logp"])
            order = sorted(range(len(chosen)), key=lambda i: (-pi[i], chosen[i]))
            names = [model["langs"][chosen[i]] for i in order]
            shares = [float(min(1.0, pi[i])) for i in order]
            out.append((names[0], shares[0], names, shares))
        return pd.DataFrame(out, columns=["lang_pred", "score", "languages", "proportions"])

    return run(text)
