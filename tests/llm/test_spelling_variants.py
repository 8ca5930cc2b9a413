"""Spelling variant grouping against brute force; the gram index against all pairs."""

import itertools
import random
import re
import zlib
from collections import Counter

import helpers
import pytest

from ratewise.llm import spelling_variants as sv


def edits_apart(a, b):
    """True if exactly one insertion, deletion or replacement apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def vocabulary(rows, least=5, count=3):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= count}


def brute(rows):
    n = vocabulary(rows)
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if edits_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        if others:
            f = min(others, key=lambda x: (-n[x], x))
            if n[f] >= 2 * n[w]:
                form[w] = f

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


def found(df):
    return sorted(map(tuple, sv.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()))


def misspelt(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    return word[:i] + rng.choice(letters) * (kind != 1) + word[i + (kind != 0):]


def texts(seed, n_words, n_docs, letters="abcdeé"):
    """Few letters: dense neighbourhoods, frequent grams, chains of forms."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(n_words)]
    out = []
    for i in range(n_docs):
        words = []
        for _ in range(60):
            w = stems[int(rng.random() ** 3 * n_words)]
            while rng.random() < 0.35:
                w = misspelt(rng, w, letters)
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_words(spark, seed):
    rows = texts(seed, 120, 250)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] != r[2] and r[1] for r in want)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == want


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in helpers.rows()] + [(None, None), (None, "nulls nulls nulls nulles")]
    rows += [(40 + i, "Éclair éclair ÷÷÷÷÷÷ ×××××× ÿÿÿÿÿÿ " + "b" * 3000 + " " + "b" * 3001) for i in range(4)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert found(df) == brute(rows)
    assert sv.variants(helpers.empty(spark)).count() == 0


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    n = vocabulary(rows)
    got = sv.variants(docs).collect()
    assert {r["word"]: r["n"] for r in got} == n
    by = {r["word"]: r for r in got}
    # all pairs, by deletion neighbourhoods
    holders = {}
    for w in n:
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            holders.setdefault(v, set()).add(w)
    near = {w: set() for w in n}
    for group in holders.values():
        for a, b in itertools.combinations(group, 2):
            if edits_apart(a, b):
                near[a].add(b)
                near[b].add(a)
    assert {w: len(x) for w, x in near.items()} == {w: r["n_near"] for w, r in by.items()}
    for w, others in near.items():
        f = min(others, key=lambda x: (-n[x], x), default=None)
        assert by[w]["form"] == (f if f and n[f] >= 2 * n[w] else None)


@pytest.mark.parametrize("qmin, qmax, t", [(2, 4, 0), (2, 4, 3), (2, 3, 1), (3, 5, 2), (2, 6, 1), (2, 4, 10 ** 9)])
def test_near_words_share_a_key(qmin, qmax, t):
    """Whatever the dictionary, one edit leaves both words a common key and at least one gram."""
    rng = random.Random(qmin * 10 + qmax + t)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(5, 12))) for _ in range(400)]
    pad = sv.padding(qmax, 5)
    counted = Counter()
    for w in words:
        s = sv.START * pad + w + sv.END * pad
        for q in range(qmin, qmax):
            counted.update(s[p:p + q] for p in range(len(s) - q + 1))
    grams = sv.Grams([g for g, c in counted.items() if c > t], qmin, qmax)
    for w in words:
        v = misspelt(rng, w, "abcd")
        if v == w or len(v) < 5:
            continue
        mine, yours = dict(grams.keys(w)), dict(grams.keys(v))
        both = [(mine[k], yours[k]) for k in mine.keys() & yours.keys()]
        assert any(edits_apart(x, y) for x, y in both), (w, v)
        s = grams.padded(w)
        assert all(a > 0 or b < len(s) for a, b in grams.edits(s))


def test_dictionary_is_bounded(spark):
    rows = [(f"{a}{b}{c}xyz", 3) for a, b, c in itertools.product("abcdefgh", repeat=3)]
    words = spark.createDataFrame(rows, "word string, n long")
    assert 0 < len(sv.frequent_grams(words, min_frequent=1, max_frequent=50)) <= 50
