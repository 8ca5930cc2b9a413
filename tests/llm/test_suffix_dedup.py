import hashlib
import random

import helpers
import numpy as np
import pytest

from ratewise.llm import suffix_dedup as S


def brute(rows, m=100):
    """rows: (id, text); result per row: (id, n_bytes, n_removed, n_spans, sha)."""
    seen = {}
    raws = [(S.NULL_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        for p in range(len(raw) - m + 1):
            s = raw[p:p + m]
            seen[s] = min(seen.get(s, (i, p)), (i, p))
    out = []
    for (i, raw), (d, _) in zip(raws, rows):
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for p in range(len(raw) - m + 1):
            if seen[raw[p:p + m]] < (i, p):
                gone[p:p + m] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int(np.sum(gone[:-1] & ~np.concatenate(([False], gone[:-1]))[:-1])) if len(raw) else 0
        out.append((d, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(8)]
    line = "x " * 38 + "common line"
    texts = []
    for k in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:], " ".join(word() for _ in range(rng.randint(0, 20))), line]
        texts.append("\n".join(parts))
    texts += [texts[3], texts[7][:-5] + "zz", "ab" * 400, "a" * 700, texts[5] + texts[5], "x" * 99, "x" * 100, "x" * 101, "", None]
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts))


def result(df):
    return sorted((tuple(r) for r in df.select("_row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("share", [S.HOT_SHARE, None])
def test_against_brute_force(spark, monkeypatch, share):
    rows = made(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if share is None:       # every repeated q-gram takes the way of the hot ones
        monkeypatch.setattr(S, "hot_grams", lambda r: np.unique(np.concatenate([p["h"] for p in S.found(r.toPandas())]))[::2])
    assert result(S.dedup_substrings(df)) == brute(rows)


def test_bucket_pointers_against_brute_force(spark):
    rows = made(5)[::2]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(S.dedup_substrings(df, method="pointers")) == brute(rows)


def test_long_texts_are_cut_with_an_overlap(monkeypatch):
    rng = np.random.default_rng(1)
    raw = bytes(rng.integers(97, 123, 5000, dtype=np.uint8))
    import pandas as pd
    pdf = pd.DataFrame({"id": [1], "tag": [0], "text": [raw.decode()]})
    whole = list(S.found(pdf))
    monkeypatch.setattr(S, "SLICE", 700)
    S._TABLES.clear()
    cut = list(S.found(pdf))
    S._TABLES.clear()
    cover = lambda ps: sorted({w for p in ps for a, b in zip(p["lo"], p["lo"] + p["span"]) for w in range(a, b + 1)})
    assert cover(whole) == cover(cut) == list(range(5000 - 99))
    name = lambda ps: {(w, h) for p in ps for a, b, h in zip(p["lo"], p["lo"] + p["span"], p["h"]) for w in range(a, b + 1)}
    assert name(whole) == name(cut)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in helpers.rows() if r[1] is None or len(r[1]) < 9000]
    ids = {r[0] for r in rows}
    df = helpers.docs(spark)
    df = df.filter(df.doc_id.isNull() | ~df.doc_id.isin(10, 11, 12))
    assert None in ids and result(S.dedup_substrings(df)) == brute(rows)
    assert S.dedup_substrings(helpers.empty(spark)).count() == 0
    out = S.dedup_substrings(df, with_kept=True)
    assert out.filter("octet_length(kept) != n_bytes - n_removed").count() == 0
