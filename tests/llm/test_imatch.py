import hashlib
import re
from collections import Counter

import helpers
import numpy as np
import xxhash

from ratewise.llm import imatch
from ratewise.llm.imatch import edited_pairs, fingerprint, lexicon, likeness


def slow_lexicon(texts):
    """Terms by document frequency, from the texts alone."""
    df = Counter(t for text in texts for t in set(re.findall(r"\w+", (text or "").lower())))
    return {t for t, n in df.items() if 0.001 * len(texts) <= n <= 0.05 * len(texts)}


def slow_fingerprint(text, band):
    """Distinct terms in the band (all, if none is), hashed in order, whole and per random subset.  The
    subsets' odd numbers are parameters; everything else is Python integers."""
    mine = set(re.findall(r"\w+", (text or "").lower()))
    h = sorted(xxhash.xxh64_intdigest(t) for t in (mine & band or mine))
    pack = lambda xs: b"".join(x.to_bytes(8, "little") for x in xs)
    out = (xxhash.xxh64_intdigest(pack(h)) if h else 0).to_bytes(8, "big")
    for k, odd in enumerate(int(x) for x in imatch._ODD):
        rate = imatch.RATES[k // imatch.PER_RATE]
        kept = [x for x in h if (x * odd) % 2 ** 64 < 2 ** (64 - rate)]
        out += (xxhash.xxh32_intdigest(pack(kept), k) % 65535 + 1 if kept else 0).to_bytes(2, "big")
    return out


def slow_likeness(a, b):
    if a == b:
        return 1.0
    pairs = [(a[i:i + 2], b[i:i + 2]) for i in range(8, len(a), 2)]
    told = [x == y for x, y in pairs if x != b"\0\0" or y != b"\0\0"]
    return sum(told) / len(told) if told else 0.0


def test_fingerprints_against_plain_python(spark):
    """Real documents: lexicon, fingerprints and likeness computed without the module's functions."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    band = slow_lexicon([t for _, t in rows])
    assert set(lexicon(docs).tolist()) == {xxhash.xxh64_intdigest(t) for t in band}
    got = {r["doc_id"]: r for r in edited_pairs(docs).collect()}
    for k, (i, t) in list(enumerate(rows))[:60]:
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        a, e, n = (slow_fingerprint(x, band) for x in (t, t[:len(t) - half] + nxt[:half], nxt))
        r = got[i]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a.hex(), e.hex())
        assert np.allclose((r["near_edited"], r["near_next"]), (slow_likeness(a, e), slow_likeness(a, n)))


def test_against_brute_force(spark):
    rows = [(k * 7 % 23, f"text {k} " + "shared words here " * (k % 4) + "é漢" * k) for k in range(20)] + [(100, None), (101, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    band = lexicon(df)
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    want = {}
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        a, b, c = (fingerprint(x, band) for x in (t, e, nxt))
        want[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), a.hex(), b.hex(), likeness(a, b), likeness(a, c))
    assert {r[0]: tuple(r)[1:] for r in edited_pairs(df).collect()} == want


def test_awkward_rows(spark):
    out = edited_pairs(helpers.docs(spark)).collect()
    assert len(out) == len(helpers.rows())
    same = {}
    for r in out:
        if r["doc_id"] in (10, 11):
            same[r["doc_id"]] = r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert same[10] == same[11]
    assert edited_pairs(helpers.empty(spark)).count() == 0
