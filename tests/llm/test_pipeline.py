"""Every stage of the corpus pipeline against plain Python, on awkward rows and on real ones."""

import math
from collections import Counter, defaultdict

import helpers
import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from test_line_dedup import brute as brute_lines
from test_mixing import draw
from test_simhash import classes, slow_simhash

import corpus_pipeline
from ratewise.llm import quality
from ratewise.llm.common import table
from ratewise.llm.queries import QUERIES
from ratewise.llm.sentencepiece_codec import default_model

SMALL = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


def short_rows():
    """The awkward rows without the very long texts (Python's own SimHash is slow on them)."""
    return [r for r in helpers.rows() if r[1] is None or len(r[1]) < 9000]


def short_docs(spark):
    return spark.createDataFrame(short_rows(), helpers.DOCS).repartition(3)


def as_counter(df):
    return Counter(map(tuple, df.collect()))


def test_quality_keeps_whole_rows(spark):
    docs = table(spark, SMALL, "documents")
    kept = STAGE["quality_classifier"](spark, docs, SMALL)
    good = {r["doc_id"] for r in QUERIES["op9_quality"](spark, SMALL).filter("predicted = 1").collect()}
    assert as_counter(kept) == Counter(tuple(r) for r in docs.collect() if r["doc_id"] in good)
    # clean documents stay, rejected ones go
    told = {r["doc_id"]: r["quality"] for r in table(spark, SMALL, "labels").collect() if r["quality"] is not None}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert np.mean([(i in ids) == (q == 1) for i, q in told.items()]) > 0.9
    # the score of a text by hand, from the model's weights
    model = quality.fit(docs, table(spark, SMALL, "labels"))
    texts = [r["text"] for r in docs.limit(20).collect()]
    ranks = {r["_row"]["text"]: r["_s"] for r in quality.ranked(docs, model, columns=["text"]).collect()}
    for t in texts:
        assert math.isclose(ranks[t], sum(a * b for a, b in zip(quality.features(t), model["w"])), abs_tol=1e-9)


def test_quality_on_awkward_rows(spark):
    kept = STAGE["quality_classifier"](spark, helpers.docs(spark), SMALL)
    assert not as_counter(kept) - Counter(helpers.rows())
    assert STAGE["quality_classifier"](spark, helpers.empty(spark), SMALL).count() == 0


def test_line_dedup_stage(spark):
    """Text and n_chars change, nothing else; a null text stays null."""
    want = Counter()
    for r in helpers.rows():
        kept = next(k for (i, n, d, k), _ in brute_lines(helpers.rows()).items()
                    if i == r[0] and n == (r[1] or "").count("\n") + 1 and _fits(k, r[1]))
        text = None if r[1] is None else kept
        want[(r[0], text, *r[2:4], len(kept), *r[5:])] += 1
    assert as_counter(STAGE["line_dedup"](spark, helpers.docs(spark), SMALL)) == want


def _fits(kept, text):
    """``kept`` is what is left of ``text``: its lines, in order."""
    lines = iter((text or "").split("\n"))
    return all(any(x == y for y in lines) for x in kept.split("\n")) or kept == ""


def test_simhash_stage(spark):
    rows = short_rows()
    label = classes([(r[0], slow_simhash(r[1])) for r in rows])
    groups = defaultdict(list)
    for r, c in zip(rows, label):
        groups[c].append(r)
    got = STAGE["simhash_near_dedup"](spark, short_docs(spark), SMALL).collect()
    # one row of each group: with its smallest id, if any row has one
    assert Counter(r["doc_id"] for r in got) == Counter(min((r[0] for r in g if r[0] is not None), default=None) for g in groups.values())
    assert not Counter(map(tuple, got)) - Counter(rows)


def test_mixing_stage(spark):
    df = helpers.docs(spark)
    mass = Counter()
    for r in helpers.rows():
        mass[r[3]] += max(len(r[1] or ""), 1)
    total, weights = sum(mass.values()), {s: m ** 0.7 for s, m in mass.items()}
    rate = {s: total * w / sum(weights.values()) / mass[s] for s, w in weights.items()}
    times = Counter((r[0], r[1]) for r in helpers.rows())
    alone = [r for r in helpers.rows() if times[r[0], r[1]] == 1]
    want = Counter({tuple(r): draw(r[0], r[1], rate[r[3]]) for r in alone})
    got = as_counter(STAGE["mix_sources"](spark, df, SMALL))
    assert Counter({r: n for r, n in got.items() if times[r[0], r[1]] == 1}) == +want


def test_encoding_stage(spark):
    lib = SentencePieceProcessor(model_file=default_model())
    rows = short_rows()
    got = STAGE["sentencepiece"](spark, short_docs(spark), SMALL).collect()
    key = lambda i, s, ids: (str(i), str(s), tuple(ids))
    assert Counter(key(r["doc_id"], r["source"], r["ids"]) for r in got) == \
        Counter(key(r[0], r[3], lib.encode(r[1]) if r[1] else []) for r in rows)
    assert all(r["n_pieces"] == len(r["ids"]) for r in got)


def test_every_stage_takes_the_empty_table(spark):
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, helpers.empty(spark), SMALL).count() == 0, name


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_stay(spark, name):
    assert STAGE[name](spark, helpers.docs(spark), SMALL).columns == helpers.DOCS.names
