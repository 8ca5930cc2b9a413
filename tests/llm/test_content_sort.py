"""Exact dedup by content sort against brute force."""

import hashlib
import re
from collections import defaultdict

import helpers
import pytest

from ratewise.llm import content_sort


def brute(rows):
    """(id, keep, size, sha256) of each row and the number of rows kept per group."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(i)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, min(known, default=None), len(ids), hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def found(df, **options):
    return content_sort.exact_groups(df, columns=["doc_id"], **options).select(
        "_row.doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()


def check(df, rows):
    got = found(df)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=str) == brute(rows)
    kept = [r for r in got if r["kept"]]
    assert sorted(r["text_sha256"] for r in kept) == sorted({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_awkward_rows(spark):
    check(helpers.docs(spark), [(r[0], r[1]) for r in helpers.rows()])


@pytest.mark.parametrize("parts", [3, 40])
def test_hot_group_over_many_buckets(spark, parts):
    """A third of all rows hold one text, others share a long opening or differ in their last sign."""
    opening = "the same long opening of many a text, which goes on for more than sixty-four signs: "
    rows = [(i, "hot  text\twith\nspaces" if i % 3 == 0 else opening + str(i % 70) + " " * (i % 4)) for i in range(6000)]
    rows += [(i, t) for i, t in rows[:50]] + [(None, "hot text with spaces")] * 300 + [(None, "no id")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    check(df, rows)


def test_bytes_decide(spark):
    rows = [(3, "é"), (2, "é"), (1, "é "), (4, " é"), (5, " é"), (6, "É"), (7, "é\x00"), (8, "é\t\r\n ")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_keep_one_and_empty(spark):
    docs = helpers.docs(spark)
    left = content_sort.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] in (2, 3, 10, 11)) == [2, 10]
    assert content_sort.exact_groups(helpers.empty(spark)).count() == 0


def test_string_ids(spark):
    rows = [("b", "x"), ("a", "x"), ("B", "x"), ("c", "y")]
    check(spark.createDataFrame(rows, "doc_id string, text string"), rows)


def test_plan_is_native(spark):
    out = content_sort.exact_groups(helpers.docs(spark))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
