import re
from collections import Counter, defaultdict

import helpers
from pyspark.sql import functions as F

from ratewise.llm.line_dedup import dedup_lines


def brute(rows, min_chars=20, min_docs=3):
    def key(line):
        k = re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line)
        return re.sub("[A-Z]", lambda m: m[0].lower(), k)
    holders = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or r[0] == max((d for d in holders[key(x)] if d is not None))]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_awkward_rows(spark):
    got = dedup_lines(helpers.docs(spark)).select("_row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert Counter(map(tuple, got)) == brute(helpers.rows())


def test_extra_columns_survive_and_empty(spark):
    out = dedup_lines(helpers.docs(spark)).select("_row.*")
    assert out.columns == helpers.DOCS.names and out.filter(F.col("`a.b`") == "d").count() == len(helpers.rows())
    assert dedup_lines(helpers.empty(spark)).count() == 0


def test_no_python_on_the_path(spark):
    plan = dedup_lines(helpers.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
