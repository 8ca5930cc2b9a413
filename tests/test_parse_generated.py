"""Generated lines: the Spark parsers against a small Python model of the Java-level behaviour
(``String.split`` dropping trailing empty fields, ``String.trim``, ``Integer.parseInt``)."""

import random
import re

import pytest

from ratewise.operators import parse

ALPHABET = ["1", "2", "7", "a", "b", " ", "\t", ",", ",", '"', ":", "|", "-", "+"]
FAIL = object()


def jsplit(s: str, sep: str = ","):
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def jtrim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 32:
        i += 1
    while j > i and ord(s[j - 1]) <= 32:
        j -= 1
    return s[i:j]


def jint(s: str):
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return FAIL
    v = int(s)
    return v if -2**31 <= v < 2**31 else FAIL


def model_movie(line: str):
    f = jsplit(line.replace('"', ""))
    if not f:
        return FAIL
    n = len(f)
    if n < 3:
        return None
    mid = jint(jtrim(f[0]))
    if mid is FAIL:
        return FAIL
    return (mid, jtrim(":".join(f[1:n - 1])), jtrim(f[n - 1]))


def model_tag(line: str):
    f = jsplit(line)
    n = len(f)
    if n < 2:
        return FAIL
    if n < 4:
        return None
    uid, mid = jint(jtrim(f[0])), jint(jtrim(f[1]))
    if uid is FAIL or mid is FAIL:
        return FAIL
    tag = "|".join(jtrim(x.replace('"', "")) for x in f[2:n - 1])
    return (uid, mid, jtrim(tag), jtrim(f[n - 1]))


def model_link(line: str):
    f = jsplit(line)
    if len(f) < 3:
        return None
    mid = jint(jtrim(f[0]))
    if mid is FAIL:
        return FAIL
    return (mid, jtrim(f[1]), jtrim(f[2]))


def lines(seed: int, count: int = 3000):
    rnd = random.Random(seed)
    out = set()
    while len(out) < count:
        head = rnd.choice(["", "1", "12", " 3", "-4", "+5", "a", "7,12", " 1 , 2 ", "3,+4", "5,x"])
        body = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(0, 14)))
        out.add(head + rnd.choice([",", ""]) + body)
    return sorted(out)


@pytest.mark.parametrize("name,model,seed", [("movies", model_movie, 1), ("tags", model_tag, 2),
                                             ("links", model_link, 4)])
def test_parser_matches_model(spark, name, model, seed):
    data = lines(seed)
    df = spark.createDataFrame([(x,) for x in data], "value string")
    good, rejects = parse.PARSERS[name](df, parse.PERMISSIVE)
    want_good = sorted(r for r in (model(x) for x in data) if r is not None and r is not FAIL)
    want_bad = sorted(x for x in data if model(x) is FAIL)
    assert sorted(tuple(r) for r in good.collect()) == want_good
    assert sorted(r.value for r in rejects.collect()) == want_bad


@pytest.mark.parametrize("sep", [",", "::"])
def test_java_split_matches_model(spark, sep):
    from pyspark.sql import functions as F

    from ratewise.functions.text import java_split
    rnd = random.Random(3)
    data = sorted({"".join(rnd.choice(["a", ":", ",", " ", "b"]) for _ in range(rnd.randrange(0, 10)))
                   for _ in range(3000)})
    df = spark.createDataFrame([(x,) for x in data], "value string")
    got = {r.value: list(r.f) for r in df.select("value", java_split(F.col("value"), sep).alias("f")).collect()}
    assert got == {x: jsplit(x, sep) for x in data}
