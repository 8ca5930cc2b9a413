"""Line parsers (S1/S2 + P1-P6): delimited text lines -> typed tables.

Each parser is one projection + filter over a ``value STRING`` column, so the scan, split,
repair and casts run in one whole-stage-codegen span with no shuffle.

Modes
-----
``strict``      the reference behaviour: a malformed number (or a line the reference indexes past
                its end) fails the job with the offending line in the message.
``permissive``  returns ``(good, rejects)``; ``rejects`` has ``value, reason``.  Lines the
                reference silently filters out (too few fields) are dropped in both modes.

Field rules (from reading the reference; Java split drops trailing empty fields, Java trim strips
every char <= U+0020):
  links    n>=3: int(trim f0), trim f1, trim f2
  movies   quotes removed first; n>=3: int(trim f0), title = trim(f1..f[n-2] joined by ':'),
           genres = trim f[n-1]; n==0 (a line of only commas) fails
  tags     n>=4: int(trim f0), int(trim f1), tag = trim(each of f2..f[n-2] unquoted+trimmed,
           joined by '|'), timeStamp = trim f[n-1]; n<2 fails
  ratings  n>=4: int(trim f0), int(trim f1), double(trim f2), trim f3
  dcolon   split on '::', exactly 4 fields (else fails): int, int, float, long, untrimmed
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.functions.text import field, java_double, java_float, java_int, java_long, java_split, jtrim

STRICT = "strict"
PERMISSIVE = "permissive"


def _check(mode: str) -> None:
    if mode not in (STRICT, PERMISSIVE):
        raise ValueError(f"mode must be '{STRICT}' or '{PERMISSIVE}', got {mode!r}")


def _fail(what: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(F.col("value"), F.lit("<null>"))))


def _parse(lines: DataFrame, fields, keep: Column, fatal: Column | None, typed: dict[str, Column],
           checked: list[str], mode: str):
    """Common shape: split once, drop short lines, type the fields.

    ``fatal``    lines on which the reference fails before its arity filter;
    ``checked``  typed fields that must parse (NULL = malformed number).

    Each stage is its own projection, so the split, each field's trim and each cast run once
    per line (the optimizer keeps non-trivial expressions that are used more than once).
    """
    _check(mode)
    df = lines.select(F.col("value"), fields.alias("_f")).withColumn("_n", F.size("_f"))
    if fatal is not None:
        if mode == STRICT:
            # evaluated before the arity filter, as in the reference
            df = df.filter(F.when(fatal, _fail("malformed line")).otherwise(F.lit(True)))
        else:
            df = df.withColumn("_fatal", fatal)
            keep = keep | F.col("_fatal")
    df = df.filter(keep)
    staged = df.select("value", *[c for c in ("_fatal",) if c in df.columns],
                       *[expr.alias(f"_c_{name}") for name, expr in typed.items()])
    if mode == STRICT:
        out = []
        for name in typed:
            c = F.col(f"_c_{name}")
            if name in checked:
                c = F.when(c.isNull(), _fail(f"bad {name} in line")).otherwise(c)
            out.append(c.alias(name))
        return staged.select(*out)

    reason = F.lit(None).cast("string")
    for name in reversed(checked):
        reason = F.when(F.col(f"_c_{name}").isNull(), F.lit(f"bad {name}")).otherwise(reason)
    if fatal is not None:
        reason = F.when(F.col("_fatal"), F.lit("malformed line")).otherwise(reason)
    staged = staged.withColumn("_reason", reason)
    good = staged.filter(F.col("_reason").isNull()).select(
        *[F.col(f"_c_{name}").alias(name) for name in typed])
    rejects = staged.filter(F.col("_reason").isNotNull()).select("value", F.col("_reason").alias("reason"))
    return good, rejects


def parse_links(lines: DataFrame, mode: str = STRICT):
    f = F.col("_f")
    mid = java_int(jtrim(field(f, 0)))
    typed = {"movie_id": mid, "imdb_id": jtrim(field(f, 1)), "tmdb_id": jtrim(field(f, 2))}
    return _parse(lines, java_split("value", ","), F.col("_n") >= 3, None, typed,
                  ["movie_id"], mode)


def parse_movies(lines: DataFrame, mode: str = STRICT):
    f, n = F.col("_f"), F.col("_n")
    mid = java_int(jtrim(field(f, 0)))
    title = jtrim(F.array_join(F.slice(f, F.lit(2), n - 2), ":"))
    typed = {"movie_id": mid, "title": title, "genres": jtrim(F.element_at(f, n))}
    return _parse(lines, java_split(F.replace(F.col("value"), F.lit('"'), F.lit("")), ","),
                  n >= 3, n == 0, typed, ["movie_id"], mode)


def parse_tags(lines: DataFrame, mode: str = STRICT):
    f, n = F.col("_f"), F.col("_n")
    uid = java_int(jtrim(field(f, 0)))
    mid = java_int(jtrim(field(f, 1)))
    parts = F.transform(F.slice(f, F.lit(3), n - 3), lambda x: jtrim(F.replace(x, F.lit('"'), F.lit(""))))
    typed = {"user_id": uid, "movie_id": mid, "tag": jtrim(F.array_join(parts, "|")),
             "timeStamp": jtrim(F.element_at(f, n))}
    return _parse(lines, java_split("value", ","), n >= 4, n < 2, typed, ["user_id", "movie_id"], mode)


def parse_ratings(lines: DataFrame, mode: str = STRICT):
    f = F.col("_f")
    uid = java_int(jtrim(field(f, 0)))
    mid = java_int(jtrim(field(f, 1)))
    rating = java_double(jtrim(field(f, 2)))
    typed = {"user_id": uid, "movie_id": mid, "rating": rating, "timeStamp": jtrim(field(f, 3))}
    return _parse(lines, java_split("value", ","), F.col("_n") >= 4, None, typed,
                  ["user_id", "movie_id", "rating"], mode)


def parse_dcolon(lines: DataFrame, mode: str = STRICT):
    """P5: ``user::movie::rating::ts`` with a strict arity of 4."""
    f, n = F.col("_f"), F.col("_n")
    uid = java_int(field(f, 0))
    mid = java_int(field(f, 1))
    rating = java_float(field(f, 2))
    ts = java_long(field(f, 3))
    typed = {"userId": uid, "movieId": mid, "rating": rating, "timestamp": ts}
    return _parse(lines, java_split("value", "::"), n == 4, n != 4, typed,
                  ["userId", "movieId", "rating", "timestamp"], mode)


PARSERS = {
    "links": parse_links,
    "movies": parse_movies,
    "tags": parse_tags,
    "ratings": parse_ratings,
    "dcolon": parse_dcolon,
}
