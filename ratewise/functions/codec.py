"""Encoders / decoders of the string forms used by the job (all column expressions).

The typed intermediate for recommendations is ``array<struct<movie_id:int, rating:double>>``
in rank order; the strings below are projections of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewise.functions.text import java_int

# Fixed formats: message value "user_movie_rating", ids joined by "_",
# scored items "movie_id=<id>,rating=<score>" joined by "|", composite key "user_movie".
ID_SEP = "_"
SCORED_SEP = "|"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pair_key(user, item) -> Column:
    """``user_id + "_" + movie_id``."""
    return F.concat_ws(ID_SEP, _col(user).cast("string"), _col(item).cast("string"))


def number_text(x, scale: int | None = None) -> Column:
    """Text of a number; with ``scale`` a fixed-point decimal text (engine independent)."""
    x = _col(x)
    if scale is None:
        return x.cast("string")
    return x.cast(f"decimal(38,{scale})").cast("string")


def encode_message(user, item, rating, key: Column | None = None, rating_scale: int | None = None):
    """``(key, value)`` with value ``user_movie_rating``.

    The reference draws the key at random in 0..9; the default here is the deterministic
    ``pmod(user*31 + movie, 10)`` so a re-run produces the same records.
    """
    if key is None:
        key = F.pmod(_col(user).cast("bigint") * 31 + _col(item).cast("bigint"), F.lit(10))
    value = F.concat_ws(ID_SEP, _col(user).cast("string"), _col(item).cast("string"),
                        number_text(rating, rating_scale))
    return key.cast("string").alias("key"), value.alias("value")


def random_key(seed: int = 0) -> Column:
    """P9/F10 with the reference's random key in 0..9 (seeded)."""
    return F.floor(F.rand(seed) * 10).cast("int").cast("string")


def decode_user(value, strict: bool = True) -> Column:
    """P10: user id = first ``_`` field of the message value."""
    head = F.substring_index(_col(value), ID_SEP, 1)
    parsed = java_int(head)
    if strict:
        return F.when(parsed.isNotNull(), parsed).otherwise(
            F.raise_error(F.concat(F.lit("bad user id in message: "), _col(value))))
    return parsed


def encode_ids(recs) -> Column:
    """Item ids in rank order joined by ``_``."""
    return F.array_join(F.transform(_col(recs), lambda r: r["movie_id"].cast("string")), ID_SEP)


def encode_scored(recs, scale: int | None = None) -> Column:
    """``movie_id=<id>,rating=<score>`` joined by ``|`` in rank order.

    ``scale=None`` prints the double as Spark does; an int prints a fixed-point decimal text,
    which two engines agree on.
    """
    return F.array_join(
        F.transform(_col(recs), lambda r: F.concat(
            F.lit("movie_id="), r["movie_id"].cast("string"),
            F.lit(",rating="), number_text(r["rating"], scale))),
        SCORED_SEP)


def day_text(day=None) -> Column:
    """``yyyy-MM-dd`` of ``day`` (a 'yyyy-MM-dd' string) or of the current date."""
    if day is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.lit(day) if isinstance(day, str) else _col(day)
