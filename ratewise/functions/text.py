"""Text column expressions with Java ``String`` semantics, all JVM-side (no UDF).

* ``jtrim``        Java ``String.trim``: strips every char <= U+0020 from both ends
                   (Spark ``trim`` strips spaces only).
* ``java_split``   Java ``String.split(sep)``: trailing empty fields are dropped; a non-empty
                   line made only of separators gives an empty array; ``""`` gives ``[""]``.
* ``java_int`` / ``java_long`` / ``java_double`` / ``java_float``
                   the number grammar of ``Integer.parseInt`` etc., NULL when the text is not a
                   number of that type (``try_cast`` alone would accept ``" 12 "`` or ``"1.5"``
                   for an int, which Java rejects).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Java whitespace class and number grammars matched by the parsers.
JAVA_WS_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+\z"
JAVA_INT = r"^[+-]?[0-9]+\z"
JAVA_DECIMAL = (r"^[\x00-\x20]*[+-]?(NaN|Infinity|"
                r"(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
                r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+)[fFdD]?)[\x00-\x20]*$")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c) -> Column:
    return F.regexp_replace(_col(c), JAVA_WS_EDGES, "")


def java_split(c, sep: str) -> Column:
    """``array<string>`` with Java ``split`` semantics for a literal separator."""
    c = _col(c)
    q = re.escape(sep)
    if len(sep) == 1:
        # one-char separator: dropping trailing empty fields == stripping trailing separators
        stripped = F.regexp_replace(c, f"{q}+\\z", "")
        return (F.when((F.length(stripped) == 0) & (F.length(c) > 0), F.array().cast("array<string>"))
                .otherwise(F.split(stripped, q)))
    parts = F.split(c, q)
    # 1-based position, from the end, of the first non-empty field (0 when all are empty)
    from_end = F.array_position(F.transform(F.reverse(parts), lambda x: x != ""), True)
    kept = F.slice(parts, F.lit(1), F.when(from_end == 0, F.lit(0)).otherwise(F.size(parts) - from_end + 1))
    return F.when(F.length(c) == 0, F.array(F.lit(""))).otherwise(kept)


def field(arr, i: int) -> Column:
    """0-based element, NULL past the end (ANSI ``arr[i]`` would raise)."""
    return F.get(_col(arr), i)


def java_int(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(JAVA_INT), c.try_cast("int"))


def java_long(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(JAVA_INT), c.try_cast("bigint"))


def java_double(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(JAVA_DECIMAL), jtrim(c).try_cast("double"))


def java_float(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(JAVA_DECIMAL), jtrim(c).try_cast("float"))
