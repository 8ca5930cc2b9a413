"""Fixtures of the tests in this folder: small tables with every awkward case."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns whose names clash with names that operators could use inside
    T.StructField("fp", T.StringType()), T.StructField("_id", T.StringType()), T.StructField("th", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("a.b", T.StringType()), T.StructField("label", T.StringType())])

LINE = "a line that is shared by several documents"


def rows():
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    texts = [
        (1, "Hello  world\nthis is one\n" + LINE), (2, None), (3, ""), (4, " \t\n"), (5, "one"), (6, "one two"),
        (7, LINE.upper() + " \n\n" + LINE + "\nmore text here"), (8, "\t" + LINE + "\r\ntail"), (9, LINE), (9, LINE),
        (10, long), (11, long), (12, long + " plus a few words more"), (13, "Élan É ß 😀 ▁ naïve x"),
        (None, "a row without an id " + LINE), (14, "x" * 5000 + " 漢字" * 40), (15, LINE), (15, "another text of the same id"),
        (16, "\x00\x01 odd   signs"), (17, "ONE TWO three one two three one two three"), (18, "one  two")]
    return [(i, t, ["en", "fr", None][k % 3], ["s0", "s0", "s1", None][k % 4], len(t) if t else None, "f", "i", 7, 0.5, "d", "l")
            for k, (i, t) in enumerate(texts)]


def docs(spark, parts=3):
    return spark.createDataFrame(rows(), DOCS).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], DOCS)
