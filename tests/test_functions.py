from pyspark.sql import functions as F

from ratewise.functions import (
    decode_user, encode_ids, encode_message, encode_scored, java_double, java_int, java_split, jtrim, pair_key,
)


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("x")).first()["x"]


def test_java_split_drops_trailing_empties(spark):
    cases = {
        "a,b,c": ["a", "b", "c"],
        "a,b,,": ["a", "b"],
        "1,0114709,": ["1", "0114709"],
        ",,,": [],
        "": [""],
        "a,,b": ["a", "", "b"],
        " , ": [" ", " "],
    }
    for line, want in cases.items():
        assert one(spark, line, java_split(F.col("v"), ",")) == want, line


def test_java_split_multichar(spark):
    assert one(spark, "1::2::3.5::9::", java_split(F.col("v"), "::")) == ["1", "2", "3.5", "9"]
    assert one(spark, "::::", java_split(F.col("v"), "::")) == []
    assert one(spark, "", java_split(F.col("v"), "::")) == [""]


def test_jtrim_strips_control_chars(spark):
    assert one(spark, "\t x y \n\r", jtrim(F.col("v"))) == "x y"


def test_java_numbers(spark):
    assert one(spark, "+12", java_int(F.col("v"))) == 12
    assert one(spark, "1.5", java_int(F.col("v"))) is None
    assert one(spark, " 12", java_int(F.col("v"))) is None
    assert one(spark, "2147483648", java_int(F.col("v"))) is None
    assert one(spark, "2.5", java_double(F.col("v"))) == 2.5
    assert one(spark, "1e3", java_double(F.col("v"))) == 1000.0
    assert one(spark, "n/a", java_double(F.col("v"))) is None
    # the rest of Java's floating literal grammar
    assert one(spark, "2.5d", java_double(F.col("v"))) == 2.5
    assert one(spark, "0x1p1", java_double(F.col("v"))) == 2.0
    assert one(spark, "-Infinity", java_double(F.col("v"))) == float("-inf")
    assert one(spark, "inf", java_double(F.col("v"))) is None      # Spark would accept, Java does not


def test_encoders_golden(spark):
    recs = spark.createDataFrame(
        [([(3, 4.5), (1, 4.0)],)], "r array<struct<movie_id:int, rating:double>>")
    assert recs.select(encode_ids("r")).first()[0] == "3_1"
    assert recs.select(encode_scored("r")).first()[0] == "movie_id=3,rating=4.5|movie_id=1,rating=4.0"
    assert recs.select(encode_scored("r", 2)).first()[0] == "movie_id=3,rating=4.50|movie_id=1,rating=4.00"
    ids = spark.createDataFrame([([(3, 0.0), (1, 0.0), (2, 0.0)],)], "r array<struct<movie_id:int, rating:double>>")
    assert ids.select(encode_ids("r")).first()[0] == "3_1_2"


def test_message_roundtrip(spark):
    df = spark.createDataFrame([(7, 3, 4.5)], "u int, m int, r double")
    key, value = encode_message("u", "m", "r")
    row = df.select(key, value, pair_key("u", "m").alias("k")).first()
    assert row["value"] == "7_3_4.5" and row["k"] == "7_3" and 0 <= int(row["key"]) <= 9
    assert one(spark, "7_3_4.5", decode_user(F.col("v"))) == 7
