"""Fixed table schemas (nothing is inferred)."""

from pyspark.sql import types as T

LINKS = T.StructType([
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("imdb_id", T.StringType()),
    T.StructField("tmdb_id", T.StringType()),
])

MOVIES = T.StructType([
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATINGS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timeStamp", T.StringType()),
])

TAGS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timeStamp", T.StringType()),
])

# "user::movie::rating::ts" lines
DCOLON_RATINGS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("timestamp", T.LongType()),
])

# train / test tables
SPLIT = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
])

RESULT = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("res", T.StringType()),
])

REC_USER = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("res", T.StringType()),
    T.StructField("day", T.StringType()),
])

MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

FACTORS = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.FloatType())),
])

RECOMMENDATION = T.ArrayType(T.StructType([
    T.StructField("movie_id", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
]))

REJECTS = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])
