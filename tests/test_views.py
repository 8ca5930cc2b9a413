"""Derived views against the numbers published in FIXTURES.md (sf0.01)."""

from pyspark.sql import functions as F

from ratewise.operators import parse, popular, split
from ratewise.plans import views as V

from conftest import SF001


def test_ratings_view_size(spark):
    assert V.ratings(spark, SF001).count() == 59391


def test_split_sizes(spark):
    train, test = split.sorted_fraction_split(V.ratings(spark, SF001), 0.6)
    assert (train.count(), test.count()) == (35634, 23756)     # one row in neither


def test_popularity_golden(spark):
    got = [tuple(r) for r in popular.top_items(V.ratings(spark, SF001), 5).collect()]
    assert got == [(558, 49), (817, 48), (1182, 48), (555, 47), (1936, 47)]


def test_parsed_line_counts(spark):
    movies = parse.parse_movies(V.movies_lines(spark, SF001))
    assert movies.count() == 1429
    assert movies.filter(F.col("title") == "").count() == 286
    assert parse.parse_tags(V.tags_lines(spark, SF001)).count() == 6667


def test_messages_and_known_users(spark):
    users = V.messages(spark, SF001).select(F.split("value", "_")[0].cast("int").alias("u")).distinct()
    assert users.count() == 150
    known = users.join(V.user_factors(spark, SF001), users.u == F.col("id"), "left_semi")
    assert known.count() == 30
