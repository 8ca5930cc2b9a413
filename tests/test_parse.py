import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from ratewise.operators import parse

FAILS = (PySparkException, Py4JJavaError)


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_movies_golden(spark):
    got = rows(parse.parse_movies(lines(spark, [
        "1,Toy Story (1995),Adventure|Animation",
        '11,"American President, The (1995)",Comedy|Drama',
        '7,"A, B, C",X',
        "5,NoGenre,",
        "",
    ])))
    assert sorted(got) == sorted([
        (1, "Toy Story (1995)", "Adventure|Animation"),
        (11, "American President: The (1995)", "Comedy|Drama"),
        (7, "A: B: C", "X"),
    ])


def test_movies_all_commas_fails(spark):
    with pytest.raises(FAILS):
        parse.parse_movies(lines(spark, [",,,"])).collect()


def test_tags_golden(spark):
    got = rows(parse.parse_tags(lines(spark, [
        "15,1193,sci-fi,1139045764",
        '15,1193,"noir",1',
        '15,1193,"dark, gritty, slow",1139045764',
        "15,1193,1",
        "15,1193",
    ])))
    assert sorted(got) == sorted([
        (15, 1193, "sci-fi", "1139045764"),
        (15, 1193, "noir", "1"),
        (15, 1193, "dark|gritty|slow", "1139045764"),
    ])


@pytest.mark.parametrize("bad", ["15", "", ",,,"])
def test_tags_short_lines_fail(spark, bad):
    with pytest.raises(FAILS):
        parse.parse_tags(lines(spark, [bad])).collect()


def test_links_golden(spark):
    got = rows(parse.parse_links(lines(spark, ["1,0114709,862", "1,0114709,", "1,,862"])))
    assert sorted(got) == [(1, "", "862"), (1, "0114709", "862")]


def test_ratings_golden(spark):
    got = rows(parse.parse_ratings(lines(spark, ["1,31,2.5,1260759144", "1,31,2.5"])))
    assert got == [(1, 31, 2.5, "1260759144")]


def test_header_line_fails_strict(spark):
    with pytest.raises(FAILS):
        parse.parse_links(lines(spark, ["movieId,imdbId,tmdbId"])).collect()


def test_permissive_rejects(spark):
    good, rejects = parse.parse_ratings(lines(spark, [
        "userId,movieId,rating,timestamp", "1,31,2.5,1", "2,x,1.0,1", "3,4,n/a,1", "1,2"]), parse.PERMISSIVE)
    assert rows(good) == [(1, 31, 2.5, "1")]
    assert sorted(rows(rejects)) == sorted([
        ("userId,movieId,rating,timestamp", "bad user_id"), ("2,x,1.0,1", "bad movie_id"), ("3,4,n/a,1", "bad rating")])


def test_dcolon_strict_arity(spark):
    got = rows(parse.parse_dcolon(lines(spark, ["1::2::3.5::99", "4::5::1.0::7::"])))
    assert sorted(got) == [(1, 2, 3.5, 99), (4, 5, 1.0, 7)]
    with pytest.raises(FAILS):
        parse.parse_dcolon(lines(spark, ["1::2::3"])).collect()


def test_parser_outputs_match_declared_schemas(spark):
    from ratewise import schemas

    def shape(st):
        return [(f.name, f.dataType.simpleString()) for f in st.fields]

    cases = {
        "links": (["1,0114709,862"], schemas.LINKS),
        "movies": (["1,Toy Story (1995),Adventure"], schemas.MOVIES),
        "tags": (["15,1193,sci-fi,1"], schemas.TAGS),
        "ratings": (["1,31,2.5,1"], schemas.RATINGS),
        "dcolon": (["1::2::3.5::9"], schemas.DCOLON_RATINGS),
    }
    for name, (rows_in, declared) in cases.items():
        assert shape(parse.PARSERS[name](lines(spark, rows_in)).schema) == shape(declared), name
