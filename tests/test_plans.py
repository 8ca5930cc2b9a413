"""Guards on physical plans: what each operator must (not) turn into."""


import pytest

import __spark_entry__ as E
from ratewise.operators import parse, popular
from ratewise.operators.recommend import top_k_rows
from ratewise.plans import views as V
from ratewise.session import scratch_path
from ratewise.sources.text import read_lines

from conftest import SF0001

CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")
ITERATIVE = {"als_recommend", "als_grid", "als_evaluate", "als_static_eval", "als_train_eval", "als_dcolon_eval"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - ITERATIVE))
def test_no_cross_join_anywhere(spark, name):
    df = E.queries()[name](spark, SF0001)
    text = plan(df)
    assert not any(c in text for c in CROSS), text


def test_scans_read_only_needed_columns(spark):
    text = plan(popular.top_items(V.ratings(spark, SF0001), 5))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text or \
        "struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "l_extendedprice" not in text and "o_totalprice" not in text


def test_popular_is_partial_aggregate_and_take_ordered(spark):
    df = popular.top_items(V.ratings(spark, SF0001), 5)
    df.collect()
    text = plan(df)
    assert "TakeOrderedAndProject" in text
    assert text.count("HashAggregate") >= 2          # partial + final


def test_parse_of_split_text_has_no_shuffle(spark):
    path = scratch_path(spark, "t-plan-text")
    V.movies_lines(spark, SF0001).repartition(4).write.text(path)
    df = parse.parse_movies(read_lines(spark, path))
    assert "Exchange" not in plan(df)


def test_topk_is_cogroup_not_pairs(spark):
    uf = V.user_factors(spark, SF0001)
    vf = V.item_factors(spark, SF0001)
    text = plan(top_k_rows(uf, vf, 5))
    assert "FlatMapCoGroupsInPandas" in text
    assert not any(c in text for c in CROSS)


def test_popular_fallback_is_scalar_subquery(spark):
    from ratewise.operators.recommend import recommend
    uf = spark.createDataFrame([(1, [1.0])], "id int, features array<float>")
    vf = spark.createDataFrame([(5, [1.0])], "id int, features array<float>")
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    pop = popular.top_items_row(spark.createDataFrame([(1, 5)], "user_id int, movie_id int"), 5)
    df = recommend(users, uf, vf, 5, "popular", pop)
    assert "scalar-subquery" in optimized(df).lower()
    assert not any(c in plan(df) for c in CROSS)
