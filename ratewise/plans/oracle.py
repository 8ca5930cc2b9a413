"""DuckDB SQL for every registered query (the cross-check; not used by the Spark plans).

Views are CTEs over the benchmark tables.  Java text rules in SQL:
  jtrim(x)      regexp_replace(x, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')
  split(x, ',') string_split(rtrim(x, ','), ','), empty when x is non-empty and all commas
"""

from __future__ import annotations

from itertools import product

from ratewise.operators.als import GRID_ITER, GRID_REG
from ratewise.operators.split import KEY_STRIDE, MINSTD_A, MINSTD_M
from ratewise.plans import catalog as C
from ratewise.plans import views as V

JT = r"'^[\x00-\x20]+|[\x00-\x20]+$'"


def jtrim(x: str) -> str:
    return f"regexp_replace({x}, {JT}, '', 'g')"


def jsplit(x: str) -> str:
    return (f"(CASE WHEN length({x}) > 0 AND rtrim({x}, ',') = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split(rtrim({x}, ','), ',') END)")


def jint(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS INTEGER) END)"


def jlong(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS BIGINT) END)"


def jdouble(x: str, typ: str = "DOUBLE") -> str:
    return (f"(CASE WHEN regexp_full_match({x}, '[\\x00-\\x20]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[\\x00-\\x20]*') "
            f"THEN TRY_CAST({jtrim(x)} AS {typ}) END)")


def vs(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def dot(u: str, v: str) -> str:
    return f"list_dot_product(CAST({u} AS DOUBLE[]), CAST({v} AS DOUBLE[]))"


RATING_TEXT = "CAST(CAST(l_quantity / 10 AS DECIMAL(6,1)) AS VARCHAR)"
ORDER_ITEMS = "lineitem JOIN orders ON l_orderkey = o_orderkey"

VIEW_SQL = {
    "ratings": """SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
        avg(l_quantity) / 10 AS rating FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_partkey""",
    "movies_lines": f"""SELECT CASE p_partkey % 7
        WHEN 0 THEN {vs('p_partkey')} || ',"' || p_name || ', The (' || {vs('p_size')} || ')",' || p_type
        WHEN 1 THEN {vs('p_partkey')} || ',' || p_name || ','
        WHEN 2 THEN {vs('p_partkey')} || ',"' || p_name || ', ' || p_brand || ', X",' || p_type
        WHEN 3 THEN ' ' || {vs('p_partkey')} || ' , ' || p_name || ' ,' || p_type || ' '
        WHEN 4 THEN {vs('p_partkey')} || ',,' || p_type
        WHEN 5 THEN {vs('p_partkey')}
        ELSE {vs('p_partkey')} || ',' || p_name || ',' || p_type END AS value FROM part""",
    "tags_lines": f"""SELECT {vs('user_id')} || ',' || {vs('event_id % 200')} || ',' || CASE event_id % 6
        WHEN 0 THEN event_type || ',' || {vs('event_id')}
        WHEN 1 THEN '"' || event_type || ', ' || props || '",' || {vs('event_id')}
        WHEN 2 THEN {vs('event_id')}
        WHEN 3 THEN ' ' || event_type || ' ,x,' || {vs('event_id')}
        WHEN 4 THEN ',' || {vs('event_id')}
        ELSE event_type || ',' END AS value FROM events""",
    "links_lines": f"""SELECT CASE p_partkey % 4
        WHEN 0 THEN {vs('p_partkey')} || ',' || lpad({vs('p_partkey * 7')}, 7, '0') || ',' || {vs('p_partkey * 3 + 1')}
        WHEN 1 THEN {vs('p_partkey')} || ',' || lpad({vs('p_partkey * 7')}, 7, '0') || ','
        WHEN 2 THEN {vs('p_partkey')} || ',,' || {vs('p_partkey * 3 + 1')}
        ELSE ' ' || {vs('p_partkey')} || ' , ' || p_brand || ' ,' || {vs('p_partkey * 3 + 1')} || ',extra' END AS value
        FROM part""",
    "ratings_lines": f"""SELECT CASE l_linenumber % 4
        WHEN 0 THEN concat_ws(',', {vs('o_custkey')}, {vs('l_partkey')}, {RATING_TEXT}, {vs('l_orderkey * 10 + l_linenumber')})
        WHEN 1 THEN concat_ws(',', {vs('o_custkey')}, {vs('l_partkey')}, {RATING_TEXT})
        WHEN 2 THEN ' ' || {vs('o_custkey')} || ' , ' || {vs('l_partkey')} || ' ,' || {vs('CAST(l_quantity AS INTEGER)')}
                    || ' ,' || {vs('l_orderkey * 10 + l_linenumber')} || ',x,y'
        ELSE concat_ws(',', {vs('o_custkey')}, {vs('l_partkey')}, {RATING_TEXT}, {vs('l_orderkey * 10 + l_linenumber')}, '')
        END AS value FROM {ORDER_ITEMS}""",
    "dcolon_lines": f"""SELECT concat_ws('::', {vs('o_custkey')}, {vs('l_partkey')}, {RATING_TEXT},
        {vs('l_orderkey * 10 + l_linenumber')}) || CASE WHEN l_linenumber % 5 = 0 THEN '::' ELSE '' END AS value
        FROM {ORDER_ITEMS}""",
    "bad_lines": f"""SELECT CASE l_linenumber % 5
        WHEN 0 THEN concat_ws(',', 'u' || {vs('o_custkey')}, {vs('l_partkey')}, {RATING_TEXT}, {vs('l_orderkey')})
        WHEN 1 THEN concat_ws(',', {vs('o_custkey')}, {vs('l_partkey')} || '.5', {RATING_TEXT}, {vs('l_orderkey')})
        WHEN 2 THEN concat_ws(',', {vs('o_custkey')}, {vs('l_partkey')}, 'n/a', {vs('l_orderkey')})
        WHEN 3 THEN concat_ws(',', {vs('o_custkey')}, {vs('l_partkey')})
        ELSE concat_ws(',', {vs('o_custkey')}, {vs('l_partkey')}, {RATING_TEXT}, {vs('l_orderkey')}) END AS value
        FROM {ORDER_ITEMS}""",
    "messages": f"""SELECT {vs('event_id % 10')} AS key,
        {vs('user_id')} || '_' || {vs('event_id % 200')} || '_' || {vs('CAST(floor(value) AS INTEGER)')} AS value
        FROM events""",
    "rec_user": f"""SELECT CAST(c_custkey AS INTEGER) AS user_id, '{V.FIXTURE_RES}' AS res,
        CASE WHEN c_mktsegment IN ({", ".join(repr(x) for x in V.OLD_SEGMENTS)}) THEN '{V.YESTERDAY}' ELSE '{V.TODAY}' END AS day
        FROM customer WHERE c_mktsegment NOT IN ({", ".join(repr(x) for x in V.NEW_SEGMENTS)})""",
    "factors": """SELECT CAST(vec_id AS INTEGER) AS id, embedding AS features, vec_id % 5 = 0 AS is_user
        FROM embeddings""",
}


def with_views(names, body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = [f"{n} AS ({VIEW_SQL[n]})" for n in names] + [f"{n} AS ({q})" for n, q in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body


FRAC = f"CAST({C.TRAIN_FRACTION} AS DOUBLE)"
RANKED = ("ranked", f"""SELECT user_id, movie_id, rating,
    row_number() OVER (ORDER BY rating DESC, user_id, movie_id) - 1 AS rk, count(*) OVER () AS n FROM ratings""")
TEST = ("test_split", f"SELECT user_id, movie_id, rating FROM ranked WHERE rk >= n - floor(n * (1 - {FRAC}))")
TRAIN = ("train_split", f"SELECT user_id, movie_id, rating FROM ranked WHERE rk < floor(n * {FRAC})")
DECODED = ("msg_users", f"SELECT DISTINCT {jint("split_part(value, '_', 1)")} AS user_id FROM messages")
PRED_TEST = ("matched", f"""SELECT t.user_id, t.movie_id, t.rating, {dot('u.features', 'v.features')} AS prediction
    FROM test_split t JOIN factors u ON u.id = t.user_id AND u.is_user
    JOIN factors v ON v.id = t.movie_id AND NOT v.is_user""")
POPULAR = ("popular", f"""SELECT string_agg({vs('movie_id')}, '_' ORDER BY cnt DESC, movie_id) AS res FROM
    (SELECT movie_id, count(*) AS cnt FROM ratings GROUP BY movie_id ORDER BY cnt DESC, movie_id LIMIT {C.K})""")


def topk_ctes(users_filter: str = "") -> list[tuple[str, str]]:
    return [
        ("scores", f"""SELECT u.id AS user_id, v.id AS movie_id, {dot('u.features', 'v.features')} AS score
            FROM factors u JOIN factors v ON u.is_user AND NOT v.is_user {users_filter}"""),
        ("topk", f"""SELECT user_id, movie_id, score, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, movie_id) AS rank
            FROM scores) WHERE rank <= {C.K}"""),
    ]


def recommend_ctes(users_cte: str) -> list[tuple[str, str]]:
    return [POPULAR] + topk_ctes(f"WHERE u.id IN (SELECT user_id FROM {users_cte})") + [
        ("known_recs", f"SELECT user_id, string_agg({vs('movie_id')}, '_' ORDER BY rank) AS res FROM topk GROUP BY user_id"),
        ("recs", f"""SELECT w.user_id, COALESCE(k.res, (SELECT res FROM popular)) AS res, k.user_id IS NOT NULL AS known
            FROM {users_cte} w LEFT JOIN known_recs k ON k.user_id = w.user_id"""),
    ]


def _bucket(keys=("user_id", "movie_id")) -> str:
    x = "CAST(0 AS BIGINT)"
    for k in keys:
        x = f"((({x}) * {KEY_STRIDE} + ((({k}) % {KEY_STRIDE} + {KEY_STRIDE}) % {KEY_STRIDE})) % {MINSTD_M})"
    for _ in range(2):
        x = f"((({x}) * {MINSTD_A}) % {MINSTD_M})"
    return f"(({x}) % 1000)"


def _parse_sql(view: str, fields_expr: str, keep: str, cols: list[tuple[str, str]]) -> str:
    sel = ", ".join(f"{e} AS {n}" for n, e in cols)
    return with_views([view], f"SELECT {sel} FROM (SELECT f, len(f) AS n FROM (SELECT {fields_expr} AS f FROM {view})) WHERE {keep}")


def _ratings_cols() -> list[tuple[str, str]]:
    return [("user_id", jint(jtrim("f[1]"))), ("movie_id", jint(jtrim("f[2]"))),
            ("rating", jdouble(jtrim("f[3]"))), ("timeStamp", jtrim("f[4]"))]


UPSERT_CTES = [DECODED] + recommend_ctes("msg_users") + [
    ("stored", "SELECT user_id, max(day) AS sday FROM rec_user GROUP BY user_id"),
    ("actions", f"""SELECT r.user_id, r.res, CASE WHEN s.user_id IS NULL THEN 'insert'
        WHEN s.sday IS DISTINCT FROM '{V.TODAY}' THEN 'update' ELSE 'skip' END AS action, '{V.TODAY}' AS day
        FROM recs r LEFT JOIN stored s ON s.user_id = r.user_id"""),
    ("written", "SELECT user_id, res, day FROM actions WHERE action <> 'skip'"),
]
UPSERT_RESULT = with_views(["ratings", "messages", "factors", "rec_user"],
                           """SELECT user_id, res, day FROM rec_user WHERE user_id NOT IN (SELECT user_id FROM written)
                           UNION ALL SELECT user_id, res, day FROM written""", UPSERT_CTES)


def _best_params() -> str:
    ranks = C.GRID_RANKS
    parts = []
    for cand, r in enumerate(ranks):
        parts.append(f"""SELECT {cand} AS candidate, {r} AS rank,
            sqrt(avg(power({dot(f'u.features[1:{r}]', f'v.features[1:{r}]')} - t.rating, 2))) AS rmse
            FROM test_split t JOIN factors u ON u.id = t.user_id AND u.is_user
            JOIN factors v ON v.id = t.movie_id AND NOT v.is_user""")
    grid = " UNION ALL ".join(parts)
    return with_views(["ratings", "factors"], f"""SELECT CAST(candidate AS INTEGER) AS candidate, CAST(rank AS INTEGER) AS rank,
        round(rmse, 6) AS rmse FROM grid ORDER BY rmse ASC NULLS LAST, candidate LIMIT 1""",
                      [RANKED, TEST, ("grid", grid)])


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["popular_items"] = with_views(["ratings"], f"""SELECT movie_id, count(*) AS cnt FROM ratings GROUP BY movie_id
        ORDER BY cnt DESC, movie_id LIMIT {C.K}""")
    q["row_counts"] = with_views(["ratings"], f"""SELECT count(*) AS n_rows,
        CAST(floor(count(*) * {FRAC}) AS BIGINT) AS n_train_06,
        CAST(floor(count(*) * (1 - {FRAC})) AS BIGINT) AS n_test_06 FROM ratings""")
    q["distinct_users"] = with_views(["ratings"], "SELECT DISTINCT user_id FROM ratings")
    q["filter_rows"] = with_views(["ratings"], f"""SELECT count(*) FILTER (WHERE rating > {C.RATING_THRESHOLD}) AS n_above,
        count(*) FILTER (WHERE user_id = {C.ONE_USER}) AS n_user FROM ratings""")
    q["split_train"] = with_views(["ratings"], "SELECT * FROM train_split", [RANKED, TRAIN])
    q["split_test"] = with_views(["ratings"], "SELECT * FROM test_split", [RANKED, TEST])
    cut = int(round(1000 * C.HASH_TRAIN_WEIGHT))
    q["split_hash"] = with_views(["ratings"], f"""SELECT user_id, movie_id, rating,
        CASE WHEN {_bucket()} < {cut} THEN 'train' ELSE 'test' END AS part FROM ratings""")
    q["anti_blacklist"] = with_views(["messages", "factors"], """SELECT user_id FROM msg_users
        WHERE user_id NOT IN (SELECT id FROM factors WHERE is_user)""", [DECODED])
    q["classify_users"] = with_views(["messages", "factors"], """SELECT user_id,
        user_id IN (SELECT id FROM factors WHERE is_user) AS known FROM msg_users""", [DECODED])
    q["score_pairs"] = with_views(["ratings", "factors"], f"""SELECT r.user_id, r.movie_id, r.rating,
        round({dot('u.features', 'v.features')}, 6) AS prediction
        FROM ratings r JOIN factors u ON u.id = r.user_id AND u.is_user JOIN factors v ON v.id = r.movie_id AND NOT v.is_user""")
    held = [RANKED, TEST, PRED_TEST]
    q["rmse_fixed"] = with_views(["ratings", "factors"], f"""SELECT round(sqrt(COALESCE((SELECT sum(power(prediction - rating, 2)) FROM matched), 0)
        / (SELECT floor(count(*) * (1 - {FRAC})) FROM ratings)), 6) AS rmse_fixed""", held)
    q["rmse_matched"] = with_views(["ratings", "factors"], """SELECT count(*) AS n_matched,
        round(sqrt(avg(power(prediction - rating, 2))), 6) AS rmse FROM matched""", held)
    q["metrics_all"] = with_views(["ratings", "factors"], """SELECT count(*) AS n_matched,
        round(sqrt(avg(power(prediction - rating, 2))), 6) AS rmse,
        round(avg(power(prediction - rating, 2)), 6) AS mse,
        round(avg(abs(prediction - rating)), 6) AS mae,
        round(1 - sum(power(prediction - rating, 2)) / (count(*) * var_pop(rating)), 6) AS r2 FROM matched""", held)
    q["best_params"] = _best_params()

    q["parse_links"] = _parse_sql("links_lines", jsplit("value"), "n >= 3",
                                  [("movie_id", jint(jtrim("f[1]"))), ("imdb_id", jtrim("f[2]")), ("tmdb_id", jtrim("f[3]"))])
    q["parse_movies"] = _parse_sql("movies_lines", jsplit("replace(value, '\"', '')"), "n >= 3",
                                   [("movie_id", jint(jtrim("f[1]"))),
                                    ("title", jtrim("array_to_string(f[2:n-1], ':')")),
                                    ("genres", jtrim("f[n]"))])
    unquoted = jtrim("replace(x, '\"', '')")
    q["parse_tags"] = _parse_sql("tags_lines", jsplit("value"), "n >= 4",
                                 [("user_id", jint(jtrim("f[1]"))), ("movie_id", jint(jtrim("f[2]"))),
                                  ("tag", jtrim(f"array_to_string(list_transform(f[3:n-1], lambda x: {unquoted}), '|')")),
                                  ("timeStamp", jtrim("f[n]"))])
    q["parse_ratings"] = _parse_sql("ratings_lines", jsplit("value"), "n >= 4", _ratings_cols())
    q["parse_dcolon"] = _parse_sql("dcolon_lines", "string_split(regexp_replace(value, '(::)+$', ''), '::')", "n = 4",
                                   [("userId", jint("f[1]")), ("movieId", jint("f[2]")),
                                    ("rating", jdouble("f[3]", "FLOAT")), ("timestamp", jlong("f[4]"))])
    rc = dict(_ratings_cols())
    q["parse_rejects"] = with_views(["bad_lines"], f"""SELECT value, reason FROM (SELECT value, CASE
        WHEN {rc['user_id']} IS NULL THEN 'bad user_id' WHEN {rc['movie_id']} IS NULL THEN 'bad movie_id'
        WHEN {rc['rating']} IS NULL THEN 'bad rating' END AS reason
        FROM (SELECT value, f, len(f) AS n FROM (SELECT value, {jsplit('value')} AS f FROM bad_lines)) WHERE n >= 4)
        WHERE reason IS NOT NULL""")

    q["encode_message"] = with_views(["ratings"], f"""SELECT {vs('(CAST(user_id AS BIGINT) * 31 + movie_id) % 10')} AS key,
        {vs('user_id')} || '_' || {vs('movie_id')} || '_' || {vs('rating')} AS value,
        {vs('user_id')} || '_' || {vs('movie_id')} AS pair_key FROM train_split""", [RANKED, TRAIN])
    q["decode_users"] = with_views(["messages"], "SELECT user_id FROM msg_users", [DECODED])
    q["topk_factors"] = with_views(["factors"], "SELECT user_id, rank, movie_id, round(score, 6) AS rating FROM topk",
                                   topk_ctes())
    q["topk_pruned"] = q["topk_factors"]
    q["encode_ids"] = with_views(["factors"], f"""SELECT user_id, string_agg({vs('movie_id')}, '_' ORDER BY rank) AS res
        FROM topk GROUP BY user_id""", topk_ctes())
    q["encode_scored"] = with_views(["factors"], f"""SELECT user_id, string_agg('movie_id=' || {vs('movie_id')} || ',rating='
        || {vs('CAST(score AS DECIMAL(38,6))')}, '|' ORDER BY rank) AS res FROM topk GROUP BY user_id""", topk_ctes())
    q["recommend_cold_start"] = with_views(["ratings", "factors"], "SELECT user_id, res, known FROM recs",
                                           [("all_users", "SELECT DISTINCT user_id FROM ratings")] + recommend_ctes("all_users"))
    q["upsert_actions"] = with_views(["ratings", "messages", "factors", "rec_user"],
                                     "SELECT user_id, res, action, day FROM actions", UPSERT_CTES)
    q["upsert_result"] = UPSERT_RESULT
    q["table_roundtrip"] = q["parse_ratings"]
    q["text_scan"] = q["parse_movies"]
    q["stream_distinct_users"] = with_views(["messages"], "SELECT CAST(0 AS BIGINT) AS batch_id, user_id FROM msg_users",
                                            [DECODED])
    q["stream_recommend"] = UPSERT_RESULT
    q["stream_replay"] = UPSERT_RESULT
    q["stream_restart"] = UPSERT_RESULT
    q["stream_failed_batch"] = UPSERT_RESULT
    q["stream_model_only"] = with_views(["messages", "factors"], f"""SELECT user_id, string_agg({vs('movie_id')}, '_' ORDER BY rank)
        AS res, (SELECT count(*) > 0 FROM msg_users WHERE user_id NOT IN (SELECT user_id FROM topk)) AS all_users_fail
        FROM topk JOIN (SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id, coalesce(epoch(CAST(ts AS TIMESTAMP)) <
        (SELECT avg(epoch(CAST(ts AS TIMESTAMP))) FROM events), FALSE) AS half FROM events) USING (user_id) GROUP BY user_id, half""",
        [DECODED] + topk_ctes())
    q["stream_offsets"] = f"""SELECT CAST(i AS BIGINT) AS batch_id, CAST(i - 1 AS BIGINT) AS starts_after, CAST(i AS BIGINT) AS ends_at,
        (SELECT count(*) FROM events) AS n_messages FROM range({2 * C.EVENT_FILES}) t(i)"""
    q["stream_counts"] = f"SELECT {2 * C.EVENT_FILES} AS n_batches, count(*) AS n_messages FROM events"
    q |= _als()
    return q


def _als() -> dict[str, str]:
    """Which rows a fitted model yields; what must hold for it is stated as true."""
    def evaluated(view: str, train: tuple, test: tuple, user: str = "user_id", item: str = "movie_id") -> str:
        return with_views([view], f"""SELECT count(*) AS n_matched, TRUE AS same_rmse, TRUE AS beats_mean
            FROM test_split p JOIN test_split t USING ({user}, {item})
            WHERE {user} IN (SELECT {user} FROM train_split) AND {item} IN (SELECT {item} FROM train_split)""", [*train, *test])

    def hashed(view: str, user: str, item: str) -> tuple:
        cut = int(round(1000 * C.HASH_TRAIN_WEIGHT))
        rows = [(n, f"SELECT * FROM (SELECT {user}, {item}, {_bucket((user, item))} AS b FROM {view}) WHERE b {test} {cut}")
                for n, test in (("train_split", "<"), ("test_split", ">="))]
        return rows[:1], rows[1:]

    by_hash = evaluated("ratings", *hashed("ratings", "user_id", "movie_id"))
    dcolon = [("parsed", f"""SELECT {jint("f[1]")} AS "userId", {jint("f[2]")} AS "movieId" FROM (SELECT
        string_split(regexp_replace(value, '(::)+$', ''), '::') AS f FROM dcolon_lines) WHERE len(f) = 4""")]
    train, test = hashed("parsed", '"userId"', '"movieId"')
    grid = ", ".join(f"({c}, CAST({reg} AS DOUBLE), {it})" for c, (reg, it) in enumerate(product(GRID_REG, GRID_ITER)))
    return {
        "als_evaluate": by_hash,
        "als_static_eval": by_hash,
        "als_train_eval": evaluated("ratings", [RANKED, TRAIN], [TEST]),
        "als_dcolon_eval": evaluated("dcolon_lines", dcolon + train, test, '"userId"', '"movieId"'),
        "als_grid": with_views(["ratings"], f"""SELECT candidate, reg, max_iter, (SELECT count(*) FROM test_split
            WHERE user_id IN (SELECT user_id FROM train_split) AND movie_id IN (SELECT movie_id FROM train_split)) AS n_matched,
            TRUE AS same_rmse, TRUE AS not_below_winner FROM (VALUES {grid}) g(candidate, reg, max_iter)""", [RANKED, TRAIN, TEST]),
        "als_recommend": with_views(["ratings"], f"""SELECT DISTINCT user_id, CAST(least({C.K}, (SELECT count(DISTINCT movie_id)
            FROM train_split)) AS INTEGER) AS n_recs, TRUE AS items_trained, TRUE AS scores_agree, TRUE AS best_first
            FROM train_split""", [RANKED, TRAIN]),
    }


ORACLE_SQL = build()
