"""Approximate nearest neighbours: an NN-descent graph and greedy graph search.

Nearness is the largest inner product.  Index:
  * equal vectors are one node (the smallest id), so copies make no hubs;
  * a start graph: in each of ``TREES`` random hyperplane partitions, a node's best neighbours
    within its cell (cells above ``LEAF_MAX`` are dealt to random pieces);
  * NN-descent: a Spark join brings together at every node v the nodes that point to v and the
    nodes v points to.  A pair is scored if v points to one of the two at least, and offered to both
    ends; two nodes that both only point to v are not compared, as a hub has no bound on them.  Each
    node keeps its ``DEGREE`` best.  A node that many point to is split into chunks, each joined with
    the same bounded list, so no such pair is dropped.  Pairs whose two edges at v are both older than the last
    round were scored before and are left out.  Rounds go on, at any size, until the share of edges
    that a round has changed is under ``DELTA``.
Graph work uses 8-bit copies of the vectors; results are scored on the originals, in doubles.

Search: a query's beam starts at the nearest of ``PIVOTS`` sampled nodes and, for a vector in the
index, at its own node.  Each round expands the best unexpanded nodes of every beam (one join with
the adjacency lists, one row a node: its neighbours' ids and their codes as one binary) and keeps
the ``BEAM`` best, until all nodes of all beams are expanded.  Beams are rows, joined in groups of
about ``GROUP_BEAMS`` at any number of queries; whether beams are open is all that reaches the driver.

Cases: vectors that are null, zero, of another length than most, or hold a null or non-finite
component take no part, nor do rows without an id; rows that repeat an id count once (one vector,
by the smallest hash); ties go to the smaller id; a query never finds itself but finds its copies;
with fewer candidates than asked for, all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import quoted
from ratewise.session import scratch_path

DEGREE = 40
TREES = 8
LEAF, LEAF_MAX = 1000, 2500       # wanted and largest cell of the start graph
DELTA = 0.001                     # rounds end when less than this share of the edges is new
CHUNK = 512                       # nodes pointing to one node that are joined in one piece
GROUP = 20_000                    # messages joined in one group
BEAM = 120
EXPAND = 30                       # nodes of a beam expanded in one round
GROUP_BEAMS = 200                 # beams joined in one group: EXPAND x DEGREE codes each, some 20 MB
PIVOTS = 256                      # sampled entry nodes (smallest md5 of the id)
SEED = 5


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder: read many times, and lost executors do not matter."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, v array<double>, rep)``: the rows that take part; ``rep`` is the node of the vector."""
    v = F.transform(quoted(vec_col), lambda x: x.cast("double") + F.lit(0.0))     # -0.0 becomes 0.0
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if length is None:
        return _written(rows.withColumn("rep", F.col("id")), "vectors")
    rows = rows.filter(F.size("v") == length["d"])
    hashed = F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(7), "v").alias("b"))
    rows = rows.groupBy("id").agg(F.min_by("v", hashed).alias("v")).withColumn("h", hashed)
    rows = _written(rows, "unique")
    first = rows.groupBy("h").agg(F.min("id").alias("rep"))
    # the pairing goes by hash, without the vectors; copies of one vector may be a third of all rows
    reps = rows.select("id", "h").join(_written(first, "firsts"), "h").select("id", "rep")
    return _written(rows.select("id", "v").join(reps, "id"), "vectors")


def codes_column(v):
    """Vector as bytes: its scale (float32) and components in 8 bits."""
    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        out = []
        for x in s:
            x = np.asarray(x, dtype=np.float64)
            scale = np.abs(x).max()
            out.append(np.float32(scale / 127).tobytes() + np.rint(x / scale * 127).astype(np.int8).tobytes())
        return pd.Series(out, dtype=object)

    return run(v)


def matrix(codes) -> np.ndarray:
    return matrix_of(b"".join(codes), len(codes))


def matrix_of(raw: bytes, n: int) -> np.ndarray:
    """``n`` codes that stand one after another."""
    raw = np.frombuffer(raw, dtype=np.uint8).reshape(n, -1)
    scale = np.ascontiguousarray(raw[:, :4]).view(np.float32)
    return raw[:, 4:].view(np.int8).astype(np.float32) * scale


def _best(src, dst, sc, k: int):
    """The ``k`` best distinct (src, dst) of each src."""
    order = np.lexsort((dst, -sc, src))
    src, dst, sc = src[order], dst[order], sc[order]
    same = np.concatenate(([False], (src[1:] == src[:-1]) & (dst[1:] == dst[:-1])))
    src, dst, sc = src[~same], dst[~same], sc[~same]
    if not len(src):
        return src, dst, sc
    new = np.concatenate(([True], src[1:] != src[:-1]))
    rank = np.arange(len(src)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    keep = rank < k
    return src[keep], dst[keep], sc[keep]


_EDGES = "src long, dst long, sc float"


def _frame(src, dst, sc) -> pd.DataFrame:
    return pd.DataFrame({"src": src.astype(np.int64), "dst": dst.astype(np.int64), "sc": sc.astype(np.float32)})


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct neighbours of every node.  One pair scored in two places can differ in
    the last bit: its best score counts, once."""
    w = Window.partitionBy("src").orderBy(F.desc("sc"), "dst")
    return (edges.groupBy("src", "dst").agg(F.max("sc").alias("sc"))
            .withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).select("src", "dst", "sc"))


def start_graph(nodes: DataFrame, n: int, dim: int, degree: int, trees: int, leaf: int, seed: int) -> DataFrame:
    bits = max(0, math.ceil(math.log2(max(1, n / leaf))))

    @F.pandas_udf("array<long>")
    def cells(s: pd.Series) -> pd.Series:
        x = matrix(list(s))
        out = np.zeros((len(x), trees), dtype=np.int64)
        for t in range(trees):
            planes = np.random.default_rng((seed, t)).standard_normal((dim, bits)).astype(np.float32)
            out[:, t] = ((x @ planes) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else 0
        return pd.Series(list(out))

    dealt = nodes.select("id", "code", F.posexplode(cells("code")).alias("t", "cell"))
    sizes = dealt.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("size"))
    pieces = F.ceil(F.col("size") / F.lit(LEAF_MAX)).cast("int")
    dealt = dealt.join(sizes, ["t", "cell"]).withColumn("piece", F.pmod(F.xxhash64("id", "t"), pieces))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["id"].to_numpy(), matrix(list(pdf["code"]))
        k = min(degree, len(ids) - 1)
        if k < 1:
            return _frame(ids[:0], ids[:0], np.zeros(0))
        out = []
        for a in range(0, len(ids), 512):
            s = x[a:a + 512] @ x.T
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
            best = np.argpartition(-s, k - 1, axis=1)[:, :k]
            out.append((np.repeat(ids[a:a + 512], k), ids[best].ravel(), np.take_along_axis(s, best, 1).ravel()))
        return _frame(*[np.concatenate(c) for c in zip(*out)])

    return _top(dealt.groupBy("t", "cell", "piece").applyInPandas(join, _EDGES), degree)


def descent_round(nodes: DataFrame, edges: DataFrame, n: int, degree: int) -> DataFrame:
    """One round: neighbours of neighbours, by a join at the node between them.

    ``edges`` (src, dst, sc, new) -> the same; ``new``: the edge was not there before the round."""
    state = nodes.join(edges.groupBy(F.col("src").alias("id")).agg(
        F.when(F.count(F.lit(1)) >= degree, F.min("sc")).alias("low")), "id", "left").select(
        F.col("id").alias("x"), "code", F.coalesce("low", F.lit(float("-inf"))).cast("float").alias("low"))
    chunks = edges.groupBy(F.col("dst").alias("v")).agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("chunks"))
    to = edges.select(F.col("dst").alias("v"), F.col("src").alias("x"), "new").join(chunks, "v").select(
        "v", F.pmod(F.xxhash64("x"), F.col("chunks")).cast("int").alias("c"), "x", F.lit(False).alias("out"), "new")
    out = edges.select(F.col("src").alias("v"), F.col("dst").alias("x"), "new").join(chunks, "v", "left").select(
        "v", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("c"), "x", F.lit(True).alias("out"), "new")
    groups = max(1, 2 * n * degree // GROUP)
    sent = to.unionByName(out).join(state, "x").withColumn("g", F.pmod(F.xxhash64("v", "c"), F.lit(groups)))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["v", "c", "out"])
        ids, low, x = pdf["x"].to_numpy(), pdf["low"].to_numpy(), matrix(list(pdf["code"]))
        v, c, is_out, new = pdf["v"].to_numpy(), pdf["c"].to_numpy(), pdf["out"].to_numpy(), pdf["new"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (c[1:] != c[:-1]))))
        src, dst, sc = [], [], []
        for a, b in zip(starts, np.append(starts[1:], len(v))):
            m = a + np.count_nonzero(~is_out[a:b])
            if m == b or not new[a:b].any():
                continue
            s = x[a:b] @ x[m:b].T
            near, far = ids[a:b], ids[m:b]
            other = (near[:, None] != far[None, :]) & (new[a:b][:, None] | new[m:b][None, :])
            i, j = np.nonzero((s > low[a:b][:, None]) & other)       # w for u
            src.append(near[i])
            dst.append(far[j])
            sc.append(s[i, j])
            i, j = np.nonzero((s > low[m:b][None, :]) & other)       # u for w
            src.append(far[j])
            dst.append(near[i])
            sc.append(s[i, j])
        if not src:
            return _frame(ids[:0], ids[:0], np.zeros(0))
        return _frame(*_best(np.concatenate(src), np.concatenate(dst), np.concatenate(sc), degree))

    offers = sent.select("g", "v", "c", "x", "out", "new", "code", "low").groupBy("g").applyInPandas(join, _EDGES)
    best = _top(edges.select("src", "dst", "sc").unionByName(offers), degree)
    before = edges.select("src", "dst", F.lit(False).alias("fresh"))
    return best.join(before, ["src", "dst"], "left").select("src", "dst", "sc", F.coalesce("fresh", F.lit(True)).alias("new"))


def descended(nodes: DataFrame, edges: DataFrame, n: int, degree: int, delta: float) -> DataFrame:
    """Rounds from ``edges`` (src, dst, sc) until under ``delta`` of the edges are new.  Each node's list
    only gets better, so that comes at last."""
    edges = _written(edges.withColumn("new", F.lit(True)), "edges")
    while True:
        edges = _written(descent_round(nodes, edges, n, degree), "edges")
        changed, total = edges.agg(F.count_if("new"), F.count(F.lit(1))).first()
        if changed <= delta * total:
            return edges.select("src", "dst", "sc")


def build(vectors: DataFrame, degree: int = DEGREE, trees: int = TREES, leaf: int = LEAF, delta: float = DELTA,
          seed: int = SEED) -> dict | None:
    """Index of ``usable`` vectors: tables ``nodes`` (id, code) and ``edges`` (src, dst, sc), and the
    pivots.  None if there is no vector."""
    head = vectors.select(F.size("v")).first()
    if head is None:
        return None
    nodes = _written(vectors.filter("id = rep").select("id", codes_column("v").alias("code")), "nodes")
    n = nodes.count()
    edges = descended(nodes, start_graph(nodes, n, head[0], degree, trees, leaf, seed), n, degree, delta)
    sample = nodes.orderBy(F.md5(F.col("id").cast("string")), "id").limit(PIVOTS).toPandas()
    return {"nodes": nodes, "edges": edges, "pivots": (sample["id"].to_numpy(dtype=np.int64), list(sample["code"]))}


_STATE = "q long, code binary, ids array<long>, sc array<float>, done array<boolean>"


def _state(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["q", "code", "ids", "sc", "done"])


def search(index: dict, queries: DataFrame, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """``queries`` (q, v, own: node of the vector or null) -> ``(q, node)``, the beam of each query."""
    spark = queries.sparkSession
    pivot_ids, pivot_codes = index["pivots"]
    near = (index["edges"].join(index["nodes"].select(F.col("id").alias("dst"), "code"), "dst")
            .groupBy("src").agg(F.collect_list(F.struct("dst", "code")).alias("near")))       # DEGREE at most
    adjacency = _written(near.select("src", F.col("near.dst").alias("dsts"), F.aggregate(
        "near", F.lit(b""), lambda a, e: F.concat(a, e["code"])).alias("codes")), "adjacency")

    def enter(batches):
        p = matrix(pivot_codes)
        for pdf in batches:
            x = matrix(list(pdf["code"]))
            s = x @ p.T
            rows = []
            for k, (q, code, own) in enumerate(zip(pdf["q"], pdf["code"], pdf["own"])):
                best = np.argsort(-s[k], kind="stable")[:expand]
                ids, sc = pivot_ids[best], s[k][best]
                if own == own and own is not None and int(own) not in ids:
                    ids, sc = np.append(ids, int(own)), np.append(sc, np.float32(x[k] @ x[k]))
                rows.append((q, code, ids, sc.astype(np.float32), np.zeros(len(ids), bool)))
            yield _state(rows)

    state = _written(queries.select("q", codes_column("v").alias("code"), "own").mapInPandas(enter, _STATE), "beams")

    def step(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: dict = {}
        for q, dsts, codes in zip(right["asked"], right["dsts"], right["codes"]):
            found.setdefault(q, []).append((dsts, codes))
        rows = []
        for q, code, ids, sc, done in zip(*[left[c] for c in ("q", "code", "ids", "sc", "done")]):
            ids, sc, done = np.asarray(ids, dtype=np.int64), np.asarray(sc, dtype=np.float32), np.asarray(done, dtype=bool)
            done = done.copy()
            done[_frontier(sc, done, expand)] = True
            if q in found:
                near = np.concatenate([np.asarray(d, dtype=np.int64) for d, _ in found[q]])
                new, at = np.unique(near, return_index=True)
                fresh = ~np.isin(new, ids)
                new, at = new[fresh], at[fresh]
                if len(new):
                    s = matrix_of(b"".join(c for _, c in found.pop(q)), len(near))[at] @ matrix([code])[0]
                    ids, sc = np.concatenate((ids, new)), np.concatenate((sc, s))
                    done = np.concatenate((done, np.zeros(len(new), bool)))
            order = np.lexsort((ids, -sc))[:beam]
            rows.append((q, code, ids[order], sc[order], done[order]))
        return _state(rows)

    groups = F.lit(max(int(spark.conf.get("spark.sql.shuffle.partitions")), state.count() // GROUP_BEAMS, 1))
    opened = F.filter(F.arrays_zip("ids", "sc", "done"), lambda e: ~e["done"])
    while True:
        waiting = state.filter(F.exists("done", lambda d: ~d))
        if not waiting.limit(1).count():
            break
        # the same choice as _frontier: best score first, then the smaller id
        best = F.slice(F.array_sort(F.transform(opened, lambda e: F.struct((-e["sc"]).alias("s"), e["ids"].alias("i")))), 1, expand)
        frontier = waiting.select("q", F.explode(best).alias("e")).select("q", F.col("e.i").alias("src"))
        near = frontier.join(adjacency, "src").select(F.col("q").alias("asked"), "dsts", "codes", F.pmod(F.xxhash64("q"), groups).alias("to"))
        held = state.withColumn("of", F.pmod(F.xxhash64("q"), groups))
        state = _written(held.groupBy("of").cogroup(near.groupBy("to")).applyInPandas(step, _STATE), "beams")
    return state.select("q", F.explode("ids").alias("node"))


def _frontier(sc: np.ndarray, done: np.ndarray, expand: int) -> np.ndarray:
    """Places of the best unexpanded nodes (beams are kept in order of score, then id)."""
    at = np.flatnonzero(~done)
    return at[np.argsort(-sc[at], kind="stable")[:expand]]


def nearest(vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", **options) -> DataFrame:
    """The ``k`` nearest found of every vector that ``queries`` (a condition on ``id``) selects, itself
    left out: ``(query_id, rank, vec_id, score)``."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    index = build(rows, **options)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = rows.filter(queries).select(F.col("id").alias("q"), "v", F.col("rep").alias("own"))
    found = search(index, asked, max(BEAM, k + 1))
    originals = rows.filter("id = rep").select(F.col("id").alias("node"), F.col("v").alias("w"))
    scored = found.join(originals, "node").join(asked.select("q", "v"), "q").select(
        "q", "node", F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x).alias("score"))
    # of each node's copies the k + 1 smallest ids: no more can be among the k nearest
    w = Window.partitionBy("rep").orderBy("id")
    members = rows.select("id", F.col("rep").alias("node"), F.row_number().over(w).alias("m")).filter(F.col("m") <= k + 1)
    pairs = scored.join(members, "node").filter(F.col("id") != F.col("q"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return (pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"))
