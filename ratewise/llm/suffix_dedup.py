"""Substring dedup: remove bytes covered by a repeated string.

Two methods give the same result (``method``).  ``pointers`` is bucket-pointer refinement: every
suffix is a row, see ``pointer_repeats``.  It moves several rows for each byte of text, far over any
budget (figures in the README), so ``winnowing``, with hashed windows, is the default and what the
query runs; it is described below.

A byte is removed if a ``MATCH``-byte string that covers it also starts earlier (smaller id, or same
document and earlier start).  Matches never cross documents; all is judged on the input.

Windows are bucketed by a q-gram and buckets are refined by hashes; no suffix is listed or sorted:
  1. Initial buckets.  In every ``MATCH``-byte window the smallest hashed q-gram is its pointer
     (``Q`` bytes, ``WINDOW`` candidates; Q + WINDOW - 1 = MATCH).  Equal windows have the same
     pointer at the same offset, so windows are compared within a pointer's bucket only, and a
     pointer stands for the run of windows that chose it.  A bucket with one pointer is done.
  2. Refinement of a whole run: pointers whose run (all bytes of all its windows) is equal share a
     sub-bucket; all but its first are repeats, in one step.
  3. Refinement by offset: the firsts that remain are split into eight blocks of window offsets;
     a block survives if the 93 bytes that all its windows share occur elsewhere in the bucket.
  4. The surviving windows are compared on 128-bit hashes of their ``MATCH`` bytes; all but the
     first of each are repeats.
Buckets hold about ``BUCKET_BYTES`` of text's pointers each.  A q-gram that holds over ``HOT_SHARE``
of all pointers is found by a counting pass and takes another way: the same refinement by
aggregations with map-side combining and skew-split joins, so no task gathers it.

Cases: null and empty texts, and those under ``MATCH`` bytes, lose nothing; a null id counts as
smaller than all; rows that repeat an id are judged on their own texts, a string in another row of
that id counts if it starts at a smaller offset; equal rows get equal results; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import finished_shuffles_deleted, packed, quoted, small_batches
from ratewise.session import scratch_path
from ratewise.sources.tables import cut_lineage

MATCH, Q, WINDOW = 100, 37, 64
BLOCKS, BLOCK = 8, 8                  # window offsets 0..63 in eight blocks of 8
CORE = MATCH - BLOCK + 1              # bytes that all windows of a block share
SLICE = 1 << 19                       # bytes hashed at once
HELD_BYTES = 8 << 20                  # text whose pointers a task holds before it hands them on
BUCKET_BYTES = 4 << 20
HOT_SHARE = 1e-6                      # of all pointers; at most 2 / HOT_SHARE such q-grams reach the driver (16 MB)
HOT_ROWS = 1000                       # and so many pointers at least
NULL_ID = -(2**63)

_B = np.uint64(0x9E3779B97F4A7C15)    # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(int(_B), -1, 2**64))
_LOW = np.uint64((1 << 24) - 1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        n = SLICE + MATCH + 1
        _TABLES["up"], _TABLES["down"] = _powers(_B, n), _powers(_INV, n)
    return _TABLES["up"], _TABLES["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pointers(buffer: bytes, ends: np.ndarray) -> dict[str, np.ndarray] | None:
    """Pointers of all windows in ``buffer``, several texts put together, that end at ``ends``.

    ``at``: the pointer, ``lo``/``hi``: first and last window start of its run, ``h``: its q-gram's
    hash, ``run``: the hash of all the run's bytes, ``core``: 32 bits for each block of offsets."""
    n = len(buffer)
    if n < MATCH:
        return None
    up, down = _tables()
    c = np.frombuffer(buffer, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(c * up[:n], out=sums[1:])

    def hashed(start, length):
        return _mix((sums[start + length] - sums[start]) * down[start])

    grams = _mix((sums[Q:] - sums[:n + 1 - Q]) * down[:n + 1 - Q])
    key = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))     # ties: the last
    for s in (1, 2, 4, 8, 16, 32):
        key = np.minimum(key[:-s], key[s:])
    start = np.arange(len(key))
    at = (_LOW - (key & _LOW)).astype(np.int64)
    ok = start + MATCH <= ends[np.searchsorted(ends, start, side="right")]
    start, at = start[ok], at[ok]
    if not len(start):
        return None
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    lo, hi, at = start[new], start[np.concatenate((new[1:], [len(start)])) - 1], at[new]
    near, far = at - hi, at - lo                                # offsets of the pointer in its windows
    run = hashed(lo, hi - lo + MATCH) ^ _mix((near * 64 + far).astype(np.uint64))
    core = np.zeros((len(at), BLOCKS), dtype=np.uint32)
    for b in range(BLOCKS):
        has = (near < (b + 1) * BLOCK) & (far >= b * BLOCK)
        core[has, b] = hashed(at[has] - b * BLOCK, CORE).astype(np.uint32)
    return {"at": at, "lo": lo, "hi": hi, "h": grams[at], "run": run, "core": core}


def _slices(ids, tags, texts):
    """(buffer, ends, row of each part, its first byte): texts put together, long ones cut with an overlap."""
    parts, size = [], 0
    for i, t in enumerate(texts):
        raw = t.encode("utf-8") if t else b""
        if len(raw) < MATCH:
            continue
        for a in range(0, max(1, len(raw) - MATCH + 1), SLICE - MATCH):
            piece = raw[a:a + SLICE - 1]
            if size + len(piece) > SLICE and parts:
                yield _joined(parts, ids, tags)
                parts, size = [], 0
            parts.append((i, a, piece))
            size += len(piece)
    if parts:
        yield _joined(parts, ids, tags)


def _joined(parts, ids, tags):
    size = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(size)
    rows = np.array([p[0] for p in parts])
    return b"".join(p[2] for p in parts), ends, ids[rows], tags[rows], np.array([p[1] for p in parts]) - (ends - size)


def found(pdf: pd.DataFrame):
    """The pointers of a batch of rows (id, tag, text), positions within each text."""
    ids, tags = pdf["id"].to_numpy(dtype=np.int64), pdf["tag"].to_numpy(dtype=np.int32)
    for buffer, ends, did, dtag, shift in _slices(ids, tags, pdf["text"]):
        p = pointers(buffer, ends)
        if p is None:
            continue
        part = np.searchsorted(ends, p["lo"], side="right")
        yield {"id": did[part], "tag": dtag[part], "lo": (p["lo"] + shift[part]).astype(np.int32),
               "span": (p["hi"] - p["lo"]).astype(np.uint8), "near": (p["at"] - p["hi"]).astype(np.uint8),
               "h": p["h"], "run": p["run"], "core": p["core"]}


#: Columns of a bucket's block, in order, as they lie in its bytes.
_BLOCK = (("id", "<i8", 1), ("tag", "<i4", 1), ("lo", "<i4", 1), ("span", "u1", 1), ("near", "u1", 1),
          ("h", "<u4", 1), ("run", "<u8", 1), ("core", "<u2", BLOCKS))


def _pack(cols: dict, rows: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(cols[c][rows].astype(t)).tobytes() for c, t, _ in _BLOCK)


def _unpack(blobs: list[bytes]) -> dict[str, np.ndarray]:
    width = sum(np.dtype(t).itemsize * k for _, t, k in _BLOCK)
    out: dict[str, list] = {c: [] for c, _, _ in _BLOCK}
    for blob in blobs:
        n, at = len(blob) // width, 0
        for c, t, k in _BLOCK:
            x = np.frombuffer(blob, dtype=t, count=n * k, offset=at)
            out[c].append(x.reshape(n, k) if k > 1 else x)
            at += x.nbytes
    return {c: np.concatenate(x) for c, x in out.items()}


def refined(c: dict[str, np.ndarray]) -> pd.DataFrame:
    """One bucket: ``sure`` byte ranges [a, b) that repeat, and windows a..b still to compare."""
    order = np.lexsort((c["lo"], c["id"], c["near"], c["span"], c["run"], c["h"]))
    c = {k: v[order] for k, v in c.items()}
    h = c["h"]
    bucket = np.cumsum(np.concatenate(([0], (h[1:] != h[:-1]).astype(np.int64))))
    alone = np.bincount(bucket)[bucket] == 1
    c, bucket = {k: v[~alone] for k, v in c.items()}, bucket[~alone]
    if not len(bucket):
        return pd.DataFrame({"id": np.zeros(0, np.int64), "tag": np.zeros(0, np.int32), "a": np.zeros(0, np.int32),
                             "b": np.zeros(0, np.int32), "sure": np.zeros(0, bool)})
    # equal runs: all but the first of each sub-bucket repeat
    sub = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (c["run"][1:] != c["run"][:-1])
                          | (c["span"][1:] != c["span"][:-1]) | (c["near"][1:] != c["near"][:-1])))
    first = np.flatnonzero(sub)[np.cumsum(sub) - 1]
    later = (c["id"] != c["id"][first]) | (c["lo"] != c["lo"][first])
    out = [(c["id"][later], c["tag"][later], c["lo"][later],
            c["lo"][later] + c["span"][later] + MATCH, np.ones(later.sum(), bool))]
    # the firsts (and rows at the very same place): blocks of offsets whose shared bytes recur in the bucket
    left = ~later
    c, bucket, sub = {k: v[left] for k, v in c.items()}, bucket[left], sub[left]
    near = c["near"].astype(np.int64)
    far = near + c["span"]
    at = c["lo"] + far
    for b in range(BLOCKS):
        has = np.flatnonzero((near < (b + 1) * BLOCK) & (far >= b * BLOCK))
        key = bucket[has] * 65536 + c["core"][has, b]
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        has = has[times[inverse] > 1]
        lo = np.maximum(at[has] - np.minimum(far[has], (b + 1) * BLOCK - 1), 0)
        hi = at[has] - np.maximum(near[has], b * BLOCK)
        out.append((c["id"][has], c["tag"][has], lo, hi, np.zeros(len(has), bool)))
    cols = [np.concatenate(x) for x in zip(*out)]
    return pd.DataFrame({"id": cols[0], "tag": cols[1].astype(np.int32), "a": cols[2].astype(np.int32),
                         "b": cols[3].astype(np.int32), "sure": cols[4]})


_RANGES = "id long, tag int, a int, b int, sure boolean"


def hot_grams(rows: DataFrame) -> np.ndarray:
    """Hashes of q-grams with at least about ``HOT_SHARE`` of all pointers (at most 2 / HOT_SHARE)."""
    def count(batches):
        held: list[np.ndarray] = []
        size = 0

        def out():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(2, HOT_SHARE / 2 * n.sum())
            yield pd.DataFrame({"h": np.append(h[often].view(np.int64), 0), "n": np.append(n[often], n.sum()),
                                "all": np.append(np.zeros(often.sum(), bool), True)})

        for pdf in batches:
            for p in found(pdf):
                held.append(p["h"])
                size += len(p["h"])
                if size > 2_000_000:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    got = rows.mapInPandas(count, "h long, n long, all boolean").groupBy("h", "all").agg(F.sum("n").alias("n"))
    got = cut_lineage(got)
    total = got.filter("all").agg(F.sum("n")).first()[0] or 0
    hot = got.filter(~F.col("all") & (F.col("n") >= max(float(HOT_ROWS), HOT_SHARE / 2 * total))).select("h").toPandas()
    return np.sort(hot["h"].to_numpy(dtype=np.int64).view(np.uint64))


def bucket_ranges(rows: DataFrame, hot: np.ndarray, n_buckets: int) -> DataFrame:
    """The refinement of all buckets but the hot ones: ``refined`` rows."""
    def deal(batches):
        held: list[dict] = []
        size = 0

        def out():
            cols = {k: np.concatenate([p[k] for p in held]) for k in held[0]}
            to = ((cols["h"] >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cut = np.flatnonzero(np.diff(to[order])) + 1
            groups = np.split(order, cut)
            yield pd.DataFrame({"bucket": [int(to[g[0]]) for g in groups], "block": [_pack(cols, g) for g in groups]})

        for pdf in batches:
            for p in found(pdf):
                if len(hot):
                    cold = ~np.isin(p["h"], hot)
                    p = {k: v[cold] for k, v in p.items()}
                if len(p["h"]):
                    held.append(p)
                    size += len(p["h"]) * WINDOW // 2
                if size > HELD_BYTES:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    return (rows.mapInPandas(deal, "bucket long, block binary").groupBy("bucket")
            .applyInPandas(lambda pdf: refined(_unpack(list(pdf["block"]))), _RANGES))


def hot_ranges(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """The refinement of hot buckets by aggregations: equal runs, then all windows of the firsts."""
    cores = [f"c{b}" for b in range(BLOCKS)]

    def deal(batches):
        for pdf in batches:
            for p in found(pdf):
                warm = np.isin(p["h"], hot)
                yield pd.DataFrame({"h": p["h"][warm].view(np.int64), "run": p["run"][warm].view(np.int64),
                                    "near": p["near"][warm].astype(np.int32), "span": p["span"][warm].astype(np.int32),
                                    "id": p["id"][warm], "tag": p["tag"][warm], "lo": p["lo"][warm]}
                                   | {c: p["core"][warm, b].view(np.int32) for b, c in enumerate(cores)})

    kind = "h long, run long, near int, span int, id long, tag int, lo int, " + ", ".join(f"{c} int" for c in cores)
    runs = cut_lineage(rows.mapInPandas(deal, kind).withColumn("place", _place("id", "lo")))
    same = ["h", "run", "near", "span"]
    firsts = cut_lineage(runs.groupBy(*same).agg(F.min("place").alias("first")))
    told = runs.join(firsts, same)
    sure = told.filter("place > first").select("id", "tag", F.col("lo").alias("a"), (F.col("lo") + F.col("span") + MATCH).alias("b"),
                                               F.lit(True).alias("sure"))
    far = F.col("near") + F.col("span")
    block = [F.when((F.col("near") < (b + 1) * BLOCK) & (far >= b * BLOCK), F.struct(
        F.lit(b).alias("block"), F.col(c).alias("core"),
        (F.col("lo") + far - F.least(far, F.lit((b + 1) * BLOCK - 1))).alias("a"),
        (F.col("lo") + far - F.greatest(F.col("near"), F.lit(b * BLOCK))).alias("b"))) for b, c in enumerate(cores)]
    blocks = cut_lineage(told.filter("place = first").select("h", "id", "tag", F.explode(F.array_compact(F.array(*block))).alias("x"))
                         .select("h", "id", "tag", "x.*"))
    shared = ["h", "block", "core"]
    recur = cut_lineage(blocks.groupBy(*shared).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*shared))
    return sure.unionByName(blocks.join(recur, shared).select("id", "tag", "a", "b", F.lit(False).alias("sure")))


def _place(id_col: str, at: str):
    """(id, position) as one number that sorts like the pair."""
    return F.col(id_col).cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)") + F.col(at)


def repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (id, tag, text) -> byte ranges ``(id, tag, a, b)`` that repeat, [a, b)."""
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    hot = hot_grams(rows)
    ranges = bucket_ranges(rows, hot, max(1, total // BUCKET_BYTES))
    if len(hot):
        ranges = ranges.unionByName(hot_ranges(rows, hot))
    path = scratch_path(spark, "ranges")
    ranges.write.parquet(path)
    ranges = spark.read.schema(_RANGES).parquet(path)

    todo = ranges.filter(~F.col("sure")).groupBy("id", "tag").agg(F.collect_set(F.struct("a", "b")).alias("spots"))

    def windows(batches):
        import xxhash

        for pdf in batches:
            ids, tags, ps, h1, h2 = [], [], [], [], []
            for i, g, t, spots in zip(pdf["id"], pdf["tag"], pdf["text"], pdf["spots"]):
                raw = t.encode("utf-8")
                at = np.unique(np.concatenate([np.arange(s["a"], s["b"] + 1) for s in spots])).tolist()
                digests = [xxhash.xxh3_128_digest(raw[p:p + MATCH]) for p in at]
                both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                ids.append(np.full(len(at), i, dtype=np.int64))
                tags.append(np.full(len(at), g, dtype=np.int32))
                ps.append(np.array(at, dtype=np.int32))
                h1.append(both[:, 0])
                h2.append(both[:, 1])
            if ids:
                yield pd.DataFrame({k: np.concatenate(x) for k, x in (("id", ids), ("tag", tags), ("p", ps), ("h1", h1), ("h2", h2))})

    # a written table: it is read twice, and the text is moved once for it
    path = scratch_path(spark, "windows")
    rows.join(todo, ["id", "tag"]).mapInPandas(windows, "id long, tag int, p int, h1 long, h2 long").write.parquet(path)
    w = spark.read.parquet(path).withColumn("place", _place("id", "p"))
    firsts = cut_lineage(w.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
                         .filter("n > 1").select("h1", "h2", "first"))
    late = w.join(firsts, ["h1", "h2"]).filter(F.col("place") > F.col("first")).select(
        "id", "tag", F.col("p").alias("a"), (F.col("p") + MATCH).alias("b"))
    path = scratch_path(spark, "repeats")
    ranges.filter("sure").select("id", "tag", "a", "b").unionByName(late).write.parquet(path)
    return spark.read.parquet(path)


GRAM = 25       # bytes of an initial bucket of ``pointer_repeats``


def pointer_repeats(rows: DataFrame, gram: int = GRAM, match: int = MATCH) -> DataFrame:
    """Bucket-pointer refinement: ``rows`` (id, tag, text) -> byte ranges ``(id, tag, a, b)`` that repeat.

    Suffixes start in the bucket of their first ``gram`` bytes.  A bucket's pointer is its first suffix
    (smallest id, then position).  Each round refines every bucket by the pointer that the suffix a step
    further on has, and the refined pointers are what the next round reads, with twice the step, until
    ``match`` bytes are told apart.  A suffix alone in its bucket is settled and leaves; so does one
    whose later suffix has left.  Buckets are refined by aggregation and a join, which splits hot ones.
    """
    def suffixes(batches):
        for pdf in batches:
            for i, g, t in zip(pdf["id"], pdf["tag"], pdf["text"]):
                raw = t.encode("utf-8")
                for a in range(0, len(raw) - gram + 1, SLICE):
                    at = range(a, min(a + SLICE, len(raw) - gram + 1))
                    yield pd.DataFrame({"id": i, "tag": g, "p": np.arange(at.start, at.stop, dtype=np.int32),
                                        "bucket": [raw[p:p + gram] for p in at]})

    def pointed(found: DataFrame, bucket: list[str]) -> DataFrame:
        """Suffixes of buckets with more than one, and their bucket's pointer."""
        first = cut_lineage(found.groupBy(*bucket).agg(F.min("place").alias("new"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
        return cut_lineage(found.join(first, bucket).select("id", "tag", "p", "place", F.col("new").alias("to")))

    start = rows.mapInPandas(suffixes, "id long, tag int, p int, bucket binary").withColumn("place", _place("id", "p"))
    held, width = pointed(start, ["bucket"]), gram
    while width < match:
        step = min(width, match - width)
        later = held.select("id", "tag", (F.col("p") - step).alias("p"), F.col("to").alias("then"))
        held = pointed(held.join(later, ["id", "tag", "p"]), ["to", "then"])
        width += step
    return held.filter("place > to").select("id", "tag", F.col("p").alias("a"), (F.col("p") + match).alias("b"))


METHODS = {"winnowing": repeats, "pointers": pointer_repeats}


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False,
                     method: str = "winnowing") -> DataFrame:
    """``_row`` (the input row, without the text), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``,
    ``spans`` (removed runs as array<struct<a, b>>) and, if wanted, ``kept`` (the remaining bytes)."""
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    row = packed(docs.select(*[quoted(c) for c in rest])) if rest else F.struct(F.lit(1).alias("_")).alias("_row")
    ident = F.coalesce(quoted(id_col).cast("long"), F.lit(NULL_ID))
    ids = docs.select(ident.alias("id"))
    twice = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count() > 0
    # ids are unique as a rule; where one repeats, rows are told apart by their text
    tag = F.hash(quoted(text_col)) if twice else F.lit(0)
    base = docs.select(row, ident.alias("id"), tag.alias("tag"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    with finished_shuffles_deleted(docs.sparkSession):
        ranges = METHODS[method](base.select("id", "tag", "text"))
    # a range is one number, a in the upper half: Python gets an integer array, not an object per range
    gone = (ranges.groupBy("id", "tag")
            .agg(F.collect_list(F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("ranges")))
    joined = base.join(gone, ["id", "tag"], "left")
    kind = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<a:int,b:int>>" + (
        ", kept binary" if with_kept else "")

    @F.pandas_udf(_struct(kind))
    def run(text: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        out = []
        for t, rs in zip(text, ranges):
            raw = t.encode("utf-8")
            kept, spans = raw, []
            if rs is not None and len(rs):
                ab = np.sort(np.asarray(rs, dtype=np.int64))
                starts, reach = ab >> 32, np.maximum.accumulate(ab & 0xFFFFFFFF)
                new = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
                a, b = starts[new], reach[np.concatenate((new[1:], [len(ab)])) - 1]
                spans = list(zip(a.tolist(), b.tolist()))
                keep = [raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)])]
                kept = b"".join(keep)
            out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                        [{"a": x, "b": y} for x, y in spans]) + ((kept,) if with_kept else ()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_kept)

    return joined.select("_row", run("text", "ranges").alias("o")).select("_row", "o.*")


def _struct(fields: str) -> str:
    return "struct<" + ",".join(f.replace(" ", ":", 1) for f in fields.split(", ")) + ">"
