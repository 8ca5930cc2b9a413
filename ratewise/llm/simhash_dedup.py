"""SimHash near-dedup with pivot distance tables.

Fingerprint: 64-bit SimHash over word shingles (XXH64, seed 42): a bit is 1 if set in over half of
the shingles' hashes.  Fingerprints at Hamming distance <= ``max_bits`` are linked; documents get
the smallest ``doc_id`` of their connected component.

Method
  * Distances to many reference fingerprints (pivots) are precomputed, split over six blocks of
    the 64 bits: a pivot's distance is the sum of its block distances.
  * Two fingerprints at most 3 bits apart agree in at least three of the six blocks, so there
    all their block distances to all pivots are equal.  Rows are grouped on those distances for
    each of the 20 choices of three blocks; nothing within the limit is missed.
  * Inside a group, pairs whose distance to some pivot differs by more than ``max_bits`` are
    discarded (triangle inequality); survivors are verified on the fingerprints themselves.
  * A group larger than ``CELL`` is dealt to cells by chunk pairs, so that no task holds it
    whole, and a cell emits a spanning forest of its links, never all pairs.
Equal fingerprints are collapsed before any of this, so copies cost one row.

Cases: null, empty or white-space text has fingerprint zero and is linked like any other; fewer
words than the shingle give one shingle, the whole sequence; rows repeating a ``doc_id`` are
separate rows of one id; a null ``doc_id`` never is a component's id unless all are null; an
empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import packed, quoted, small_batches, unpacked
from ratewise.llm.components import components
from ratewise.sources.tables import cut_lineage

SHINGLE = 3
MAX_BITS = 3
N_PIVOTS = 16
CELL = 1024
#: Six blocks of the 64 bits as (first bit, bits).
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))


def pivots(n: int = N_PIVOTS, seed: int = 20) -> list[int]:
    return [int(x) for x in np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)]


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text; hashes are folded in pieces, so memory is bounded."""
    import xxhash

    # bytes.split() takes exactly the ASCII white space 0x20 and 0x09-0x0D, bytes.lower() only A-Z
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    h, total = xxhash.xxh64_intdigest, len(starts)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, total, 16384):
        s, e = starts[i:i + 16384].tolist(), ends[i:i + 16384].tolist()
        hashes = np.fromiter((h(joined[a:b], 42) for a, b in zip(s, e)), dtype="<u8", count=len(s))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text, shingle: int = SHINGLE):
    """Signed 64-bit fingerprint of a text column."""
    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    return run(text)


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def block_distances(fp, block: tuple[int, int], refs: list[int]):
    """The block's distances to all pivots, four bits each, in one long."""
    mask = ((1 << block[1]) - 1) << block[0]
    out = F.lit(0).cast("long")
    for j, p in enumerate(refs):
        d = F.bit_count(fp.bitwiseXOR(F.lit(_signed(p))).bitwiseAND(F.lit(_signed(mask)))).cast("long")
        out = out.bitwiseOR(F.shiftleft(d, 4 * j))
    return out


def _forest(fps: np.ndarray, refs: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among ``fps`` (uint64, distinct)."""
    n = len(fps)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    out = []
    for i in range(n - 1):
        near = np.abs(table[i + 1:, 0] - table[i, 0]) <= max_bits
        near = np.flatnonzero(near) + i + 1
        near = near[np.abs(table[near] - table[i]).max(axis=1, initial=0) <= max_bits]   # discard
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= max_bits]                    # verify
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                out.append((i, j))
    return out


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = N_PIVOTS, cell: int = CELL) -> DataFrame:
    """``fingerprints`` (one distinct long column ``fp``) -> links ``(a, b)`` that connect exactly
    the fingerprints connected by pairs at distance <= ``max_bits`` (at most 3)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("six blocks choose three cover at most 3 differing bits")
    refs = pivots(n_pivots)
    tabled = fingerprints.select("fp", *[block_distances(F.col("fp"), b, refs).alias(f"v{i}") for i, b in enumerate(BLOCKS)])
    tables = [F.struct(F.lit(t).alias("t"), F.xxhash64(*[F.col(f"v{i}") for i in trio]).alias("key"))
              for t, trio in enumerate(combinations(range(len(BLOCKS)), 3))]
    keyed = tabled.select("fp", F.explode(F.array(*tables)).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    members = keyed.join(sizes, ["t", "key"]).select(
        "t", "key", "fp", chunks.alias("chunks"), F.pmod(F.xxhash64("fp", F.lit(1)), chunks).cast("int").alias("c"))
    cells = (members.select("t", "key", "fp", "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o"))
             .groupBy("t", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))
             .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps"))

    def run(batches):
        r = np.array(refs, dtype=np.uint64)
        for pdf in batches:
            a, b = [], []
            for fps in pdf["fps"]:
                f = np.asarray(fps, dtype=np.int64)
                if len(f) == 2:
                    x = f.view(np.uint64)
                    if (np.abs(np.bitwise_count(x[0] ^ r).astype(np.int8) - np.bitwise_count(x[1] ^ r).astype(np.int8)).max() <= max_bits
                            and int(x[0] ^ x[1]).bit_count() <= max_bits):
                        a.append(f[0])
                        b.append(f[1])
                    continue
                for i, j in _forest(f.view(np.uint64), r, max_bits):
                    a.append(f[i])
                    b.append(f[j])
            yield pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return cells.mapInPandas(run, "a long, b long")


def grouped(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, th, fp, label, component_id)``, one row per input row: ``th`` a hash of the whole
    text, ``fp`` the signed fingerprint, ``label`` the component's smallest fingerprint."""
    small_batches(docs.sparkSession)
    text = quoted(text_col)
    fps = cut_lineage(docs.select(quoted(id_col).alias("doc_id"), F.xxhash64(text).alias("th"),
                                  fingerprint_column(text, shingle).alias("fp")))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    labels = components(links(classes.select("fp"), max_bits))
    of = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "low", F.coalesce("label", "fp").alias("label"))
    ids = of.groupBy("label").agg(F.min("low").alias("component_id"))
    return fps.join(of.join(ids, "label").select("fp", "label", "component_id"), "fp").select(
        "doc_id", "th", "fp", "label", "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per input row."""
    return grouped(docs, shingle, max_bits, id_col, text_col).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row per component: its smallest ``doc_id`` (of rows that repeat this
    id in the component, one with the smallest text hash).  Same columns as ``docs``."""
    found = grouped(docs, shingle, max_bits, id_col, text_col)
    stays = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("label", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("label", "doc_id").agg(F.min(F.struct("th", "n")).alias("s"))
             .select(F.col("doc_id").alias("_kid"), F.col("s.th").alias("_kth"), F.col("s.n").alias("_n")).distinct())
    rows = docs.select(packed(docs), quoted(id_col).alias("_id"), F.xxhash64(quoted(text_col)).alias("_th"))
    kept = rows.join(stays, rows["_id"].eqNullSafe(stays["_kid"]) & (rows["_th"] == stays["_kth"]))
    repeated = kept.filter("_n > 1").groupBy("_id", "_th").agg(F.first("_row").alias("_row"))
    out = kept.filter("_n = 1").select("_row").unionByName(repeated.select("_row"))
    return unpacked(out, docs.columns)
