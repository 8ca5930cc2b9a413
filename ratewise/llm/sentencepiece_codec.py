"""SentencePiece encoding and decoding by suffix-array matching.

Encoding a batch of texts:
  1. white space becomes U+2581 and a dummy prefix is added (the model's identity normaliser), and
     texts are cut before each run of U+2581, where no piece crosses; distinct chunks not met
     before are concatenated;
  2. a suffix array of that concatenation (prefix doubling, to the length of the longest piece)
     is built, and every piece is binary-searched for its range of occurrences;
  3. the resulting edges (start, end, piece) are sorted by position and relaxed from left to
     right, for all chunks at once.
The model at hand merges pairs by rank, so an edge's cost is not a sum of scores: the edge into a
position is accepted if merging its piece with the piece before it gives just those two pieces
back.  A prefix has one encoding, so exactly one edge per position is accepted, and the path is
the encoding.  Characters without a piece become byte pieces.

Decoding concatenates the pieces' bytes, turns U+2581 to spaces and drops the dummy prefix.

The tokenizer file is a parameter; the library reads its vocabulary and scores, nothing else.

Cases: null and empty texts have no pieces and decode to ``""``; U+2581 in a text decodes as a
space (as in any tokenizer of this kind); very long texts are taken in groups by length, and a
chunk without white space is cut between characters that no piece joins; other rows do not
influence a row's result.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import packed, quoted, small_batches

SPACE = "▁"
CACHE_CHUNKS = 400_000        # distinct chunks a worker remembers
GROUP_CHARS = 1_000_000       # text handled together
INDEX_CHARS = 200_000         # characters of distinct chunks in one suffix array
MEMO_PAIRS = 4_000_000        # pairs of pieces a worker remembers
PAIR = 1 << 32                # two tokens in one integer
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.pieces = [m.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: m.get_score(i) for i in plain}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if m.is_byte(i)}
        self.size = n
        self.decoded = [b""] * n
        for p, i in self.ids.items():
            self.decoded[i] = p.replace(SPACE, " ").encode("utf-8")
        for b, i in self.byte_ids.items():
            self.decoded[i] = bytes([b])
        self.longest = max(map(len, self.ids))
        # adjacent characters that occur together in some piece
        self.joined = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.by_start = sorted(self.ids)      # any order; matched all at once
        self.piece_ids = np.array([self.ids[p] for p in self.by_start], dtype=np.int64)
        self.piece_len = np.array([len(p) for p in self.by_start], dtype=np.int64)
        self.piece_code = np.full((len(self.by_start), self.longest), -1, dtype=np.int64)
        for k, p in enumerate(self.by_start):
            self.piece_code[k, :len(p)] = [ord(c) for c in p]
        self.pair_keys = np.array([-1], dtype=np.int64)
        self.pair_fits = np.zeros(1, dtype=bool)
        self.fresh: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merging by best score, leftmost first, from single characters."""
        s, score, none = list(text), self.score, float("-inf")
        pairs = [score.get(a + b, none) for a, b in zip(s, s[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            i = pairs.index(best)
            s[i:i + 2] = [s[i] + s[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score.get(s[i - 1] + s[i], none)
            if i < len(pairs):
                pairs[i] = score.get(s[i] + s[i + 1], none)
        return s

    def name(self, token: int) -> str:
        """A piece, or the character of a token beyond the vocabulary."""
        return self.pieces[token] if token < self.size else chr(token - self.size)

    def fits(self, keys: np.ndarray) -> np.ndarray:
        """For sorted pairs ``left * PAIR + right``: whether the two side by side stay as they are.

        What is known is a sorted table, new pairs wait in a dict until there are enough."""
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        out = self.pair_fits[at]
        unseen = np.flatnonzero(self.pair_keys[at] != keys)
        fresh = self.fresh
        for i, k in zip(unseen.tolist(), keys[unseen].tolist()):
            got = fresh.get(k)
            if got is None:
                left, right = self.name(k // PAIR), self.name(k % PAIR)
                got = fresh[k] = left[-1] + right[0] not in self.joined or self.merged(left + right) == [left, right]
            out[i] = got
        if len(fresh) > MEMO_PAIRS // 16:
            if len(self.pair_keys) > MEMO_PAIRS:
                self.pair_keys, self.pair_fits = self.pair_keys[:1], self.pair_fits[:1]
            keys = np.concatenate((self.pair_keys, np.fromiter(fresh.keys(), np.int64, len(fresh))))
            order = np.argsort(keys)
            self.pair_keys = keys[order]
            self.pair_fits = np.concatenate((self.pair_fits, np.fromiter(fresh.values(), bool, len(fresh))))[order]
            fresh.clear()
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` codes."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    span, bits = 1, max(1, int(rank.max()).bit_length())
    if bits <= 15:      # four characters at once
        key = np.zeros(n + 3, dtype=np.int64)
        key[:n] = rank
        key = (((key[:n] << bits | key[1:n + 1]) << bits | key[2:n + 2]) << bits) | key[3:n + 3]
        span = 4
    else:
        key = rank
    order = np.argsort(key)
    while True:
        k = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate(([1], (k[1:] != k[:-1]).astype(np.int64))))
        if span >= depth or new[order[-1]] == n:
            return order
        later = np.zeros(n, dtype=np.int64)
        later[:n - span] = new[span:] if span < n else 0
        key = new * (n + 1) + later
        order = np.argsort(key)
        span *= 2


def occurrences(codes: np.ndarray, sa: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Suffix-array range [low, high) of every piece, all pieces searched side by side."""
    n, p = len(codes), len(v.piece_len)
    padded = np.concatenate((codes.astype(np.int64), np.full(v.longest, -2, dtype=np.int64)))
    out = []
    for upper in (False, True):
        lo, hi = np.zeros(p, dtype=np.int64), np.full(p, n, dtype=np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            at = sa[mid]
            sign = np.zeros(len(open_), dtype=np.int8)     # suffix against piece, up to its length
            todo = np.arange(len(open_))
            for c in range(v.longest):
                want = v.piece_code[open_[todo], c]
                have = padded[np.minimum(at[todo] + c, n + v.longest - 1)]
                inside = want >= 0
                differs = inside & (want != have)
                sign[todo[differs]] = np.where(have[differs] > want[differs], 1, -1)
                todo = todo[inside & ~differs]
                if not len(todo):
                    break
            right = sign < 0 if not upper else sign <= 0
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
        out.append(lo)
    return out[0], out[1]


def _segments(chunk: str, v: Vocabulary) -> list[str]:
    """A long chunk cut between characters that no piece joins."""
    out, start = [], 0
    for i in range(1, len(chunk)):
        if chunk[i - 1:i + 1] not in v.joined:
            out.append(chunk[start:i])
            start = i
    out.append(chunk[start:])
    return out


def encode_chunks(chunks: list[str], v: Vocabulary) -> list[bytes]:
    """Little-endian int32 ids of each chunk."""
    text = "\x00".join(chunks) + "\x00"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    size = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
    first = np.cumsum(size + 1) - size - 1
    ends_of = first + size                               # position after the last character
    chunk_of = np.repeat(np.arange(len(chunks)), size + 1)
    codes[ends_of] = -3                                  # separators match nothing
    sa = suffix_array(codes, v.longest)
    low, high = occurrences(codes, sa, v)
    # the edges: every occurrence of every piece, and single characters without a piece
    n_occ = high - low
    place = np.arange(n_occ.sum()) + np.repeat(low - np.cumsum(n_occ) + n_occ, n_occ)
    start = sa.astype(np.int32)[place]
    length, token = np.repeat(v.piece_len.astype(np.int32), n_occ), np.repeat(v.piece_ids.astype(np.int32), n_occ)
    has_char = np.zeros(len(codes), dtype=bool)
    has_char[start[length == 1]] = True
    has_char[ends_of] = True
    bare = np.flatnonzero(~has_char).astype(np.int32)
    start = np.concatenate((start, bare))
    length = np.concatenate((length, np.ones(len(bare), dtype=np.int32)))
    token = np.concatenate((token, (v.size + codes[bare]).astype(np.int32)))
    end = start + length
    # relax in order of the end's offset in its chunk, all chunks side by side
    step = end - first.astype(np.int32)[chunk_of][start]
    order = np.argsort(step.astype(np.uint16) if step.max(initial=0) < 65536 else step, kind="stable")
    start, end, token, step = start[order], end[order], token[order], step[order]
    bounds = np.searchsorted(step, np.arange(1, int(step.max()) + 2)) if len(step) else np.zeros(1, dtype=np.int64)
    into = np.full(len(codes) + 1, -1, dtype=np.int32)   # piece that ends at a position
    back = np.full(len(codes) + 1, -1, dtype=np.int32)
    is_first = np.zeros(len(codes) + 1, dtype=bool)
    is_first[first] = True
    for a, b in zip(bounds[:-1], bounds[1:]):
        if a == b:
            continue
        s, t = start[a:b], token[a:b]
        before = into[s]
        ok = is_first[s].copy()
        test = np.flatnonzero(~ok & (before >= 0))
        if len(test):
            key, inverse = np.unique(before[test].astype(np.int64) * PAIR + t[test], return_inverse=True)
            ok[test] = v.fits(key)[inverse]
        e = end[a:b][ok]
        into[e] = t[ok]
        back[e] = s[ok]
    # walk back from every chunk's end, all chunks side by side
    at, trail = ends_of.copy(), []
    live = np.arange(len(chunks))
    while len(live):
        trail.append((live, into[at[live]]))
        at[live] = back[at[live]]
        live = live[at[live] > first[live]]
    who = np.concatenate([x[0] for x in trail]) if trail else np.zeros(0, dtype=np.int64)
    what = np.concatenate([x[1] for x in trail]) if trail else np.zeros(0, dtype=np.int64)
    order = np.lexsort((-np.arange(len(who)), who))
    who, what = who[order], what[order]
    at = np.searchsorted(who, np.arange(len(chunks) + 1))
    rare = what >= v.size
    ids32 = what.astype("<i4")
    if not rare.any():
        raw = ids32.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if rare[a:b].any():
            ids: list[int] = []
            for t in what[a:b].tolist():
                ids += [t] if t < v.size else [v.byte_ids[x] for x in chr(t - v.size).encode("utf-8", "replace")]
            out.append(np.array(ids, dtype="<i4").tobytes())
        else:
            out.append(ids32[a:b].tobytes())
    return out


class Codec:
    """Encoder and decoder of one worker, with its memory of chunks."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, chunks: set[str]) -> None:
        """Have all of ``chunks`` in ``known``; what two turns did not use is forgotten."""
        if len(self.known) + len(chunks) > CACHE_CHUNKS // 2:
            self.old, self.known = self.known, {}
        new = []
        for c in chunks:
            if c not in self.known:
                ids = self.old.get(c)
                if ids is None:
                    new.append(c)
                else:
                    self.known[c] = ids
        group, size = [], 0
        for c in new:
            group.append(c)
            size += len(c) + 1
            if size >= INDEX_CHARS:
                self.known.update(zip(group, encode_chunks(group, self.v)))
                group, size = [], 0
        if group:
            self.known.update(zip(group, encode_chunks(group, self.v)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian int32 bytes."""
        cut = []
        for t in texts:
            chunks = _CHUNK.findall(SPACE + t.replace(" ", SPACE)) if t else []
            if chunks and max(map(len, chunks)) > 64:
                chunks = [s for c in chunks for s in (_segments(c, self.v) if len(c) > 64 else (c,))]
            cut.append(chunks)
        self._learn(set().union(*cut))
        get = self.known.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, ids: bytes) -> str:
        table = self.v.decoded
        text = b"".join([table[i] for i in np.frombuffer(ids, dtype="<i4").tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def groups(texts, limit: int = GROUP_CHARS):
    """Consecutive texts, together up to ``limit`` characters (one text at least)."""
    group, size = [], 0
    for t in texts:
        n = len(t) if t else 0
        if group and size + n > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += n
    if group:
        yield group


def encoded(docs: DataFrame, path: str | None = None, text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs``' columns (as struct ``_row`` without the text, plus) ``ids`` array<int> (left out
    if not wanted), ``n_pieces`` long, ``ids_sha256`` (of the little-endian int32 ids),
    ``decoded_sha256`` and ``round_trip`` (the decoded text is the input)."""
    path = path or default_model()
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(packed(docs.select(*[quoted(c) for c in rest])) if rest else F.struct(F.lit(1).alias("_")).alias("_row"),
                       quoted(text_col).alias("_text"))
    kind = ("ids array<int>, " if with_ids else "") + "n_pieces long, ids_sha256 string, decoded_sha256 string, round_trip boolean"

    @F.pandas_udf(f"struct<{kind.replace(' ', ':').replace(',:', ',')}>")
    def run(s: pd.Series) -> pd.DataFrame:
        c = codec(path)
        cols: dict = {"ids": [], "n_pieces": [], "ids_sha256": [], "decoded_sha256": [], "round_trip": []}
        for group in groups(s):
            for t, ids in zip(group, c.encode(group)):
                back = c.decode(ids)
                cols["n_pieces"].append(len(ids) // 4)
                cols["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                cols["decoded_sha256"].append(hashlib.sha256(back.encode("utf-8")).hexdigest())
                cols["round_trip"].append(back == (t or ""))
                if with_ids:
                    cols["ids"].append(np.frombuffer(ids, dtype="<i4"))
        if not with_ids:
            cols.pop("ids")
        return pd.DataFrame(cols)

    return rows.select("_row", run("_text").alias("_o")).select("_row", "_o.*")
