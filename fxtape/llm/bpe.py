"""Byte-level BPE by rank: a segment tree over byte positions holds the leftmost lowest pair rank.

A leaf stands for the pair that begins at a live byte position. The root names the next merge; it
changes the merged pair's leaf, the leaf of the pair it swallows and that of the live neighbour on
the left, so a merge costs three updates of logarithmic length whatever the size of the piece.
Short pieces are merged side by side, a row of one numpy tree each; long ones walk a tree of their own.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape.llm.texts import PieceCache, sliced, strings

NONE = np.iinfo(np.int64).max
# Pieces up to this many bytes are merged side by side; rows handled at once.
SIDE_BY_SIDE = 64
ROWS = 16384


class Vocabulary:
    """Ranks of a rank file: lines of a base64 token and its rank, which is its id."""

    def __init__(self, ranks: bytes):
        pairs = [line.split() for line in ranks.splitlines() if line]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.byte = np.full(256, -1, np.int64)
        for b in range(256):
            self.byte[b] = self.rank[bytes([b])]
        self.base = max(self.rank.values()) + 1
        joined = [
            (self.rank[t[:i]] * self.base + self.rank[t[i:]], r)
            for t, r in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        ]
        self.merge = dict(joined)
        self.keys = np.array(sorted(self.merge), np.int64)
        self.values = np.array([self.merge[k] for k in self.keys.tolist()], np.int64)
        tokens = sorted((r, t) for t, r in self.rank.items())
        self.length = np.zeros(self.base, np.int64)
        self.length[[r for r, _ in tokens]] = [len(t) for _, t in tokens]
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where it is no token."""
        key = left * self.base + right
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.values[i], NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        ends = np.cumsum(n)
        if not len(ids):
            return b""
        return self.flat[np.repeat(self.begin[ids] - (ends - n), n) + np.arange(ends[-1])].tobytes()


def merged_rows(pieces: list[bytes], size: int, vocabulary: Vocabulary) -> list[np.ndarray]:
    """The ids of pieces of at most ``size`` bytes, a power of two."""
    rows = len(pieces)
    lengths = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8)
    token = vocabulary.byte[raw].reshape(rows, size)
    column = np.arange(size)
    live = column < lengths[:, None]
    # Position ``size`` is a fence: the next of the last live byte and the previous of the first.
    after = np.where(column + 1 < lengths[:, None], column + 1, size)
    before = np.tile(np.where(column > 0, column - 1, size), (rows, 1))

    def entry(rank: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return np.where(rank == NONE, NONE, rank * size + pos)

    tree = np.full((rows, 2 * size), NONE)
    has = after < size
    r, c = np.nonzero(has)
    tree[r, size + c] = entry(vocabulary.pair(token[r, c], token[r, c + 1]), c)
    for level in range(size // 2, 0, -1):
        if level & (level - 1) == 0:
            below = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])

    def update(row: np.ndarray, pos: np.ndarray, value: np.ndarray) -> None:
        node = pos + size
        tree[row, node] = value
        while size > 1 and node[0] > 1:  # all leaves have one depth
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    work = np.flatnonzero(tree[:, 1] != NONE)
    while len(work):
        top = tree[work, 1]
        i, rank = top % size, top // size
        j = after[work, i]
        k, h = after[work, j], before[work, i]
        token[work, i], after[work, i] = rank, k
        live[work, j] = False
        right = k < size
        before[work[right], k[right]] = i[right]
        update(work, j, np.full(len(work), NONE))
        fresh = np.full(len(work), NONE)
        fresh[right] = entry(vocabulary.pair(rank[right], token[work[right], k[right]]), i[right])
        update(work, i, fresh)
        left = h < size
        if left.any():
            w, at = work[left], h[left]
            update(w, at, entry(vocabulary.pair(token[w, at], rank[left]), at))
        work = work[tree[work, 1] != NONE]
    flat, ends = token[live].astype("<u4"), np.cumsum(live.sum(1))
    return np.split(flat, ends[:-1])


def merged_long(piece: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """The ids of one long piece, by the same tree in plain lists."""
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    none, merge, base = NONE, vocabulary.merge, vocabulary.base
    token = vocabulary.byte[np.frombuffer(piece, np.uint8)]
    ranks = np.full(2 * size, NONE)
    rank = vocabulary.pair(token[:-1], token[1:])
    ranks[size : size + n - 1] = np.where(rank == NONE, NONE, rank * size + np.arange(n - 1))
    for level in (1 << d for d in range(size.bit_length() - 2, -1, -1)):
        below = ranks[2 * level : 4 * level]
        ranks[level : 2 * level] = np.minimum(below[::2], below[1::2])
    tree, token = ranks.tolist(), token.tolist()
    after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def update(pos: int, left: int, right: int) -> None:
        found = merge.get(token[left] * base + token[right], none) if right < n else none
        put(pos, none if found == none else found * size + pos)

    def put(pos: int, value: int) -> None:
        node = pos + size
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            value = a if a < b else b
            if tree[node] == value:
                break
            tree[node] = value

    while tree[1] != none:
        rank, i = divmod(tree[1], size)
        j = after[i]
        k, h = after[j], before[i]
        token[i], after[i], live[j] = rank, k, False
        if k < n:
            before[k] = i
        put(j, none)
        update(i, i, k)
        if h >= 0:
            update(h, h, i)
    return np.array(token, "<u4")[np.array(live)]


def merged(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Little-endian 32-bit ids of each piece; a piece that is a token is that token."""
    out: list[bytes] = [b""] * len(pieces)
    sizes: dict[int, list[int]] = {}
    for at, piece in enumerate(pieces):
        rank = vocabulary.rank.get(piece)
        if rank is not None:
            out[at] = rank.to_bytes(4, "little")
        elif len(piece) > SIDE_BY_SIDE:
            out[at] = merged_long(piece, vocabulary).tobytes()
        elif piece:
            sizes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(at)
    for size, places in sizes.items():
        for begin in range(0, len(places), ROWS):
            some = places[begin : begin + ROWS]
            for at, ids in zip(some, merged_rows([pieces[a] for a in some], size, vocabulary), strict=True):
                out[at] = ids.tobytes()
    return out


class Codec:
    """Encoder and decoder of one vocabulary and split pattern, with its cache of pieces."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex

        self.vocabulary, self.split = Vocabulary(ranks), regex.compile(pattern)
        self.cache = PieceCache(self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        parts = [[m.encode() for m in self.split.findall(p)] for p in pieces]
        distinct = list({m for part in parts for m in part})
        ids = dict(zip(distinct, merged(distinct, self.vocabulary), strict=True))
        return [b"".join(ids[m] for m in part) for part in parts]


_CODECS: dict[tuple[int, str], Codec] = {}


def codec(ranks: bytes, pattern: str) -> Codec:
    """The codec of this worker, made once."""
    mark = (zlib.crc32(ranks), pattern)
    if mark not in _CODECS:
        _CODECS[mark] = Codec(ranks, pattern)
    return _CODECS[mark]


def encoded(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row; ``with_ids`` adds ids and bytes.

    ``ranks`` is a rank file on the driver; its bytes are broadcast (a vocabulary, below 1 MB for
    50,000 tokens, whatever the corpus). Each match of ``pattern`` is merged on its own. There is no
    shuffle; a lost executor costs its tasks. The digests are of ids as little-endian unsigned 32-bit
    integers and of the bytes the ids decode to. A null text is an empty one: no ids and the digests of
    no bytes. Rows that repeat give rows that repeat; the key may be null; other columns are left out.
    """
    with open(ranks, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<bigint>, decoded binary" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(content.value, pattern)
        for batch in sliced(batches, text):
            ids = own.cache.ids(strings(batch, text))
            arrays = [np.frombuffer(i, "<u4") for i in ids]
            back = [own.vocabulary.decode(a) for a in arrays]
            out = {
                key: batch.column(key).cast(pa.int64()),
                "n_tokens": pa.array([len(a) for a in arrays], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()),
            }
            if with_ids:
                out["ids"] = pa.array([a.astype(np.int64) for a in arrays], pa.list_(pa.int64()))
                out["decoded"] = pa.array(back, pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col(key), text).mapInArrow(run, schema)
