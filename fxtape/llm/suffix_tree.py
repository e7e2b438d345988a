"""Language-model scores from a probabilistic suffix tree over bytes, beside a word unigram base.

Training counts every byte with the six before it. A context of three to six bytes is a state of the
tree when coding its next bytes by its own distribution instead of its suffix's saves THRESHOLD bits
or more, or when a longer state ends in it; the few shorter contexts are all states. A state's
distribution is smoothed with its suffix's by Kneser-Ney discounts, down to the uniform distribution. A
byte is scored by the longest state that the text before it ends in.

Texts are dealt in chunks. A chunk asks once for each of its windows and words, with its own training
counts beside them. Contexts that end in the same ENDING bytes lie in one slice, which holds all that
smoothing and pruning them needs: a slice sums the counts of all chunks, builds its branches of the
tree and answers the chunks. Neither the tree nor the words ever stand in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape.llm.texts import Words, sliced, strings
from fxtape.shared import published

DEPTH = 6
ENDING = 3  # last bytes of a context that name its slice
THRESHOLD = 1.0  # bits
CHUNK_BYTES = 1 << 24  # text of one chunk; one longer text is a chunk of its own
MOST_SLICES = 4096
MERGED_CHUNKS = 64  # chunks a slice meets in one task; more of them share the work of a slice
END = np.uint64(0x5BD1E995)  # the end token among word hashes
SPREAD = np.uint64(2_654_435_761)
BOUND = b"\xff"  # before and after a text; no byte of UTF-8
WORD, BYTES = 0, 1
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def learned(keys: list, parts: int, held: int) -> np.ndarray:
    """Which rows are learned from: crc32 of the key's text, modulo ``parts``, is not ``held``."""
    text = ["" if k is None else str(k) for k in keys]
    return np.array([zlib.crc32(t.encode()) % parts != held for t in text], bool)


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(DEPTH context bytes and the next one in a long, text index) for every byte and every end."""
    raw = [t.encode().translate(LOWER) for t in texts]
    joined = np.frombuffer(b"".join(BOUND * DEPTH + r for r in raw) + BOUND * DEPTH, np.uint8)
    size = np.array([len(r) for r in raw], np.int64)
    codes = np.zeros(len(joined) - DEPTH, np.uint64)
    for i in range(DEPTH + 1):
        codes = codes << np.uint64(8) | joined[i : len(joined) - DEPTH + i]
    # A text's symbols are its bytes and the first bound after it; the other bounds predict nothing.
    ends = np.cumsum(size + DEPTH) - DEPTH
    own = np.ones(len(codes), bool)
    for i in range(1, DEPTH):
        own[ends + i] = False
    return codes[own], np.repeat(np.arange(len(raw), dtype=np.int32), size + 1)


def low(codes: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes."""
    return codes & np.uint64((1 << 8 * n) - 1)


def turned(codes: np.ndarray) -> np.ndarray:
    """Windows with the ENDING bytes of the context before its other half; the same again turns back."""
    half = 8 * ENDING
    return low(codes >> np.uint64(8), ENDING) << np.uint64(half + 8) | codes >> np.uint64(half + 8) << np.uint64(8) | low(codes, 1)


def packed(a: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on, compressed."""
    return zstandard.compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 1)


def unpacked(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(size, -1).T.tobytes(), kind)


def packed_keys(k: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    return packed(np.diff(k, prepend=np.uint64(0)))


def unpacked_keys(rows: pa.Table) -> list[np.ndarray]:
    return [np.cumsum(unpacked(b, np.uint64), dtype=np.uint64) for b in rows["keys"].to_pylist()]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    k, n = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(n[order], first) if len(k) else n


def slice_of(kind: int, keys: np.ndarray, slices: int) -> np.ndarray:
    """The slice of words, or of turned windows."""
    name = keys if kind == WORD else (keys >> np.uint64(8 * (ENDING + 1))) * SPREAD >> np.uint64(16)
    return (name % np.uint64(slices)).astype(np.uint16)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of the words of the texts and of their ends."""
    found = Words(texts)
    every = np.arange(len(texts), dtype=np.int32)
    return np.append(found.hash, np.full(len(texts), END)), np.append(np.repeat(every, found.last - found.first), every)


SYMBOLS = {WORD: tokens, BYTES: windows}


def chunked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows in chunks of about CHUNK_BYTES, named by the task that reads them: (chunk, ids, sizes,
    body), where body holds the texts of some ids, compressed, and sizes their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in sliced(batches, "text"):
            raw = [t.encode() for t in strings(batch, "text")]
            body = b"".join(raw)
            if size and size + len(body) > CHUNK_BYTES:
                chunk, size = chunk + 1, 0
            size += len(body)
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([chunk], pa.int64()), "ids": pa.array([batch.column("key").to_pylist()], pa.list_(pa.int64())),
                "sizes": pa.array([[len(r) for r in raw]], pa.list_(pa.int64())),
                "body": pa.array([zstandard.compress(body, 3)], pa.binary()),
            })

    own = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return published(own.mapInArrow(run, "chunk long, ids array<bigint>, sizes array<bigint>, body binary"), "chunks")


def opened(rows: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, list, list[str]]]:
    """(chunk, ids, texts) of rows of chunks."""
    for i in range(rows.num_rows):
        chunk, ids, sizes, body = (rows.column(c)[i].as_py() for c in ("chunk", "ids", "sizes", "body"))
        raw, last = zstandard.decompress(body), np.cumsum(sizes).tolist()
        yield chunk, ids, [raw[z - n : z].decode() for n, z in zip(sizes, last, strict=True)]


def asked(rows: DataFrame, slices: int, parts: int, held: int) -> DataFrame:
    """(kind, slice, chunk, keys, counts): a chunk's distinct words and windows, sorted by slice, with
    their counts in its training texts, which may be 0."""

    def given(chunk: int, found: dict) -> Iterator[pa.RecordBatch]:
        for kind, (keys, counts) in found.items():
            k, n = summed(keys, counts)
            name = slice_of(kind, k, slices)
            order = np.argsort(name, kind="stable")
            k, n, used = k[order], n[order], np.bincount(name, minlength=slices)
            last = np.cumsum(used)
            some = np.flatnonzero(used).tolist()
            cuts = [slice(last[s] - used[s], last[s]) for s in some]
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([kind] * len(some), pa.int32()), "slice": pa.array(some, pa.int32()),
                "chunk": pa.array([chunk] * len(some), pa.int64()),
                "keys": pa.array([packed_keys(k[c]) for c in cuts], pa.binary()),
                "counts": pa.array([packed(n[c]) for c in cuts], pa.binary()),
            })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, found = None, {}
        for batch in batches:
            for chunk, ids, texts in opened(batch):
                if chunk != open_:
                    if found:
                        yield from given(open_, found)
                    open_, found = chunk, {WORD: ([], []), BYTES: ([], [])}
                mine = learned(ids, parts, held)
                for kind, symbols in SYMBOLS.items():
                    codes, owner = symbols(texts)
                    codes = codes if kind == WORD else turned(codes)
                    own = mine[owner]
                    k, n = np.unique(codes[own], return_counts=True)
                    other = np.unique(codes[~own])
                    found[kind][0].extend([k, other])
                    found[kind][1].extend([n, np.zeros(len(other), np.int64)])
        if found:
            yield from given(open_, found)

    return rows.mapInArrow(run, "kind int, slice int, chunk long, keys binary, counts binary")


def shorter(keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The entries of contexts of ``depth`` bytes, each with the number of different bytes before it."""
    return np.unique(low(keys, depth + 1), return_counts=True)


def entries(keys: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A slice's entries (context and next byte, count) by the depth of the context, down to ENDING."""
    out = {DEPTH: (keys, counts)}
    for d in range(DEPTH - 1, ENDING - 1, -1):
        out[d] = shorter(out[d + 1][0], d)
    return out


def merged(group: tuple, rows: pa.Table) -> pa.Table:
    """The training counts of some chunks in one; of windows also the numbers of entries that occur one
    to four times at each depth, of words their total."""
    kind = rows["kind"][0].as_py()
    k, n = summed(unpacked_keys(rows), [unpacked(b, np.int64) for b in rows["counts"].to_pylist()])
    k, n = k[n > 0], n[n > 0]
    if kind == WORD:
        numbers, top = [int(n.sum()), len(k)], np.zeros(0, np.int64)
    else:
        own = entries(turned(k), n)
        numbers = [int((own[d][1] == i).sum()) for d in range(ENDING, DEPTH + 1) for i in range(1, 5)]
        top = np.concatenate(shorter(own[ENDING][0], ENDING - 1)).astype(np.int64)
    return pa.table({
        "kind": pa.array([kind], pa.int32()), "slice": pa.array([rows["slice"][0].as_py()], pa.int32()),
        "keys": pa.array([packed_keys(k)], pa.binary()), "counts": pa.array([packed(n)], pa.binary()),
        "numbers": pa.array([numbers], pa.list_(pa.int64())), "top": pa.array([packed(top)], pa.binary()),
    })


MERGED = "kind int, slice int, keys binary, counts binary, numbers array<bigint>, top binary"


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What is taken from counts of one, two and more, from the numbers of counts of one to four."""
    y = n1 / max(1, n1 + 2 * n2)
    found = [1 - 2 * y * n2 / max(1, n1), 2 - 3 * y * n3 / max(1, n2), 3 - 4 * y * n4 / max(1, n3)]
    return [min(max(x, 0.05), i - 0.1) for i, x in enumerate(found, 1)]


class Level:
    """The states of one depth: their next bytes' probabilities and the weight handed to the suffix."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, less: list[float], below: Level | None):
        self.keys = keys
        state = keys >> np.uint64(8)
        first = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.states = state[first]
        self.of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        taken = np.array(less)[np.minimum(counts, 3) - 1]
        total, free = (np.bincount(self.of, weights=x, minlength=len(first)) for x in (counts, taken))
        if below is None:
            q = np.full(len(keys), 1 / 256)
        else:  # the suffix has every next byte that a state has
            q = below.p[np.searchsorted(below.keys, low(keys, below.depth + 1))]
        self.depth = 0 if below is None else below.depth + 1
        self.p = (counts - taken + free[self.of] * q) / total[self.of]
        self.weight = np.log10(free / total)
        self.saved = np.bincount(self.of, weights=counts * np.log2(self.p / q), minlength=len(first))
        self.kept = np.ones(len(first), bool)

    def prune(self, longer: Level | None, threshold: float) -> None:
        """Keep the states that save ``threshold`` bits, and the suffixes of kept longer ones."""
        self.kept = self.saved >= threshold
        if longer is not None:
            used = low(longer.states[longer.kept], self.depth)
            self.kept |= np.isin(self.states, used)

    def look(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For windows: whether the context is a state, whether it has the byte, and the log10
        probability of the byte or else of what the state hands on."""
        if not len(self.keys):
            return np.zeros(len(codes), bool), np.zeros(len(codes), bool), np.zeros(len(codes))
        state, entry = low(codes >> np.uint64(8), self.depth), low(codes, self.depth + 1)
        s = np.minimum(np.searchsorted(self.states, state), len(self.states) - 1)
        e = np.minimum(np.searchsorted(self.keys, entry), len(self.keys) - 1)
        is_state = (self.states[s] == state) & self.kept[s]
        seen = is_state & (self.keys[e] == entry)
        return is_state, seen, np.where(seen, np.log10(self.p[e]), self.weight[s])


def trunk(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """The levels below ENDING, of which there are at most 256 ** ENDING entries, shortest first."""
    every = [(keys, counts)]
    for d in range(ENDING - 2, -1, -1):
        every.insert(0, shorter(every[0][0], d))
    out: list[Level] = []
    for k, n in every:
        out.append(Level(k, n, discounts(*[int((n == i).sum()) for i in range(1, 5)]), out[-1] if out else None))
    return out


def branches(keys: np.ndarray, counts: np.ndarray, less: list[list[float]], low_levels: list[Level], threshold: float) -> list[Level]:
    """All levels for one slice, pruned from the longest contexts down to ENDING."""
    own, out = entries(keys, counts), list(low_levels)
    for d in range(ENDING, DEPTH + 1):
        out.append(Level(*own[d], less[d - ENDING], out[-1]))
    for d in range(DEPTH, ENDING - 1, -1):
        out[d].prune(out[d + 1] if d < DEPTH else None, threshold)
    return out


def scores(levels: list[Level], codes: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each window, given the others."""
    out, open_ = np.zeros(len(codes)), np.arange(len(codes))
    for level in reversed(levels):
        is_state, seen, value = level.look(codes[open_])
        out[open_[is_state]] += value[is_state]
        open_ = open_[~seen]
    out[open_] += np.log10(1 / 256)
    return out


def found_at(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The places of codes in sorted keys that have them all. Each distinct code is looked up once and in
    order, as look-ups at random in keys beyond the processor's cache cost several times that."""
    some, which = np.unique(codes, return_inverse=True)
    return np.searchsorted(keys, some)[which]


def rounded(values: np.ndarray) -> np.ndarray:
    """Floats of 16 significant bits, a relative error below 0.00001; their last byte is empty and packs to nothing."""
    bits = values.astype(np.float32).view(np.uint32)
    return (bits + np.uint32(128) & np.uint32(0xFFFFFF00)).view(np.float32)


def scored(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    parts: int = 7,
    held: int = 2,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are words (runs without white space, A-Z lower-cased) and one end. ``base_score`` sums
    log10((c + 1) / (N + V + 1)) over them, with the training count c of each; ``score`` is the tree's
    log10 probability of the lower-cased text and its end, added up from bytes with 16 significant bits each. Rows with crc32(key as text) modulo ``parts``
    equal to ``held`` are scored only; a null key counts as an empty text there.

    Chunks, questions and answers go in compressed columns. A frequent word or context reaches its slice as one entry a chunk; a slice that many chunks ask is
    summed and answers by groups of MERGED_CHUNKS of them. What is broadcast are the entries of contexts
    below ENDING bytes, 256 ** ENDING at most. Null and empty texts have the end alone; repeated rows are counted
    and scored each; with no training row the tree is uniform; an empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    rows = chunked(docs, key, text)
    chunks = rows.agg(F.count_distinct("chunk")).first()[0]
    slices, salts = min(MOST_SLICES, max(1, chunks)), max(1, -(-chunks // MERGED_CHUNKS))
    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int").alias("salt")
    asks = published(asked(rows, slices, parts, held).select("*", salt), "asked")
    partial = asks.drop("chunk").groupBy("kind", "slice", "salt").applyInArrow(merged, MERGED)
    counted = published(partial.groupBy("kind", "slice").applyInArrow(merged, MERGED), "counted")

    def sums(kind: int, n: int) -> list[int]:
        some = counted.where(F.col("kind") == kind)
        return list(some.agg(*[F.coalesce(F.sum(F.col("numbers")[i]), F.lit(0)) for i in range(n)]).first())

    total, kinds = sums(WORD, 2)
    times = sums(BYTES, 4 * (DEPTH - ENDING + 1))
    less = [discounts(*times[i : i + 4]) for i in range(0, len(times), 4)]

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column("top").to_pylist():
                k, n = unpacked(b, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_pydict({"k": k, "n": n})

    short = counted.where(F.col("kind") == BYTES).select("top").mapInArrow(tops, "k long, n long")
    short = short.groupBy("k").agg(F.sum("n").alias("n")).orderBy("k").toArrow()  # 256 ** ENDING rows at most
    low_levels = spark.sparkContext.broadcast(trunk(short["k"].to_numpy().astype(np.uint64), short["n"].to_numpy()))

    def answered(group: tuple, asks_of: pa.Table, own: pa.Table) -> pa.Table:
        k = unpacked_keys(asks_of)
        kind = (asks_of if len(k) else own)["kind"][0].as_py()
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if own.num_rows:
            keys, counts = unpacked_keys(own)[0], unpacked(own["counts"][0].as_py(), np.int64)
        if kind == BYTES:
            order = np.argsort(turned(keys))
            levels = branches(turned(keys)[order], counts[order], less, low_levels.value, threshold)
            values = [packed(rounded(scores(levels, turned(c)))) for c in k]
        else:
            values = []
            for c in k:
                at = np.searchsorted(keys, c)
                hit = np.append(keys, np.uint64(0))[at] == c
                hit &= at < len(keys)
                values.append(packed(np.where(hit, np.append(counts, 0)[at], 0)))
        return pa.table({
            "chunk": asks_of["chunk"], "kind": asks_of["kind"], "keys": asks_of["keys"], "values": pa.array(values, pa.binary()),
        })

    every = counted.select("kind", "slice", "keys", "counts", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    names = ("kind", "slice", "salt")
    answers = asks.drop("counts").groupBy(*names).cogroup(every.groupBy(*names)).applyInArrow(
        answered, "chunk long, kind int, keys binary, values binary"
    )
    space = total + kinds + 1

    def told(group: tuple, own: pa.Table, answers_of: pa.Table) -> pa.Table:
        known, table = answers_of["kind"].to_numpy(), {}
        for kind, form in ((WORD, np.int64), (BYTES, np.float32)):
            mine = answers_of.filter(pa.array(known == kind))
            k = np.concatenate(unpacked_keys(mine))
            v = np.concatenate([unpacked(b, form) for b in mine["values"].to_pylist()])
            order = np.argsort(k)
            table[kind] = k[order], v[order]
        out = []
        for _, ids, texts in opened(own):
            n = len(ids)
            found = {}
            for kind, symbols in SYMBOLS.items():
                codes, owner = symbols(texts)
                codes = codes if kind == WORD else turned(codes)
                k, v = table[kind]
                found[kind] = owner, v[found_at(k, codes)].astype(np.float64)
            (word, times_of), (byte, value) = found[WORD], found[BYTES]
            out.append(pa.RecordBatch.from_pydict({
                "key": pa.array(ids, pa.int64()), "held_out": pa.array(~learned(ids, parts, held)),
                "n_tokens": np.bincount(word, minlength=n), "n_known": np.bincount(word[times_of > 0], minlength=n),
                "train_tokens": np.full(n, total, np.int64),
                "base_score": np.bincount(word, weights=np.log10((times_of + 1) / space), minlength=n),
                "score": np.bincount(byte, weights=value, minlength=n),
            }))
        return pa.Table.from_batches(out)

    columns = "key long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(told, columns)
    return out.withColumnRenamed("key", key)
