"""Token ids in Simple-8b words: a selector of 4 bits and as many ids as fit in the other 60.

Ids come in blocks of BLOCK; every block begins at a word of its own, whose offset is stored, so that
blocks decode independently and all at once. An id of more than 60 bits is escaped: its word carries
selector 0 and the id follows, whole, after the block's last data word.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fxtape.llm.texts import LETTER_PIECES, PIECES, PieceCache, sliced, strings
from fxtape.shared import new_folder

BLOCK = 1024
CHUNK_IDS = 1 << 20
LINE = 16384  # pieces tokenized as one text
# Selectors 1..14 of a word: ids per word and bits per id.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 0
FILES = (
    "part long, chunk long, start long, doc_ids array<bigint>, n_tokens array<bigint>, "
    "offsets binary, escapes binary, words binary"
)


def packed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block, escapes of each block) of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint16)
    room = BLOCK + int(COUNTS.max())
    grid = np.zeros((blocks, room), np.uint64)
    full = len(ids) // BLOCK
    grid[:full, :BLOCK] = ids[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        grid[full, : len(ids) - full * BLOCK] = ids[full * BLOCK :]
    width = np.frexp(grid.astype(np.float32))[1].astype(np.uint8)  # rounding up costs a bit at most
    lengths = np.full(blocks, BLOCK)
    lengths[-1] = len(ids) - (blocks - 1) * BLOCK

    # The selector at each position: the largest count whose ids all fit.
    choice = np.zeros((blocks, BLOCK), np.uint8)
    reach = width.copy()
    span = 1
    for s in range(len(COUNTS) - 1, 0, -1):
        count = int(COUNTS[s])
        while span < count:
            step = min(span, count - span)
            reach[:, : room - step] = np.maximum(reach[:, : room - step], reach[:, step:])
            span += step
        choice[reach[:, :BLOCK] <= WIDTHS[s]] = s

    # All blocks walk from word to word together.
    at = np.zeros(blocks, np.int64)
    live = np.arange(blocks)
    taken = []
    while len(live):
        s = choice[live, at[live]]
        taken.append((live, at[live], s))
        at[live] += COUNTS[s]
        live = live[at[live] < lengths[live]]
    row = np.concatenate([t[0] for t in taken])
    pos = np.concatenate([t[1] for t in taken])
    sel = np.concatenate([t[2] for t in taken])
    order = np.argsort(row, kind="stable")
    row, pos, sel = row[order], pos[order], sel[order]

    data = np.bincount(row, minlength=blocks)
    escapes = np.bincount(row[sel == ESCAPE], minlength=blocks)
    offsets = np.concatenate([[0], np.cumsum(data + escapes)])
    words = np.zeros(int(offsets[-1]), np.uint64)
    first = np.concatenate([[0], np.cumsum(data)])
    slot = offsets[row] + np.arange(len(row)) - first[row]
    flat, at = grid.ravel(), row * room + pos
    for s in range(1, len(COUNTS)):
        mine = np.flatnonzero(sel == s)
        value, begin = np.full(len(mine), s << 60, np.uint64), at[mine]
        for k in range(int(COUNTS[s]) if len(mine) else 0):
            value |= flat[begin + k] << np.uint64(k * WIDTHS[s])
        words[slot[mine]] = value
    lone = np.flatnonzero(sel == ESCAPE)
    if len(lone):
        before = np.concatenate([[0], np.cumsum(escapes)])
        place = offsets[row[lone]] + data[row[lone]] + np.arange(len(lone)) - before[row[lone]]
        words[place] = grid[row[lone], pos[lone]]
    return words, offsets[:-1].astype(np.uint32), escapes.astype(np.uint16)


def unpacked(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of all blocks, decoded by selector and not word by word."""
    if not n:
        return np.zeros(0, np.uint64)
    ends = np.append(offsets[1:].astype(np.int64), len(words))
    block = np.repeat(np.arange(len(offsets)), ends - offsets)
    tail = np.arange(len(words)) >= (ends - escapes)[block]
    data, raw = np.flatnonzero(~tail), words[tail]
    block, coded = block[data], words[data]
    sel = (coded >> np.uint64(60)).astype(np.int64)
    count = COUNTS[sel]
    total = np.cumsum(count) - count
    first = np.searchsorted(block, np.arange(len(offsets)))
    room = BLOCK + int(COUNTS.max())  # a block's last word may be filled up with zeros
    start = total - total[first][block] + block * room
    ids = np.empty(len(offsets) * room, np.uint64)
    for s in range(1, len(COUNTS)):
        mine = np.flatnonzero(sel == s)
        value, place = coded[mine], start[mine]
        for k in range(int(COUNTS[s]) if len(mine) else 0):
            ids[place + k] = value >> np.uint64(k * WIDTHS[s]) & np.uint64((1 << int(WIDTHS[s])) - 1)
    ids[start[sel == ESCAPE]] = raw
    return np.ascontiguousarray(ids.reshape(-1, room)[:, :BLOCK]).ravel()[:n]


def gpt2_pattern(model: bytes) -> bool:
    """Whether a tokenizer cuts texts by GPT-2's pattern, and by nothing before it."""
    told = json.loads(model)
    cuts = told.get("pre_tokenizer") or {}
    return cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts.get("add_prefix_space") and not told.get("normalizer")


def tokenizer_pieces(model: bytes) -> PieceCache:
    """A cache over a tokenizer of the ``tokenizers`` library; special tokens are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(model.decode())
    tokenizer.encode_special_tokens = True

    # Visible pieces go through the tokenizer in long lines: a line break between two of them is
    # always a token of its own, and none of them holds one.
    cut = tokenizer.encode("\n", add_special_tokens=False).ids[0]

    def encode(pieces: list[str]) -> list[bytes]:
        known = {p: np.array(tokenizer.encode(p, add_special_tokens=False).ids, "<u4").tobytes()
                 for p in pieces if p.isspace()}
        shown = [p for p in pieces if p not in known]
        lines = [shown[i : i + LINE] for i in range(0, len(shown), LINE)]
        found = tokenizer.encode_batch_fast(["\n".join(x) for x in lines], add_special_tokens=False)
        for line, e in zip(lines, found, strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == cut), len(ids))
            begins, raw = np.append(0, ends[:-1] + 1), ids.tobytes()
            known.update(zip(line, [raw[a:b] for a, b in zip((4 * begins).tolist(), (4 * ends).tolist())], strict=True))
        return [known[p] for p in pieces]

    return PieceCache(encode, LETTER_PIECES if gpt2_pattern(model) else PIECES)


_CACHES: dict[int, PieceCache] = {}


def worker_pieces(model: bytes) -> PieceCache:
    """The cache of this Python worker, which outlives its tasks."""
    mark = zlib.crc32(model)
    if mark not in _CACHES:
        _CACHES[mark] = tokenizer_pieces(model)
    return _CACHES[mark]


def write(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every text, append ``end_id`` and write the ids below ``folder`` in key order.

    ``tokenizer`` is a file of the tokenizers library on the driver; its bytes are broadcast (a
    vocabulary, a few MB whatever the corpus). Texts are dealt by ranges of the key and sorted in
    each, so file ``part`` follows file ``part - 1`` in key order; null keys come first and rows with
    one key are ordered by text. A row of a file is a chunk of whole documents with CHUNK_IDS ids or one
    longer document: keys, lengths, block offsets and words. Null and empty texts have the end id only.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(model.value)
        part, tail = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        chunk, start, keys, held, size = 0, 0, [], [], 0

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            words, offsets, escapes = packed(ids)
            return pa.RecordBatch.from_pydict({
                "part": [part], "chunk": [chunk], "start": [start],
                "doc_ids": pa.array([keys], pa.list_(pa.int64())),
                "n_tokens": pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int64())),
                "offsets": [offsets.astype("<u4").tobytes()],
                "escapes": [escapes.astype("<u2").tobytes()],
                "words": [words.astype("<u8").tobytes()],
            })

        for batch in sliced(batches, text):
            for k, ids in zip(
                batch.column(key).to_pylist(), pieces.ids(strings(batch, text)), strict=True
            ):
                keys.append(k)
                held.append(ids + tail)
                size += len(ids) // 4 + 1
                if size >= CHUNK_IDS:
                    yield row()
                    chunk, start, keys, held, size = chunk + 1, start + size, [], [], 0
        if keys:
            yield row()

    ordered = docs.select(F.col(key).cast("long").alias(key), text).repartitionByRange(key)
    ordered.sortWithinPartitions(key, text).mapInArrow(encoded, FILES).write.parquet(folder)


def read(spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of the written documents, decoded from the files.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over the ids as little-endian
    unsigned 32-bit integers. ``with_ids`` adds the ids. Only one total per file reaches the driver.
    """
    files = spark.read.parquet(folder)
    sizes = files.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    totals = sorted(sizes.groupBy("part").agg(F.sum("n")).collect())
    bases, base = {}, 0
    for part, n in totals:
        bases[part], base = base, base + n
    schema = f"{key} long, start long, n_tokens long, ids_crc32 long"
    schema += ", ids array<bigint>" if with_ids else ""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["n_tokens"], np.int64)
                ids = unpacked(
                    np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4"),
                    np.frombuffer(row["escapes"], "<u2"), int(lengths.sum()),
                )
                ends = np.cumsum(lengths)
                begin = ends - lengths
                raw = ids.astype("<u4").tobytes()
                cuts = list(zip(begin.tolist(), ends.tolist(), strict=True))
                out = {
                    key: pa.array(row["doc_ids"], pa.int64()),
                    "start": bases[row["part"]] + row["start"] + begin,
                    "n_tokens": lengths,
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in cuts], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in cuts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    columns = files.select("part", "start", "doc_ids", "n_tokens", "offsets", "escapes", "words")
    return columns.mapInArrow(decoded, schema)


def round_trip(docs: DataFrame, tokenizer: str, **settings) -> DataFrame:
    """Write into a new folder of the shared storage and read back."""
    folder = new_folder(docs.sparkSession, "simple8b")
    write(docs, tokenizer, folder, **settings)
    return read(docs.sparkSession, folder)
