"""Phrase collocations from padded longest windows, with shorter phrases by ROLLUP.

Every word position gives one window: the word and, from lead columns, the four words after it. Its
count is that of the longest phrase; a ROLLUP over the five columns sums the windows by successively
shorter prefixes, so phrases of one to four words are never exploded on their own.

A window is padded where its piece ends, and where it can hold no candidate any more: behind a word, a
pair or a triple of words that occurs less often than a candidate must. Words, pairs of frequent words
and triples of frequent pairs are counted first, the latter two as hashes, and those that are frequent
are told to the tasks by a bit table of fixed size each. A bit set by chance, or two pairs of one hash,
keep a window longer and change no count. Tasks count what they emit slice by slice, and Spark counts
partially before each shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fxtape.llm.texts import BASE, BYTE_VALUES, mixed, powers, sliced
from fxtape.shared import published

LONGEST = 5
LEADS = [f"w{k}" for k in range(LONGEST)]
PAD = ""
RUNS = 3  # words of the longest runs that are counted before the windows
FILTER_BITS = 26  # of a bit table, 8 MB whatever the corpus
BLOCK = 1 << 16  # bytes of a bit table that travel as one row
SLICE = 1 << 19  # bytes of text handled at once: a slice takes some 70 times that in arrays and words

WORD, SPACE, BREAK = 0, 1, 2
KIND = np.full(256, WORD, np.uint8)
KIND[[0x20, 0x09]] = SPACE
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
ORDER = [np.uint64((BASE * (2 * k + 3)) % (1 << 64) | 1) for k in range(LONGEST)]


def language_value(lang: str) -> int:
    h = np.zeros(1, np.uint64)
    for byte in lang.encode():
        h = mixed(h + BYTE_VALUES[[byte]])
    return int(mixed(h + np.uint64(len(lang)))[0])


class Pieces:
    """The words of some texts with a hash of word and language, and which neighbours share a piece."""

    def __init__(self, texts: list[str], langs: list[str]):
        parts = [t.encode() for t in texts]
        ends = np.cumsum([len(p) + 1 for p in parts])
        raw = np.frombuffer((b"\n".join(parts) + b"\n").lower(), np.uint8)
        kind = KIND[raw]
        edge = np.flatnonzero(np.diff((kind == WORD).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        self.start, self.stop = edge[::2], edge[1::2]
        up, down = powers(len(raw) + 1, SLICE)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.multiply(BYTE_VALUES[raw], up[: len(raw)], out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        value = (total[self.stop] - total[self.start]) * down[self.start]
        row = np.searchsorted(ends, self.start, side="right")
        self.names = sorted(set(langs))
        number = {name: i for i, name in enumerate(self.names)}
        self.lang = np.array([number[name] for name in langs], np.int64)[row]
        salt = np.array([language_value(name) for name in self.names], np.uint64)
        self.hash = mixed(value + (self.stop - self.start).astype(np.uint64)) ^ salt[self.lang]
        breaks = np.cumsum(kind == BREAK, dtype=np.int32)[self.start]
        self.joined = np.zeros(len(self.start), bool)  # with the word after it
        self.joined[:-1] = breaks[1:] == breaks[:-1]
        self.bytes = raw.tobytes()

    def runs(self, size: int) -> np.ndarray:
        """The hash of each word with the ones after it; the last ones run over the end."""
        n, h = len(self.hash), np.zeros(len(self.hash), np.uint64)
        for k in range(size):
            h[: n - k] += mixed(self.hash[k:] * ORDER[k])
        return mixed(h + np.uint64(size))

    def frequent(self, tables: list[np.ndarray]) -> list[np.ndarray]:
        """Where a run of 1, 2, ... words begins that the tables know, as do all runs inside it."""
        found = [has(tables[0], self.hash)]
        for size, table in enumerate(tables[1:], 2):
            open_to = self.open_to(found)
            open_to[open_to] = has(table, self.runs(size)[open_to])
            found.append(open_to)
        return found

    def open_to(self, found: list[np.ndarray]) -> np.ndarray:
        """Where a run one word longer can be frequent."""
        shorter = found[-1]
        out = shorter & self.joined if len(found) == 1 else shorter.copy()
        out[:-1] &= shorter[1:]
        out[-1:] = False
        return out

    def words(self, at: np.ndarray) -> pa.Array:
        cut = self.bytes
        return pa.array([cut[a:b] for a, b in zip(self.start[at].tolist(), self.stop[at].tolist(), strict=True)], pa.string())

    def languages(self, at: np.ndarray) -> pa.Array:
        return pa.array([self.names[i] for i in self.lang[at].tolist()], pa.string())


def has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether both bits of a hash are set."""
    found = np.ones(len(h), bool)
    for shift in (0, 32):
        at = (h >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
    return found


def bit_table(rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The bit table over the ``hashes`` of rows: set in tasks, united by block in Spark, 8 MB at most
    on the driver. Rows are hashed where their bits are set: a second Python step in a task would be a second worker
    with memory of its own."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((1 << FILTER_BITS) >> 3, np.uint8)
        for batch in batches:
            h = hashes(batch)
            for shift in (0, 32):
                at = (h >> np.uint64(shift)) & np.uint64((1 << FILTER_BITS) - 1)
                np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        blocks = bits.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([blocks[i].tobytes() for i in used], pa.binary())], ["block", "bits"]
        )

    def united(part: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK, np.uint8)
        for value in part.column("bits"):
            bits |= np.frombuffer(value.as_buffer(), np.uint8)
        return pa.table({"block": part.column("block").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    kind = "block long, bits binary"
    whole = np.zeros((1 << FILTER_BITS) >> 3, np.uint8).reshape(-1, BLOCK)
    for row in rows.mapInArrow(partial, kind).groupBy("block").applyInArrow(united, kind).collect():
        whole[row.block] = np.frombuffer(row.bits, np.uint8)
    return whole.reshape(-1)


def emitted(
    texts: DataFrame, kind: str, of: Callable[[Pieces], pa.RecordBatch]
) -> DataFrame:
    """``of`` over the words of each slice of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", SLICE):
            found = Pieces(part.column("text").to_pylist(), part.column("lang").to_pylist())
            if len(found.hash):
                yield of(found)

    return texts.mapInArrow(run, kind)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of all words; a row with a null word counts all words of its language."""

    def of(p: Pieces) -> pa.RecordBatch:
        _, at, n = np.unique(p.hash, return_index=True, return_counts=True)
        total = np.bincount(p.lang, minlength=len(p.names))
        lang = pa.concat_arrays([p.languages(at), pa.array(p.names, pa.string())])
        word = pa.concat_arrays([p.words(at), pa.nulls(len(p.names), pa.string())])
        return pa.RecordBatch.from_arrays([lang, word, pa.array(np.concatenate([n, total]))], ["lang", "word", "n"])

    partial = emitted(texts, "lang string, word string, n long", of)
    return partial.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def hashed(batch: pa.RecordBatch) -> np.ndarray:
    """The hash of each (lang, word), as tasks compute it from texts."""
    return Pieces(batch.column(1).to_pylist(), batch.column(0).to_pylist()).hash


def run_table(texts: DataFrame, known: list, least: int) -> np.ndarray:
    """The bit table of frequent runs one word longer than those of the ``known`` tables."""

    def of(p: Pieces) -> pa.RecordBatch:
        at = p.open_to(p.frequent([table.value for table in known]))
        h, n = np.unique(p.runs(len(known) + 1)[at], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    counted = emitted(texts, "h long, n long", of).groupBy("h").agg(F.sum("n").alias("n"))
    return bit_table(counted.where(F.col("n") >= least).select("h"), lambda b: b.column(0).to_numpy().view(np.uint64))


def windows(texts: DataFrame, words: np.ndarray, least: int) -> DataFrame:
    """(lang, w0 .. w4, n): the padded longest windows that start with a frequent word, counted."""
    context = texts.sparkSession.sparkContext
    tables = [context.broadcast(words)]
    while len(tables) < RUNS:
        tables.append(context.broadcast(run_table(texts, tables, least)))

    def of(p: Pieces) -> pa.RecordBatch:
        found = p.frequent([table.value for table in tables])
        size = len(p.hash)
        on, length, key = found[0], found[0].astype(np.int64), mixed(p.hash * ORDER[0])
        for k in range(1, LONGEST):
            run = found[min(k, RUNS - 1)]
            begin = max(k - RUNS + 1, 0)  # of the last run inside the first k + 1 words
            more = np.zeros(size, bool)
            more[: size - begin] = on[: size - begin] & run[begin:]
            on, length = more, length + more
            lead = np.zeros(size, np.uint64)
            lead[: size - k] = mixed(p.hash[k:] * ORDER[k])
            key = key + np.where(on, lead, np.uint64(0))
        key = mixed(key + length.astype(np.uint64))
        start = np.flatnonzero(found[0])
        _, first, n = np.unique(key[start], return_index=True, return_counts=True)
        start = start[first]
        columns = [p.languages(start), p.words(start)]
        for k in range(1, LONGEST):
            there = length[start] > k
            lead = np.full(len(start), PAD, object)
            lead[there] = p.words(start[there] + k).to_numpy(zero_copy_only=False)
            columns.append(pa.array(lead, pa.string()))
        return pa.RecordBatch.from_arrays([*columns, pa.array(n)], ["lang", *LEADS, "n"])

    kind = f"lang string, {', '.join(f'{w} string' for w in LEADS)}, n long"
    return emitted(texts, kind, of).groupBy("lang", *LEADS).agg(F.sum("n").alias("n"))


def frequencies(counted: DataFrame, least: int) -> DataFrame:
    """(lang, words, f) of every phrase found ``least`` times or more, by ROLLUP over the lead columns."""
    summed = counted.rollup("lang", *LEADS).agg(
        F.sum("n").alias("f"), F.grouping_id().alias("rolled")
    )
    kept = F.lit(LONGEST) - F.bit_count("rolled").cast("int")
    words = F.slice(F.array(*LEADS), F.lit(1), kept)
    return (
        summed.where((F.bit_count("rolled") < LONGEST) & (F.col("f") >= least))
        .select("lang", words.alias("words"), "f")
        .where(F.element_at("words", -1) != PAD)
    )


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000
) -> DataFrame:
    """The ``top`` phrases of each language by score: (lang, rank, phrase, a, l, r, n, score).

    Words are runs of other characters than space and tab inside pieces, which end at ``.,;:!?`` and line
    breaks; A-Z are lower-cased. A phrase of 2 to 5 words with count a of ``least`` or more is cut where
    floor(1000 * a * n / (l * r)) is lowest (the first such cut): l and r count its parts, n all words of
    the language. A phrase inside a longer one of the same count goes. Ties in score go by count, then by
    the phrase's bytes.

    Null texts are empty and a null language is ``und``, together with rows that say so. Repeated rows
    count again. Texts of any length are read whole. Other columns are not read. No phrases, no rows.
    """
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    counts = word_counts(texts)
    counts = published(counts.where((F.col("n") >= least) | F.col("word").isNull()), "words")
    words = counts.where("word IS NOT NULL")
    totals = counts.where("word IS NULL").select("lang", "n")
    counted = published(windows(texts, bit_table(words.select("lang", "word"), hashed), least), "windows")
    phrases = published(
        frequencies(counted, least).select(
            "lang", F.concat_ws(" ", "words").alias("phrase"), F.size("words").alias("size"), "words", "f"
        ),
        "phrases",
    )
    return ranked(phrases, totals, top)


def ranked(phrases: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Scores of candidates from the counts of all frequent phrases, all joins by (lang, phrase)."""

    def part(begin: Column, size: Column) -> Column:
        return F.concat_ws(" ", F.slice("words", begin, size))

    candidates = phrases.where("size > 1")
    cut = candidates.select(
        "lang", "phrase", "size", "words", F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cut.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    scored = scored.withColumn("score", F.expr(
        "(1000 * cast(a AS decimal(16,0)) * cast(n AS decimal(18,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"
    ))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.any_value("a").alias("a"), F.any_value("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = candidates.where("size > 2").select(
        "lang", "words", "size", "f", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("width")
    ).select(
        "lang", "words", "f", "width", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1)).alias("at")
    )
    inside = inner.groupBy("lang", part(F.col("at"), F.col("width")).alias("phrase")).agg(F.max("f").alias("outer"))
    left = lowest.join(inside, ["lang", "phrase"], "left").where("outer IS NULL OR outer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
