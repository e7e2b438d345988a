"""Benchmark decontamination: item-sized windows of texts that lie within an edit distance of an item.

The CGK embedding walks over a sequence with random steps: at step j it emits the current word and
advances by a random bit of (j, word). Two sequences at a small edit distance emit equal words at most
steps, so edit distance becomes Hamming distance. A repetition samples a few steps of a walk; windows
and items with equal samples are candidates, and the exact edit distance over words decides.

Walks start at every word of a text. A repetition draws the steps it samples, at gaps of every scale up to the
size of the item, and for each item the word it starts at, so an edit spoils few repetitions. How many
repetitions an item has is found on drawn copies of it with as many edits as are allowed: they go on until each copy shares
a code with the item in COVERED repetitions. A window whose first samples fit no item is dropped before it
walks on, which changes nothing in the outcome and makes a repetition cost little more than a look at each word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape.llm.texts import Words, mixed, sliced, strings

SAMPLED = 3  # different words in a code; fewer in an item that keeps fewer
COPIES = 24  # drawn for each item
COVERED = 2  # repetitions in which a copy has to share a code with its item
# Items handled in one pass over the texts; more items mean more passes.
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 16_000_000
STRAIGHT = -1  # the repetition whose walks go on at every step


def folded(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(code * np.uint64(3) + word)


def moves(word: np.ndarray, r: int, j: int) -> np.ndarray:
    """The words by which a walk at ``word`` goes on after step ``j``: a random bit of both."""
    if r == STRAIGHT:
        return np.ones(len(word), np.int64)
    seed = hashlib.sha256(f"walk {r} {j // 64}".encode()).digest()[:8]
    return ((mixed(word ^ np.uint64(int.from_bytes(seed, "big"))) >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)


def drawn_steps(scale: int, r: int) -> tuple[int, ...]:
    """The steps repetition ``r`` samples for items of 2 ** scale words and more: the first, one soon
    after it, and one at a gap of any scale up to the size of the item."""
    rng = np.random.default_rng([scale, r])
    near = 1 + int(rng.integers(4))
    return (0, near, near + int(np.ceil(2 ** (rng.random() * (scale + 1)))))


def walked(
    h: np.ndarray, p: np.ndarray, end: np.ndarray, r: int, steps: tuple[int, ...], partial: list[np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the start, code, different words sampled) of the walks from ``p`` that sample all steps
    before ``end`` and, where ``partial`` is given, whose codes are among its codes at each sample."""
    who, i = np.arange(len(p)), p.copy()
    code, count, last = np.zeros(len(p), np.uint64), np.zeros(len(p), np.int64), np.full(len(p), -1)
    taken = 0
    for j in range(steps[-1] + 1):
        if j:
            i = i + moves(h[i], r, j - 1)
            keep = i < end
            who, i, end, code, count, last = who[keep], i[keep], end[keep], code[keep], count[keep], last[keep]
        if j == steps[taken]:
            code, count, last = folded(code, h[i]), count + (i != last), i
            if partial is not None:
                keep = np.isin(code, partial[taken])
                who, i, end, code, count, last = who[keep], i[keep], end[keep], code[keep], count[keep], last[keep]
            taken += 1
    return who, code, count


def edited(words: np.ndarray, edits: int, kind: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A copy of an item with ``edits`` words replaced, removed or put in, and the place of each word in it (-1:
    none). The first kinds edit the beginning, the end, and every so many words; the others any words."""
    n = len(words)
    if kind == 0 or kind == 1:
        places = np.arange(edits)
    elif kind == 2:
        places = n - 1 - np.arange(edits)
    elif kind == 3:
        places = np.arange(edits) * n // max(1, edits)
    else:
        places = rng.permutation(n)[:edits]
    how = np.zeros(n, np.int64)  # 1 replaced, 2 removed, 3 another word before it
    how[places] = (1, 2, 1, 1)[kind] if kind < 4 else rng.integers(1, 4, len(places))
    size = np.array([1, 1, 0, 2])[how]
    begin = np.cumsum(size) - size
    out = rng.integers(1, 1 << 62, int(size.sum())).astype(np.uint64)
    at = np.where(how == 3, begin + 1, begin)
    kept = (how == 0) | (how == 3)
    out[at[kept]] = words[kept]
    return out, np.where(kept, at, -1)


class ItemIndex:
    """The sampled codes of one block of items."""

    def __init__(self, items: pd.DataFrame, repetitions: int, percent: int):
        self.ids = items["item"].tolist()
        words = Words([t or "" for t in items["text"]])
        self.words = [words.hash[a:b] for a, b in zip(words.first, words.last, strict=True)]
        self.known = np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]))
        # (repetition, steps) -> for each sample the partial codes that occur, and the items of a whole code.
        self.tables: dict[tuple[int, tuple[int, ...]], tuple[list[set], dict[int, list[tuple[int, int]]]]] = {}
        # In how many items a word is: walks begin at the rarer ones.
        name, often = np.unique(np.concatenate([*[np.unique(w) for w in self.words], np.zeros(0, np.uint64)]), return_counts=True)
        self.rarity = [often[np.searchsorted(name, w)] for w in self.words]
        scales: dict[int, list[int]] = {}
        for at, w in enumerate(self.words):
            if len(w):
                scales.setdefault(len(w).bit_length() - 1, []).append(at)
        self.straight = [at for scale, some in sorted(scales.items()) for at in self.covered(scale, some, repetitions, percent)]
        for at in self.straight:  # a stretch more than edits: one of them stays whole
            w = self.words[at]
            size = len(w) // (len(w) * percent // 100 + 1)
            for k in range(len(w) * percent // 100 + 1):
                self.enter(STRAIGHT, tuple(range(size)), at, k * size)
        self.tables = {
            key: ([np.array(sorted(p), np.uint64) for p in partial], whole) for key, (partial, whole) in self.tables.items()
        }
        # Which known words can be a first sample, a bit for each table.
        self.order = sorted(self.tables)
        self.first = np.zeros((len(self.order), len(self.known) + 1), bool)
        for t, key in enumerate(self.order):
            self.first[t, 1:] = np.isin(folded(np.zeros(1, np.uint64), self.known), self.tables[key][0][0])

    def enter(self, r: int, steps: tuple[int, ...], at: int, start: int) -> None:
        """Put the codes of an item's walk from ``start`` into its table."""
        w = self.words[at]
        partial, whole = self.tables.setdefault((r, steps), ([set() for _ in steps], {}))
        for k in range(len(steps)):
            _, code, _ = walked(w, np.array([start]), np.array([len(w)]), r, steps[: k + 1])
            partial[k].add(int(code[0]))
        whole.setdefault(int(code[0]), []).append((at, start))

    def covered(self, scale: int, some: list[int], repetitions: int, percent: int) -> list[int]:
        """Give the items of one scale their repetitions; the items whose copies are not all covered by then."""
        rng = np.random.default_rng([scale, 0xC6])
        made = [
            edited(self.words[at], len(self.words[at]) * percent // 100, kind, rng) for at in some for kind in range(COPIES)
        ]
        h = np.concatenate([c for c, _ in made])
        last = np.cumsum([len(c) for c, _ in made])
        begin = last - [len(c) for c, _ in made]
        item = np.concatenate([self.words[at] for at in some])
        item_last = np.cumsum([len(self.words[at]) for at in some])
        item_begin = item_last - [len(self.words[at]) for at in some]
        wanted = np.array([max(1, min(SAMPLED, n - n * percent // 100)) for n in item_last - item_begin])
        missing = np.full((len(some), COPIES), COVERED)
        for r in range(repetitions):
            if not missing.any():
                break
            steps = drawn_steps(scale, r)
            start = np.array([self.begin(at, r) for at in some])
            who, code, count = walked(item, item_begin + start, item_last, r, steps)
            useful = count >= wanted[who]
            own = dict(zip(who[useful].tolist(), code[useful].tolist(), strict=True))
            image = np.array([made[k * COPIES + c][1][start[k]] for k in range(len(some)) for c in range(COPIES)])
            there = np.flatnonzero(image >= 0)
            who, code, _ = walked(h, begin[there] + image[there], last[there], r, steps)
            hit = np.zeros((len(some), COPIES), bool)
            for copy, value in zip(there[who].tolist(), code.tolist(), strict=True):
                if own.get(copy // COPIES) == value:
                    hit[copy // COPIES, copy % COPIES] = True
            hit &= missing > 0
            for k in np.flatnonzero(hit.any(axis=1)).tolist():
                self.enter(r, steps, some[k], int(start[k]))
            missing -= hit
        return [some[k] for k in np.flatnonzero(missing.any(axis=1)).tolist()]

    def begin(self, at: int, r: int) -> int:
        """The word a walk of an item starts at: of three drawn ones the rarest among the items."""
        rng = np.random.default_rng([at, r, 7])
        places = rng.integers(0, len(self.words[at]), 3)
        return int(min(places.tolist(), key=lambda p: (self.rarity[at][p], p)))

    def candidates(self, words: Words) -> set[tuple[int, int, int]]:
        """(text, item, word where the item would begin) of windows that share a code with an item."""
        if not len(words.hash) or not len(self.known):
            return set()
        h = words.hash
        slot = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        name = np.where(self.known[slot] == h, slot + 1, 0)
        near = np.flatnonzero(name)
        name = name[near]
        owner = np.repeat(np.arange(len(words.first)), words.last - words.first)
        limit = words.last[owner]
        found = set()
        for t, (r, steps) in enumerate(self.order):
            partial, whole = self.tables[r, steps]
            p = near[self.first[t][name]]
            who, code, _ = walked(h, p, limit[p], r, steps, partial)
            for at, c in zip(p[who].tolist(), code.tolist(), strict=True):
                for item, start in whole.get(c, ()):
                    found.add((int(owner[at]), item, at - start))
        return found


def fit(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(edit distance, end) of the stretch of ``text`` nearest to ``item``; ties go to the first end."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, word in enumerate(item):
        fresh = row + 1
        fresh[1:] = np.minimum(fresh[1:], row[:-1] + (text != word))
        fresh[0] = k + 1
        row = np.minimum.accumulate(fresh - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def searched(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    percent: int = 20,
    repetitions: int = 300,
) -> DataFrame:
    """(key, item, distance, item_words, end_word): items found in texts, the nearest place of each.

    A text holds an item when a stretch of it is within floor(percent / 100 * words of the item) word
    edits; words are runs without white space, A-Z lower-cased. An item has as many repetitions as its drawn
    copies need, ``repetitions`` at most; one whose copies need more is cut into a stretch more than it may
    have edits, which finds all of its copies. Windows near a candidate are compared in full, so a
    reported distance is exact.

    Items go by blocks of BLOCK_ITEMS and BLOCK_BYTES, each broadcast with its codes and compared with
    every text; there is no shuffle of texts. Null and empty texts or items hold and match nothing;
    repeated rows and items give a row each; equal distances go to the first place; empty tables give
    no rows; keys may be null; other columns are left out.
    """
    spark = docs.sparkSession
    listed = items.select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text"))
    rows, size = listed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    out = None
    for b in range(blocks):
        some = listed.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).toPandas()
        index = spark.sparkContext.broadcast(ItemIndex(some, repetitions, percent))
        found = matches(docs, index, key, text, item, percent)
        out = found if out is None else out.union(found)
    return out


def matches(docs: DataFrame, index, key: str, text: str, item: str, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in sliced(batches, text):
            keys = batch.column(key).to_pylist()
            words = Words(strings(batch, text))
            best: dict[tuple[int, int], tuple[int, int]] = {}
            for d, at, begin in sorted(own.candidates(words)):
                w = own.words[at]
                allowed = len(w) * percent // 100
                first, last = int(words.first[d]), int(words.last[d])
                a, z = max(first, begin - allowed), min(last, begin + len(w) + allowed)
                if np.isin(w, words.hash[a:z], invert=True).sum() > allowed:
                    continue  # each word that is not there costs an edit
                distance, end = fit(w, words.hash[a:z])
                if distance <= allowed:
                    best[d, at] = min(best.get((d, at), (distance, last)), (distance, a + end - first))
            places = sorted(best)
            yield pa.RecordBatch.from_pydict({
                key: pa.array([keys[d] for d, _ in places], pa.int64()),
                item: pa.array([own.ids[at] for _, at in places], pa.int64()),
                "distance": pa.array([best[p][0] for p in places], pa.int64()),
                "item_words": pa.array([len(own.words[at]) for _, at in places], pa.int64()),
                "end_word": pa.array([best[p][1] for p in places], pa.int64()),
            })

    schema = f"{key} long, {item} long, distance long, item_words long, end_word long"
    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, schema)


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; null keys stay."""
    held = searched(docs, items, key=key, **settings).select(key).distinct()
    return docs.join(held, key, "left_anti").select(*docs.columns)
