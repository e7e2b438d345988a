"""SimHash near-duplicates by anchor points of a covering code.

Two fingerprints of 64 bits that differ in at most 3 bits differ in at most 1 bit in one of their
halves, so each half is a covering problem of 32 bits with threshold 1. The anchors of a half are the
words of the perfect Hamming code of length 31, with the last bit free: covering radius 1. A fingerprint
has one home, its nearest anchor, and visits every anchor within covering radius plus threshold, 2 bits:
17 at most. Whatever lies within 1 bit of it visits its home, so homes are compared with visitors and
every pair that was found is verified on all 64 bits.

Over the 64 bits at once a code of this kind needs thousands of anchors for a radius of its own plus 3.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape.llm.components import components
from fxtape.llm.texts import sliced, strings
from fxtape.shared import published

SEED = 42
BITS = 3
CROWD = 1024  # visitors of an anchor beyond which it is dealt again by the other half's bytes
HASHES = 1 << 18  # hashes whose bits are added up at once

SPAN = 31
SYNDROME = [np.uint32(sum(1 << (p - 1) for p in range(1, SPAN + 1) if p >> bit & 1)) for bit in range(5)]
FREE = np.uint32(1 << SPAN)


def fingerprint(text: str, size: int = 3) -> int:
    """Bits that are set in over half of the XXH64 values of a text's shingles, repeats included.

    Shingles are ``size`` words joined by spaces, A-Z lower-cased; fewer words make one of them all, and
    no word makes fingerprint zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    count = max(len(words) - size + 1, 1)
    first, last = begins[:count].tolist(), ends[min(size, len(words)) - 1 :].tolist()
    of, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, count, HASHES):
        part = [of(joined[a:b], SEED) for a, b in zip(first[k : k + HASHES], last[k : k + HASHES], strict=True)]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """(key, print), the fingerprint as a signed long. A null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, text):
            values = np.array([fingerprint(t, size) for t in strings(part, text)], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values.view(np.int64))], ["key", "print"])

    plain = docs.select(F.col(key).alias("key"), F.col(text).alias(text if text != "key" else "text"))
    if text == "key":
        plain, text = plain, "text"
    return plain.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, print long")


def syndrome(x: np.ndarray) -> np.ndarray:
    """Which of the bits 1 to 31 leads to the nearest word of the code; 0 for a word of it."""
    s = np.zeros(len(x), np.uint32)
    for bit, mask in enumerate(SYNDROME):
        s |= (np.bitwise_count(x & mask).astype(np.uint32) & np.uint32(1)) << np.uint32(bit)
    return s


def flipped(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``x`` with bit ``at`` (1 to 31) turned; 0 turns none."""
    bit = np.uint32(1) << (np.maximum(at, 1) - 1).astype(np.uint32)
    return np.where(at > 0, x ^ bit, x)


def home(x: np.ndarray) -> np.ndarray:
    """The anchor of each half within the covering radius."""
    return flipped(x, syndrome(x))


def anchors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``x``, anchor) for every anchor within 2 bits of each half."""
    s, every = syndrome(x), np.arange(len(x))
    nearest = flipped(x, s)
    where, found = [every, every], [nearest, nearest ^ FREE]
    for i in range(1, SPAN + 1):
        j = s ^ np.uint32(i)
        pair = np.flatnonzero((s > 0) & (j > i))
        where.append(pair)
        found.append(flipped(flipped(x[pair], np.full(len(pair), i, np.uint32)), j[pair]))
    return np.concatenate(where), np.concatenate(found)


def halves(prints: np.ndarray) -> list[np.ndarray]:
    bits = prints.view(np.uint64)
    return [(bits & np.uint64(0xFFFFFFFF)).astype(np.uint32), (bits >> np.uint64(32)).astype(np.uint32)]


def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, print, guest) rows; the lowest bit of an anchor's number names the half."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1 << 16):
            prints = batch.column(0).slice(start, 1 << 16).to_numpy()
            for side, half in enumerate(halves(prints)):
                at, anchor = anchors(half)
                number = anchor.astype(np.int64) * 2 + side
                guest = home(half)[at] != anchor
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), pa.array(prints[at]), pa.array(guest)], ["anchor", "print", "guest"]
                )


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row each of ``count`` rows reaches over the edges."""
    label = np.arange(count)
    while len(a):
        least = label.copy()
        np.minimum.at(least, label[a], label[b])
        np.minimum.at(least, label[b], label[a])
        while not np.array_equal(least, deeper := least[least]):
            least = deeper
        label = least[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def linked(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """As few links as keep together what the edges connect."""
    label = forest(len(prints), a, b)
    other = np.flatnonzero(label != np.arange(len(prints)))
    return pa.RecordBatch.from_arrays(
        [pa.array(prints[other]), pa.array(prints[label[other]])], ["a", "b"]
    )


def near(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)) <= most


def compared(most: int):
    """Links inside runs of equal anchors; rows are sorted by anchor and no run exceeds CROWD rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([kept, batch] if kept is not None else [batch])
            anchor = table.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
            whole = table.combine_chunks().to_batches()
            kept = whole[0].slice(cut) if whole else None
            yield of(table.slice(0, cut))
        if kept is not None:
            yield of(pa.Table.from_batches([kept]))

    def of(rows: pa.Table) -> pa.RecordBatch:
        anchor, prints = rows.column("anchor").to_numpy(), rows.column("print").to_numpy()
        guest = rows.column("guest").to_numpy(zero_copy_only=False).astype(bool)
        at, step, a, b = np.arange(len(anchor)), 1, [], []
        while True:
            at = at[at + step < len(anchor)]
            at = at[anchor[at] == anchor[at + step]]
            if not len(at):
                break
            two = at + step
            hit = near(prints[at], prints[two], most) & ~(guest[at] & guest[two])
            a.append(at[hit])
            b.append(two[hit])
            step += 1
        none = np.zeros(0, np.int64)
        return linked(prints, np.concatenate(a or [none]), np.concatenate(b or [none]))

    return run


def crowd_compared(most: int):
    """Links of crowded anchors: rows sorted by group, the homes of a group before its guests.

    A group holds at most about CROWD homes; its guests pass by in batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, homes = None, np.zeros(0, np.int64)
        for batch in batches:
            names = list(zip(batch.column("anchor").to_pylist(), batch.column("part").to_pylist(), strict=True))
            prints, guest = batch.column("print").to_numpy(), batch.column("guest").to_numpy(zero_copy_only=False)
            edges = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
            for begin, end in zip(edges, edges[1:], strict=False):
                if names[begin] != group:
                    group, homes = names[begin], np.zeros(0, np.int64)
                here, there = prints[begin:end], guest[begin:end].astype(bool)
                homes = np.concatenate([homes, here[~there]])
                for k in range(0, len(here), CROWD):
                    some = here[k : k + CROWD]
                    a, b = np.nonzero(near(homes[:, None], some[None, :], most))
                    yield linked(np.concatenate([homes, some]), a, b + len(homes))

    return run


def links(prints: DataFrame, most: int = BITS) -> DataFrame:
    """Links (a, b) that connect what differs in at most ``most`` (3 or fewer) bits.

    ``prints``: distinct fingerprints in a column ``print``. Anchors are counted by partial aggregation.
    Those with more than CROWD visitors are dealt again by the four bytes of the other half, one of which
    is equal in every pair, and the homes of what is still large are split into parts that all its
    visitors pass. Comparisons within a group grow with homes times visitors, links with their sum.
    """
    if most > BITS:
        raise ValueError("the halves' anchors cover 3 bits")
    seen = published(prints.select("print").mapInArrow(visits, "anchor long, print long, guest boolean"), "visits")
    crowded = published(seen.groupBy("anchor").count().where(F.col("count") > CROWD).select("anchor"), "crowded")
    few = seen.join(crowded, "anchor", "left_anti")
    found = (
        few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compared(most), "a long, b long")
    )
    other = F.when(F.col("anchor") % 2 == 0, F.shiftrightunsigned("print", 32)).otherwise(F.col("print"))
    byte = F.explode(F.array(*[
        F.struct(F.lit(k).alias("at"), F.shiftrightunsigned(other, 8 * k).bitwiseAND(255).alias("value")) for k in range(4)
    ])).alias("byte")
    many = seen.join(crowded, "anchor", "left_semi").select("anchor", "print", "guest", byte)
    many = many.select(F.xxhash64("anchor", "byte").alias("anchor"), "print", "guest")
    sizes = many.groupBy("anchor").agg(F.ceil(F.count_if(~F.col("guest")) / CROWD).cast("int").alias("parts"))
    parted = many.join(sizes.where("parts > 0"), "anchor")
    mine = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    passing = parted.select("anchor", F.explode(every).alias("part"), "print", F.lit(True).alias("guest"))
    staying = parted.where(~F.col("guest")).select("anchor", mine.alias("part"), "print", "guest")
    more = (
        passing.union(staying).repartition("anchor", "part").sortWithinPartitions("anchor", "part", "guest")
        .mapInArrow(crowd_compared(most), "a long, b long")
    )
    return found.union(more)


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, most: int = BITS) -> DataFrame:
    """(key, fingerprint, component_id) of every row: 16 hex digits, and the smallest key reachable by
    links of at most ``most`` differing bits, its own included.

    Null and empty texts, and those of white space, have fingerprint zero and link like any other.
    Repeated keys are rows of their own. A row without a key takes part and gets the smallest key of its
    component, null if there is none. Other columns are not read; an empty table gives no rows.
    """
    prints = published(fingerprints(docs, key, text, size), "fingerprints")
    distinct = published(prints.groupBy("print").agg(F.min("key").alias("first")), "distinct_prints")
    together = components(links(distinct, most))
    least = together.join(distinct, together["node"] == distinct["print"]).groupBy("component").agg(
        F.min("first").alias("least")
    )
    reach = together.join(least, "component").select(F.col("node").alias("print"), "least")
    named = published(
        distinct.join(reach, "print", "left").select("print", F.coalesce("least", "first").alias("component_id")),
        "named_prints",
    )
    return prints.join(named, "print").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
