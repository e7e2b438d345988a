"""Similarity join of documents by Jaccard over word n-grams: a blocked product of the sparse
document-by-n-gram matrix that drops pairs below bounds derived from the sizes.

1. Columns are ordered from rare to common by a fixed-size table of counters. A document's prefix is
   its first n-grams in that order. A pair at the threshold shares at least ``need`` of them, so rows
   meet only in prefix columns, and their accumulated overlap is held against that bound.
2. Columns of more than ``wide`` documents are not paired off. A pair may share as many of them as either
   document has: so much less is asked of its other columns, and pairs that pass are put in one cluster.
   Documents with enough wide columns to pass by these alone are put in one cluster with all such
   documents of the column.
3. Inside a cluster the whole rows are multiplied in blocks of ``block`` documents, ordered by size;
   pairs of blocks whose sizes cannot reach the threshold are left out. A product returns a spanning
   forest of its linked pairs.

Equal sets are one row of the matrix, however many copies a document has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fxtape.llm.components import components
from fxtape.llm.texts import Words, mixed, sliced, strings
from fxtape.shared import published

COUNTERS = 18  # bits: the table of counters has 262,144 entries whatever the corpus
COLUMNS = 4096  # of a dense part of a product
SLICE = 1 << 19  # bytes of text handled at once: a slice takes some 60 times that in arrays and sets


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """(slice, its n-gram sets) of some texts."""
    for batch in sliced(batches, text, SLICE):
        yield batch, Words(strings(batch, text), SLICE).shingles(size)


def prefix_sizes(n: int, percent: int) -> tuple[int, int]:
    """(length of the prefix, overlap that a linked pair has in it) for a set of ``n``.

    A linked pair shares ceil(t * n) elements or more, so at most n - ceil(t * n) of them are missing
    from the other set: the first ``prefix`` elements hold ``prefix - missing`` shared ones.
    """
    missing = n - -(-n * percent // 100)
    prefix = min(n, missing + 1 + n // 20)
    return prefix, prefix - missing


def counters(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """How many document n-grams fall on each counter; the counters alone reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS, np.int64)
        for _, sets in slices(batches, text, size):
            if sets:
                slot = (np.concatenate(sets) >> np.uint64(64 - COUNTERS)).astype(np.int64)
                total += np.bincount(slot, minlength=1 << COUNTERS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(used, pa.int32()), "n": total[used]})

    rows = docs.select(text).mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    out = np.zeros(1 << COUNTERS, np.int64)
    out[found["slot"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def prefixes(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """(id, n, identity, prefix) of every row; identity names the set, null for an empty one."""
    weight = docs.sparkSession.sparkContext.broadcast(counters(docs, text, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in slices(batches, text, size):
            identity, chosen = [], []
            for s in sets:
                slot = (s >> np.uint64(64 - COUNTERS)).astype(np.int64)
                length = prefix_sizes(len(s), percent)[0]
                order = np.argsort(weight.value[slot], kind="stable")[:length]  # ties by value
                chosen.append(s[order].view(np.int64))
                both = np.array([s.sum(dtype=np.uint64), mixed(s).sum(dtype=np.uint64)], "<u8")
                identity.append(both.tobytes() + len(s).to_bytes(8, "little") if len(s) else None)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(key).cast(pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "identity": pa.array(identity, pa.binary()),
                "prefix": pa.array(chosen, pa.list_(pa.int64())),
            })

    return docs.select(key, text).mapInArrow(run, "id long, n long, identity binary, prefix array<bigint>")


def clusters(prefixed: DataFrame, percent: int, wide: int) -> DataFrame:
    """(node, cluster) such that every linked pair of different sets lies in one cluster."""
    sets = (
        prefixed.where("identity IS NOT NULL AND id IS NOT NULL")
        .groupBy("identity").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    )
    entries = sets.select("node", "n", F.explode("prefix").alias("g"))
    column, row = Window.partitionBy("g"), Window.partitionBy("node")
    shared = published(
        entries.withColumn("m", F.count("*").over(column)).where("m > 1")
        .withColumn("crowded", F.sum((F.col("m") > wide).cast("int")).over(row)),
        "columns",
    )
    narrow = shared.where(F.col("m") <= wide)
    x, y = narrow.alias("x"), narrow.select("g", "node", "n", "crowded").alias("y")
    fits = (F.col("x.n") * 100 >= F.col("y.n") * percent) & (F.col("y.n") * 100 >= F.col("x.n") * percent)
    met = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.node") < F.col("y.node")) & fits)

    def need(size: Column) -> Column:
        """``prefix_sizes(size)[1]`` as an expression."""
        missing = size - F.ceil(size * percent / 100)
        return F.least(size - missing, F.floor(size / 20) + 1)

    # What a pair lacks may lie in wide columns, of which it shares no more than either document has.
    lacking = F.least(need(F.col("x.n")), need(F.col("y.n"))) - F.least("x.crowded", "y.crowded")
    close = (
        met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), lacking.cast("int").alias("need"))
        .groupBy("a", "b", "need").agg(F.count("*").alias("overlap")).where("overlap >= need")
    )
    # Only a document that has enough of them for its smallest partner can be linked by wide columns alone.
    alone = F.col("crowded") >= need(F.ceil(F.col("n") * percent / 100))
    hot = shared.where((F.col("m") > wide) & alone).select("node", F.min("node").over(column).alias("lead"))
    edges = close.select("a", "b").union(hot.where("node != lead").select("lead", "node"))
    return components(edges).withColumnRenamed("component", "cluster")


def product(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs between rows ``left`` and ``right``, as positions."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, col, uses = np.unique(flat, return_inverse=True, return_counts=True)
    several = uses > 1
    number = np.cumsum(several) - 1
    keep = several[col]
    row, col = row[keep], number[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, int(several.sum()), COLUMNS):
        a, b = np.searchsorted(col, [begin, begin + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], col[a:b] - begin] = 1
        overlap += part @ part.T
    common = np.rint(overlap[np.ix_(left, right)]).astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - common
    i, j = np.nonzero((common * 100 >= union * percent) & (common > 0))
    parent = list(range(len(sets)))

    def root(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    forest = []
    for a, b in zip(left[i].tolist(), right[j].tolist(), strict=True):
        p, q = root(a), root(b)
        if p != q:
            parent[q] = p
            forest.append((a, b))
    return forest


def links(docs: DataFrame, grouped: DataFrame, key: str, text: str, size: int, percent: int, block: int) -> DataFrame:
    """(a, b): linked pairs of each cluster, enough to connect all that are linked.

    Texts are dealt to their blocks, being smaller than their sets of hashes, and hashed there again.
    The joins are merge joins at every size, as the clustered documents grow with the corpus.
    """
    rows = published(
        docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).join(grouped.hint("merge"), "node"),
        "clustered",
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in slices(batches, "text", size):
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "cluster": batch.column("cluster"), "n": n})

    sized = rows.mapInArrow(measure, "node long, cluster long, n long").groupBy("cluster", "node").agg(F.max("n").alias("n"))
    by_size = Window.partitionBy("cluster").orderBy("n", "node")
    placed = published(sized.withColumn("block", F.floor((F.row_number().over(by_size) - 1) / block)), "blocks")
    bounds = placed.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    i, j = bounds.alias("i"), bounds.alias("j")
    pairs = i.join(
        j,
        (F.col("i.cluster") == F.col("j.cluster")) & (F.col("i.block") <= F.col("j.block"))
        & (F.col("i.high") * 100 >= F.col("j.low") * percent),
    ).select(F.col("i.cluster").alias("cluster"), F.col("i.block").alias("i"), F.col("j.block").alias("j"))
    sides = pairs.select("cluster", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    dealt = rows.drop("cluster").join(placed.join(sides, ["cluster", "block"]).drop("n").hint("merge"), "node")

    def multiply(keys: tuple, part: pa.Table) -> pa.Table:
        node, at = part["node"].to_numpy(), part["block"].to_numpy()
        sets = [s for _, some in slices(part.select(["text"]).to_batches(), "text", size) for s in some]
        left, right = (np.flatnonzero(at == k.as_py()) for k in keys[1:])
        found = np.array(product(sets, left, right, percent), np.int64).reshape(-1, 2)
        return pa.table({"a": node[found[:, 0]], "b": node[found[:, 1]]})

    return dealt.groupBy("cluster", "i", "j").applyInArrow(multiply, "a long, b long")


def joined(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 3,
    percent: int = 90,
    wide: int = 32,
    block: int = 512,
) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Two rows link when 100 * intersection >= percent * union of their n-gram sets; component_id is the
    smallest key reachable by links, the row's own included. Fewer words than ``size`` make one n-gram
    of them all. A row without words, or with a null text, links with nothing. Rows with equal sets
    link. Rows that share a key are one document: it links where any of them does. A null key takes no
    part in links; such a row gets the component of its equals, or null. An empty table gives no rows;
    other columns are left out. ``percent`` is from 1 to 100.
    """
    sets = published(prefixes(docs, key, text, size, percent), "prefixes")
    grouped = clusters(sets, percent, wide)
    linked = components(links(docs, grouped, key, text, size, percent, block))
    nodes = sets.where("identity IS NOT NULL").groupBy("identity").agg(F.min("id").alias("node"))
    named = nodes.join(linked, "node", "left").select("identity", F.coalesce("component", "node").alias("c"))
    return sets.select("id", "n", "identity").join(named, "identity", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("c", "id").alias("component_id")
    )


def first_of_each(docs: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of its component, with all their columns."""
    judged = joined(docs, key, **settings)
    gone = judged.where(F.col(key) != F.col("component_id")).select(key).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)
