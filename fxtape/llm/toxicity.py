"""Toxicity by the nearest labelled examples in exact TF-IDF cosine, over an inverted index.

Terms are all words of the examples, known by 64-bit hashes; a word outside them meets no example and
counts in the norm of a text only.
A term's TF-IDF weight grows with the likelihood ratio by which it tells the two labels apart. The index
lists, term by term, the examples and their weights; the lists of the commonest terms are dense rows. A
query sums its short lists and meets the dense ones together with other queries, as a matrix product; examples that
are among the nearest by that, or miss it by less than the error of single precision, are scored again in
double precision. (Largest weights by block, which were used before, left two examples of five to score, since
common words meet nearly all.) The nearest vote, nearer ones with more weight, and a logistic curve fitted to the
examples' votes on each other turns votes into calibrated scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fxtape.llm.texts import sliced, strings
from fxtape.shared import published

EXAMPLES = 20_000  # most labelled rows learned from: those with the lowest hash of their key
RATIO = 14.0  # likelihood ratio that doubles a term's weight
NEAREST = 24
COMMON = 256  # terms whose lists are dense, 20 MB a worker for the most examples
TOGETHER = 64  # queries that meet the dense lists at once
LANES = 16  # examples in a matrix of the dense lists; products this small stay on the task's own core
SLACK = 1e-5  # error of a cosine in single precision, at most
WORD = re.compile(r"[^\W_]+")
SPACED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))  # ASCII bytes of no word are spaces
OTHER = re.compile(r"[^\w\x00-\x7F]")  # a character of no word that is not ASCII


def words(text: str) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower())


def counted(text: str) -> Counter[bytes]:
    """The words of a text in UTF-8 with their counts; where only ASCII characters part words, bytes tell them."""
    low = text.lower()
    if low.isascii() or not OTHER.search(low):
        return Counter(low.encode().translate(SPACED).split())
    return Counter(w.encode() for w in WORD.findall(low))


def packed(terms: np.ndarray, counts: np.ndarray, others: np.ndarray) -> bytes:
    """Rising terms, their counts and the counts of other words; equal bytes of the values stand together."""
    whole = np.concatenate([np.diff(terms, prepend=np.int32(0)), counts, others]).astype("<i4")
    return len(terms).to_bytes(4, "little") + whole.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(hits: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(hits[:4], "little")
    whole = np.ascontiguousarray(np.frombuffer(hits, np.uint8, offset=4).reshape(4, -1).T).view("<i4").ravel()
    return np.cumsum(whole[:n]), whole[n : 2 * n], whole[2 * n :]


def examples(labels: DataFrame, key: str, label: str, parts: int, held: int, most: int) -> DataFrame:
    """(key, y) of the rows learned from: at most ``most``, with crc32(key as text) mod parts not held."""
    own = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key))
    known = own.agg(F.max(F.col(label).cast("int")).alias("y"))
    free = F.crc32(F.col(key).cast("string").cast("binary")) % parts != held
    return known.where(free).orderBy(F.xxhash64(key), key).limit(most)


def ratio(a: np.ndarray, n: np.ndarray, toxic: int, total: int) -> np.ndarray:
    """Log-likelihood ratio of "the term occurs" against "the label is 1": ``a`` of ``n`` rows with
    the term have the label, ``toxic`` of ``total`` rows altogether."""
    def part(found, expected):
        return np.where(found > 0, found * np.log(np.maximum(found, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    share = n / max(total, 1)
    cells = (
        (a, toxic * share), (n - a, (total - toxic) * share),
        (toxic - a, toxic * (1 - share)), (total - toxic - n + a, (total - toxic) * (1 - share)),
    )
    return 2 * sum(part(f, e) for f, e in cells)


class Terms:
    """Words by their 64-bit hashes ``h``, numbered in the order they are given; 12 bytes a word."""

    def __init__(self, h: np.ndarray):
        self.number = np.argsort(h).astype(np.int32)
        self.hash = h[self.number]

    def __len__(self) -> int:
        return len(self.hash)

    def find(self, some: list[str] | list[bytes]) -> np.ndarray:
        """The number of each word, -1 for others."""
        if not len(self.hash):
            return np.full(len(some), -1, np.int32)
        h = hashed(some)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[at] == h, self.number[at], np.int32(-1))


def hashed(terms: list[str] | list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t) for t in terms), np.uint64, len(terms))


def weighed_terms(rows: DataFrame, text: str) -> tuple[Terms, np.ndarray]:
    """The terms of labelled rows (text, y), those that tell most first, and the factors of their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, toxic = Counter(), Counter()
        for batch in sliced(batches, text):
            for t, y in zip(strings(batch, text), batch.column("y").to_pylist(), strict=True):
                found = set(words(t))
                seen.update(found)
                if y:
                    toxic.update(found)
        terms = list(seen)
        for i in range(0, len(terms), 100_000):
            some = terms[i : i + 100_000]
            yield pa.RecordBatch.from_pydict({
                "term": pa.array(some, pa.string()), "a": pa.array([toxic[t] for t in some], pa.int64()),
                "n": pa.array([seen[t] for t in some], pa.int64()),
            })

    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    counted = rows.select(text, "y").mapInArrow(run, "term string, a long, n long")
    summed = counted.groupBy("term").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
    found = summed.toArrow()  # of the bounded examples; no word of it becomes an object, but for its hash
    g = ratio(found["a"].to_numpy().astype(float), found["n"].to_numpy().astype(float), toxic, total)
    found = found.select(["term"]).append_column("g", pa.array(g)).sort_by([("g", "descending"), ("term", "ascending")])
    h = [hashed(part.column("term").to_pylist()) for part in found.to_batches(max_chunksize=10_000)]
    return Terms(np.concatenate([np.zeros(0, np.uint64), *h])), 1 + found["g"].to_numpy() / RATIO


class Weights:
    """Vectors of examples one after the other; by term they read as dense rows."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.width = width
        self.terms = np.concatenate([np.zeros(0, np.int32), *[t.astype(np.int32, copy=False) for t, _ in vectors]])
        self.values = np.concatenate([np.zeros(0, np.float32), *[w for _, w in vectors]])
        self.first = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])]).astype(np.int64)

    @property
    def row(self) -> np.ndarray:
        """The example of each value; computed, as the start of each example says it."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), np.diff(self.first))

    def __getitem__(self, terms: np.ndarray) -> np.ndarray:
        out = np.zeros((len(terms), self.width), np.float32)
        for i, t in enumerate(terms):
            at = np.flatnonzero(self.terms == t)
            out[i, self.row[at]] = self.values[at]
        return out


class Lists:
    """The inverted lists of example vectors: term by term the examples with it and their weights; the
    COMMON longest ones are dense, as matrices of (term, LANES examples)."""

    def __init__(self, held: Weights, terms: int):
        length = np.bincount(held.terms, minlength=terms)
        some = np.argsort(-length, kind="stable")[:COMMON]
        self.place = np.full(terms, -1, np.int32)
        self.place[some] = np.arange(len(some))
        self.width, at, row = held.width, self.place[held.terms], held.row
        common = at >= 0
        self.dense = np.zeros((-(-held.width // LANES), len(some), LANES), np.float32)
        self.dense[row[common] // LANES, at[common], row[common] % LANES] = held.values[common]
        left = np.flatnonzero(at < 0)
        left = left[np.argsort(held.terms[left], kind="stable")]
        self.row, self.values = row[left].astype(np.intp), held.values[left]
        length[some] = 0
        self.begin = np.concatenate([[0], np.cumsum(length)])

    def summed(self, terms: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Products of all examples with these terms, none of them dense."""
        begin = self.begin[terms]
        n = self.begin[terms + 1] - begin
        at = np.repeat(begin - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        values = self.values.take(at)
        values *= np.repeat(w, n)
        return np.bincount(self.row.take(at), weights=values, minlength=self.width)

    def met(self, common: np.ndarray, w: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Products of some examples with dense terms, in double precision."""
        values = self.dense[(some // LANES)[:, None], common, (some % LANES)[:, None]]
        return (values * w).sum(axis=1, dtype=np.float64)


class Index:
    """Distinct example vectors with their numbers of rows and of toxic rows."""

    def __init__(self, rows: pd.DataFrame, idf: np.ndarray):
        self.idf = idf
        merged: dict[tuple, list] = {}
        zero = [0, 0]
        for key, y, terms, counts in zip(rows["key"], rows["y"], rows["terms"], rows["counts"], strict=True):
            if not len(terms):
                zero = [zero[0] + 1, zero[1] + int(y)]
                continue
            name = tuple(np.asarray(x, ">i4").tobytes() for x in (terms, counts))
            at = merged.setdefault(name, [0, 0, key, terms, counts])
            at[0], at[1], at[2] = at[0] + 1, at[1] + int(y), min(at[2], key)
        total, toxic = max(1, len(rows)), int(rows["y"].sum()) if len(rows) else 0
        self.prior = (toxic + 1) / (total + 2)
        self.silent = (zero[1] + self.prior) / (zero[0] + 1)  # of texts without a term
        found = [merged[name] for name in sorted(merged)]
        del merged
        self.size = len(found)
        self.rows, self.toxic, self.keys = np.zeros(self.size), np.zeros(self.size), np.zeros(self.size, np.int64)
        for e, (n, y, key, _, _) in enumerate(found):
            self.rows[e], self.toxic[e], self.keys[e] = n, y, key
        self.weights = Weights([self.vector(t, c) for *_, t, c in found], self.size)
        self.lists = None

    def __getstate__(self):
        return self.__dict__ | {"lists": None}  # each worker makes its own

    def vector(self, terms, counts, more: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Weights of unit length; ``more`` is the squared weight of words that are no terms."""
        terms = np.asarray(terms, np.int32)
        w = (1 + np.log(np.asarray(counts, np.float64))) * self.idf[terms]
        return terms, (w / np.sqrt((w * w).sum() + more)).astype(np.float32)

    def example(self, e: int) -> tuple[np.ndarray, np.ndarray]:
        a, z = self.weights.first[e], self.weights.first[e + 1]
        return self.weights.terms[a:z], self.weights.values[a:z]

    def opened(self) -> Lists:
        if self.lists is None:
            self.lists = Lists(self.weights, len(self.idf))
        return self.lists

    def nearest(self, terms, counts, more: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(example numbers, cosines) of the NEAREST distinct vectors; ties go to the lower number."""
        return next(self.search([self.vector(terms, counts, more)]))

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The nearest of each of some vectors of unit length, in order."""
        for i in range(0, len(queries), TOGETHER):
            some, held = queries[i : i + TOGETHER], self.opened()
            places = [held.place[terms] for terms, _ in some]
            rows = np.zeros((len(some), held.dense.shape[1]), np.float32)
            for row, place, (_, w) in zip(rows, places, some, strict=True):
                row[place[place >= 0]] = w[place >= 0]
            products = rows @ held.dense
            for j, (place, (terms, w)) in enumerate(zip(places, some, strict=True)):
                common, product = place >= 0, products[:, j].ravel()[: self.size]
                yield self.chosen(held.summed(terms[~common], w[~common]), product, place[common], w[common])

    def chosen(self, rare: np.ndarray, product: np.ndarray, common: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest, of all examples that are among them by single-precision products, give or take SLACK."""
        near = rare + product
        least = np.partition(near, -NEAREST)[-NEAREST] if len(near) > NEAREST else 0.0
        found = np.flatnonzero((near > 0) & (near >= least - 2 * SLACK))
        score = rare[found] + self.opened().met(common, w, found)
        keep = np.lexsort((found, -score))[:NEAREST]
        return found[keep], score[keep]

    def vote(self, found: np.ndarray, score: np.ndarray, without: tuple[int, float] = (-1, 0.0)) -> float:
        """Share of toxic rows among the nearest, weighted by 1 / (distance + 0.05), with the share of
        all examples as one more row; ``without`` leaves one row of an example out."""
        n, y = self.rows[found].copy(), self.toxic[found].copy()
        own = found == without[0]
        n[own], y[own] = n[own] - 1, y[own] - without[1]
        w = 1 / (1.05 - score.astype(np.float64))
        # A vector of many rows counts as the logarithm of their number, with their share of toxic ones.
        share = np.divide(y, n, out=np.zeros_like(y), where=n > 0)
        w = w * np.log1p(n)
        return float(((w * share).sum() + self.prior) / (w.sum() + 1))

    def votes(self, examples: list[int]) -> Iterator[tuple[float, float, float]]:
        """(vote as a logit, rows, label) of examples judged by the others, for each label they have."""
        for e, (found, score) in zip(examples, self.search([self.example(e) for e in examples]), strict=True):
            of = ((1.0, self.toxic[e]), (0.0, self.rows[e] - self.toxic[e]))
            yield from ((logit(self.vote(found, score, (e, y))), float(n), y) for y, n in of if n)

    def judged(self, queries: list[tuple], curve: tuple[float, float]) -> Iterator[tuple[float, list[int], list[float]]]:
        """(score, keys and cosines of the three nearest toxic examples) of each (terms, counts, more)."""
        nearest = self.search([self.vector(*q) for q in queries if len(q[0])])
        for q in queries:
            if not len(q[0]):
                yield float(self.silent), [], []
                continue
            found, score = next(nearest)
            p = float(1 / (1 + np.exp(-(curve[0] * logit(self.vote(found, score)) + curve[1]))))
            bad = np.flatnonzero(self.toxic[found] > 0)[:3]
            yield p, self.keys[found[bad]].tolist(), score[bad].astype(float).tolist()


def logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def fitted(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The slope and shift of a logistic curve from votes to labels."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(30):  # Newton steps with a light pull to the identity
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([(n * (p - y) * x).sum() + (a - 1), (n * (p - y)).sum() + b])
        w = n * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    return (float(a), float(b)) if a > 0 and np.isfinite([a, b]).all() else (1.0, 0.0)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    parts: int = 5,
    held: int = 0,
    most: int = EXAMPLES,
) -> DataFrame:
    """(key, held_out, score, predicted, evidence, cosines) of every row.

    Labels are learned from rows of ``labels`` whose crc32(key as text) modulo ``parts`` is not
    ``held``, at most ``most`` of them; a text, and nothing else of a row, makes its score. Document
    frequencies are counted over all rows; a word no example has counts in a text's norm like one that no
    text has. Texts are read once; their term counts are stored, for frequencies and for scores. The index of at most ``most`` examples over all their words is
    broadcast; every row is searched exactly, with no limit on its length.

    A text without a word of the examples, a null or an empty one gets the share of toxic ones among such examples.
    Repeated rows are scored alike; a key with several labels is toxic if one says so; null labels are
    left out; without examples every score is a third. A null key counts as an
    empty text in crc32; other columns are left out.
    """
    spark = docs.sparkSession
    learned = published(examples(labels, key, label, parts, held, most), "examples")
    own = docs.select(F.col(key).cast("long").alias(key), text)
    rows = published(own.join(F.broadcast(learned), key), "labelled")  # at most ``most`` keys
    terms, factor = weighed_terms(rows, text)
    number = spark.sparkContext.broadcast(terms)

    def hits(t: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms in order, their counts, and the counts of words no example has."""
        found = counted(t)
        at, counts = number.value.find(list(found)), np.fromiter(found.values(), np.int32, len(found))
        known = at >= 0
        order = np.argsort(at[known])
        return at[known][order], counts[known][order], np.sort(counts[~known])

    size = len(terms)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            found = pa.array([packed(*hits(t)) for t in strings(batch, text)], pa.binary())
            yield pa.RecordBatch.from_pydict({key: batch.column(key), "hits": found})

    stored = published(own.mapInArrow(read, f"{key} long, hits binary"), "hits")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, np.int64)
        for batch in sliced(batches, "hits"):
            for b in batch.column("hits").to_pylist():
                counts[unpacked(b)[0]] += 1
                counts[size] += 1
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"t": pa.array(used, pa.int32()), "n": counts[used]})

    df = np.zeros(size + 1)
    frequencies = stored.select("hits").mapInArrow(summed, "t int, n long").groupBy("t").agg(F.sum("n").alias("n"))
    told = frequencies.toArrow()  # the examples' terms, and the number of rows
    df[told["t"].to_numpy()] = told["n"].to_numpy()
    idf = (np.log((df[size] + 1) / (df[:size] + 1)) + 1) * factor
    rare = float(np.log(df[size] + 1) + 1)  # of a word no example has

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text):
            found = [hits(t) for t in strings(batch, text)]
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "y": batch.column("y"),
                "terms": pa.array([t for t, _, _ in found], pa.list_(pa.int32())),
                "counts": pa.array([c for _, c, _ in found], pa.list_(pa.int32())),
            })

    known = rows.select(F.col(key).alias("key"), F.col("y").cast("long").alias("y"), text)
    known = known.mapInArrow(taken, "key long, y long, terms array<int>, counts array<int>").distinct()
    made = Index(known.toArrow().to_pandas(), idf)  # of the bounded examples
    pa.default_memory_pool().release_unused()  # what the collected rows took
    index = spark.sparkContext.broadcast(made)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            found = list(own.votes(batch.column("id").to_pylist()))
            yield pa.RecordBatch.from_pydict({c: pa.array([v[i] for v in found], pa.float64()) for i, c in enumerate("xny")})

    # Examples lie in the order of their likeness, so neighbours are dealt to different tasks.
    numbers = spark.range(made.size).repartition(4 * spark.sparkContext.defaultParallelism)
    votes = numbers.mapInArrow(voted, "x double, n double, y double").toArrow()
    curve = fitted(*[votes[c].to_numpy() for c in "xny"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = index.value, {}
        for batch in sliced(batches, "hits"):
            names, new = batch.column("hits").to_pylist(), {}
            if len(seen) > 10_000:
                seen.clear()
            for name in names:
                if name not in seen and name not in new:
                    t, c, other = unpacked(name)
                    w = (1 + np.log(other)) * rare
                    new[name] = t, c, float((w * w).sum())
            seen.update(zip(new, own.judged(list(new.values()), curve), strict=True))
            out = [seen[name] for name in names]
            yield pa.RecordBatch.from_pydict({
                key: batch.column(key), "score": pa.array([o[0] for o in out], pa.float64()),
                "evidence": pa.array([o[1] for o in out], pa.list_(pa.int64())),
                "cosines": pa.array([o[2] for o in out], pa.list_(pa.float64())),
            })

    judged = stored.mapInArrow(judge, f"{key} long, score double, evidence array<bigint>, cosines array<double>")
    name = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return judged.select(
        key, (F.crc32(name) % parts == held).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "cosines",
    )
