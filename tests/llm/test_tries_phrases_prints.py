"""op11 to op13 against plain versions, with nulls, empties, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fxtape.llm import phrases, prefix_trie, simhash_anchors
from fxtape.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def nodes(sequences: dict[int, tuple]) -> set[tuple]:
    """Every prefix of every sequence with its counts."""
    members, children = defaultdict(list), defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved, out = {}, {}, set()
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) or 1
        words = len(WORDS.findall(n[-1][1])) if n else 0
        saved[n] = (len(members[n]) - 1) * words + sum(saved[k] for k in children[n])
    for n, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(sequences[c]) == len(n))))
        out.add((
            min(of), len(n), min(members[n[:-1]]) if n else None, len(of), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


@pytest.fixture(scope="module")
def chats() -> list[tuple]:
    """Few distinct turns, so prefixes are shared; whole copies; one long conversation; nulls."""
    rnd = random.Random(5)
    rows = []
    for c in range(400):
        for t in range(rnd.randint(1, 6)):
            rows.append((c, t, rnd.choice(["user", "bot"]), rnd.choice(["a b", "c", "d e f", ""])))
    for c in range(1000, 1100):
        rows += [(c, 0, "user", "same start"), (c, 1, "bot", "same end")]
    rows += [(2000, t, "user", f"turn {t % 7}") for t in range(900)]
    rows += [(3001, None, None, None), (3001, 2, "user", None), (3001, 1, None, "x"), (None, 1, "user", "lost")]
    rows += [(3002, 1, "user", "twice"), (3002, 1, "user", "twice"), (3003, 0, "u", "ab"), (3003, 0, "ua", "b")]
    return rows


def frame(spark, rows):
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return made.withColumns({"id": F.lit("x"), "words": F.lit(0), "depth": F.lit(1), "key": F.lit(None).cast("string")})


@pytest.mark.parametrize("limits", [(200_000, 64, 4), (50, 2, 9)])
def test_trie_equals_all_prefixes(spark, chats, limits, monkeypatch):
    turns, run, shards = limits
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "RUN", run)
    coded = prefix_trie.encoded(frame(spark, chats).repartition(5))
    got = [tuple(r) for r in prefix_trie.tried(coded, shards).collect()]
    by = defaultdict(list)
    for c, t, role, text in chats:
        if c is not None and c != 3003:
            by[c].append(((t is not None, t or 0), (role or "", text or "")))
    plain = {c: tuple(turn for _, turn in sorted(rows)) for c, rows in by.items()}
    order = sorted(
        [("u", "ab"), ("ua", "b")], key=lambda p: hashlib.sha256(f"{len(p[0])}:{p[0]}{p[1]}".encode()).hexdigest()
    )
    plain[3003] = tuple(order)
    assert len(got) == len(set(got))
    assert set(got) == nodes(plain)


def test_rebuilt_conversations(spark, chats):
    turns = prefix_trie.encoded(frame(spark, chats).where("conv_id < 1000 AND conv_id % 20 <> 0 OR conv_id < 200"))
    ids = {r.conv_id: [t.id for t in r.turns] for r in turns.collect()}
    got = {r.conv_id: [t.id for t in r.turns] for r in prefix_trie.rebuilt(turns).collect()}
    for c, own in ids.items():
        h = zlib.crc32(str(c).encode()) % 4
        assert got[c] == ids.get(c - c % 20, [])[:h] + own[h:]
    assert [] in got.values()
    root = prefix_trie.tried(prefix_trie.rebuilt(turns)).where("depth = 0").first()
    empty = sorted(c for c, turns in got.items() if not turns)
    assert root.n_convs == len(ids)
    assert root.ends_sha256 == hashlib.sha256(",".join(map(str, empty)).encode()).hexdigest()


def test_trie_of_nothing(spark):
    assert prefix_trie.tried(prefix_trie.encoded(frame(spark, []))).count() == 0


def test_balanced_tree():
    tree = prefix_trie.TernaryTree([([i], [1], 1, i, "") for i in range(1, 1024)])

    def height(node: int) -> int:
        return node and 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.child[0]) == 10


def plain_collocations(docs: list[tuple], least: int, top: int) -> set[tuple]:
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if a >= found[p[i : i + k]]
        }
        scored = []
        for p, a in found.items():
            if p not in gone:
                s, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for i, (s, a, p, left, r) in enumerate(sorted(scored)[:top]):
            out.add((lang, i + 1, p.decode(), -a, left, r, n[lang], -s))
    return out


@pytest.mark.parametrize("least,top", [(12, 2000), (3, 2000), (3, 7)])
def test_collocations_equal_counting_everything(spark, least, top):
    rnd = random.Random(3)
    words = ["a", "Bb", "é", "Ée", "the", "x\x1cy", "中文", "nul\0l"] + [f"w{i}" for i in range(30)]
    docs = []
    for _ in range(150):
        text = "".join(rnd.choice(words[: rnd.randint(2, 38)]) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n"])
                       for _ in range(rnd.randint(1, 60)))
        docs.append((rnd.choice(["en", "de", None, "und"]), text))
    docs += [("en", "to be or not to be"), ("fr", None), ("fr", ""), (None, " .,; "), ("en", "go go go go go go go")] * 15
    docs.append(("en", "far too long " * 30000))
    made = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, lang string, text string")
    made = made.withColumns({"n": F.lit("x"), "w0": F.lit(1), "phrase": F.lit(None).cast("int")}).repartition(4)
    got = [tuple(r) for r in phrases.collocations(made, least=least, top=top).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_collocations(docs, least, top)


def test_collocations_beyond_64_bits(spark):
    made = spark.createDataFrame(
        [("en", "a b", 2, ["a", "b"], 3 * 10**9), ("en", "a", 1, ["a"], 4 * 10**9), ("en", "b", 1, ["b"], 5 * 10**9)],
        "lang string, phrase string, size int, words array<string>, f long",
    )
    totals = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    row = phrases.ranked(made, totals, 10).first()
    assert row.score == 1000 * 3 * 10**9 * 10**13 // (4 * 10**9 * 5 * 10**9)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "doc_id long, lang string, text string")).count() == 0


def plain_print(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(len(words) - 2, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], most: int = 3) -> dict[int, int]:
    label = {p: p for p in prints}

    def root(p: int) -> int:
        while label[p] != p:
            p = label[p]
        return p

    values = np.array(sorted(label), np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ v) <= most):
            a, b = root(int(v)), root(int(values[i + 1 + j]))
            label[max(a, b)] = min(a, b)
    return {p: root(p) for p in label}


def near_prints(rnd: random.Random, crowd: int) -> list[int]:
    """Chains of fingerprints a few bits apart, pairs at 3 and 4 bits, and a crowd around one value."""
    out = {0, (1 << 64) - 1}
    for _ in range(300):
        p = rnd.getrandbits(64)
        out.add(p)
        for _ in range(rnd.randint(1, 4)):
            for bit in rnd.sample(range(64), rnd.choice([1, 2, 3, 3, 4])):
                p ^= 1 << bit
            out.add(p)
    centre = rnd.getrandbits(64)
    for _ in range(crowd):
        p = centre
        for bit in rnd.sample(range(64), rnd.randint(0, 9)):
            p ^= 1 << bit
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("crowd,limit", [(0, 1024), (2500, 64)])
def test_anchors_lose_no_link(spark, crowd, limit, monkeypatch):
    monkeypatch.setattr(simhash_anchors, "CROWD", limit)
    prints = near_prints(random.Random(9), crowd)
    made = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print long").repartition(3)
    found = simhash_anchors.links(made)
    got = {r.node: r.component for r in components(found).collect()}
    want = plain_components(prints)
    signed = {p: int(np.uint64(p).view(np.int64)) for p in prints}
    groups, plain = defaultdict(set), defaultdict(set)
    for p in prints:
        groups[got.get(signed[p], signed[p])].add(p)
        plain[want[p]].add(p)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in plain.values()}


def test_every_pair_meets_at_a_home():
    rnd = random.Random(1)
    values = np.array([rnd.getrandbits(32) for _ in range(2000)], np.uint32)
    at, anchor = simhash_anchors.anchors(values)
    assert np.bitwise_count(values[at] ^ anchor).max() == 2
    assert len({*zip(at.tolist(), anchor.tolist(), strict=True)}) == len(at) <= 17 * len(values)
    visited = {*zip(at.tolist(), anchor.tolist(), strict=True)}
    for bit in [None, *range(32)]:
        other = values if bit is None else values ^ np.uint32(1 << bit)
        assert all((i, h) in visited for i, h in enumerate(simhash_anchors.home(other).tolist()))
    assert np.bitwise_count(values ^ simhash_anchors.home(values)).max() <= 1


def test_simhash_components(spark):
    rnd = random.Random(4)
    base = [" ".join(rnd.choice(["Ab", "c", "dé", "x\x1cy", "zz"]) + str(rnd.randint(0, 99)) for _ in range(n)) for n in (1, 2, 3, 40, 900, 4000)]
    texts = [*base, *base[:4], None, "", " \n\t", "one two", "ONE\ttwo", "word " * 50000]
    words = base[5].split(" ")
    for _ in range(30):
        changed = list(words)
        changed[rnd.randrange(len(words))] = "new"
        texts.append(" ".join(changed))
    rows = [(i + 10, t) for i, t in enumerate(texts)] + [(3, base[0]), (10, base[1]), (None, base[2]), (None, "alone here now")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    made = made.withColumns({"print": F.lit("x"), "first": F.lit(1), "key": F.lit(2), "component_id": F.lit(0)}).repartition(3)
    got = sorted(simhash_anchors.joined(made).collect(), key=str)
    prints = [(k, plain_print(t)) for k, t in rows]
    group = plain_components([p for _, p in prints])
    least = defaultdict(list)
    for k, p in prints:
        least[group[p]] += [] if k is None else [k]
    want = [(k, f"{p:016x}", min(least[group[p]], default=None)) for k, p in prints]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_simhash_of_nothing(spark):
    assert simhash_anchors.joined(spark.createDataFrame([], "doc_id long, text string")).count() == 0
