"""Every operator against a plain version, and on nulls, empty and long texts, ties and extra columns."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fxtape.llm import (
    bpe, cgk, line_dedup, ngram_join, quality_rules, quotes, simple8b, suffix_tree, toxicity, url_filter,
)
from fxtape.llm.components import components
from fxtape.llm.queries import URL_RULES
from fxtape.llm.texts import Words

SPACE = " \t\n\x0b\x0c\r"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")


def prose(rnd: random.Random, n: int) -> list[str]:
    return ["".join(rnd.choice(["th", "er", "on", "an", "re"]) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    """Prose, near and exact copies, repeated lines, odd characters, one long text, null and empty ones."""
    rnd = random.Random(11)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(60):
        lines = [" ".join(prose(rnd, rnd.randint(3, 25))) + "." for _ in range(rnd.randint(1, 6))]
        rows.append((i, "\n".join(lines)))
    for i in range(60, 90):
        words = rows[rnd.randrange(12)][1].split(" ")
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = prose(rnd, 1)[0]
        rows.append((i, " ".join(words)))
    rows += [(90, None), (91, ""), (92, " \n\t "), (93, "one"), (94, "One\ttwo"), (95, "a  b\x1c\x85 c　d"),
             (96, rows[3][1]), (97, "x" * 3000 + " éßñ 中文 🙂 don't 12½ <|endoftext|>\r\n\n  end"),
             (98, " ".join(prose(rnd, 20000))), (99, "ab " * 200), (7, rows[7][1]), (None, rows[5][1]),
             (None, "only here and nowhere else at all")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns whose names clash with those the operators use inside."""
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    return frame.withColumns({"n": F.lit(1), "row": F.lit("x"), "k": F.lit(None).cast("string"), "score": F.lit(0)}).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def byte_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 3), (200, 201), (201, 202), (7, 7), (None, 5), (200, 201)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {i: 0 for i in [*range(41), 100]} | {i: 200 for i in (200, 201, 202)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_hashed_alike_and_apart():
    words = [b"a", b"b", b"ab", b"ba", b"aa", b"a" * 70, "é".encode()]
    texts = [" ".join(w.decode() for w in words), "AB\tba", "", "  "]
    found = Words(texts)
    assert len(set(found.hash[: len(words)].tolist())) == len(words)
    assert found.hash[len(words)] == found.hash[2] and found.first.tolist() == [0, 7, 9, 9]


def test_quality_measures(docs, texts):
    def repeated(words):
        seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        return len({i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)})

    found = Counter(
        tuple(r[:7]) for r in quality_rules.judged(docs).select(
            "doc_id", *[F.col("quality")[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
        ).collect()
    )
    wanted = Counter()
    for key, text in texts:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        again = repeated(words)
        failed = len(words) < 50 or 100 * again > 50 * len(words)
        wanted[key, len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), again, failed] += 1
    assert found == wanted


def test_quality_keeps_columns(docs, nothing):
    kept = quality_rules.kept(docs.withColumn("quality", F.lit(3)))
    assert kept.columns == [*docs.columns, "quality"] and 0 < kept.count() < docs.count()
    assert quality_rules.kept(nothing).count() == 0


@pytest.mark.parametrize("top", [2, 300, 50257, 2**32, 2**60, 2**64])
def test_simple8b_words(top):
    rnd = np.random.default_rng(top % 97)
    for n in (0, 1, 5, 1023, 1024, 1025, 4000):
        ids = rnd.integers(0, top, n, dtype=np.uint64)
        ids[::7] %= 3
        assert (simple8b.unpacked(*simple8b.packed(ids), n) == ids).all()


def test_simple8b_files(docs, texts, nothing):
    model = Tokenizer.from_file(MODEL)
    model.encode_special_tokens = True
    found = [tuple(r) for r in simple8b.round_trip(docs, MODEL).collect()]
    ids = {t: [*model.encode(t or "", add_special_tokens=False).ids, 2] for _, t in texts}
    start, wanted = 0, []
    for key, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        own = ids[text]
        wanted.append((key, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(found, key=lambda r: r[1]) == wanted
    assert simple8b.round_trip(nothing, MODEL).count() == 0


def test_bpe_is_the_librarys(docs, texts, nothing):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = Counter(map(tuple, bpe.encoded(docs, RANKS, public_tokenizers.PATTERN).collect()))
    wanted = Counter()
    for key, text in texts:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        wanted[key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert found == wanted
    assert bpe.encoded(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_trees_agree():
    with open(RANKS, "rb") as file:
        vocabulary = bpe.Vocabulary(file.read())
    rnd = random.Random(2)
    pieces = ["".join(rnd.choice("abeth ñ") for _ in range(rnd.randint(1, 30))).encode()[:60] for _ in range(300)]
    rows = bpe.merged_rows(pieces, 64, vocabulary)
    assert all((a == bpe.merged_long(p, vocabulary)).all() for a, p in zip(rows, pieces, strict=True))


def fitted(item: list, text: list) -> int:
    row = [0] * (len(text) + 1)
    for w in item:
        new = [row[0] + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (w != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_cgk_recall_and_exactness(spark):
    rnd = random.Random(4)
    items = [(i, " ".join(prose(rnd, rnd.randint(1, 50)))) for i in range(60)]
    items += [(60, None), (61, ""), (62, items[0][1])]
    rows = []
    for i, (_, text) in enumerate(items[:60] * 3):
        words = [w for w in text.split() if rnd.random() > 0.05]
        words = [prose(rnd, 1)[0] if rnd.random() < 0.05 else w for w in words]
        rows.append((i, " ".join([*prose(rnd, rnd.randint(0, 80)), *words, *prose(rnd, 30)])))
    rows += [(500, None), (501, ""), (502, items[5][1].upper()), (503, " ".join(prose(rnd, 500)))]
    found = cgk.searched(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {(r.doc_id, r.item_id): r.distance for r in found}
    wanted = {}
    for d, text in rows:
        for i, item in items:
            a, b = byte_words(item), byte_words(text)
            if a and (n := fitted(a, b)) <= len(a) * 20 // 100:
                wanted[d, i] = n
    assert set(got) <= set(wanted) and len(got) >= 0.95 * len(wanted)
    assert all(got[p] == wanted[p] for p in got)
    assert (502, 5) in got and not {500, 501} & {d for d, _ in got}
    assert {p for p, n in wanted.items() if n == 0} <= set(got)


def test_cgk_clean_keeps_the_rest(docs, nothing, spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    kept = cgk.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert cgk.clean(nothing, items).count() == 0
    assert cgk.clean(docs, items.where("false")).count() == docs.count()


def line_components(rows, size=line_dedup.SHINGLE, percent=line_dedup.PERCENT):
    at = defaultdict(list)
    for key, text in rows:
        for p, line in enumerate((text or "").split("\n")):
            if line.strip(SPACE):
                at[line].append((key is None, key or 0, p))
    lines = list(at)
    sets = [{x[i : i + size] for i in range(max(1, len(x) - size + 1))} for x in lines]
    parent = list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common * 100 >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, line in enumerate(lines):
        groups[root(i)] += at[line]
    return [(p, p == min(g)) for g in groups.values() for p in g]


def test_line_dedup(docs, texts, nothing):
    wanted = dict(line_components(texts))
    found = {
        (r.doc is None, r.doc or 0, r.pos): r.kept for r in line_dedup.verdicts(docs).collect()
    }
    assert set(found) == set(wanted)
    assert sum(found[p] != wanted[p] for p in found) <= 0.02 * len(found)
    out = line_dedup.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for row in out.where("doc_id < 60").collect():
        source = dict((k, t) for k, t in texts if k is not None)[row.doc_id].split("\n")
        kept = [x for p, x in enumerate(source) if found.get((False, row.doc_id, p), True)]
        assert row.text == "\n".join(kept)
    assert line_dedup.summary(nothing).count() == 0 and line_dedup.deduplicated(nothing).count() == 0


def test_line_blocks_of_a_large_cluster(spark):
    """A cluster over several blocks is verified whole: a chain and its strangers."""
    base = "abcdefghijklmnopqrstuvwxyz0123456789" * 4
    rows = [(i, base[:i] + "#" + base[i + 1 :]) for i in range(0, 140)]
    found = line_dedup.verdicts(spark.createDataFrame(rows, "doc_id long, text string"), block=8).where("kept").count()
    assert found == sum(kept for _, kept in line_components(rows))


def test_url_filter(spark):
    urls = [
        "http://a.com/x", "https://Example.COM/en/1?x#y", "http://www.example.com/en/2", "http://b.net/es/1",
        "http://b.net/de/1", "http://c.org/p", "http://d.org/", "no scheme", None, "http://", "http://example.com/en",
        "http://e.org/q", "ftp://x.fr.net/fr/", "http://com/", "http://notexample.com/en/", "http://f.org/z/#frag",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    edges = spark.createDataFrame(
        [("http://c.org/p", "http://b.net/es/9"), ("https://d.org", "http://c.org/p"), ("http://e.org/q", "http://b.net/fr/"),
         ("http://e.org/q", "http://www.example.com/en/"), (None, "http://c.org/p"), ("http://f.org/z", "bad")],
        "url string, target string",
    )
    found = {r.page_id: r for r in url_filter.filtered(pages, edges, URL_RULES).collect()}
    assert [found[i].rule for i in range(len(urls))] == [
        "com/", "example.com/en/", "www.example.com/en/", "net/es/", None, None, None, None, None, None, "com/", None,
        "net/fr/", "com/", "com/", None,
    ]
    assert [found[i].verdict == "block" for i in range(len(urls))] == [
        False, True, False, True, False, True, True, False, False, False, False, False, True, False, False, False,
    ]
    assert found[1].host == "example.com" and found[1].path == "/en/1" and found[7].host == found[8].path == ""
    assert found[11].source == "alias" and found[15].source == "default"
    assert url_filter.filtered(pages.where("false"), edges.where("false"), URL_RULES).count() == 0


def test_links_of_pages(spark):
    html = [
        (0, "http://a.org/x", '<head><LINK href="http://b.org/y" rel="canonical"><meta http-equiv=refresh content="0; URL=/z">'),
        (1, "http://a.org/x", "<link rel=stylesheet href=s.css>"), (2, None, None),
        (3, "https://c.org/1", "<link rel='canonical' href='//d.org/2'>"),
    ]
    pages = spark.createDataFrame(html, "page_id long, url string, html string")
    assert {tuple(r) for r in url_filter.link_edges(pages).collect()} == {
        ("http://a.org/x", "http://b.org/y"), ("http://a.org/x", "http://a.org/z"), ("https://c.org/1", "http://d.org/2"),
    }


def gram_components(rows, size, percent):
    def grams(text):
        w = byte_words(text)
        return frozenset(zip(*[w[i:] for i in range(size)], strict=False)) if len(w) >= size else frozenset([tuple(w)] if w else [])

    nodes = [(k, grams(t)) for k, t in rows]
    parent = {k: k for k, _ in nodes if k is not None}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (a, s) in enumerate(nodes):
        for b, o in nodes[:i]:
            if a is not None and b is not None and s and 100 * len(s & o) >= percent * len(s | o):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    equal = {s: min((root(k) for k, o in nodes if o == s and k is not None), default=None) for _, s in nodes if s}
    return Counter((k, len(s), root(k) if k is not None else equal.get(s)) for k, s in nodes)


@pytest.mark.parametrize("size,percent,wide,block", [(3, 90, 32, 128), (3, 60, 2, 4), (5, 80, 4, 8), (1, 50, 3, 2)])
def test_ngram_join(docs, texts, size, percent, wide, block):
    found = ngram_join.joined(docs, size=size, percent=percent, wide=wide, block=block).collect()
    assert Counter(map(tuple, found)) == gram_components(texts, size, percent)


def test_ngram_first_of_each(docs, texts, nothing):
    kept = ngram_join.first_of_each(docs, size=5, percent=80)
    gone = {k for k, _, c in gram_components(texts, 5, 80) if k is not None and k != c}
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k for k, _ in texts if k not in gone)
    assert ngram_join.joined(nothing).count() == 0


def test_suffix_tree(docs, texts, nothing):
    counts = Counter()
    for key, text in texts:
        if zlib.crc32(("" if key is None else str(key)).encode()) % 7 != 2:
            counts.update([*byte_words(text), None])
    total, space = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    found = sorted(suffix_tree.scored(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens))
    ordered = sorted(texts, key=lambda r: (r[0] is None, r[0] or 0, len(byte_words(r[1]))))
    for row, (key, text) in zip(found, ordered, strict=True):
        tokens = [*byte_words(text), None]
        base = sum(math.log10((counts[t] + 1) / space) for t in tokens)
        assert (row.doc_id, row.n_tokens, row.n_known, row.train_tokens) == (key, len(tokens), sum(t in counts for t in tokens), total)
        assert row.base_score == pytest.approx(base) and row.score < 0
    assert sum(r.score for r in found) > 1.02 * sum(r.base_score for r in found)
    assert suffix_tree.scored(nothing).count() == 0


def plain_tree(train, threshold):
    """The tree from dictionaries: log10 probability of a byte after a context."""
    bound, depth = suffix_tree.BOUND, suffix_tree.DEPTH
    grams = {depth: Counter()}
    for t in train:
        raw = bound * depth + t.encode().lower() + bound
        grams[depth].update(raw[i - depth : i + 1] for i in range(depth, len(raw)))
    for d in range(depth - 1, -1, -1):
        grams[d] = Counter(g[1:] for g in grams[d + 1])
    p, hand, saved = {}, {}, Counter()
    for d in range(depth + 1):
        less = suffix_tree.discounts(*[sum(n == i for n in grams[d].values()) for i in range(1, 5)])
        total, free = Counter(), Counter()
        for g, n in grams[d].items():
            total[g[:-1]] += n
            free[g[:-1]] += less[min(n, 3) - 1]
        for g, n in grams[d].items():
            q = p[g[1:]] if d else 1 / 256
            p[g] = (n - less[min(n, 3) - 1] + free[g[:-1]] * q) / total[g[:-1]]
            saved[g[:-1]] += n * math.log2(p[g] / q)
        hand.update({s: free[s] / total[s] for s in total})
    kept = {s for s in hand if len(s) < suffix_tree.ENDING or saved[s] >= threshold}
    kept |= {s[i:] for s in kept for i in range(len(s) + 1)}

    def score(context, byte):
        out = 0.0
        for d in range(depth, -1, -1):
            s = context[len(context) - d :]
            if s in kept:
                if s + byte in p:
                    return out + math.log10(p[s + byte])
                out += math.log10(hand[s])
        return out + math.log10(1 / 256)

    return score


@pytest.mark.parametrize("threshold", [0.0, 1.0, 30.0])
def test_suffix_tree_against_a_plain_one(spark, monkeypatch, threshold):
    rnd = random.Random(4)
    rows = [(i, " ".join(prose(rnd, 30)) + ("\0\1" if i % 3 else " é")) for i in range(40)]
    rows += [(40, None), (41, "ABRA cadabra " * 300), (0, rows[0][1]), (None, "unknown ~ text")]
    held = {k for k, _ in rows if zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2}
    plain = plain_tree([t or "" for k, t in rows if k not in held], threshold)
    bound, depth = suffix_tree.BOUND, suffix_tree.DEPTH
    wanted = []
    for k, t in rows:
        raw = bound * depth + (t or "").encode().lower() + bound
        wanted.append((k or -1, sum(plain(raw[i - depth : i], raw[i : i + 1]) for i in range(depth, len(raw)))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_tree, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(suffix_tree, "MERGED_CHUNKS", 2)
    monkeypatch.setattr("fxtape.llm.texts.SLICE_BYTES", 600)
    found = [(r.doc_id or -1, r.score) for r in suffix_tree.scored(frame, threshold=threshold).collect()]
    for (a, x), (b, y) in zip(sorted(found), sorted(wanted), strict=True):
        assert a == b and x == pytest.approx(y, rel=1e-5)


def test_suffix_tree_is_a_distribution():
    """The next byte's probabilities sum to one in every state."""
    codes, _ = suffix_tree.windows(["abra cadabra " * (i + 1) for i in range(6)])
    keys, counts = np.unique(codes, return_counts=True)
    own = suffix_tree.entries(keys, counts)
    less = [suffix_tree.discounts(*[int((own[d][1] == i).sum()) for i in range(1, 5)]) for d in range(3, 7)]
    low_levels = suffix_tree.trunk(*suffix_tree.shorter(own[3][0], 2))
    levels = suffix_tree.branches(keys, counts, less, low_levels, suffix_tree.THRESHOLD)
    for context in (b"", b"bra c", b"zzzzz", b"a cad"):
        head = int.from_bytes(context, "big") << 8
        every = np.array([head | b for b in range(256)], np.uint64)
        assert (10 ** suffix_tree.scores(levels, every)).sum() == pytest.approx(1)


@pytest.fixture(scope="module")
def judged(spark):
    rnd = random.Random(9)
    bad = ["idiot", "scum", "vile"]
    rows, labels = [], []
    for i in range(400):
        words = prose(rnd, 60)
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(bad).capitalize() + ","
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (0, rows[0][1]), (None, "what an idiot")]
    labels += [(0, 1), (2, None), (None, 1), (901, 0)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
        rows,
    )


def test_toxicity_on_held_out_rows(judged):
    docs, labels, rows = judged
    found = toxicity.scored(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert toxicity.scored(docs.where("false"), labels).count() == 0
    assert all(r.score == pytest.approx(1 / 3) for r in toxicity.scored(docs, labels.where("false")).collect())


def test_toxicity_search_is_exact():
    import pandas as pd

    rnd = np.random.default_rng(3)
    rows = pd.DataFrame([
        {"key": i, "y": int(rnd.integers(2)), "terms": t.tolist(), "counts": rnd.integers(1, 4, len(t)).tolist()}
        for i in range(500) for t in [np.sort(rnd.choice(40, rnd.integers(0, 6), replace=False))]
    ])
    index = toxicity.Index(rows, 1 + rnd.random(40))
    for _ in range(100):
        terms = np.sort(rnd.choice(40, 4, replace=False))
        found, score = index.nearest(terms, [1, 2, 1, 1])
        t, w = index.vector(terms, [1, 2, 1, 1])
        plain = w @ index.weights[t]
        best = [e for e in np.lexsort((np.arange(len(plain)), -np.round(plain, 5))) if plain[e] > 0][: toxicity.NEAREST]
        assert np.allclose(np.sort(score), np.sort(plain[best]), atol=1e-5)
        assert set(found) == set(np.flatnonzero(plain > plain[best[-1]] + 1e-5)) | (set(found) & set(np.flatnonzero(np.abs(plain - plain[best[-1]]) <= 1e-5)))


def test_quotes(spark):
    rows = [
        (1, 0, "Hello there.\nHow are you?\n\nSecond   par"), (1, 1, "On Monday X wrote:\n> Hello there.\n> HOW are you?\nFine."),
        (1, 2, ">> hello there.\n>> How are you?\n> Fine.\n\nGood\n"), (2, 0, "> Second par\nok"), (2, 1, None), (3, 0, ""),
        (None, 5, "> Fine."), (1, 3, "> nothing known\n> Good\nx > y"), (2, 2, "> ok\n> unknown line\nyes"), (2, 2, "> ok\n> unknown line\nyes"),
        (4, 0, "> ok\n"), (4, None, "> yes"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("level", F.lit("x"))
    passages, messages = quotes.linked(frame)
    links = {(r.conv, r.turn, r.level): (r.from_conv, r.from_turn) for r in passages.collect()}
    assert links == {
        (1, 1, 1): (1, 0), (1, 2, 2): (1, 0), (1, 2, 1): (1, 1), (1, 3, 1): (1, 2), (2, 0, 1): (1, 0), (2, 2, 1): (2, 0),
        (None, 5, 1): (1, 1), (4, 0, 1): (2, 0), (4, None, 1): (2, 2),
    }
    found = {(r.conv, r.turn): (r.reply_to, r.thread, r.clean) for r in messages.collect()}
    assert len(found) == messages.count() == 11
    assert found[1, 1] == (0, 0, "Fine.") and found[1, 2] == (1, 0, "Good") and found[1, 3] == (2, 0, "x > y")
    assert found[2, 2] == (0, 0, "yes") and found[2, 1] == (None, 1, "") and found[2, 0] == (None, 0, "ok")
    ordered = [(r.conv, r.turn) for r in quotes.conversations(frame).collect() if r.conv == 1]
    assert ordered == [(1, 0), (1, 1), (1, 2), (1, 3)]
    assert [t.count() for t in quotes.linked(frame.where("false"))] == [0, 0]
