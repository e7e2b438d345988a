"""Quotation links, threads and clean texts against a version that compares every message with every other."""

from __future__ import annotations

import random
import re

from fxtape.llm import quotes


def normal(text):
    lowered = text.translate(str.maketrans(quotes.UPPER, quotes.LOWER))
    return re.sub(r"[ \t\r\f\x0B\n]+", " ", lowered).strip(" ")


def parse(text):
    """(level, line, body) of every line."""
    out = []
    for line in text.split("\n"):
        prefix = re.match(quotes.PREFIX, line)
        prefix = prefix.group() if prefix else ""
        out.append([prefix.count(">"), line, normal(line[len(prefix):])])
    for here, below in zip(out, out[1:]):
        if here[0] == 0 and below[0] > 0 and re.search(quotes.ATTRIBUTION, here[1]):
            here[0] = -1
    return out


def passages(parsed):
    """(level, begin, bodies) of runs."""
    out, last = [], None
    for pos, (level, _, body) in enumerate(parsed):
        if not body:
            last = None
        elif level == last:
            out[-1][2].append(body)
        else:
            out.append((level, pos, [body]))
            last = level
    return out


def plain(rows):
    messages = {(c, t, x or "") for c, t, x in rows}
    found = {m: passages(parse(m[2])) for m in messages}
    stated = []
    for (c, t, _), runs in found.items():
        own = [(b, bodies) for level, b, bodies in runs if level == 0]
        if c is not None and t is not None and own:
            whole = [" ".join(bodies) for _, bodies in own]
            stated.append((c, t, {*whole, *[b for _, bodies in own for b in bodies], " ".join(whole)}))

    def origin(words, c, t):
        near = min((u for d, u, said in stated if d == c and words in said), default=None)
        if near is not None and t is not None and near < t:
            return c, near
        return min(((d, u) for d, u, said in stated if d != c and words in said), default=None)

    links, replies = {}, {}
    for (c, t, x), runs in found.items():
        for level, begin, bodies in runs:
            if level > 0:
                tried = (origin(w, c, t) for w in [" ".join(bodies), *bodies])
                links[c, t, x, level, begin] = next((o for o in tried if o), (None, None))
    for m in messages:
        own = [u for (*n, level, _), (d, u) in links.items() if tuple(n) == m and level == 1 and u is not None and d == m[0]]
        replies[m] = max(own, default=None)
    out = {}
    for m in messages:
        thread = m[1]
        while m[0] is not None and thread is not None:
            up = max((r for n, r in replies.items() if n[:2] == (m[0], thread) and r is not None), default=None)
            if up is None:
                break
            thread = up
        own = [k for k in links if k[:3] == m]
        clean = "\n".join(line for level, line, _ in parse(m[2]) if level == 0).strip(" \t\n\x0b\f\r")
        out[m] = (
            replies[m], thread, len(own), sum(links[k][1] is not None for k in own), max((k[3] for k in own), default=0), clean,
        )
    return links, out


def test_against_plain_version(spark):
    rnd = random.Random(5)
    words = ["yes", "No", "we  met", "at noon", "fine.", "x > y", "Later"]
    rows = []
    for conv in range(12):
        said = []
        for turn in range(rnd.randint(1, 7)):
            parts = []
            for _ in range(rnd.randint(0, 3)):
                if said and rnd.random() < 0.6:
                    pool = said if rnd.random() < 0.8 else [r[2] for r in rows if r[2]]
                    quoted = rnd.choice(pool).split("\n")
                    a = rnd.randrange(len(quoted))
                    if rnd.random() < 0.3:
                        parts.append("On Monday someone wrote:")
                    parts += [rnd.choice(["> ", ">", " >> "]) + q for q in quoted[a : a + rnd.randint(1, 3)]]
                parts += [" ".join(rnd.choices(words, k=rnd.randint(0, 4))) for _ in range(rnd.randint(0, 3))]
            text = "\n".join(parts)
            rows.append((conv, turn, text))
            said.append(text)
    long = "\n".join(f"line {i} of a long text" for i in range(5000))
    rows += [(20, 0, long), (20, 1, "> " + long.replace("\n", "\n> ") + "\nread"), (21, 0, "> line 4999 of a long text")]
    rows += [(None, 1, "> at noon\nyes"), (3, None, "> yes"), (4, 0, None), (5, 1, ""), rows[3], (6, 1, "another\n> yes")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    links, messages = plain(rows)
    found, told = quotes.linked(frame)
    texts = {(r.conv, r.turn, r.mark): r for r in told.collect()}
    marks = {(r.c, r.t, r.m): r.x for r in frame.selectExpr(
        "conv_id AS c", "turn AS t", "md5(coalesce(text, '')) AS m", "coalesce(text, '') AS x").distinct().collect()}
    assert {(k[0], k[1], marks[k]): (r.reply_to, r.thread, r.n_passages, r.n_linked, r.deepest, r.clean)
            for k, r in texts.items()} == messages
    assert {(r.conv, r.turn, marks[r.conv, r.turn, r.mark], r.level, r.begin): (r.from_conv, r.from_turn)
            for r in found.collect()} == links
    assert sum(v[1] is not None for v in links.values()) > 20
