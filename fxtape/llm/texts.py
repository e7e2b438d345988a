"""Texts inside tasks: bounded slices of Arrow batches, pieces between white space, word hashes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; one longer text is handled alone.
SLICE_BYTES = 1 << 21
CACHE_PIECES = 800_000

# White space in the Unicode sense, as the patterns of byte-level tokenizers use it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Cuts only where every byte-level pattern cuts: before a space that a visible character follows,
# and around other white space. A piece is tokenized alone, so equal pieces are tokenized once.
PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Cuts where GPT-2's pattern cuts as well: behind a run of A-Z from a cut on, if another ASCII character
# follows. Words with and without a comma are one piece then; a run that may go on in other letters stays whole.
LETTER_PIECES = re.compile(r" ?[A-Za-z]++(?![^\x00-\x7F])|" + PIECES.pattern)


def sliced(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds ``most`` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group, total, start = 0, 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows > start:
            yield batch.slice(start)


def strings(batch: pa.RecordBatch, text: str) -> list[str]:
    return [t or "" for t in batch.column(text).to_pylist()]


class PieceCache:
    """Ids of pieces as little-endian 32-bit bytes, kept while a Python worker lives and bounded."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], cuts: re.Pattern = PIECES):
        self.encode, self.cuts, self.known = encode, cuts, {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        cut = [self.cuts.findall(t) for t in texts]
        known = self.known
        new = list(set().union(*cut).difference(known))
        if new:
            known.update(zip(new, self.encode(new), strict=True))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in cut]


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(n: int, most: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse for i up to ``n``, kept for slices of ``most`` bytes only."""
    usual = most + (most >> 2)
    size = max(n, usual)
    if size not in _POWERS:
        both = tuple(np.full(size, x, np.uint64) for x in (BASE, INVERSE))
        for a in both:
            a[0] = 1
            np.multiply.accumulate(a, out=a)
        if size > usual:
            return both
        _POWERS[size] = both
    return _POWERS[size]


class Words:
    """The words of some texts: 64-bit hashes in order, and where each text's words begin and end.

    A word is a run of bytes other than space and the controls 9 to 13, with A-Z lower-cased. Its hash
    is a polynomial over random byte values, taken for all words at once from running sums; it does not
    depend on ``most``, the bytes of text that a caller usually hands over at once.
    """

    def __init__(self, texts: list[str], most: int = SLICE_BYTES):
        parts = [t.encode() for t in texts]
        ends = np.cumsum([len(p) + 1 for p in parts]) if parts else np.zeros(0, np.int64)
        raw = np.frombuffer((b"\n".join(parts) + b"\n").lower(), np.uint8)
        space = IS_SPACE[raw]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
        self.start, self.stop = edge[::2], edge[1::2]
        up, down = powers(len(raw) + 1, most)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.multiply(BYTE_VALUES[raw], up[: len(raw)], out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        value = (total[self.stop] - total[self.start]) * down[self.start]
        self.hash = mixed(value + (self.stop - self.start).astype(np.uint64))
        self.last = np.searchsorted(self.start, ends)
        self.first = np.concatenate([[0], self.last[:-1]]).astype(np.int64) if len(parts) else self.last
        self.raw = raw

    def windows(self, size: int) -> np.ndarray:
        """The hash of the ``size`` words from each word on; the last ones of a text run over its end."""
        n, h = len(self.hash), np.zeros(len(self.hash), np.uint64)
        for k in range(size):
            h[: n - k] += self.hash[k:] * np.uint64((BASE * (2 * k + 1)) % (1 << 64) | 1)
        return mixed(h)

    def shingles(self, size: int) -> list[np.ndarray]:
        """The sorted distinct window hashes of each text; fewer words make one shingle of them all."""
        window, out = self.windows(size), []
        for a, b in zip(self.first.tolist(), self.last.tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(window[a : b - size + 1]))
            elif b > a:
                short = np.zeros(1, np.uint64)
                for k in range(a, b):
                    short = mixed(short + self.hash[k : k + 1] + np.uint64(b - a))
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
        return out
