"""Array kernels over batches of texts: words, shingles and set intersections, without a Python loop per word.

A word is a maximal run of letters, marks and digits of the lower-cased text. A shingle is a run of ``k``
words, hashed to 64 bits; a text of fewer words (but at least one) has one shingle made of all of them.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Characters that one pass holds at a time (about 60 bytes each).
PASS_CHARS = 400_000


@functools.cache
def word_chars() -> np.ndarray:
    """For each code point, whether it is a letter, mark or digit."""
    table = np.zeros(0x110000, dtype=bool)
    for i in range(0x110000):
        table[i] = unicodedata.category(chr(i))[0] in "LMN"
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit moves about half of the output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_powers = np.ones(1, dtype=U)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 256), 0x9E3779B97F4A7C15 | 1, dtype=U)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def passes(texts: list[str | None], chars: int = PASS_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``chars`` characters together; a longer text is alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def word_spans(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, where each word starts and its length, and where each text's words start."""
    low = [t.lower() if t else "" for t in texts]
    ends = np.cumsum([len(t) + 1 for t in low])
    codes = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    edge = np.diff(word_chars()[codes].astype(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    lengths = np.flatnonzero(edge == -1) - starts  # the last character is never in a word
    return codes, starts, lengths, np.searchsorted(starts, np.concatenate(([0], ends)))


def hash_spans(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of code points (none empty)."""
    if not len(starts):
        return np.zeros(0, dtype=U)
    offset = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(offset, lengths)
    value = (codes[np.repeat(starts, lengths) + place].astype(U) + U(1)) * U(0xD6E8FEB86659FD93)
    value ^= value >> U(32)
    value *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, offset) + lengths.astype(U))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and for each text where its words start (one more at the end)."""
    codes, starts, lengths, first = word_spans(texts)
    return hash_spans(codes, starts, lengths), first


def shingle_sets(texts: list[str | None], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, and where each text's shingles start."""
    words, first = word_hashes(texts)
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[:-1][owner]
    have = np.minimum(count[owner], k)
    value = np.zeros(len(owner), dtype=U)
    for j in range(k):
        part = words[np.minimum(at + j, max(len(words) - 1, 0))] if len(words) else value
        value = np.where(have > j, mix(value * U(0x9E3779B97F4A7C15) + part), value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[keep], owner[keep]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(salt))


def minhash(values: np.ndarray, first: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """A row of ``n`` minima for each set; an empty set has the largest integer throughout."""
    out = np.full((len(first) - 1, n), np.iinfo(np.uint64).max, dtype=U)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        for j, s in enumerate(seeds(n, salt)):
            x = (values ^ s) * U(0xFF51AFD7ED558CCD)
            x ^= x >> U(32)
            x *= U(0xC4CEB9FE1A85EC53)
            out[full, j] = np.minimum.reduceat(x, first[:-1][full])
    return out


def set_keys(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits (two columns) that stand for each whole set; an empty set has zeros."""
    out = np.zeros((len(first) - 1, 2), dtype=U)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        for j, s in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            out[full, j] = mix(np.add.reduceat(mix(values ^ U(s)), first[:-1][full]) + np.diff(first)[full].astype(U))
    return out


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections. Values held by one set only are left out of the products."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.zeros((m, m), dtype=np.float32)
    out[np.arange(m), np.arange(m)] = sizes
    if m < 2 or not sizes.sum():
        return out.astype(np.int64)
    values, row = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, row = np.cumsum(new & shared)[shared] - 1, row[shared]
    total = np.zeros((m, m), dtype=np.float64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [lo, lo + columns])
        block = np.zeros((m, columns), dtype=np.float32)
        block[row[a:b], column[a:b] - lo] = 1
        total += block @ block.T
    total[np.arange(m), np.arange(m)] = sizes
    return np.rint(total).astype(np.int64)
