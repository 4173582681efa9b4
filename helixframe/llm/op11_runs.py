"""Periodic runs of words: Lyndon stacks under both orders, extended by longest common extensions.

A run is a stretch of consecutive words with smallest period q, of at least ``max(least, 2 * q)`` words, that no neighbouring
word extends keeping that period. By the runs theorem the longest Lyndon word at some place of the run, under the order of
the words or under its inverse, is as long as the period. So one stack for each order, filled from right to left, names a
period for every place; the stretch around it is extended to both sides, and what is long enough is a run.

Stack and extension compare suffixes by longest common extensions (LCE): a few words one by one, then binary search on
prefix hashes modulo 2**61 - 1. Every stretch that a hash calls equal is compared word by word (stretches of one distance
that were compared before are not compared again); should a hash err, the text is done again with another base. No suffix
array is built.

The stack visits only words that can lie in a run: one of at least ``least`` words repeats within itself at the distance
of its period, so each of its words lies in a window of ``least // 2`` words that the text has twice. Texts are cut at all
other words beforehand; nothing is lost, as a run lies between two cuts.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text and are equal if their bytes are. A null or empty text has no words, no run
and an empty collapsed text. Texts of any length are done whole, in memory that grows with the longest text. Rows are
independent: repeated ones have equal results, nulls in the id and clashing names do no harm, an empty table gives an empty one.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .op10_pieces import joined
from .session import arrow_map, prepare, table

LEAST = 12
MODULUS, BASES = (1 << 61) - 1, (1_000_003_000_017, 777_767_777_000_061, 123_456_789_000_107)
#: Words that are compared one by one before hashes are asked.
DIRECT = 8
Run = tuple[int, int, int]


class HashError(Exception):
    """Two stretches have one hash and different words."""


class Words:
    """Words as numbers, with LCE queries."""

    def __init__(self, words: list[int], base: int):
        self.words, self.n = words, len(words)
        self.sums = list(itertools.accumulate(words, lambda h, w: (h * base + w + 1) % MODULUS, initial=0))
        self.powers = list(itertools.accumulate(itertools.repeat(base, self.n), lambda p, b: p * b % MODULUS, initial=1))
        self.compared: dict[int, tuple[int, int]] = {}  # distance: the last stretch found equal at it, up to its right end

    def same(self, i: int, j: int, k: int) -> bool:
        h, p = self.sums, self.powers[k]
        return (h[i + k] - h[i] * p - h[j + k] + h[j] * p) % MODULUS == 0

    def verified(self, i: int, j: int, k: int) -> None:
        if self.words[i : i + k] != self.words[j : j + k]:
            raise HashError

    def ahead(self, i: int, j: int) -> int:
        """Words that are equal from ``i`` and ``j`` > ``i`` on."""
        w, d, most = self.words, j - i, self.n - j
        low, high = self.compared.get(d, (self.n + 1, self.n + 1))
        if low <= i <= high:
            return high - i
        k, near = 0, min(DIRECT, most)
        while k < near and w[i + k] == w[j + k]:
            k += 1
        if k < DIRECT or k == most:
            return k
        over = most + 1  # k words are equal, that many are not
        while over - k > 1:
            middle = (k + over) // 2
            if self.same(i, j, middle):
                k = middle
            else:
                over = middle
        if i < low <= i + k:
            self.verified(i, j, low - i)
            if i + k != high:
                raise HashError
        else:
            self.verified(i, j, k)
        self.compared[d] = (i, i + k)
        return k

    def behind(self, i: int, j: int) -> int:
        """Words that are equal before ``i`` and ``j`` > ``i``."""
        w, k, near = self.words, 0, min(DIRECT, i)
        while k < near and w[i - 1 - k] == w[j - 1 - k]:
            k += 1
        if k < DIRECT or k == i:
            return k
        over = i + 1
        while over - k > 1:
            middle = (k + over) // 2
            if self.same(i - middle, j - middle, middle):
                k = middle
            else:
                over = middle
        self.verified(i - k, j - k, k)
        return k

    def smaller(self, i: int, j: int, inverse: bool) -> bool:
        """Whether the suffix at ``j`` is smaller than that at ``i`` < ``j``; of a word and its beginning the latter is, in both orders."""
        w = self.words
        k = self.ahead(i, j) if w[i] == w[j] else 0
        return j + k == self.n or (w[j + k] > w[i + k] if inverse else w[j + k] < w[i + k])

    def runs(self, least: int) -> set[Run]:
        w, n, found = self.words, self.n, set()
        for inverse in (False, True):
            stack = [n]  # the starts of the Lyndon words that follow, the nearest last
            extended: dict[int, tuple[int, int]] = {}  # distance: the last stretch extended to both sides
            for i in range(n - 1, -1, -1):
                while (j := stack[-1]) < n and not self.smaller(i, j, inverse):
                    stack.pop()
                stack.append(i)
                d = j - i
                low, high = extended.get(d, (n + 1, n))
                if low <= i <= high:
                    continue
                right = self.ahead(i, j) if j < n and w[i] == w[j] else 0
                left = self.behind(i, j) if i and w[i - 1] == w[j - 1] else 0
                if left or right:
                    extended[d] = (i - left, i + right)
                    if left + right >= max(d, least - d):
                        found.add((i - left, left + right + d, d))
        return found


def runs_of(words: list[int], least: int = LEAST) -> list[Run]:
    """All runs (start, length, period) of a list of numbers of 0 or more, by start and then period."""
    for base in BASES:
        try:
            return sorted((s, n, q) for s, n, q in Words(words, base).runs(least))
        except HashError:
            continue
    raise ValueError("hashes of every base fail on a text")


def stretches(ids: np.ndarray, text: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The parts of the row of all texts' words that windows occurring twice in one text cover, cut between texts."""
    n = len(ids) - width + 1
    if n < 2:
        return []
    with np.errstate(over="ignore"):
        h = text[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(width):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[k : n + k].astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    inside = np.flatnonzero(text[:n] == text[width - 1 :])
    order = inside[np.argsort(h[inside])]
    equal = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(ids) + 1, np.int64)
    starts = np.unique(order[np.flatnonzero(np.append(equal, False) | np.insert(equal, 0, False))])
    if not len(starts):
        return []
    np.add.at(twice, starts, 1)
    np.add.at(twice, starts + width, -1)
    covered = np.cumsum(twice[:-1]) > 0
    edge = np.ones(len(ids) + 1, bool)
    edge[1:-1] = (covered[1:] != covered[:-1]) | (text[1:] != text[:-1])
    edges = np.flatnonzero(edge)
    return [(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) if covered[a]]


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST) -> list[list[Run]]:
    """The runs of each list of words."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.fromiter(map(numbers.__getitem__, itertools.chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    first, text = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(texts)), sizes)
    out: list[list[Run]] = [[] for _ in texts]
    for a, b in stretches(ids, text, max(1, least // 2)):
        if b - a >= least:
            t = int(text[a])
            shift = a - int(first[t])
            out[t] += [(s + shift, n, q) for s, n, q in runs_of(ids[a:b].tolist(), least)]
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The words that no run holds after its first period, joined by a space."""
    if runs:
        kept = bytearray(b"\1") * len(words)
        for s, n, q in runs:
            kept[s + q : s + n] = bytes(n - q)
        words = list(itertools.compress(words, kept))
    return b" ".join(words).decode()


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``id_col``, ``runs`` (by start and then period) and ``collapsed`` (the text without repetitions) for every row."""
    prepare(df.sparkSession)
    given = df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for keys, texts in joined(batches):
            words = [t.encode().split() for t in texts]  # of bytes, split() knows \x20 and \x09-\x0D alone
            found = runs_of_texts(words, least)
            rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
            yield [keys, pa.array(rows, kind), pa.array(map(collapsed, words, found), pa.string())]

    return arrow_map(given, run, [(id_col, given.schema.fields[0].dataType), ("runs", RUNS), ("collapsed", "string")])


def with_planted_tails(id_: Column, text: Column) -> Column:
    """The text; where the crc32 of the id (decimal) ends in 0, its words from some place on repeat with some period."""
    h = F.crc32(id_.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")

    words = F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda x: x != "")
    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(""))
    return F.when(h % 10 == 0, F.get(planted, F.lit(0))).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", with_planted_tails(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES = {"op11_runs": op11_runs}
ORACLES: dict[str, str] = {}
