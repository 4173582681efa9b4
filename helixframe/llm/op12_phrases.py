"""Phrase collocations: depth-limited count tries per shard, merged by prefix range.

1. A task cuts its texts into shards (``SHARD_WORDS`` words of one language, or one longer text) and counts each in a trie
   of the phrases of up to ``DEPTH`` words that begin at its words. The trie is serialised in sorted order: the words, and for each path that
   ends somewhere its words' numbers and count; a node's count is the sum of the paths below it. Tries go to the checkpoint folder, so texts are read once.
2. Prefix ranges are cut at paths (language, word, word, word) that a bounded number of tries name as their quantiles
   (``MARKS`` of each of at most ``MARKED`` tries). They decide how even the work is, not what comes out. As a range may begin inside a frequent word, a
   frequent word's phrases go to many ranges.
3. Every trie is cut at the ranges' bounds, and each range merges its parts from all tries: sorted runs of numbers in one
   stable sort. With each part come the trie's counts of the (at most four) nodes that lie on the range's bounds, so that these nodes too have
   their whole counts in the range that begins before them. Nodes of fewer than ``least`` occurrences go only then.
4. Walking the merged trie gives every phrase its left parts' counts (its ancestors). Right parts come along suffix links:
   pairs join the words they end with, then triples join those pairs, which bring both suffixes' counts.

Rules. Letters A-Z are lower-cased and nothing else is changed. ``[.,;:!?\\x0A-\\x0D]`` ends a piece, words are
``[^\\x20\\x09]+`` within pieces, phrases lie within pieces, and overlapping occurrences count. All counts are by language; a null language is
``und`` and adds to an ``und`` that is there. The score of a cut of a phrase with a occurrences into parts of l and r is
floor(1000000 a a / (l r)) in exact integers; the lowest cut counts, the shorter left part among equal ones. A pair that a longer candidate
of at least half its occurrences holds is dropped. Null and empty texts have no words; a language without words gives no rows. Repeated
rows count each time. Other columns are not read, so their names do no harm.
"""

from __future__ import annotations

import bisect
import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .session import arrow_map, prepare, table

LEAST, TOP, DEPTH = 10, 2000, 3
#: Words of a shard, paths that a range should have, marks of a trie, and tries that give marks.
SHARD_WORDS, RANGE_PATHS, MARKS, MARKED = 2_000_000, 2_000_000, 64, 2000
#: Parts into which a language's candidates are dealt before its first ones are taken.
PARTS = 256
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SPACED = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r", b" \n\n\n\n\n\n\n\n\n\n")
Path = tuple[bytes, bytes, bytes, bytes]


def tokens(texts: list[bytes]) -> list[bytes]:
    """The lower-cased words of all texts, a line feed between pieces, and empty strings where spaces meet."""
    return b"\n".join(texts).translate(LOWER).translate(SPACED).replace(b"\n", b" \n ").split(b" ")


class Trie:
    """Counts of paths of one to three words: ``words`` in byte order, ``paths`` (columns of numbers from 1, 0 for none) in order, ``counts``."""

    def __init__(self, words: list[bytes], paths: np.ndarray, counts: np.ndarray):
        self.words, self.paths, self.counts = words, paths, counts
        self.below = np.concatenate(([0], np.cumsum(counts)))

    @classmethod
    def of_tokens(cls, found: list[bytes]) -> Trie:
        numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        end, nothing = numbers[b"\n"], numbers[b""]
        ids = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
        known = list(numbers)[2:]
        order = sorted(range(len(known)), key=known.__getitem__)
        rank = np.zeros(len(known) + 2, np.int64)
        rank[np.array(order, np.int64) + 2] = np.arange(1, len(known) + 1)
        row = rank[ids[ids != nothing]]  # a piece's end is 0
        padded = np.concatenate((row, np.zeros(DEPTH - 1, np.int64)))
        paths = np.stack([padded[k : len(row) + k] for k in range(DEPTH)])
        for k in range(1, DEPTH):
            paths[k][paths[k - 1] == 0] = 0
        paths = paths[:, paths[0] > 0]
        assert end == 0
        return cls(*merged([([known[i] for i in order], paths, np.ones(paths.shape[1], np.int64))]))

    def place(self, path: tuple[bytes, ...]) -> int:
        """The number of paths before ``path``."""
        low, high = 0, len(self.counts)
        for k, word in enumerate(path):
            column, r = self.paths[k][low:high], 0
            if word:
                r = bisect.bisect_left(self.words, word)
                if r == len(self.words) or self.words[r] != word:
                    return low + int(np.searchsorted(column, r + 1))  # before all paths with a later word
                r += 1
            low, high = low + int(np.searchsorted(column, r)), low + int(np.searchsorted(column, r, "right"))
        return low

    def count(self, path: tuple[bytes, ...]) -> int:
        """Occurrences of the node ``path`` (without empty words)."""
        return int(self.below[self.place((*path[:-1], path[-1] + b"\0"))] - self.below[self.place(path)])

    def part(self, low: int, high: int) -> Trie:
        own = self.paths[:, low:high]
        there = np.zeros(len(self.words) + 1, bool)
        there[own] = True
        there[0] = False
        return Trie([self.words[r - 1] for r in np.flatnonzero(there).tolist()], np.cumsum(there)[own], self.counts[low:high])

    def dumped(self) -> bytes:
        """Sorted words, then the columns with their bytes of one place together; all of it compressed."""
        head = np.array([len(self.words), len(self.counts)], "<i8").tobytes()
        sizes = np.fromiter(map(len, self.words), "<u4", len(self.words)).tobytes()
        planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() for x in (self.paths.astype("<u4").ravel(), self.counts.astype("<i8"))]
        return zstandard.compress(b"".join([head, sizes, *planes, *self.words]), 1)

    @classmethod
    def loaded(cls, dump: bytes) -> Trie:
        raw = zstandard.decompress(dump)
        n, m = np.frombuffer(raw, "<i8", 2).tolist()
        at = 16 + 4 * n
        ends = np.cumsum(np.frombuffer(raw, "<u4", n, 16)).tolist()
        paths = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * DEPTH * m, at).reshape(4, -1).T).view("<u4").reshape(DEPTH, m)
        counts = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * m, at + 4 * DEPTH * m).reshape(8, -1).T).view("<i8").ravel()
        text = raw[at + (4 * DEPTH + 8) * m :]
        return cls([text[a:b] for a, b in zip([0, *ends], ends, strict=False)], paths.astype(np.int64), counts)

    def marks(self, lang: bytes, most: int) -> list[Path]:
        at = np.unique(np.linspace(0, len(self.counts) - 1, most + 1).astype(np.int64)[1:]) if len(self.counts) else []
        return [(lang, *(self.words[r - 1] if r else b"" for r in self.paths[:, i].tolist())) for i in at]


def merged(runs: list[tuple[list[bytes], np.ndarray, np.ndarray]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """One sorted trie of many: numbers are those of all words together, equal paths are added up."""
    if len(runs) == 1:
        words, paths = runs[0][:2]
    else:
        words = sorted(set().union(*(r[0] for r in runs)))
        number = dict(zip(words, range(1, len(words) + 1), strict=True))
        columns = []
        for own, paths, _ in runs:
            to = np.zeros(len(own) + 1, np.int64)
            to[1:] = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
            columns.append(to[paths])
        paths = np.concatenate(columns, axis=1)
    counts = np.concatenate([r[2] for r in runs])
    bits = len(words).bit_length()
    if DEPTH * bits <= 63:
        key = (paths[0] << (2 * bits)) | (paths[1] << bits) | paths[2]
        if len(runs) == 1:  # of windows, all counted once
            key, counts = np.unique(key, return_counts=True)
        else:
            order = np.argsort(key, kind="stable")  # merges the sorted runs
            key, counts = key[order], counts[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            key, counts = key[first], np.add.reduceat(counts, first) if len(first) else counts
        mask = (1 << bits) - 1
        return words, np.stack([key >> (2 * bits), (key >> bits) & mask, key & mask]), counts.astype(np.int64)
    order = np.lexsort(paths[::-1])
    paths, counts = paths[:, order], counts[order]
    first = np.flatnonzero(np.append(True, (paths[:, 1:] != paths[:, :-1]).any(axis=0))) if len(counts) else np.zeros(0, np.int64)
    return words, paths[:, first], np.add.reduceat(counts, first) if len(first) else counts


def _batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[bytes, list[bytes]]]:
    """Texts of one language, of about ``most`` words together or one longer text; what a task holds at a time is bounded too."""
    held: dict[bytes, tuple[list[bytes], int]] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            if not text:
                continue
            key = ("und" if lang is None else lang).encode()
            texts, size = held.get(key, ([], 0))
            texts.append(text)
            size += text.count(b" ") + 1
            held[key] = (texts, size)
            if size >= most:
                yield key, held.pop(key)[0]
            elif sum(s for _, s in held.values()) >= 2 * most:
                largest = max(held, key=lambda k: held[k][1])
                yield largest, held.pop(largest)[0]
    for key, (texts, _) in held.items():
        yield key, texts


def shard_tries(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang``, ``trie`` (serialised), ``words``, ``paths`` and ``marks`` for every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for lang, texts in _batches(batches, SHARD_WORDS):
            trie = Trie.of_tokens(tokens(texts))
            if len(trie.counts):
                marks = [[list(m) for m in trie.marks(lang, MARKS)]]
                yield [pa.array([lang]), pa.array([trie.dumped()]), pa.array([int(trie.below[-1])]), pa.array([len(trie.counts)]), pa.array(marks, pa.list_(pa.list_(pa.binary())))]

    given = docs.select(F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`"))
    return arrow_map(given, run, [("lang", "binary"), ("trie", "binary"), ("words", "bigint"), ("paths", "bigint"), ("marks", "array<array<binary>>")])


def bounds_of(tries: DataFrame) -> list[Path]:
    """Paths that cut all tries into ranges of about ``RANGE_PATHS`` paths. At most ``MARKS`` x ``MARKED`` marks reach the driver."""
    total, count = tries.agg(F.sum("paths"), F.count("*")).first()
    ranges = -(-(total or 0) // RANGE_PATHS)
    if ranges < 2:
        return []
    chosen = tries if count <= MARKED else tries.orderBy(F.xxhash64("trie")).limit(MARKED)
    rows = chosen.select((F.col("paths") / F.size("marks")).alias("weight"), F.explode("marks").alias("m")).collect()
    marks = sorted((tuple(map(bytes, r.m)), r.weight) for r in rows)
    sums = list(itertools.accumulate(w for _, w in marks))
    return sorted({marks[min(bisect.bisect_left(sums, sums[-1] * i / ranges), len(marks) - 1)][0] for i in range(1, ranges)})


def on_bounds(lang: bytes, low: Path | None, high: Path | None) -> list[tuple[bytes, ...]]:
    """The words and pairs that a range's bounds lie in, or begin with."""
    return [b[1 : 1 + k] for b in (low, high) if b and b[0] == lang for k in (1, 2) if b[k]]


def cut_tries(tries: DataFrame, bounds: list[Path]) -> DataFrame:
    """``range``, ``lang``, ``part`` (a serialised trie) and ``counts`` of the nodes on the range's bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            for lang, dump in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                trie = Trie.loaded(dump)
                places = [0 if b[0] < lang else len(trie.counts) if b[0] > lang else trie.place(b[1:]) for b in bounds]
                ends = list(zip([None, *bounds], [*bounds, None], [0, *places], [*places, len(trie.counts)], strict=True))
                for r, (low, high, a, b) in enumerate(ends):
                    counts = [trie.count(p) for p in on_bounds(lang, low, high)]
                    if b > a or any(counts):
                        yield [pa.array([r]), pa.array([lang]), pa.array([trie.part(a, b).dumped()]), pa.array([counts], pa.list_(pa.int64()))]

    return arrow_map(tries.select("lang", "trie"), run, [("range", "bigint"), ("lang", "binary"), ("part", "binary"), ("counts", "array<bigint>")])


def nodes_of(trie: Trie, whole: dict[tuple[bytes, ...], int], least: int) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """Walks a merged trie: (phrase, its count, that of its first word, that of its first two) for nodes of ``least`` occurrences and more.

    ``whole`` has the counts of nodes that other ranges' paths add to.
    """
    w, paths, counts = trie.words, trie.paths, trie.counts
    if not len(counts):
        return
    new = np.empty((DEPTH, len(counts)), bool)
    changed = np.zeros(len(counts), bool)
    changed[0] = True
    sums = []
    for k in range(DEPTH):
        changed[1:] |= paths[k][1:] != paths[k][:-1]
        new[k] = changed
        first = np.flatnonzero(changed)
        sums.append(np.repeat(np.add.reduceat(counts, first), np.diff(np.append(first, len(counts)))))
    for path, n in whole.items():  # few
        at = np.ones(len(counts), bool)
        for k, word in enumerate(path):
            r = bisect.bisect_left(w, word)
            at &= paths[k] == (r + 1 if r < len(w) and w[r] == word else -1)
        sums[len(path) - 1] = np.where(at, n, sums[len(path) - 1])
    for k in range(DEPTH):
        for i in np.flatnonzero(new[k] & (paths[k] > 0) & (sums[k] >= least)).tolist():
            path = tuple(w[r - 1] for r in paths[: k + 1, i].tolist())
            if path not in whole:
                yield path, int(sums[k][i]), int(sums[0][i]), int(sums[1][i])


NODES = "lang string, depth int, phrase string, prefix string, suffix string, f bigint, left1 bigint, left2 bigint"


def merge_ranges(parts: DataFrame, bounds: list[Path], least: int) -> DataFrame:
    """All nodes of ``least`` occurrences and more, with their left parts' counts (columns of ``NODES``)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r = int(pdf["range"].iloc[0])
        low, high = [None, *bounds][r], [*bounds, None][r]
        rows = []
        for lang, own in pdf.groupby("lang", sort=True):
            special = on_bounds(lang, low, high)
            whole = dict(zip(special, np.sum(np.stack([np.array(c, np.int64) for c in own["counts"]]), axis=0).tolist() if special else [], strict=True))
            tries = [Trie.loaded(x) for x in own["part"]]
            trie = Trie(*merged([(t.words, t.paths, t.counts) for t in tries])) if len(tries) > 1 else tries[0]
            found = list(nodes_of(trie, whole, least))
            for path, n in whole.items():  # these belong to the range that holds their own place
                place = (lang, *path, *[b""] * (DEPTH - len(path)))
                if n >= least and (low is None or low <= place) and (high is None or place < high):
                    found.append((path, n, whole[path[:1]], n))
            for path, n, one, two in found:
                text = [x.decode() for x in path]
                rows.append((lang.decode(), len(path), " ".join(text), " ".join(text[:-1]), " ".join(text[1:]), n, one, two))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in NODES.split(", ")])

    return parts.groupBy("range").applyInPandas(run, NODES)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), in decimals of 38 digits: exact for counts up to 10**15."""
    wide = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", (F.lit(1_000_000).cast("decimal(7,0)") * wide(a)) * wide(a), wide(left) * wide(right))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases of two and three words."""
    prepare(docs.sparkSession)
    tries = shard_tries(docs, lang_col, text_col).checkpoint()
    totals = tries.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("words").alias("n"))
    bounds = bounds_of(tries)
    nodes = merge_ranges(cut_tries(tries, bounds), bounds, least).checkpoint()
    ones = nodes.filter("depth = 1").select("lang", F.col("phrase").alias("suffix"), F.col("f").alias("r1"))
    twos = nodes.filter("depth = 2").join(ones, ["lang", "suffix"])
    links = twos.select("lang", F.col("phrase").alias("suffix"), F.col("f").alias("r1"), F.col("r1").alias("r2"))
    threes = nodes.filter("depth = 3").join(links, ["lang", "suffix"])
    first, second = score(F.col("f"), F.col("left1"), F.col("r1")), score(F.col("f"), F.col("left2"), F.col("r2"))
    threes = threes.withColumns({"s1": first, "s2": second})
    lower = F.col("s2") < F.col("s1")
    triples = threes.select("lang", "phrase", F.col("f").alias("a"), F.when(lower, F.col("left2")).otherwise(F.col("left1")).alias("l"), F.when(lower, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    longer = threes.select("lang", F.explode(F.array("prefix", "suffix")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    pairs = twos.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < 50 * F.col("f"), F.lit(True)))
    pairs = pairs.select("lang", "phrase", F.col("f").alias("a"), F.col("left1").alias("l"), F.col("r1").alias("r"), score(F.col("f"), F.col("left1"), F.col("r1")).alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = pairs.unionByName(triples).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
with pieces as materialized (
  select lang, d, row_number() over () as piece, regexp_extract_all(p, '[^ \t]+') as w
  from (select coalesce(lang, 'und') as lang, doc_id as d,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
        from documents)
), places as materialized (
  select lang, w[i] as w1, w[i + 1] as w2, w[i + 2] as w3
  from (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces)
), ones as materialized (select lang, w1, count(*) as f from places group by all),
twos as materialized (select lang, w1, w2, count(*) as f from places where w2 is not null group by all),
threes as materialized (select lang, w1, w2, w3, count(*) as f from places where w3 is not null group by all having count(*) >= 10),
scored2 as (
  select t.lang, t.w1 || ' ' || t.w2 as phrase, t.f as a, x.f as l, y.f as r, t.f::hugeint * t.f * 1000000 // (x.f::hugeint * y.f) as score
  from twos t join ones x on x.lang = t.lang and x.w1 = t.w1 join ones y on y.lang = t.lang and y.w1 = t.w2
  where t.f >= 10
), longer as (
  select lang, p, max(f) as f from (select lang, w1 || ' ' || w2 as p, f from threes union all select lang, w2 || ' ' || w3, f from threes) group by all
), cuts as (
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 as phrase, t.f as a, a.f as l1, yz.f as r1, xy.f as l2, c.f as r2,
         t.f::hugeint * t.f * 1000000 // (a.f::hugeint * yz.f) as s1, t.f::hugeint * t.f * 1000000 // (xy.f::hugeint * c.f) as s2
  from threes t join ones a on a.lang = t.lang and a.w1 = t.w1 join ones c on c.lang = t.lang and c.w1 = t.w3
  join twos xy on xy.lang = t.lang and xy.w1 = t.w1 and xy.w2 = t.w2 join twos yz on yz.lang = t.lang and yz.w1 = t.w2 and yz.w2 = t.w3
), candidates as (
  select s.lang, s.phrase, s.a, s.l, s.r, s.score from scored2 s left join longer g on g.lang = s.lang and g.p = s.phrase
  where g.f is null or 100 * g.f < 50 * s.a
  union all
  select lang, phrase, a, case when s2 < s1 then l2 else l1 end, case when s2 < s1 then r2 else r1 end, least(s1, s2) from cuts
), ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from candidates)
select ranked.lang, rank, phrase, a, l, r, n, score::bigint as score
from ranked join (select lang, sum(f)::bigint as n from ones group by lang) using (lang) where rank <= 2000
"""

QUERIES = {"op12_collocations": op12_collocations}
ORACLES = {"op12_collocations": SQL}
