"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Test items are partitioned by their number of shingles into classes ``[m, 2m)``. For a class, a document is cut into
windows of ``4m`` shingles that begin every ``2m`` shingles, so any passage as long as an item of the class lies in
one window whole, and the Jaccard similarity of an item to a window that contains ``threshold`` of it has a floor
that depends on nothing but the threshold. The number of one-row bands follows from that floor and ``recall``. Band
minima are taken over blocks of ``2m`` shingles and shared by the two windows over a block; the hash of a shingle is
shared by all classes. Candidates are verified by the exact share of an item's shingles that the whole document has.

Items are read in blocks of at most ``ITEM_BYTES`` (one item at least). A pass over the documents takes ``BLOCKS`` blocks, whose
index, about 2.5 bytes for each of text, is broadcast; a larger benchmark takes more passes, with a checkpoint of the rows between them. Nothing that
grows with the documents is collected or shuffled.

An item shorter than ``k`` words is searched by shingles of its own length. Items without words match nothing, nor
do null and empty documents and documents shorter than the shingles. Repeated items and rows each get their rows;
an empty table on either side gives an empty result. Texts are searched whole, a very long one alone. The columns in ``keep`` are carried along
whatever their names, but one that carries the output's name is replaced; no other is read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import U, mix, passes, seeds, word_hashes
from .session import arrow_map, prepare, table

K, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Text of a block of items, and blocks that a pass takes.
ITEM_BYTES, BLOCKS = 8 << 20, 4


def sequence(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each text in order, repeated ones included, and where each text's begin."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    begin = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(len(owner)) - begin[:-1][owner] + first[:-1][owner]
    value = np.zeros(len(owner), dtype=U)
    for j in range(k):
        value = mix(value * U(0x9E3779B97F4A7C15) + words[at + j])
    return value, begin


def permuted(values: np.ndarray, seed: np.uint64) -> np.ndarray:
    x = (values ^ seed) * U(0xFF51AFD7ED558CCD)
    return x ^ (x >> U(32))


def bands_for(threshold: float, recall: float) -> int:
    """One-row bands that find a window of ``4m`` shingles with ``threshold`` of the smallest item of ``[m, 2m)``."""
    floor = threshold / (4 + 1 - threshold)
    return math.ceil(math.log(1 - recall) / math.log(1 - floor))


@dataclass
class ItemClass:
    k: int
    size: int
    items: list[int]
    sets: list[np.ndarray]
    lows: list[np.ndarray]  # for each band its items' minima, ascending
    who: list[np.ndarray]  # and whose they are


class ItemIndex:
    """Of the items of one block; item numbers are places in the block."""

    def __init__(self, texts: list[str | None], k: int = K, threshold: float = THRESHOLD, recall: float = RECALL):
        self.threshold, self.bands = threshold, bands_for(threshold, recall)
        words, first = word_hashes(texts)
        by: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for i, n in enumerate(np.diff(first).tolist()):
            if n:
                s = np.unique(sequence(words[first[i] : first[i + 1]], np.array([0, n]), min(k, n))[0])
                by.setdefault((min(k, n), 1 << (len(s).bit_length() - 1)), []).append((i, s))
        self.classes = []
        for (kk, size), members in sorted(by.items()):
            lows, who = [], []
            for seed in seeds(self.bands):
                low = np.array([permuted(s, seed).min() for _, s in members])
                order = np.argsort(low, kind="stable")
                lows.append(low[order])
                who.append(order)
            self.classes.append(ItemClass(kk, size, [i for i, _ in members], [s for _, s in members], lows, who))

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text, item, shared shingles, shingles of the item) of all verified pairs."""
        words, first = word_hashes(texts)
        out = []
        for kk in sorted({c.k for c in self.classes}):
            values, begin = sequence(words, first, kk)
            if len(values):
                out += self._verified(values, begin, [c for c in self.classes if c.k == kk])
        return sorted(out)

    def _verified(self, values: np.ndarray, begin: np.ndarray, classes: list[ItemClass]) -> Iterator[tuple[int, int, int, int]]:
        layout = []
        counts = np.diff(begin)
        for c in classes:
            blocks = -(-counts // (2 * c.size))
            owner = np.repeat(np.arange(len(counts)), blocks)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            paired = np.append(owner[1:] == owner[:-1], False)
            layout.append((c, owner, begin[:-1][owner] + nth * 2 * c.size, paired))
        first = np.cumsum([0, *(len(c.items) for c in classes)])
        found: list[np.ndarray] = []
        for band, seed in enumerate(seeds(self.bands)):
            x = permuted(values, seed)
            for at, (c, owner, starts, paired) in enumerate(layout):
                low = np.minimum.reduceat(x, starts)
                low[:-1] = np.where(paired[:-1], np.minimum(low[:-1], low[1:]), low[:-1])
                known = c.lows[band]
                place = np.searchsorted(known, low)
                hit = np.flatnonzero(known[np.minimum(place, len(known) - 1)] == low)
                if len(hit):
                    place = place[hit]
                    equal = np.searchsorted(known, low[hit], side="right") - place  # items with this minimum
                    member = c.who[band][np.arange(int(equal.sum())) + np.repeat(place - np.cumsum(equal) + equal, equal)]
                    found.append(np.unique(np.repeat(owner[hit], equal) * first[-1] + first[at] + member))
        if not found:
            return
        text, member = np.divmod(np.unique(np.concatenate(found)), first[-1])
        sets = [s for c in classes for s in c.sets]
        items = [i for c in classes for i in c.items]
        edges = [0, *(np.flatnonzero(np.diff(text)) + 1).tolist(), len(text)]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            t, members = int(text[lo]), member[lo:hi].tolist()
            have = np.unique(values[begin[t] : begin[t + 1]])
            for part in range(0, len(members), 4096):
                own = [sets[m] for m in members[part : part + 4096]]
                sizes = np.array([len(s) for s in own])
                flat = np.concatenate(own)
                there = have[np.minimum(np.searchsorted(have, flat), len(have) - 1)] == flat
                shared = np.add.reduceat(there, np.cumsum(sizes) - sizes, dtype=np.int64)
                for i in np.flatnonzero(shared >= self.threshold * sizes - 1e-9).tolist():
                    yield t, items[members[part + i]], int(shared[i]), int(sizes[i])


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in blocks of at most ITEM_BYTES (one item at least), streamed to the driver."""
    block, size = [], 0
    for row in items.select(id_col, text_col).toLocalIterator():
        n = len((row[1] or "").encode())
        if block and size + n > ITEM_BYTES:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += n
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, out: str = "leaks", k: int = K, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` (all, if not given) with ``out``: array of (item, shared, shingles)."""
    spark = prepare(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != out.lower()]
    arrow = pa.list_(pa.struct([("item", items.limit(0).toArrow().schema.field(item_id).type), ("shared", pa.int32()), ("shingles", pa.int32())]))
    kind = f"array<struct<item: {dict(items.dtypes)[item_id]}, shared: int, shingles: int>>"
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`"), F.array().cast(kind))
    columns = [(f.name, f.dataType) for f in rows.schema.fields]
    blocks = item_blocks(items, item_id, item_text)
    now, later = list(itertools.islice(blocks, BLOCKS)), list(itertools.islice(blocks, BLOCKS))
    while True:
        shared = [spark.sparkContext.broadcast(([i for i, _ in b], ItemIndex([t for _, t in b], k, threshold, recall))) for b in now]
        run = _searched(shared, arrow)
        if not later:
            return arrow_map(rows, lambda batches: ([*c[:-2], c[-1]] for c in run(batches)), [*columns[:-2], (out, columns[-1][1])])
        rows = arrow_map(rows, run, columns).checkpoint()
        for b in shared:
            b.unpersist()
        now, later = later, list(itertools.islice(blocks, BLOCKS))


def _searched(shared: list, arrow: pa.DataType):
    """Adds what the blocks' items give to the last column, by the text in the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 2).to_pylist()
            for lo, hi in passes(texts):
                part = batch.slice(lo, hi - lo)
                found = part.columns[-1].to_pylist()
                for b in shared:
                    ids, index = b.value
                    for text, item, n, m in index.search(texts[lo:hi]):
                        found[text].append({"item": ids[item], "shared": n, "shingles": m})
                yield [*part.columns[:-1], pa.array(found, arrow)]

    return run


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, item) with at least 0.8 of the item's five-word shingles in the document."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    leak = found.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", F.col("x.item").alias("item_id"), F.col("x.shared").alias("shared"), F.col("x.shingles").alias("shingles"))
    return leak.withColumn("containment", F.round(F.col("shared") / F.col("shingles"), 6))


SQL = rf"""
WITH w AS (SELECT 0 AS kind, row_number() OVER () AS n, doc_id AS id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS w FROM documents
           UNION ALL SELECT 1, row_number() OVER (), item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') FROM benchmark),
s AS (SELECT DISTINCT kind, n, id, unnest(list_transform(range(1, len(w) - {K - 2}), lambda i: array_to_string(w[i:i + {K - 1}], ' '))) AS s FROM w WHERE len(w) >= {K}),
q AS (SELECT n, id, s, count(*) OVER (PARTITION BY n) AS size FROM s WHERE kind = 1)
SELECT s.id AS doc_id, q.id AS item_id, count(*)::INTEGER AS shared, size::INTEGER AS shingles, round(count(*) / size, 6) AS containment
FROM s JOIN q USING (s) WHERE s.kind = 0 GROUP BY s.n, s.id, q.n, q.id, size HAVING count(*) >= {THRESHOLD} * size - 1e-9
"""
QUERIES = {"op1_decontamination": op1_decontamination}
ORACLES = {"op1_decontamination": SQL}
