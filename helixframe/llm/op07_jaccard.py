"""N-gram Jaccard join by chosen paths.

Each text is its set of five-word shingles, embedded as ``COORDINATES`` MinHash tokens, so the share of equal tokens
of two sets estimates their Jaccard similarity. In each run all sets start in one node; a node samples ``BRANCH``
coordinates, the same for all sets in it, and sends every set to the child that its token there names. Children of
one set vanish, small ones are brute-forced, and those beyond ``BLOCK`` sets split again while splitting shrinks
them. What does not shrink is a group of similar sets: it is brute-forced too, in pairs of blocks that go to
different tasks. A pair survives a run with a probability that ``survival`` gives for the share of its equal tokens;
the number of runs follows from the target recall of pairs at the threshold, over all numbers of equal tokens.

Texts with equal sets (copies above all) are one class from the start, and only its representative takes part.
Brute force has two steps. The first, on sketches alone, keeps the sets that have a likely partner in a block pair;
only these get their whole sets, for the exact second step. A pair that meets in several nodes is counted in the one
with the smallest path. No list of pairs is ever made: a block pair gives each set's number of links, weighted with
copies, and a spanning forest of the links found, and the groups are the components of these forests.

Null and empty texts and texts without words are in no group and have no links. A text of fewer than five words has
one shingle of all of them. Repeated rows are copies of each other. A group's id is its smallest document id (null
where all are null). An empty table gives an empty result; other columns than id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .kernels import intersections, minhash, passes, set_keys, shingle_sets
from .session import prepare, table

K, THRESHOLD, RECALL = 5, 0.8, 0.9999
COORDINATES, BRANCH, START_DEPTH, MOST_DEPTH = 48, 2, 2, 8
#: Sets of a node that are brute-forced at once, and the share of its parent below which a node counts as shrunk.
BLOCK, SHRINK = 1024, 0.6


def survival(similarity: float, depth: int) -> float:
    """That two sets of this similarity meet in at least one node at ``depth`` of a run."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - similarity * p) ** BRANCH
    return p


def least_equal(threshold: float) -> int:
    """Equal tokens below which a pair isn't likely to be at the threshold."""
    return math.floor(COORDINATES * threshold - 5 * math.sqrt(COORDINATES * threshold * (1 - threshold)))


def recall_of(threshold: float, runs: int) -> float:
    """That a pair at the threshold is found. All runs draw from one sketch, so they are independent only once its equal tokens are given, whose number is binomial."""
    n, p = COORDINATES, threshold
    return sum(math.comb(n, m) * p**m * (1 - p) ** (n - m) * (1 - (1 - survival(m / n, MOST_DEPTH)) ** runs) for m in range(max(0, least_equal(p)), n + 1))


def runs_for(threshold: float, recall: float) -> int:
    for runs in range(1, 1000):
        if recall_of(threshold, runs) >= recall:
            return runs
    raise ValueError(f"sketches of {COORDINATES} tokens give no recall of {recall} at {threshold}")


def embedded(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``id``, ``h`` (of the text), ``a`` and ``b`` (the set's key), ``n`` (its size) and ``sketch``."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in passes(texts):
                values, first = shingle_sets(texts[lo:hi], k)
                keys = set_keys(values, first).view(np.int64)
                low = (minhash(values, first, COORDINATES) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                sketch = pa.ListArray.from_arrays(pa.array(np.arange(0, low.size + 1, COORDINATES, dtype=np.int32)), pa.array(low.ravel()))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.diff(first).astype(np.int32)), sketch], names=["id", "h", "a", "b", "n", "sketch"])

    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"), F.col(f"`{text_col}`").alias("text"))
    return given.mapInArrow(run, f"id {kind}, h long, a long, b long, n int, sketch array<int>")


def branched(nodes: DataFrame) -> DataFrame:
    """Every set in the children of its node (``path``); needs its ``sketch``."""
    one = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(COORDINATES)).cast("int")
    two = F.pmod(one + 1 + F.pmod(F.xxhash64("path", F.lit(2)), F.lit(COORDINATES - 1)).cast("int"), F.lit(COORDINATES))
    children = [F.xxhash64("path", i, F.element_at("sketch", i + 1)) for i in (one, two)]
    return nodes.withColumn("path", F.explode(F.array(*children)))


def populated(nodes: DataFrame) -> DataFrame:
    """Nodes with two sets or more, with their ``size``."""
    sizes = nodes.groupBy("path").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    # A key made anew asks for an exchange on this side too: only then can a node with very many sets be split between tasks.
    return nodes.join(sizes.select(F.col("path").bitwiseXOR(F.lit(0)).alias("path"), "size"), "path")


def leaves(reps: DataFrame, runs: int) -> DataFrame:
    """``path``, ``a``, ``b`` and ``size`` of all nodes that are to be brute-forced."""
    nodes = reps.select("a", "b", "sketch", F.explode(F.array(*(F.lit(-1 - r).cast("long") for r in range(runs)))).alias("path"))
    for _ in range(START_DEPTH):
        nodes = branched(nodes)
    nodes = populated(nodes.select("path", "a", "b")).withColumn("more", F.col("size") > BLOCK).checkpoint()
    done = [nodes.filter(~F.col("more")).select("path", "a", "b", "size")]
    for _ in range(START_DEPTH, MOST_DEPTH):
        large = nodes.filter("more")
        if not large.limit(1).count():
            return _union(done)
        children = branched(large.select("path", "a", "b", F.col("size").alias("parent")).join(reps.select("a", "b", "sketch"), ["a", "b"]))
        found = populated(children.select("path", "a", "b", "parent"))
        nodes = found.withColumn("more", (F.col("size") > BLOCK) & (F.col("size") < SHRINK * F.col("parent"))).checkpoint()
        done.append(nodes.filter(~F.col("more")).select("path", "a", "b", "size"))
    return _union([*done, nodes.filter("more").select("path", "a", "b", "size")])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal first ``keys`` columns, from batches sorted by them; a run may cross batches."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        t = t.combine_chunks()
        change = np.zeros(t.num_rows, dtype=bool)
        for c in t.columns[:keys]:
            x = c.to_numpy()
            change[1:] |= x[1:] != x[:-1]
        edges = [0, *np.flatnonzero(change).tolist()]
        whole = t.to_batches()[0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            yield whole.slice(lo, hi - lo)
        rest = t.slice(edges[-1])
    if rest is not None:
        yield rest.combine_chunks().to_batches()[0]


def _fresh(own: int, paths: list[np.ndarray], block: np.ndarray, i: int, j: int) -> np.ndarray:
    """Which pairs of a block pair are to be compared here: across blocks (or x < y in one), and not met in a smaller path."""
    m = len(paths)
    if m == 2:
        x, y = paths
        met = bool(np.isin(x[x < own], y[y < own]).any())
        pair = np.zeros((2, 2), dtype=bool)
        pair[0, 1] = not met
    else:
        pair = intersections([p[p < own] for p in paths]) == 0
    if i == j:
        return np.triu(pair, 1)
    if m == 2:
        return pair if block[0] != block[1] else np.zeros((2, 2), dtype=bool)
    return pair & (block[:, None] == i) & (block[None, :] == j)


def _lists(column: pa.Array) -> list[np.ndarray]:
    values = column.values.to_numpy()
    offsets = column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _likely(least: int) -> Callable:
    """First step: the sets that have a partner with at least ``least`` equal tokens in this block pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches, 3):
            if g.num_rows < 2:
                continue
            own, i, j = (g.column(c)[0].as_py() for c in range(3))
            block = g.column(3).to_numpy()
            paths, sketch = _lists(g.column(6)), np.stack(_lists(g.column(7)))
            pair = _fresh(own, paths, block, i, j)
            if not pair.any():
                continue
            x, y = np.nonzero(pair)
            keep = np.zeros(g.num_rows, dtype=bool)
            for lo in range(0, len(x), 1 << 16):
                xs, ys = x[lo : lo + (1 << 16)], y[lo : lo + (1 << 16)]
                good = (sketch[xs] == sketch[ys]).sum(axis=1) >= least
                keep[xs[good]] = True
                keep[ys[good]] = True
            if keep.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in g.columns[:7]], names=["path", "i", "j", "block", "a", "b", "paths"])

    return run


def _exact(threshold: float) -> Callable:
    """Second step: links by set, and the spanning forest of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches, 3):
            if g.num_rows < 2:
                continue
            own, i, j = (g.column(c)[0].as_py() for c in range(3))
            a, b, weight = (g.column(c).to_numpy() for c in (4, 5, 7))
            sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in g.column(8)]
            pair = _fresh(own, _lists(g.column(6)), g.column(3).to_numpy(), i, j)
            size = np.array([len(s) for s in sets])
            common = intersections(sets)
            link = pair & (common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9)
            if not link.any():
                continue
            link |= link.T
            label = np.arange(len(sets))
            while True:
                low = np.minimum(label, np.where(link, label[None, :], len(sets)).min(axis=1))
                low = low[low]
                if (low == label).all():
                    break
                label = low
            at = np.flatnonzero(link.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[at]), pa.array(b[at]), pa.array(a[label[at]]), pa.array(b[label[at]]), pa.array(link[at].sum(axis=1).astype(np.int64)), pa.array((link[at] * weight[None, :]).sum(axis=1).astype(np.int64))],
                names=["a", "b", "a2", "b2", "sets", "rows"],
            )

    return run


def whole_sets(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``a``, ``b`` and ``shingles`` (64-bit integers) of the texts that ``chosen`` (id, h, a, b) names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in passes(texts):
                values, first = shingle_sets(texts[lo:hi], k)
                data = [values[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(data, pa.binary())], names=["a", "b", "shingles"])

    texts = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(F.col(f"`{text_col}`")).alias("__h"), F.col(f"`{text_col}`").alias("__text"))
    found = texts.join(chosen, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__h") == F.col("h"))).select("a", "b", "__text")
    return found.dropDuplicates(["a", "b"]).mapInArrow(run, "a long, b long, shingles binary")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """A row for each row of ``docs``: ``id``, ``h`` (xxhash64 of the text), ``group_id``, ``group_rows``, ``n_links`` (other rows
    at the threshold, copies included), ``n_texts`` (other shingle sets at the threshold) and ``stays`` (whether this is the text that stands for the group)."""
    prepare(docs.sparkSession)
    base = embedded(docs, id_col, text_col, k).checkpoint()
    first = F.min(F.struct("id", "h"))
    reps = base.filter("n > 0").groupBy("a", "b").agg(F.count("*").alias("weight"), first.alias("who"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch")).checkpoint()
    nodes = leaves(reps, runs_for(threshold, recall)).checkpoint()
    paths = nodes.groupBy("a", "b").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    known = reps.select("a", "b", "sketch").join(paths, ["a", "b"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = nodes.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("a", "b", "path"), F.col("blocks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = other.select("path", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "a", "b").join(known, ["a", "b"])
    order = ["path", "i", "j"]
    columns = [*order, "block", "a", "b", "paths"]
    likely = spread.select(*columns, "sketch").repartition(*order).sortWithinPartitions(*order).mapInArrow(_likely(least_equal(threshold)), "path long, i int, j int, block int, a long, b long, paths array<long>").checkpoint()
    chosen = likely.select("a", "b").distinct().join(reps.select("a", "b", "weight", "who"), ["a", "b"])
    sets = whole_sets(docs, chosen.select("a", "b", "who.id", "who.h"), id_col, text_col, k)
    full = likely.join(sets, ["a", "b"]).join(chosen.select("a", "b", "weight"), ["a", "b"]).select(*columns, "weight", "shingles")
    links = full.repartition(*order).sortWithinPartitions(*order).mapInArrow(_exact(threshold), "a long, b long, a2 long, b2 long, sets long, rows long").checkpoint()
    groups = components(links.select(F.struct("a", "b").alias("u"), F.struct(F.col("a2").alias("a"), F.col("b2").alias("b")).alias("v")))
    counts = links.groupBy("a", "b").agg(F.sum("sets").alias("sets"), F.sum("rows").alias("rows"))
    named = groups.select("node.a", "node.b", "label").join(counts, ["a", "b"], "left")
    member = reps.select("a", "b", "weight", "who").join(named, ["a", "b"], "left").withColumn("label", F.coalesce("label", F.struct("a", "b")))
    whole = member.groupBy("label").agg(F.min("who").alias("best"), F.sum("weight").alias("group_rows"))
    verdict = member.join(whole, "label").select("a", "b", "best", "group_rows", (F.coalesce("rows", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("sets", F.lit(0)).alias("n_texts"))
    out = base.select("id", "h", "a", "b", "n").join(verdict, ["a", "b"], "left")
    alone = F.col("n") == 0
    return out.select(
        "id", "h", F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("group_id"), F.when(alone, 1).otherwise(F.col("group_rows")).cast("long").alias("group_rows"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"), (alone | (F.struct("id", "h") == F.col("best"))).alias("stays"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each group: the smallest id (then text hash), and of rows that share these the one whose columns have the smallest hash. Rows without words all stay."""
    kept = similar_groups(docs, id_col, text_col, **settings).filter("stays").select("id", "h", "group_rows").distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.col(f"`{id_col}`").alias("own_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("own_h"), F.struct(*columns).alias("row"))
    found = rows.join(kept, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_h") == F.col("h"))).select("id", "h", "group_rows", "row")
    several = F.col("group_rows") > 1
    one = found.filter(several).groupBy("id", "h").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return found.filter(~several).select("row").unionByName(one.select("row")).select("row.*")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similar_groups(docs).select(F.col("id").alias("doc_id"), "group_id", "group_rows", "n_links", "n_texts")


QUERIES = {"op7_jaccard_join": op7_jaccard_join}
ORACLES: dict[str, str] = {}
