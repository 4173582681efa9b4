"""Mixing overlapping sources to target weights: a min-cost flow over membership patterns, then seeded documents.

1. Documents are counted by membership pattern (the set of sources they belong to). Only these sums reach the driver, at most ``PATTERNS`` of
   them; more raise an error, as sources are names that the mix's owner gives quotas to, not keys of the data.
2. Words flow from an origin through patterns to their sources, and from there to the end. A pattern has an arc for each repetition, all as
   wide as its words; the k-th costs k * k, so a text is repeated only where no fresh text can serve its sources, and no pattern
   is repeated again before it must be. A source's arc is as wide as its quota. The flow is found by shortest distances with potentials and blocking flows.
3. A pattern's documents are taken so many times whole, and for what is left some of them once more. These are spread over the
   documents' size classes (powers of two) by words, and come first in their class in the order of a seeded hash. Where the order is cut is found
   by sums over the hash's digits (``DIGIT`` bits a round, one row for a class reaches the driver) until at most ``UNITS`` documents stand at
   the cut. Those are taken in order where they fit, from the largest class on; what a class leaves goes to the next one. In
   the end documents at the cut are added, dropped or swapped one by one while that comes nearer.

So documents are never sorted, collected or cut themselves; a source of a third of all rows is summed in parts like any other.

Rules. A size is an integer; a null one counts as 0. Documents of no source (null or empty array) are not taken. Rows that are alike in sources, id and
size have one place in the order and are taken alike. A null among the sources is a source of its own. Quotas of sources that have no rows do nothing.
A quota that cannot be met is met as far as ``repeats`` copies of its documents reach. An empty table gives an empty result. Columns of the
input are kept, whatever their names, but for one named as the result. Equal input and seed give equal results, however the rows are partitioned.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Hashable, Iterable
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .session import prepare, table

PATTERNS, UNITS, DIGIT = 100_000, 4096, 6
WEIGHTS, SHARE, MOST = (3, 1, 2), Fraction(3, 2), 2


class Network:
    """A network of arcs with capacities and costs of 0 or more."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        """Adds an arc and the one that takes it back; gives its number."""
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def fill(self, origin: int, end: int) -> None:
        """Sends as much as passes from ``origin`` to ``end``, at the lowest cost."""
        height = [0] * len(self.out)
        while True:
            far = self._distances(origin, height)
            if far[end] is None:
                return
            most = max(d for d in far if d is not None)
            height = [h + (most if d is None else d) for h, d in zip(height, far, strict=True)]
            while self._block(origin, end, height):
                pass

    def _distances(self, origin: int, height: list[int]) -> list[int | None]:
        far: list[int | None] = [None] * len(self.out)
        queue = [(0, origin)]
        while queue:
            d, a = heapq.heappop(queue)
            if far[a] is not None:
                continue
            far[a] = d
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and far[b] is None:
                    heapq.heappush(queue, (d + self.cost[e] + height[a] - height[b], b))
        return far

    def _block(self, origin: int, end: int, height: list[int]) -> int:
        """Fills the paths of fewest arcs among those of least cost; gives what was sent."""
        free = lambda e, a: self.room[e] and self.cost[e] + height[a] == height[self.to[e]]
        level, queue = {origin: 0}, deque([origin])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.to[e] not in level and free(e, a):
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        if end not in level:
            return 0
        sent, tried, path, a = 0, [0] * len(self.out), [], origin
        while True:
            if a == end:
                size = min(self.room[e] for e in path)
                for e in path:
                    self.room[e] -= size
                    self.room[e ^ 1] += size
                sent += size
                path, a = [], origin
            elif tried[a] < len(self.out[a]):
                e = self.out[a][tried[a]]
                if free(e, a) and level.get(self.to[e]) == level[a] + 1:
                    path.append(e)
                    a = self.to[e]
                else:
                    tried[a] += 1
            elif a == origin:
                return sent
            else:
                a = self.to[path.pop() ^ 1]
                tried[a] += 1


def route(patterns: list[tuple[int, Iterable[Hashable]]], quotas: dict[Hashable, int], repeats: int) -> list[dict[Hashable, int]]:
    """For each pattern (words, sources) the words that go to each of its sources."""
    used = sorted({s for _, own in patterns for s in own if quotas.get(s, 0) > 0}, key=repr)
    node = {s: 2 + len(patterns) + i for i, s in enumerate(used)}
    net = Network(2 + len(patterns) + len(used))
    to_source: list[dict[Hashable, int]] = []
    for i, (words, own) in enumerate(patterns):
        for k in range(1, repeats + 1):
            net.arc(0, 2 + i, words, k * k)
        to_source.append({s: net.arc(2 + i, node[s], words * repeats) for s in sorted(set(own) & node.keys(), key=repr)})
    for s in used:
        net.arc(node[s], 1, quotas[s])
    net.fill(0, 1)
    return [{s: net.room[e ^ 1] for s, e in own.items()} for own in to_source]


def chosen(sizes: list[int], rooms: list[int]) -> list[bool]:
    """Which of the sizes to take: in order where they fit, as the room left grows by ``rooms``; then one is added, dropped or swapped as long as that comes nearer."""
    taken, left = [], 0
    for n, room in zip(sizes, rooms, strict=True):
        left += room
        taken.append(0 < n <= left)
        left -= n if taken[-1] else 0
    size, mask = np.array([*sizes, 0], np.int64), np.array([*taken, False])
    while left:
        own, others = np.append(np.flatnonzero(mask), len(sizes)), np.flatnonzero(~mask)  # the last one has no size and stands for none
        others = others[np.argsort(size[others], kind="stable")]
        wanted = size[own] + left
        at = np.searchsorted(size[others], wanted).clip(1, max(1, len(others) - 1))
        near = np.stack([at - 1, np.minimum(at, len(others) - 1)])
        gap = wanted - size[others[near]]
        side, k = np.unravel_index(np.argmin(abs(gap)), gap.shape)
        if abs(gap[side, k]) >= abs(left):
            break
        mask[own[k]], mask[others[near[side, k]]] = False, True
        mask[-1], left = False, int(gap[side, k])
    return mask[:-1].tolist()


def _upper(bits: str):
    """The first ``bits`` (a column) of ``place``; 0 of them are 0."""
    return F.expr(f"if({bits} = 0, 0L, shiftrightunsigned(place, 64 - {bits}))")


def mix(df: DataFrame, quotas: dict[str | None, int], repeats: int = 4, seed: int = 0, id_col: str = "doc_id", sources_col: str = "sources", size_col: str = "size", out: str = "copies") -> DataFrame:
    """All rows and columns of ``df`` with ``out``, the times a row is taken (0 to ``repeats``)."""
    spark = prepare(df.sparkSession)
    sources = F.array_sort(F.array_distinct(F.col(f"`{sources_col}`").cast("array<string>")))
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()))
    size = F.coalesce(F.col(f"`{size_col}`").cast("bigint"), F.lit(0))
    class_ = F.length(F.bin("size")).alias("class")
    given = df.select(row.alias("row"), F.coalesce(F.to_json(sources), F.lit("[]")).alias("key"), sources.alias("own"), size.alias("size")).select("*", class_)
    given = given.withColumn("place", F.xxhash64(F.lit(seed), F.col("row").getField(id_col) if id_col.lower() != out.lower() else F.lit(0), "size"))
    found = given.groupBy("key", "class").agg(F.first("own").alias("own"), F.sum("size").alias("words"), F.count("*").alias("rows")).limit(64 * PATTERNS).collect()
    patterns: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r.key, -r["class"])):
        patterns.setdefault(r.key, []).append(r)
    if len(patterns) > PATTERNS:
        raise ValueError(f"there are over {PATTERNS} membership patterns")
    words = {k: sum(r.words for r in own) for k, own in patterns.items()}
    flows = route([(words[k], own[0].own or []) for k, own in patterns.items()], quotas, repeats)
    plan = {}  # key, class: copies of the whole pattern, words of one more, first bits of the cut's hash and how many, rows there
    for (k, own), flow in zip(patterns.items(), flows, strict=True):
        times, rest = divmod(sum(flow.values()), words[k]) if words[k] else (0, 0)
        rooms = [rest * r.words // words[k] if words[k] else 0 for r in own]
        rooms[0] += rest - sum(rooms)
        for r, room in zip(own, rooms, strict=True):
            # A class without room of its own is at the cut too: it may get what larger ones leave.
            plan[k, r["class"]] = [times, room, 0, 0, r.rows if rest else 0]
    narrow = given.select("key", "class", "size", "place")
    while wide := [(*k, p[2], p[3], p[1]) for k, p in plan.items() if p[4] > UNITS and p[3] + DIGIT <= 60]:
        cuts = spark.createDataFrame(wide, "key string, class int, prefix bigint, bits int, room bigint")
        there = narrow.join(F.broadcast(cuts), ["key", "class"]).filter(_upper("bits") == F.col("prefix"))
        digit = F.expr(f"shiftrightunsigned(place, 64 - bits - {DIGIT})").alias("at")
        sums = there.groupBy("key", "class", "room", digit).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        ends = F.sum("words").over(Window.partitionBy("key", "class").orderBy("at"))
        cut = sums.withColumn("ends", ends).filter(F.col("ends") > F.col("room")).groupBy("key", "class").agg(F.min(F.struct("at", "rows", (F.col("ends") - F.col("words")).alias("before"))).alias("cut"))
        reached = {(r.key, r["class"]): r.cut for r in cut.collect()}
        for key, *_ in [((w[0], w[1]),) for w in wide]:
            p, c = plan[key], reached.get(key)
            plan[key] = [p[0], p[1] - c.before, c.at, p[3] + DIGIT, c.rows] if c else [*p[:4], 0]  # only zeros have no cut
    cuts = F.broadcast(spark.createDataFrame([(*k, p[0], p[2], p[3], p[1], p[4] > 0) for k, p in plan.items()], "key string, class int, times int, prefix bigint, bits int, room bigint, open boolean"))
    at_cut = F.col("open") & (_upper("bits") == F.col("prefix"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["class", "place", "size"], ascending=[False, True, True])
        rooms = pdf["room"].where(~pdf["class"].duplicated(), 0)
        return pdf[chosen((pdf["size"] * pdf["rows"]).tolist(), rooms.tolist())][["key", "class", "place", "size"]]

    units = narrow.join(cuts, ["key", "class"]).filter(at_cut).groupBy("key", "class", "room", "place", "size").agg(F.count("*").alias("rows"))
    taken = units.groupBy("key").applyInPandas(fit, "key string, class int, place bigint, size bigint").withColumn("more", F.lit(1))
    placed = given.join(cuts, ["key", "class"])
    inside = placed.filter(at_cut).join(taken, ["key", "class", "place", "size"], "left").select("row", (F.col("times") + F.coalesce("more", F.lit(0))).alias("copies"))
    outside = placed.filter(~at_cut).select("row", (F.col("times") + (F.col("open") & (_upper("bits") < F.col("prefix"))).cast("int")).alias("copies"))
    return inside.unionByName(outside).select("row.*", F.col("copies").alias(out))


def shared(sizes: list[int], weights: list[int], total: Fraction, most: int = MOST) -> list[Fraction]:
    """``total`` by weight; no share is above ``most`` times its size, the excess is shared again by weight."""
    out, left = [Fraction(0)] * len(sizes), total
    free = [i for i, n in enumerate(sizes) if n]
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > most * sizes[i]]
        for i in over or free:
            out[i] = Fraction(most * sizes[i]) if over else weights[i] * unit
        left -= sum((out[i] for i in over), Fraction(0))
        free = [i for i in free if i not in set(over)] if over else []
    return out


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit("[^ \\x09-\\x0D]+")).cast("bigint"), F.lit(0))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array(F.col("source").cast("string")).alias("sources"), size.alias("size")).checkpoint()
    found = docs.groupBy(F.col("sources")[0].alias("source")).agg(F.sum("size").alias("size")).limit(PATTERNS + 1).collect()
    if len(found) > PATTERNS:
        raise ValueError(f"there are over {PATTERNS} sources")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))]
    targets = shared([r["size"] for r in found], weights, SHARE * sum(r["size"] for r in found))
    mixed = mix(docs, {r.source: round(t) for r, t in zip(found, targets, strict=True)}, repeats=MOST)
    rows = [([r.source], r["size"], float(t)) for r, t in zip(found, targets, strict=True)]
    facts = spark.createDataFrame(rows, "own array<string>, source_size bigint, target double").withColumn("key", F.to_json("own")).drop("own")
    joined = mixed.withColumn("key", F.to_json("sources")).join(F.broadcast(facts), "key")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


QUERIES = {"op13_mixing": op13_mixing}
ORACLES: dict[str, str] = {}
