"""Mixing: the flow against one of single words, the chosen documents against quotas, the query against its rule."""

from __future__ import annotations

import collections
import json
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from helixframe.llm import op13_mixing as op13
from helixframe.llm.queries import QUERIES


def plain_flow(patterns: list, quotas: dict, repeats: int) -> tuple[int, int]:
    """Words and cost of the best flow: word after word along a cheapest path, by Bellman-Ford."""
    arcs, at = [], {}
    for i, (n, own) in enumerate(patterns):
        arcs += [["origin", i, n, k * k] for k in range(1, repeats + 1)]
        arcs += [[i, s, 10**6, 0] for s in own]
    arcs += [[s, "end", q, 0] for s, q in quotas.items()]
    arcs = [x for a, b, n, c in arcs for x in ([a, b, n, c], [b, a, 0, -c])]
    words = cost = 0
    while True:
        far, via = collections.defaultdict(lambda: 10**9, origin=0), {}
        for _ in range(len(patterns) + len(quotas) + 3):
            for e, (a, b, n, c) in enumerate(arcs):
                if n and far[a] + c < far[b]:
                    far[b], via[b] = far[a] + c, e
        if far["end"] == 10**9:
            return words, cost
        words, cost, at = words + 1, cost + far["end"], "end"
        while at != "origin":
            e = via[at]
            arcs[e][2] -= 1
            arcs[e ^ 1][2] += 1
            at = arcs[e][0]


def test_flow_is_the_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        sources = ["a", "b", "c", None][: rng.randrange(1, 5)]
        patterns = [(rng.randrange(0, 9), rng.sample(sources, rng.randrange(0, len(sources) + 1))) for _ in range(rng.randrange(0, 6))]
        quotas, repeats = {s: rng.randrange(0, 15) for s in sources}, rng.randrange(1, 4)
        got = op13.route(patterns, quotas, repeats)
        for s in sources:
            assert sum(f.get(s, 0) for f in got) <= quotas[s]
        cost = 0
        for (n, own), flow in zip(patterns, got, strict=True):
            assert set(flow) <= set(own) and sum(flow.values()) <= n * repeats
            times, rest = divmod(sum(flow.values()), n) if n else (0, 0)
            cost += n * sum(k * k for k in range(1, times + 1)) + rest * (times + 1) ** 2
        assert (sum(sum(f.values()) for f in got), cost) == plain_flow(patterns, quotas, repeats)


def test_choice_comes_near():
    assert op13.chosen([], []) == [] and op13.chosen([5], [0]) == [False] and op13.chosen([0, 0], [3, 0]) == [False, False]
    assert op13.chosen([5, 4, 3], [4, 0, 0]) == [False, True, False] and op13.chosen([10], [6]) == [True] and op13.chosen([10], [5]) == [False]
    assert op13.chosen([7, 8, 3], [9, 0, 0]) == [False, True, False]
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randrange(0, 500) for _ in range(rng.randrange(20, 60))]
        room = rng.randrange(sum(sizes))
        assert abs(sum(n for n, x in zip(sizes, op13.chosen(sizes, [room, *[0] * (len(sizes) - 1)]), strict=True) if x) - room) <= 12


def test_shares_reach_no_more_than_the_limit():
    assert op13.shared([100, 100, 100], [3, 1, 2], Fraction(450)) == [200, Fraction(250, 3), Fraction(500, 3)]
    assert op13.shared([10, 1000], [3, 1], Fraction(1515)) == [20, 1495]
    assert op13.shared([], [], Fraction(0)) == [] and op13.shared([0, 4], [3, 1], Fraction(6)) == [0, 6]


@pytest.mark.parametrize("units", [8, 4096])
def test_overlapping_sources(spark, monkeypatch, units):
    """Every quota is met to a few words; hot pattern, repeated rows, nulls, and clashing columns."""
    monkeypatch.setattr(op13, "UNITS", units)
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        own = ["web"] if i % 3 == 0 else rng.choice([["web", "books"], ["books"], ["code"], ["code", "web", "code"], [None], [None, "code"], [], None])
        rows.append((i, own, rng.randrange(0, 60) if i % 50 else 2000, "x"))
    rows += [(7, ["code"], 30, "x"), (7, ["code"], 30, "x"), (None, ["code"], None, None), (None, None, 5, None)]
    df = spark.createDataFrame(rows, "`doc.id` long, sources array<string>, size int, `key` string").withColumn("Copies", F.lit(9))
    words = collections.Counter()
    for _, own, n, _ in rows:
        words[tuple(sorted(set(own or []), key=repr))] += n or 0
    quotas = {"web": 30_000, "books": 50_000, "code": 9_000, None: 20_000, "nowhere": 5}
    got = op13.mix(df, quotas, repeats=3, id_col="doc.id")
    assert sorted(got.columns) == ["copies", "doc.id", "key", "size", "sources"]
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r.copies <= 3 for r in out)
    by, times = collections.Counter(), collections.defaultdict(set)
    for r in out:
        own = tuple(sorted(set(r.sources or []), key=repr))
        by[own] += r.copies * (r["size"] or 0)
        times[own].add(r.copies)
    order = sorted(words, key=lambda own: json.dumps(sorted(own, key=lambda s: (s is None, s)), separators=(",", ":")))
    for own, flow in zip(order, op13.route([(words[own], own) for own in order], quotas, 3), strict=True):
        assert abs(by[own] - sum(flow.values())) <= (60 if units > 64 else 600)
        assert max(times[own]) - min(times[own]) <= 1
    assert sum(by.values()) == pytest.approx(109_000, rel=0.02)
    again = op13.mix(df.repartition(7), quotas, repeats=3, id_col="doc.id").collect()
    key = lambda r: (str(r["doc.id"]), str(r["size"]), str(r["sources"]), r.copies)
    assert sorted(map(key, again)) == sorted(map(key, out))
    other = op13.mix(df, quotas, repeats=3, id_col="doc.id", seed=1).collect()
    assert sorted(map(key, other)) != sorted(map(key, out))
    assert op13.mix(df.limit(0), quotas, id_col="doc.id").count() == 0


def test_more_patterns_than_the_driver_takes(spark, monkeypatch):
    monkeypatch.setattr(op13, "PATTERNS", 2)
    df = spark.createDataFrame([(i, [str(i)], 1) for i in range(3)], "doc_id long, sources array<string>, size int")
    with pytest.raises(ValueError, match="patterns"):
        op13.mix(df, {"1": 1})


def test_query(spark, sf):
    got = QUERIES["op13_mixing"](spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        d = docs[r.doc_id]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) and r.taken in (0, r["size"], 2 * r["size"])
        sizes[d.source] += r["size"]
        taken[d.source] += r.taken
        target[d.source] = r.target
    names = sorted(sizes)
    weights = [(3, 1, 2)[i % 3] for i in range(len(names))]
    low, high = 0.0, float(sum(sizes.values()))
    for _ in range(200):  # the level at which min(weight * level, 2 * size) add up
        level = (low + high) / 2
        low, high = (level, high) if sum(min(w * level, 2 * sizes[s]) for s, w in zip(names, weights, strict=True)) < 1.5 * sum(sizes.values()) else (low, level)
    for s, w in zip(names, weights, strict=True):
        assert target[s] == pytest.approx(min(w * low, 2 * sizes[s]))
        assert abs(taken[s] - target[s]) <= max(30, 0.15 * target[s])  # some ten documents a source
    assert all(r.source_size == sizes[docs[r.doc_id].source] for r in got)
