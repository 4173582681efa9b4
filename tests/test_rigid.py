"""Superpositions by sums, symmetry groups and random motions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import geometry, rigid
from helixframe.plans import rigid as plans

M, T = ("ax", "ay", "az"), ("bx", "by", "bz")
PAIR = "g string, ax double, ay double, az double, bx double, by double, bz double, w double"


def rows(rng, name: str, n: int, mirror: bool = False, noise: float = 0.1) -> list[tuple]:
    a = rng.normal(size=(n, 3)) * 5 + 40
    r = plans.turn(tuple(rng.normal(size=3)), float(rng.uniform(0, 180)))
    b = (a * ([-1, 1, 1] if mirror else [1, 1, 1])) @ r.T + rng.normal(size=3) * 30 + rng.normal(size=(n, 3)) * noise
    return [(name, *map(float, x), *map(float, y), float(rng.integers(0, 3))) for x, y in zip(a, b, strict=True)]


@pytest.mark.parametrize("weight", [None, "w"])
def test_superpositions_match_whole_groups(spark, weight):
    rng = np.random.default_rng(2)
    given = [*rows(rng, "a", 50), *rows(rng, "mirror", 40, True), *rows(rng, "exact", 20, noise=0.0), *rows(rng, "three", 3), *rows(rng, "two", 2), ("flat", 0, 0, 0, 0, 0, 0, 1.0), ("flat", 1, 0, 0, 0, 1, 0, 1.0), ("flat", 0, 2, 0, -2, 0, 0, 1.0), ("none", *[None] * 6, 1.0), ("a", math.nan, 1, 1, 1, 1, 1, 1.0), ("a", 1, 1, 1, 1, None, 1, 1.0)]
    given = [(g, *(None if x is None else float(x) for x in rest)) for g, *rest in given]
    df = spark.createDataFrame(given, PAIR).repartition(5)
    got = {r.g: r for r in rigid.superpositions(df, ["g"], M, T, weight).collect()}
    assert "none" not in got and set(got) >= {"a", "mirror", "exact", "flat"}
    for g, r in got.items():
        own = np.array([x[1:] for x in given if x[0] == g and None not in x and not any(math.isnan(v) for v in x[1:])])
        w = own[:, 6] if weight else np.ones(len(own))
        own, w = own[w > 0], w[w > 0]
        assert r.n == len(own) and r.weight == pytest.approx(w.sum())
        if len(own) < 3:
            assert r.rmsd is None and r.rotation is None and r.translation is None
            continue
        if not weight:
            assert r.rmsd == pytest.approx(geometry.superposition(own[:, :3], own[:, 3:6])[2], abs=1e-5)
        rotation = np.array(r.rotation).reshape(3, 3)
        assert np.allclose(rotation @ rotation.T, np.eye(3)) and np.linalg.det(rotation) == pytest.approx(1)
        moved = own[:, :3] @ rotation.T + r.translation
        assert r.rmsd == pytest.approx(np.sqrt((w[:, None] * (moved - own[:, 3:6]) ** 2).sum() / w.sum()), abs=1e-5)
    assert got["exact"].rmsd < 1e-5 and got["flat"].rmsd < 1e-6 and got["mirror"].rmsd > 1
    assert rigid.superpositions(df.limit(0), ["g"], M, T).count() == 0


def test_a_large_group_is_spread_over_tasks(spark):
    """A key of a million points combines in every task before one row a task is exchanged."""
    n = 1_000_000
    u = [rigid.uniform(k, "id") for k in range(3)]
    df = spark.range(n, numPartitions=4).select(F.concat(F.lit("one"), F.col("id") % 1).alias("g"), *(x.alias(c) for x, c in zip(u, M, strict=True)))
    df = df.withColumns({"bx": -F.col("ay") + 3, "by": F.col("ax") - 1, "bz": F.col("az")})
    out = rigid.superpositions(df, ["g"], M, T)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "FlatMapGroups" not in plan and plan.count("Exchange hashpartitioning(g") == 1
    r = out.first()
    assert r.n == n and r.rmsd < 1e-5 and np.allclose(r.rotation, [0, -1, 0, 1, 0, 0, 0, 0, 1], atol=1e-9) and np.allclose(r.translation, [3, -1, 0], atol=1e-9)
    back = rigid.fitted(df.limit(5), out, ["g"], M).collect()
    assert all(abs(x.ax - x.bx) + abs(x.ay - x.by) + abs(x.az - x.bz) < 1e-6 for x in back)


def test_symmetry_groups(spark):
    matrices = {name: [np.array(m[2:]).reshape(3, 3) for m in plans.elements() if m[0] == g] for g, name in enumerate(plans.GROUPS)}
    rng = np.random.default_rng(3)
    extra = {"C4": [plans.turn((1, 2, 3), 90 * k) for k in range(4)], "C7": [plans.turn((0, 1, 0), 360 / 7 * k) for k in range(7)], "unknown": [np.eye(3), plans.turn((0, 0, 1), 90)], "unknown ": [np.eye(3), plans.turn((0, 0, 1), 180), plans.turn((1, 0, 1), 180)]}
    table = []
    for name, found in (matrices | extra).items():
        side = plans.turn(tuple(rng.normal(size=3)), float(rng.uniform(0, 180)))
        table += [(name, *map(float, (side @ m @ side.T).ravel())) for m in found]
    table += [x for x in table if x[0] == "D3"]  # operators that are listed twice
    df = spark.createDataFrame(table, "g string, " + ", ".join(f"r{i}{j} double" for i in (1, 2, 3) for j in (1, 2, 3)))
    got = {r.g: r.symmetry for r in rigid.symmetry_groups(df, ["g"]).collect()}
    assert got == {name: name.strip() for name in (*matrices, *extra)}
    facts = rigid.rotation_facts(df.filter("g = 'C7'")).collect()
    assert sorted(r.order for r in facts) == [1] + [7] * 6 and all(r.axis is None or abs(sum(x * x for x in r.axis) - 1) < 1e-9 for r in facts)


def test_augmented_groups_are_turned(spark):
    rng = np.random.default_rng(4)
    points = [(g, i, *map(float, rng.normal(size=3) * 4 + 9)) for g in range(200) for i in range(3)] + [(None, 0, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(points, "g int, i int, x double, y double, z double").repartition(4)
    out = rigid.augmented(df, ["g"], 7, 2.0).filter("g is not null").orderBy("g", "i").collect()
    again = rigid.augmented(df.repartition(2), ["g"], 7, 2.0).filter("g is not null").orderBy("g", "i").collect()
    assert len(out) == 600 and np.allclose([r[2:] for r in out], [r[2:] for r in again])
    a, b = (np.array([r[2:] for r in t]).reshape(200, 3, 3) for t in ([p for p in points if p[0] is not None], out))
    side = lambda p: np.linalg.norm(p - np.roll(p, 1, axis=1), axis=2)
    volume = lambda p: np.linalg.det(np.stack([p[:, 1] - p[:, 0], p[:, 2] - p[:, 0], np.cross(p[:, 1] - p[:, 0], p[:, 2] - p[:, 0])], axis=1))
    assert np.allclose(side(a), side(b)) and np.allclose(volume(a), volume(b))
    middles = b.mean(axis=1)
    assert abs(middles.mean()) < 0.5 and 1.7 < middles.std() < 2.3
    rows_ = df.select("g").filter("g is not null").distinct().select(F.array(*(F.array(*r) for r in rigid.random_rotation(7, "g"))).alias("r")).collect()
    turns = np.array([r.r for r in rows_])
    assert np.allclose(turns @ turns.transpose(0, 2, 1), np.eye(3)) and np.allclose(np.linalg.det(turns), 1) and abs(turns.mean(axis=0)).max() < 0.15
    still = rigid.augmented(df.filter("g = 1"), ["g"], 7, centred=False, rotated=False, shifted=False).orderBy("i").collect()
    assert [r.x for r in still] == [p[2] for p in points if p[0] == 1]


def test_pairs_of_structures_meet_by_one_exchange(spark, sf):
    """Atoms are read and exchanged by structure once for the fits and the moved points together, and fits are made once."""
    from helixframe.plans.fixture import atoms

    p = plans.paired(spark, sf, True)
    own = {}
    for r in atoms(spark, sf).filter("chain_id = 'AF'").collect():
        own.setdefault(r.structure_id, {})[r.residue_pos, r.atom_pos] = r
    names = sorted(own)
    want = {(s, *k): (a.x, a.y, a.z, b.x, b.y, b.z, 0.0 if a.element == "H" else k[1] + 1.0) for s, o in zip(names, names[1:], strict=False) for k, a in own[s].items() if (b := own[o].get(k))}
    got = p.select("structure_id", "residue_pos", "atom_pos", *M, *T, "w").collect()
    assert len(got) == len(want) > 0 and {tuple(r[:3]): tuple(r[3:]) for r in got} == want
    df = plans.l14_rotations(spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("MapInPandas") == 1 and "residue_pos" not in "".join(x for x in plan.splitlines() if "Join" in x)
    points = [x for x in plan.splitlines() if "Exchange hashpartitioning(structure_id" in x and "REPARTITION_BY_COL" in x and "Reused" not in x]
    assert len(points) == 1, plan
