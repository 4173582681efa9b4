"""What must not depend on one large file, one wide range or one task."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from helixframe.operators import geometry
from helixframe.operators import relational as R
from helixframe.sources import alignments as L
from helixframe.sources import storage
from helixframe.sources import structures as M
from helixframe.streaming import files as X


def atom_file(atoms: int) -> bytes:
    names = "group_PDB id type_symbol label_alt_id auth_comp_id auth_atom_id auth_asym_id auth_seq_id Cartn_x Cartn_y Cartn_z".split()
    rows = "\n".join(f"ATOM {i} C . ALA CA A {i} {i}.5 0.0 1.0" for i in range(atoms))
    return ("data_X\nloop_\n" + "\n".join(f"_atom_site.{n}" for n in names) + "\n" + rows + "\n").encode()


def test_atoms_of_a_large_file_take_linear_time():
    took = []
    for n in (20_000, 200_000):
        content = atom_file(n)
        start = time.process_time()
        got = M.parse_structure("x/big.cif", content)
        took.append(time.process_time() - start)
        assert got["error"] is None and [a["residue_pos"] for a in got["atoms"]] == list(range(n))
    assert took[1] < 25 * took[0]


def test_fasta_over_several_tasks(spark, tmp_path):
    rng = random.Random(4)
    records = [(f"id{i % 700} number {i}", "".join(rng.choice("ACDE") for _ in range(rng.randrange(1, 300)))) for i in range(3000)]
    wrapped = "".join(f">{h}\n" + "\n".join(s[k : k + 60] for k in range(0, len(s), 60)) + "\n" for h, s in records)
    (tmp_path / "big.fasta").write_text(wrapped)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = L.read_fasta(spark, str(tmp_path / "big.fasta"))
        assert spark.read.text(str(tmp_path / "big.fasta")).rdd.getNumPartitions() > 3
        got = [(r.description, r.sequence) for r in df.orderBy("pos").collect()]
        last = {r.id: r.sequence for r in L.read_fasta(spark, str(tmp_path / "big.fasta"), keep="last").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == records and [r.pos for r in df.orderBy("pos").collect()] == list(range(3000))
    assert last == {h.split()[0]: s for h, s in records}


def test_numbers_over_uneven_values(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGE_ROWS", 10)
    values = [*range(200), *(2**60 + i * i for i in range(40)), -(2**62)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    got = {r.v: r.n for r in R.numbered(df, "v", "n", start=3).collect()}
    assert got == {v: i + 3 for i, v in enumerate(sorted(values))}
    sizes = [r[0] for r in R.batches(df, "v", 50).groupBy("batch").count().orderBy("batch").select("count").collect()]
    assert sizes == [50, 50, 50, 50, 41]
    with pytest.raises(ValueError, match="one row at least"):
        R.batches(df, "v", 0)


def plain_aligned(query: str, other: str) -> float:
    """The best score, cell by cell."""
    n, m = len(query), len(other)
    score = np.zeros((n + 1, m + 1))
    score[1:, 0], score[0, 1:] = -10 - np.arange(n), -10 - np.arange(m)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            score[i, j] = max(score[i - 1, j - 1] + (4 if query[i - 1] == other[j - 1] else -1), score[i - 1, j] - 1, score[i, j - 1] - 1)
    return score[n, m]


def test_alignment_by_rows_is_the_best():
    rng = random.Random(6)
    for _ in range(60):
        a, b = ("".join(rng.choice("ACDE") for _ in range(rng.randrange(0, 14))) for _ in range(2))
        x, y = geometry.aligned(a, b)
        assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)
        total, i, j = 0.0, 0, 0
        for p, q in zip(x, y, strict=True):
            total += (4 if p == q else -1) if "-" not in (p, q) else ((-10 if (i == 0 and j == 0) else -1) if (i == 0 or j == 0) else -1)
            i, j = i + (p != "-"), j + (q != "-")
        assert total == plain_aligned(a, b)


def test_storage(spark, tmp_path):
    box = storage.create_storage(spark, f"file://{tmp_path}/box")
    assert box.list() == [] and not box.exists("a/b")
    box.put("a/b", b"one")
    box.put("a/b", b"\x00\xff two")
    box.put_json("a/c.json", {"k": [1, None]})
    box.put_arrays("d.npz", x=np.array([1, 2, 3]), y=np.array([[1.5, 2], [3, 4]]))
    assert box.get("a/b") == b"\x00\xff two" and box.get_json("a/c.json") == {"k": [1, None]}
    assert {k: v.tolist() for k, v in box.get_arrays("d.npz").items()} == {"x": [1, 2, 3], "y": [[1.5, 2.0], [3.0, 4.0]]}
    assert box.list("a/") == ["a/b", "a/c.json"] and box.list() == ["a/b", "a/c.json", "d.npz"]
    assert box.delete("a/b") and not box.delete("a/b")
    with pytest.raises(KeyError):
        box.get("a/b")
    with pytest.raises(ValueError, match="not a store"):
        storage.create_storage(spark, "ftp://x/y")


def test_retries():
    calls, waits = [], []

    def failing(limit):
        calls.append(1)
        if len(calls) < limit:
            raise OSError("no")
        return "done"

    assert X.retried(failing, 3, sleep=waits.append, draw=lambda: 0.5)(3) == "done" and waits == [1.0, 2.0]
    calls.clear()
    with pytest.raises(OSError, match="no"):
        X.retried(failing, 2, sleep=waits.append)(9)
    assert len(calls) == 2


def test_oversized_files_are_dead_letters(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "MOST_BYTES", 50)
    (tmp_path / "in").mkdir()
    for name, size in (("small.txt", 10), ("large.txt", 200)):
        (tmp_path / "in" / name).write_text("x" * size)
    X.stream_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/dead", f"{tmp_path}/log", lambda path, content: content.upper()).awaitTermination()
    done = [r.path.rsplit("/", 1)[-1] for r in spark.read.parquet(f"{tmp_path}/out/*").collect()]
    dead = {r.path.rsplit("/", 1)[-1]: r.error for r in spark.read.parquet(f"{tmp_path}/dead/*").collect()}
    assert done == ["small.txt"] and dead == {"large.txt": "200 bytes are more than 50"}


def test_symmetry_keeps_to_its_own_structure(spark):
    points = spark.createDataFrame([("s", 1.0, 2.0, 3.0), ("t", 1.0, 2.0, 3.0)], "structure_id string, x double, y double, z double")
    names = ["structure_id", "op", *(f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)), "t1", "t2", "t3"]
    ops = spark.createDataFrame([("s", "1", 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0), ("s", "2", -1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 9.0), ("t", "1", 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.5, 0.0, 0.0)], names)
    got = sorted((r.structure_id, r.op, r.x, r.y, r.z) for r in R.expand_symmetry(points, ops, ["structure_id"]).collect())
    assert got == [("s", "1", 1.0, 2.0, 3.0), ("s", "2", -1.0, -2.0, 12.0), ("t", "1", 1.5, 2.0, 3.0)]
    assert "Cartesian" not in R.expand_symmetry(points, ops, ["structure_id"])._jdf.queryExecution().toString()


def test_draws_follow_weights(spark):
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate((0, 1, 3, 6))], "k long, w double")
    got = {r.k: r["count"] for r in R.drawn(df, "k", "w", 4000, 5).groupBy("k").count().collect()}
    assert set(got) == {1, 2, 3} and sum(got.values()) == 4000
    assert all(abs(got[k] / 4000 - w / 10) < 0.03 for k, w in ((1, 1), (2, 3), (3, 6)))


def test_finished_tasks_take_no_worker(spark):
    from pyspark.sql import functions as F

    from helixframe.streaming import tasks

    rows = [("j", 1, "completed", 1, 9), ("j", 2, "completed", 1, 8), ("j", 3, "pending", 0, 1), ("j", 4, "pending", 2, 0), ("j", 5, "pending", 0, 0), ("k", 6, "cancelled", 0, 9), ("k", 7, None, 0, 9), ("k", 8, "pending", 0, None)]
    got = tasks.fetched(spark.createDataFrame(rows, "job string, task int, state string, tried int, priority int"), 2, [F.col("task")])
    assert {r.task: (r.state, r.tried) for r in got.collect()} == {1: ("completed", 1), 2: ("completed", 1), 3: ("assigned", 1), 4: ("assigned", 3), 5: ("pending", 0), 6: ("cancelled", 0), 7: (None, 0), 8: ("assigned", 1)}


def test_near_pairs_are_all_pairs(spark):
    """Against all pairs: any width, thresholds met exactly, points on cells' edges, far away and without a place."""
    import math
    import random

    from helixframe.operators import spatial

    rng = random.Random(4)
    rows = [(i, i % 2, *(rng.choice([rng.uniform(-3, 3), float(rng.randrange(-3, 4))]) for _ in range(3))) for i in range(300)]
    rows += [(300, 0, math.nan, 0.0, 0.0), (301, 0, 1e9, 0.0, 0.0), (302, 0, 1e9 + 0.5, 0.0, 0.0), (303, 1, -1e9, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "i int, g int, x double, y double, z double").repartition(3)
    far = lambda a, b: math.sqrt(sum((p - q) * (p - q) for p, q in zip(a[2:], b[2:], strict=True)))
    for threshold, width, strict in ((1.0, None, False), (1.0, 1.0, True), (0.5, 3.0, False), (2.0, 2.5, True)):
        close = lambda a, b, t=threshold, s=strict: far(a, b) < t if s else far(a, b) <= t
        want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and close(a, b))
        got = spatial.near_pairs(df, "i", threshold, ("g",), strict, width).select("a_i", "b_i").collect()
        assert sorted(map(tuple, got)) == want
        both = spatial.within(df.filter("i < 150"), df, threshold, ("g",), strict).select("a_i", "b_i").collect()
        assert sorted(map(tuple, both)) == sorted((a[0], b[0]) for a in rows[:150] for b in rows if a[1] == b[1] and close(a, b))
    assert spatial.near_pairs(df.limit(0), "i", 1.0).count() == 0


def test_repeated_atom_names_keep_the_first(spark):
    from helixframe.operators import structures as S

    rows = [("s", "A", 0, 1, "", "ALA", "CA", p, "C", float(p), 0.0, 0.0) for p in (3, 1, 2)] + [("s", "A", 0, 1, "", "ALA", "N", 0, "N", 0.0, 0.0, 0.0)]
    r = S.residues(spark.createDataFrame(rows, "structure_id string, chain_id string, residue_pos int, seq_id int, ins_code string, residue string, atom string, atom_pos int, element string, x double, y double, z double")).first()
    assert r.n_atoms == 4 and set(r.atoms) == {"CA", "N"} and r.atoms["CA"].x == 1.0


def test_points_are_not_broadcast_by_their_file(spark, tmp_path):
    """A file of few bytes with many points must not send them through the driver."""
    from helixframe.operators import spatial

    spark.range(20_000).selectExpr("id", "0 as g", "id % 10 * 1.0 as x", "id div 10 * 2.0 as y", "0.0 as z").write.parquet(f"{tmp_path}/points")
    p = spark.read.parquet(f"{tmp_path}/points")
    for joined in (spatial.near_pairs(p, "id", 1.5, ("g",)), spatial.within(p, p, 1.5, ("g",))):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert spatial.near_pairs(p, "id", 1.5, ("g",)).count() == 18_000


def test_bonds_and_features_are_not_broadcast(spark, sf):
    """As above, for the tokens of bonds and the rows of a structure; a bond's kind is not worked out inside the join."""
    from helixframe.operators import assemble
    from helixframe.operators import structures as S
    from helixframe.plans.fixture import atoms

    a = atoms(spark, sf)
    t, bonds = S.tokens(a), S.bonded(a)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(assemble.assembled(a, t, S.bond_tokens(bonds, t)))
    joins = [x for x in plan(bonds).splitlines() if "SortMergeJoin" in x]
    assert len(joins) == 1 and "disulfide" not in joins[0] and "kind" not in joins[0].rsplit("], Inner", 1)[-1]


def test_atoms_and_tokens_meet_by_merge(spark, sf):
    """Tokens of a file of few bytes must not go through the driver to find their atoms; interfaces' atoms neither."""
    from helixframe.operators import structures as S
    from helixframe.plans.fixture import atoms

    a = atoms(spark, sf)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    t = S.tokens(a)
    assert "Broadcast" not in plan(S.token_atoms(a, t)) and "Broadcast" not in plan(S.ligand_bonds(a, t))
    for found in (S.bonded(a), S.neighbours(a), S.touching_chains(a)):
        assert "Broadcast" not in plan(found)
    near = [x for x in plan(S.interfaces(a)).splitlines() if "__cell" in x and "Join" in x]
    assert near and all("SortMergeJoin" in x for x in near)


def test_atoms_are_exchanged_once_for_tokens_and_features(spark, sf):
    """One exchange by structure and one sort of atoms serve groups, token numbers and feature rows."""
    from helixframe.operators import assemble
    from helixframe.operators import structures as S
    from helixframe.plans.fixture import atoms

    a = atoms(spark, sf)
    t = S.tokens(a)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(t).count("Exchange") == 1 and sum("Sort [" in x for x in plan(t).splitlines()) == 1
    assert plan(assemble.token_features(t)).count("Exchange") == 1


def test_centres_of_tokens(spark):
    """The highest of repeated centres, else the first atom; other codes than standard ones have a token an atom."""
    from helixframe.operators import structures as S

    named = [("ALA", "CA", 3, 1.0), ("ALA", "N", 0, 9.0), ("ALA", "CA", 1, 2.0), ("GLY", "O", 2, 5.0), ("GLY", "C", 1, 6.0), ("GLY", None, 3, 7.0), ("ala", "CA", 5, 1.0), ("ala", "N", 4, 3.0), ("DA", "C1'", 2, 4.0), ("DA", "CA", 0, 8.0), ("ZN", "ZN", 0, 1.0), ("ATP", "CA", 1, 1.0), ("ATP", "C2", 0, 2.0)]
    pos = {r: i for i, r in enumerate(dict.fromkeys(r for r, *_ in named))}
    rows = [("s", "A", pos[r], pos[r], "", r, atom, p, "C", x, 0.0, 0.0) for r, atom, p, x in named] + [("s", "A", 0, 0, "", "ALA", "H", 9, "H", 99.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "structure_id string, chain_id string, residue_pos int, seq_id int, ins_code string, residue string, atom string, atom_pos int, element string, x double, y double, z double").repartition(3)
    got = [(r.residue, r.kind, r.n_atoms, r.x, r.atom) for r in S.tokens(df).orderBy("token").collect()]
    assert got == [("ALA", "PROTEIN", 3, 2.0, None), ("GLY", "PROTEIN", 3, 6.0, None), ("ala", "LIGAND", 2, 3.0, None), ("DA", "DNA", 2, 4.0, None), ("ZN", "ION", 1, 1.0, "ZN"), ("ATP", "LIGAND", 1, 2.0, "C2"), ("ATP", "LIGAND", 1, 1.0, "CA")]
