from __future__ import annotations

import numpy as np

from helixframe.operators import geometry
from helixframe.plans import files, kernels, structures
from helixframe.streaming import tasks


def test_symmetry_operators():
    turns = geometry.icosahedral()
    assert len(turns) == 60 and all(np.allclose(r @ r.T, np.eye(3)) and np.isclose(np.linalg.det(r), 1) for r in turns)
    assert sorted({round(geometry.rotation_angle(r)) for r in turns}) == [0, 72, 120, 144, 180]
    m = np.eye(4)
    m[:3, :3], m[:3, 3] = turns[7], [1, 2, 3]
    assert np.allclose(geometry.composed([m, geometry.inverse(m)]), np.eye(4))
    axis = geometry.rotation_axis(np.diag([-1.0, -1.0, 1.0]))
    assert np.allclose(axis, [0, 0, 1]) and geometry.rotation_axis(np.eye(3)) is None


def test_growth_and_mapping():
    contacts = {("A", "B"): 5, ("B", "C"): 9, ("A", "C"): 1}
    got = geometry.grown(contacts, ["A", "B", "C", "D"], 3, 0)
    assert len(got) == 3 and "D" not in got[1:] or got[0] == "D"
    assert geometry.grown(contacts, ["A"], 5, 0) == ["A"] and geometry.grown({}, [], 5, 0) == []
    assert geometry.mapped("AC-G", "-CTG") == [-1, 0, 2]


def test_kernel_queries(spark, sf):
    fits = kernels.l13_superposition(spark, sf).collect()
    assert fits and all(r.rmsd is None or r.rmsd >= 0 for r in fits)
    rows = kernels.l26_realigned(spark, sf).collect()
    names = {r.p_partkey: (r.p_name, r.p_type) for r in spark.read.parquet(f"{sf}/part.parquet").collect()}
    assert all((r.query.replace("-", ""), r.template.replace("-", "")) == tuple(x.replace("-", "") for x in names[r.p_partkey]) and len(r.query) == len(r.template) for r in rows)
    assert kernels.g06_greedy(spark, sf).count() > 0
    crop = kernels.j04_contiguous_crop(spark, sf).groupBy("structure_id").count().collect()
    assert crop and all(r["count"] <= 16 for r in crop)
    near = {}
    for r in structures.QUERIES["d11_interfaces"](spark, sf).collect():
        near.setdefault(r.structure_id, set()).add((r.chain_1, r.chain_2))
    grown = {}
    for r in kernels.g12_chain_growth(spark, sf).orderBy("structure_id", "place").collect():
        grown.setdefault(r.structure_id, []).append(r.chain_id)
    assert len(grown) == 10 and all(len(c) == len(set(c)) <= 4 for c in grown.values())
    touching = lambda s, c, others: any((min(c, o), max(c, o)) in near.get(s, ()) for o in others)
    assert sum(touching(s, c, own[:i]) for s, own in grown.items() for i, c in enumerate(own) if i) > 20
    assert files.QUERIES["k01_search"](spark, sf).filter("NOT found").count() == spark.read.parquet(f"{sf}/supplier.parquet").count()


def test_realigned_rows_are_dealt_out(spark, sf):
    """However small their file is."""
    assert kernels.l26_realigned(spark, sf).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_task_stream_matches_plain_machine(spark, sf):
    want: dict[str, tuple[str, int]] = {}
    for r in spark.read.parquet(f"{sf}/events.parquet").orderBy("event_id").collect():
        report = {"view": "started", "purchase": "completed"}.get(r.event_type, "failed")
        want[str(r.user_id)] = tasks.step(*want.get(str(r.user_id), ("pending", 0)), report, 3)
    assert {r.task: (r.state, r.tried) for r in kernels.n16_task_stream(spark, sf).collect()} == want
