from __future__ import annotations

import numpy as np

from helixframe.operators import geometry
from helixframe.operators import structures as S

ATOM = "structure_id string, chain_id string, residue_pos int, seq_id int, ins_code string, residue string, atom string, atom_pos int, element string, x double, y double, z double"


def atoms(spark, rows):
    return spark.createDataFrame([("s", c, p, p + 1, "", r, a, i, a[0], *map(float, xyz)) for i, (c, p, r, a, xyz) in enumerate(rows)], ATOM)


def test_glycosidic_and_pocket(spark):
    df = atoms(spark, [("A", 0, "ASN", "ND2", (0, 0, 0)), ("A", 0, "ASN", "CA", (3, 0, 0)), ("G", 0, "NAG", "C1", (1.4, 0, 0)), ("G", 1, "NAG", "C1", (1.4, 1.5, 0)), ("G", 3, "NAG", "C1", (1.4, -1.5, 0)), ("A", 9, "GLY", "CA", (60, 0, 0))])
    codes = spark.createDataFrame([("NAG",), ("NAG",)], "code string")
    assert {(r.chain_id_1, r.residue_pos_1, r.chain_id_2, r.residue_pos_2) for r in S.glycosidic(df, codes).collect()} == {("G", 0, "A", 0), ("G", 0, "G", 1)}
    assert [(r.residue_pos, r.atom) for r in S.pocket(df).collect()] == [(0, "CA")]


def test_leaving_atoms(spark):
    df = atoms(spark, [("A", 0, "X", "C1", (0, 0, 0)), ("A", 0, "X", "O1", (1, 0, 0)), ("B", 0, "X", "O1", (5, 0, 0)), ("C", 0, "X", "O1", (9, 0, 0))])
    bonds = spark.createDataFrame([("s", "A", 1, "C1", "B", 1, "C1")], "structure_id string, chain_1 string, seq_1 int, atom_1 string, chain_2 string, seq_2 int, atom_2 string")
    known = spark.createDataFrame([("X", "O1", True), ("X", "C1", False)], "code string, atom string, leaving boolean")
    assert sorted((r.chain_id, r.atom) for r in S.without_leaving_atoms(df, bonds, known).collect()) == [("A", "C1"), ("C", "O1")]


def test_frames_match_the_kernel(spark):
    rng = np.random.default_rng(3)
    p = rng.normal(size=(3, 3))
    rows = [("A", 0, "ALA", n, x) for n, x in zip(("N", "CA", "C"), p, strict=True)] + [("A", 1, "ALA", n, (i, 0, 0)) for i, n in enumerate(("N", "CA", "C"))] + [("A", 2, "GLY", "CA", (1, 1, 1))]
    got = {r.residue_pos: r for r in S.frames(S.residues(atoms(spark, rows))).collect()}
    assert np.allclose([got[0].ex, got[0].ey, got[0].ez], geometry.frame(*p)) and np.allclose([got[0].x, got[0].y, got[0].z], p[1])
    assert got[1].ex is None and got[1].ez is None and got[2].ey is None
