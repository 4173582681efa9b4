"""Token frames and model inputs: small structures by hand, plans by their exchanges."""

from __future__ import annotations

import math

import pytest

from helixframe.operators import inputs as I
from helixframe.operators import structures as S

ATOM = "structure_id string, chain_id string, residue_pos int, seq_id int, ins_code string, residue string, atom string, atom_pos int, element string, x double, y double, z double, charge int"


def residue(structure: str, chain: str, pos: int, code: str, *atoms: tuple) -> list[tuple]:
    return [(structure, chain, pos, pos + 10, "", code, name, i, name[:1], float(x), float(y), float(z), 0) for i, (name, x, y, z) in enumerate(atoms)]


@pytest.fixture(scope="module")
def made(spark):
    rows = (
        residue("s", "A", 0, "ALA", ("N", 0, 1, 0), ("CA", 0, 0, 0), ("C", 1, 0, 0), ("CB", -1, 0, 1))
        + residue("s", "A", 1, "GLY", ("N", 4, 0, 0), ("CA", 5, 0, 0), ("C", 6, 0, 0))  # on a line
        + residue("s", "A", 2, "SER", ("N", 8, 1, 0), ("C", 9, 0, 0))  # no CA
        + residue("s", "B", 0, "DA", ("P", 0, 9, 0), ("C4'", 0, 8, 1), ("C1'", 0, 7, 0), ("C3'", 0, 6, 0))
        + residue("s", "C", 0, "LIG", ("C1", 0, 0, 20), ("C2", 1, 0, 20), ("C3", 0, 1, 20), ("C4", -1, 0, 20), ("H1", 0, 0, 21))  # three at the same distance from C1
        + residue("s", "D", 0, "ZN", ("ZN", 5, 5, 5))
        + residue("t", "A", 0, "TWO", ("C1", 0, 0, 0), ("C1", 1, 0, 0))  # a name twice
        + residue("t", "A", 1, "ALA", ("N", math.nan, 0, 0), ("CA", 0, 0, 0), ("C", 1, 0, 0), ("C", 9, 9, 9))
        + residue("u", "A", 0, "ALA", ("H", 0, 0, 0))  # nothing but a hydrogen
    )
    return spark.createDataFrame(rows, ATOM).repartition(3)


def test_frames(made):
    got = {(r.structure_id, r.token): (r.has_frame, r.frame_atoms) for r in I.token_frames(I.residue_blocks(made)).collect()}
    none = (0, [-1, -1, -1])
    assert got == {
        ("s", 0): (1, [0, 1, 2]), ("s", 1): none, ("s", 2): none, ("s", 3): (1, [11, 12, 10]),
        ("s", 4): (1, [14, 13, 15]), ("s", 5): (1, [13, 14, 15]), ("s", 6): (1, [13, 15, 14]), ("s", 7): (1, [13, 16, 15]), ("s", 8): none,
        ("t", 0): none, ("t", 1): none, ("t", 2): none,
    }
    assert I.token_frames(I.residue_blocks(made.limit(0))).count() == 0


def test_frames_follow_the_angle(spark):
    rows = []
    for i, degrees in enumerate((24.9, 25.1, 90, 154.9, 155.1, 180, 0)):
        a = math.radians(degrees)
        rows += residue(f"s{i}", "A", 0, "ALA", ("N", 1, 0, 0), ("CA", 0, 0, 0), ("C", math.cos(a), math.sin(a), 0))
    rows += residue("s7", "A", 0, "ALA", ("N", 0, 0, 0), ("CA", 0, 0, 0), ("C", 1, 0, 0))
    got = {r.structure_id: r.has_frame for r in I.token_frames(I.residue_blocks(spark.createDataFrame(rows, ATOM))).collect()}
    assert got == {"s0": 0, "s1": 1, "s2": 1, "s3": 1, "s4": 0, "s5": 0, "s6": 0, "s7": 0}


def test_inputs(spark, made):
    msa = spark.createDataFrame([("s", "A", 0, "AGS", [0, 1, 0]), ("s", "A", 1, "A-S", None), ("s", "C", 0, "X", [2]), ("zz", "A", 0, "A", [0])], "structure_id string, chain_id string, row int, sequence string, deletions array<int>")
    tpl = spark.createDataFrame([("s", "A", 1, 2, 7, [1.0, 2.0, 3.0], 1, 1), ("s", "A", 1, 0, 5, None, 0, 1), ("s", "A", 3, 9, 5, None, 0, 1)], "structure_id string, chain_id string, slot int, pos int, aatype int, pseudo_beta array<double>, pseudo_beta_mask int, frame_mask int")
    bonds = spark.createDataFrame([("s", 0, 1), ("s", 1, 0), ("s", 0, 1), ("s", 4, 5)], "structure_id string, token_1 int, token_2 int")
    out = I.model_inputs(made, msa, tpl, bonds, most_rows=2)
    got = {r.structure_id: r for r in out.collect()}
    assert sorted(got) == ["s", "t"]
    s, t = got["s"], got["t"]
    assert (s.n_tokens, s.n_atoms, s.asym_id, s.atoms_in_token) == (9, 18, [0, 0, 0, 1, 2, 2, 2, 2, 3], [4, 3, 2, 4, 1, 1, 1, 1, 1])
    assert s.atom_to_token == [0] * 4 + [1] * 3 + [2] * 2 + [3] * 4 + [4, 5, 6, 7, 8] and s.restype[:4] == [0, 7, 15, 26]
    assert s.centre[2] == [8, 1, 0] and s.pseudo_beta[:3] == [[-1, 0, 1], [5, 0, 0], None] and s.pseudo_beta_mask == [1, 1] + [0] * 7
    assert s.n_rows == 2 and s.msa == [[0, 0], [7, 31], [15, 15], [31, 31], *[[20, 31]] * 4, [31, 31]] and s.deletions[1] == [1, 0] and s.deletions[4] == [2, 0]
    assert s.profile[1][7] == s.profile[1][31] == 0.5 and sum(s.profile[3]) == 0 and s.deletion_mean == [0, 0.5, 0, 0, 2, 2, 2, 2, 0] and s.has_deletion[1] == 1
    assert s.template_aatype[0] == [31] * 9 and s.template_aatype[1] == [5, 31, 7, *[31] * 6] and s.template_pseudo_beta[1][2] == [1, 2, 3] and s.template_pseudo_beta[1][0] == [0, 0, 0] and s.template_frame_mask[1][:3] == [1, 0, 1]
    assert [tuple(b) for b in s.token_bonds] == [(0, 1), (1, 0), (4, 5)]
    assert (t.n_rows, t.msa, t.token_bonds, t.template_aatype[0]) == (0, [[]] * 3, [], [31] * 3)
    kept = spark.createDataFrame([("s", k) for k in (5, 4, 0, 7, 77)], "structure_id string, token int")
    (c,) = I.with_pairs(I.cropped_inputs(out, kept)).collect()
    assert (c.n_tokens, c.n_atoms, c.seq_id, c.atom_to_token) == (4, 7, [10, 10, 10, 10], [0] * 4 + [1, 2, 3])
    assert c.frame_atoms == [[0, 1, 2], [-1] * 3, [-1] * 3, [-1] * 3] and c.has_frame == [1, 0, 0, 0]  # C3 is cropped, and with it the frames that use it
    assert [tuple(b) for b in c.token_bonds] == [(1, 2)] and c.msa == [[0, 0]] + [[20, 31]] * 3 and c.template_aatype[1] == [5, 31, 31, 31]
    assert c.same_chain[1] == [0, 1, 1, 1] and c.relative_position[0] == [32, 65, 65, 65] and c.distogram[1][1] is None and c.distogram[1][2] == 0
    assert I.model_inputs(made.limit(0), msa, tpl, bonds).count() == 0


def test_pairs_need_no_frames(spark, made):
    """Frames are most of the work of a structure's row, and what is left out of it can't be pruned from inside its residues."""
    bare = I.model_inputs(made, frames=False)
    assert set(I.model_inputs(made).columns) - set(bare.columns) == {"frame_atoms", "has_frame"}
    kept = spark.createDataFrame([("s", k) for k in (5, 4, 0, 7)], "structure_id string, token int")
    got, want = (I.with_pairs(I.cropped_inputs(i, kept)).select("seq_id", "relative_position", "same_chain", "distogram").first() for i in (bare, I.model_inputs(made)))
    assert got == want
    plan = bare.select("structure_id", "centre")._jdf.queryExecution().optimizedPlan().toString()
    assert "acos" not in plan.lower() and "upper(element" not in plan


def test_one_exchange_for_an_input(spark, made):
    """Each input is shuffled once; all that follows keeps the partitions."""
    msa = spark.createDataFrame([("s", "A", 0, "AGS", [0, 1, 0])], "structure_id string, chain_id string, row int, sequence string, deletions array<int>")
    tpl = spark.createDataFrame([("s", "A", 1, 2, 7, [1.0, 2.0, 3.0], 1, 1)], "structure_id string, chain_id string, slot int, pos int, aatype int, pseudo_beta array<double>, pseudo_beta_mask int, frame_mask int")
    bonds, kept = spark.createDataFrame([("s", 0, 1)], "structure_id string, token_1 int, token_2 int"), S.tokens(made).select("structure_id", "token").checkpoint()
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = I.cropped_inputs(I.model_inputs(made.checkpoint(), msa, tpl, bonds), kept)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])
    assert plan.count("Exchange hashpartitioning(structure_id") == 5 == plan.count("Exchange ")


def test_template_frames(spark):
    from helixframe.operators import templates as T

    atoms = spark.createDataFrame(
        residue("h", "A", 0, "ALA", ("N", 0, 1, 0), ("CA", 0, 0, 0), ("C", 2, 0, 0)) + residue("h", "A", 1, "GLY", ("CA", 0, 0, 5)) + residue("h", "A", 2, "ALA", ("N", 4, 0, 0), ("CA", 5, 0, 0), ("C", 6, 0, 0)) + residue("h", "A", 3, "DA", ("C3'", 0, 100, 0))
        + residue("h", "B", 0, "ALA", ("CA", 9, 9, 9)) + residue("other", "A", 0, "ALA", ("CA", 9, 9, 9)),
        ATOM,
    )
    hits = spark.createDataFrame([("q", 0, "h", "A", "-AG-K", "AG-AG", 1, 0), ("q", 1, "gone", "A", "AAAA", "AAAA", 0, 0), ("r", 0, "h", "A", "AAA", "AA", 0, 2)], "query string, slot int, hit string, chain_id string, query_aligned string, template_aligned string, query_start int, template_start int")
    assert sorted(map(tuple, T.aligned_positions(hits, ["query", "slot"]).collect())) == [("q", 0, 1, 1), ("q", 0, 3, 3), *(("q", 1, i, i) for i in range(4)), ("r", 0, 0, 2), ("r", 0, 1, 3)]
    lengths = spark.createDataFrame([("q", 3), ("r", 2)], "query string, n int")
    got = {(r.query, r.slot): r for r in T.template_frames(atoms, hits, lengths).collect()}
    q, none, r = got["q", 0], got["q", 1], got["r", 0]
    assert q.mask == [0, 1, 0] and q.frame_mask == [0, 0, 0] and q.distogram == [[-1] * 3, [-1, 0, -1], [-1] * 3]  # place 3 is beyond the query's end
    assert none.mask == [0, 0, 0] and none.unit_vector[1][2] == [0, 0, 0]
    assert r.mask == [1, 1] and r.frame_mask == [0, 0] and r.distogram[0] == [0, 38]  # one residue is on a line, the other lacks atoms
    start = hits.filter("query = 'r'").drop("template_start").selectExpr("*", "0 as template_start")
    (f,) = T.template_frames(atoms, start, lengths).collect()
    assert f.frame_mask == [1, 0] and f.frame[0] == [[1, 0, 0], [0, -1, 0], [0, 0, -1]] and f.unit_vector[0][1] == [0, 0, -1] and f.local_vector[0][1] == [0, 0, -1] and f.local_vector[1][0] == [0, 0, 0]
    assert T.template_frames(atoms.limit(0), hits.limit(0), lengths).count() == 0
