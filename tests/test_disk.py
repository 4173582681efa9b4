"""What queries on neighbours and bonds exchange or keep must stay a small multiple of the atoms."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import assemble, spatial
from helixframe.operators import structures as S
from helixframe.plans.fixture import atoms


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settled(spark):
    """Plans as they run: without adaptive execution an exchange that is used again shows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.enabled")


def exchanges(df) -> list[str]:
    return [x for x in plan(df).splitlines() if "Exchange" in x and "ReusedExchange" not in x]


def test_points_and_copies_are_exchanged_once(settled, sf):
    a = atoms(settled, sf)
    for found in (S.bonded(a), S.neighbours(a), S.neighbours(a, S.CLASH)):
        assert len(exchanges(found)) == 1 and "ReusedExchange" in plan(found)


def test_few_atoms_are_copied(spark, sf):
    """For bonds a cell of one and a half thresholds had five rows an atom."""
    a = atoms(spark, sf)
    n = a.count()
    for threshold, most in ((S.BOND, 2), (S.CONTACT, 3)):
        assert n < spatial._copies(a.select(*spatial.XYZ), S.cell_width(threshold), threshold, True, "").count() < most * n


def test_neighbours_are_not_kept(spark, sf):
    from helixframe.plans.structures import QUERIES

    assert "ExistingRDD" not in plan(QUERIES["l03_kept_neighbours"](spark, sf))


def test_residues_of_bonds_look_for_tokens_once(settled):
    """Against all pairs: bonds are repeated, both ways and inside a residue; a residue has some tokens, or none."""
    rng = random.Random(3)
    toks = [(s, c, r, 0) for s in "st" for c in "AB" for r in range(5) for _ in range(rng.randrange(4))]
    toks = [(s, c, r, i) for i, (s, c, r, _) in enumerate(toks)]
    bonds = [(rng.choice("st"), *(x for _ in "12" for x in (rng.choice("AB"), rng.randrange(6)))) for _ in range(80)]
    of = lambda s, c, r: [t[3] for t in toks if t[:3] == (s, c, r)]
    want = {(s, i, j) for s, c, r, d, q in bonds for a in of(s, c, r) for b in of(s, d, q) if a != b for i, j in ((a, b), (b, a))}
    bonds = settled.createDataFrame(bonds, "structure_id string, chain_id_1 string, residue_pos_1 int, chain_id_2 string, residue_pos_2 int")
    toks = settled.createDataFrame(toks, "structure_id string, chain_id string, residue_pos int, token int")
    found = S.bond_tokens(bonds, toks)
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert "Union" not in plan(found)


def test_glycans_are_copied_and_atoms_find_codes_without_exchange(settled, sf):
    found = plan(S.glycosidic(atoms(settled, sf), settled.createDataFrame([("ATP",)], "code string")))
    assert "SortMergeJoin [residue" not in found and "BroadcastHashJoin [residue" in found


def test_only_sulfurs_look_for_disulfides(spark, sf):
    a = atoms(spark, sf)
    assert "EqualTo(atom,SG)" in plan(S.bond_features(a, S.tokens(a)))
    want = sorted(map(tuple, S.bonded(a).filter("bond = 'disulfide'").collect()))
    assert want and sorted(map(tuple, S.disulfides(a).collect())) == want


def test_atoms_that_are_near_look_for_tokens(settled, sf):
    """Atoms with their tokens went by residue before the distance join."""
    a = atoms(settled, sf)
    assert not any(" chain_id#" in x for x in exchanges(S.ligand_bonds(a, S.tokens(a))))


def test_features_come_from_one_exchange(settled, sf):
    a = atoms(settled, sf)
    made = assemble.assembled(a)
    assert len(exchanges(made)) == 1
    both = [df.select("structure_id", *(F.to_json(F.struct(c)).alias(c) for c in sorted(set(made.columns) - {"structure_id"}))) for df in (made, assemble.assembled(a, S.tokens(a)))]
    one, two = (sorted(map(tuple, df.collect())) for df in both)
    assert one and one == two


def test_atoms_go_without_names_where_bonds_need_none(settled, sf):
    a = atoms(settled, sf)
    found = plan(S.bond_tokens(S.bonded(a), S.tokens(a)))
    assert "a_role" in found and "a_atom#" not in found
    assert "a_atom#" in plan(S.bonded(a))
