from __future__ import annotations

import hashlib
import json

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.__main__ import main
from helixframe.config import Config
from helixframe.functions import chem, sequences
from helixframe.operators import relational as R
from helixframe.operators import search
from helixframe.operators import structures as S
from helixframe.plans import curate, registry
from helixframe.sources import components as C

from .test_structures import ATOMS, HEAD

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_sql(spark, sf, con, name):
    df = registry.queries()[name](spark, sf)
    found = con.execute(registry.oracles()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    value = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    want = sorted(repr([value(v) for v in r]) for r in found.fetchall())
    assert sorted(repr([value(r[c]) for c in columns]) for r in df.collect()) == want


def test_first_failing_rule_and_dates(spark):
    df = spark.createDataFrame([(1, "2021-9-3", 2.0, ""), (2, "2021-10-01", 2.0, ""), (3, None, 2.0, ""), (4, "2021-09-30", None, "solution nmr"), (5, "2021-09-30", None, None), (6, "x", 1.0, ""), (7, "2020-01-01", 9.5, "")], "id int, d string, r double, m string")
    out = R.first_failing(df, [("date", R.date_rule(F.col("d"), "2021-09-30")), ("resolution", R.resolution_rule(F.col("r"), F.col("m"), 9.0))])
    assert {r.id: r.reason for r in out.collect()} == {1: None, 2: "date", 3: "date", 4: None, 5: "resolution", 6: "date", 7: "resolution"}


def test_identity_pairs(spark):
    df = spark.createDataFrame([("AGHK", "AGHK", 1.0), ("AGHK", "XGHX", 0.5), ("AAAA", "BBBB", 0.0), ("AA", "AAA", 0.0), ("--", "--", 0.0)], "a string, b string, want double")
    assert all(r.want == r.got for r in df.withColumn("got", sequences.identity(F.col("a"), F.col("b"))).collect())


def test_numbering_has_no_gaps_for_any_spread(spark):
    ids = [-(1 << 40), -3, 0, 1, 2, 3, 1000, 1 << 40]
    got = R.numbered(spark.createDataFrame([(i,) for i in ids], "id long"), "id", "n").orderBy("id").collect()
    assert [r.n for r in got] == list(range(len(ids)))
    assert R.numbered(spark.createDataFrame([], "id long"), "id", "n").count() == 0


def test_weighted_sample_prefers_heavy_rows(spark):
    df = spark.range(2000).withColumn("w", F.when(F.col("id") < 100, 50.0).otherwise(0.5))
    got = R.weighted_sample(df, "id", F.col("w"), 100, 3)
    assert got.count() == 100 and got.filter("id < 100").count() > 60


def test_one_hot_and_bins(spark):
    row = spark.createDataFrame([("GLY", 3.0, 4.6, 99.0)], "r string, a double, b double, c double").select(chem.one_hot(chem.restype_index(F.col("r"))).alias("h"), *(chem.distance_bin(F.col(c)).alias(c) for c in "abc")).first()
    assert row.h == [float(i == 7) for i in range(32)] and (row.a, row.b, row.c) == (0, 1, 38)


def test_components(spark, tmp_path):
    atoms = "\n".join(f"X {a} {e} 0 N {i} 0 0 {v}" for i, (a, e, v) in enumerate([("C1", "C", "5 6 7"), ("O1", "O", "8 9 1"), ("H1", "H", "? ? ?")]))
    head = "loop_\n" + "\n".join(f"_chem_comp_atom.{c}" for c in "comp_id atom_id type_symbol charge pdbx_leaving_atom_flag model_Cartn_x model_Cartn_y model_Cartn_z pdbx_model_Cartn_x_ideal pdbx_model_Cartn_y_ideal pdbx_model_Cartn_z_ideal".split())
    (tmp_path / "c.cif").write_text(f"data_X\n_chem_comp.id X\n_chem_comp.name 'a name'\n{head}\n{atoms}\ndata_Y\n_chem_comp.id Y\n{head}\n" + atoms.replace("5 6 7", "? ? ?"))
    known = C.read_components(spark, str(tmp_path))
    got = {(r.code, r.atom): (r.x, r.origin) for r in C.conformers(known).collect()}
    assert got == {("X", "C1"): (5.0, "ideal"), ("X", "O1"): (8.0, "ideal"), ("Y", "C1"): (0.0, "model"), ("Y", "O1"): (1.0, "model")}
    seen = spark.createDataFrame([("s", "A", 0, "X", "C1", 1.0, 1.0, 1.0), ("s", "A", 1, "Z", "Q", 2.0, 2.0, 2.0)], "structure_id string, chain_id string, residue_pos int, residue string, atom string, x double, y double, z double")
    assert {(r.residue, r.ref_x, r.origin) for r in C.reference_conformers(seen, C.conformers(known)).collect()} == {("X", 5.0, "ideal"), ("Z", 0.0, "observed")}


def test_side_by_side_stacks_all_rows(spark, tmp_path):
    parts = [(i, f"Brand#{i % 7}", 1 + (i % 10 == 0), "n") for i in range(60)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    rows = {k: [b.translate(str.maketrans("#2", "--")) for _, b, s, _ in parts if s == k] for k in (1, 2)}
    want = {i: "".join(rows[k][i] if i < len(rows[k]) else "-" * 7 for k in (1, 2)) for i in range(54)}
    got = {r.row: r.digest for r in registry.queries()["h03_side_by_side"](spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.md5(s.encode()).hexdigest() for i, s in want.items()}


def test_realigned_or_as_given(spark, tmp_path):
    df = spark.createDataFrame([("a", ["q", "h"], ["AC-GU", "A-.GU"]), ("b", ["q"], ["A-C"])], "id string, names array<string>, sequences array<string>")
    given = {"a": ">q\nAC-GU\n>h\nA-.GU\n", "b": ">q\nA-C\n"}
    copy = {"build": lambda q, h: ["cp", q, h], "align": lambda h, s, o: ["cp", s, o]}
    got = {r.id: r for r in search.realigned(df, **copy).collect()}
    assert got["a"].realigned and got["a"].output == ">q\nACGU\n>h\nAGU\n" and not got["b"].realigned and got["b"].output == given["b"]
    for x in ({"build": lambda q, h: ["no-such-program"]}, {"align": lambda h, s, o: ["false"]}):
        r = search.realigned(df, **(copy | x)).filter("id = 'a'").first()
        assert not r.realigned and r.output == given["a"] and r.error
    (tmp_path / "rna.hmm").write_text("model")
    r = search.realigned(df, model=str(tmp_path / "rna.hmm"), align=lambda h, s, o: ["cp", h, o]).filter("id = 'a'").first()
    assert r.output == "model" and search.hmmalign("m", "s", "o")[-2:] == ["m", "s"]
    with pytest.raises(Exception, match="none.hmm"):
        search.realigned(df, model=str(tmp_path / "none.hmm")).collect()


def test_clash_fractions_cover_all_chain_pairs(spark):
    rows = [("s", c, 0, i, "C", "C", "ALA", x, 0.0, 0.0) for c, xs in (("A", (0, 1, 50)), ("B", (2.5, 70)), ("C", (90,))) for i, x in enumerate(map(float, xs))] + [("t", "A", 0, 0, "C", "C", "ALA", 0.0, 0.0, 0.0)]
    atoms = spark.createDataFrame(rows, "structure_id string, chain_id string, residue_pos int, atom_pos int, atom string, element string, residue string, x double, y double, z double")
    got = {(r.chain_id, r.other): (r.near, r.n) for r in S.clashes_by_pair(atoms).collect()}
    assert got == {("A", "B"): (1, 3), ("A", "C"): (0, 3), ("B", "A"): (1, 2), ("B", "C"): (0, 2), ("C", "A"): (0, 1), ("C", "B"): (0, 1)}
    assert S.clashes_by_pair(atoms, 2.5).filter("chain_id = 'A' and other = 'B'").first().near == 2


def test_search_without_programs_gives_the_query(spark):
    df = spark.createDataFrame([(1, "ACGU")], "id int, sequence string")
    row = search.searched(df, lambda q, o, n: ["no-such-program", q, o]).first()
    assert not row.found and row.output == ">1\nACGU\n" and "not installed" in row.error
    assert search.searched(df, lambda q, o, n: ["cp", q, o]).first().found
    assert "0.02" in search.nhmmer("q", "d", "o", 40) and "0.02" not in search.nhmmer("q", "d", "o", 60)
    assert search.jackhmmer("q", "d", "o", z=5)[-4:] == ["-Z", "5", "q", "d"] and search.SEARCHES["uniprot"].z == 138_515_945


def test_config_layers(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"filtering": {"max_resolution": 3.0}}))
    c = Config.load(str(tmp_path / "c.json"), {"HELIXFRAME_CROPPING__MAX_TOKENS": "64"}, filtering={"min_residues": 1})
    assert (c.filtering.max_resolution, c.cropping.max_tokens, c.filtering.min_residues) == (3.0, 64, 1)
    with pytest.raises(TypeError):
        Config.load(None, {}, filtering={"nothing": 1})
    assert main(["config", "init", "--to", str(tmp_path / "d.json")]) == 0 and json.loads((tmp_path / "d.json").read_text())["alignments"]["max_templates"] == 4
    assert main([]) == 1


def test_curation_end_to_end(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "one.cif").write_text(HEAD + "\n".join(ATOMS) + "\n#\n")
    (d / "late.cif").write_text((HEAD + "\n".join(ATOMS)).replace("2020-01-01", "2023-01-01"))
    (d / "broken.cif").write_bytes(b"\xff\xfe\xff")
    out = curate.curate(spark, str(d), Config.load(None, {}, filtering={"min_residues": 1}))
    assert {r.structure_id: r.reason for r in out.verdicts.collect()} == {"one": None, "late": "date", "broken": "unreadable"}
    curate.write(out, str(tmp_path / "out"))
    tokens = spark.read.parquet(str(tmp_path / "out/tokens"))
    assert [r.token for r in tokens.orderBy("token").collect()] == list(range(tokens.count())) and tokens.count() > 0
    assert spark.read.parquet(str(tmp_path / "out/pairs")).count() == tokens.count() ** 2
    assert np.isfinite([r.x for r in tokens.collect()]).all()
    assert curate.filter_counts(out.verdicts).count() == 3
