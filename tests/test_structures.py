from __future__ import annotations

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import alignments as msa
from helixframe.operators import crop, geometry, spatial
from helixframe.operators import structures as S
from helixframe.sources import alignments as A
from helixframe.sources import structures as src
from helixframe.sources.star import parse_star
from helixframe.streaming import files, tasks

HEAD = """data_TEST
_exptl.method 'X-RAY DIFFRACTION'
_refine.ls_d_res_high 2.00
_pdbx_database_status.recvd_initial_deposition_date 2020-01-01
loop_
_struct_conn.id
_struct_conn.conn_type_id
_struct_conn.ptnr1_auth_asym_id
_struct_conn.ptnr1_auth_seq_id
_struct_conn.ptnr1_label_atom_id
_struct_conn.ptnr2_auth_asym_id
_struct_conn.ptnr2_auth_seq_id
_struct_conn.ptnr2_label_atom_id
c1 covale A 1 CB L 1 C1
c2 hydrog A 1 N L 1 C1
loop_
_pdbx_struct_oper_list.id
""" + "\n".join(f"_pdbx_struct_oper_list.matrix[{i}][{j}]" for i in (1, 2, 3) for j in (1, 2, 3)) + """
_pdbx_struct_oper_list.vector[1]
_pdbx_struct_oper_list.vector[2]
_pdbx_struct_oper_list.vector[3]
1 1 0 0 0 1 0 0 0 1 0 0 0
2 -1 0 0 0 -1 0 0 0 1 30 0 0
loop_
_pdbx_struct_assembly_gen.assembly_id
_pdbx_struct_assembly_gen.oper_expression
_pdbx_struct_assembly_gen.asym_id_list
1 1,2 A
loop_
""" + "\n".join(f"_atom_site.{c}" for c in "group_PDB id type_symbol label_atom_id label_alt_id label_comp_id label_asym_id label_entity_id label_seq_id Cartn_x Cartn_y Cartn_z occupancy B_iso_or_equiv auth_seq_id auth_asym_id".split()) + "\n"
ATOMS = [
    "ATOM 1 N N . ALA A 1 1 0.000 0.000 0.000 1.0 10 1 A", "ATOM 2 C CA . ALA A 1 1 1.458 0.000 0.000 1.0 10 1 A", "ATOM 3 C C . ALA A 1 1 2.009 1.420 0.000 1.0 10 1 A", "ATOM 4 O O . ALA A 1 1 1.251 2.390 0.000 1.0 10 1 A",
    "ATOM 5 C CB A ALA A 1 1 1.986 -0.760 -1.220 0.4 10 1 A", "ATOM 6 C CB B ALA A 1 1 1.986 -0.760 1.220 0.6 10 1 A", "ATOM 7 N N . GLY A 1 2 3.326 1.530 0.000 1.0 10 2 A", "ATOM 8 C CA . GLY A 1 2 3.970 2.840 0.000 1.0 10 2 A", "ATOM 9 C C . GLY A 1 2 5.480 2.710 0.000 1.0 10 2 A",
    "ATOM 10 O O . GLY A 1 2 6.040 1.600 0.000 1.0 10 2 A", "HETATM 11 SE SE . MSE A 1 3 7 7 7 1.0 10 3 A", "HETATM 12 C CA . MSE A 1 3 7 8 7 1.0 10 3 A", "HETATM 13 C C1 . LIG L 2 . 2.0 -1.0 2.5 1.0 10 1 L", "HETATM 14 O O1 . LIG L 2 . 2.0 -1.0 3.9 1.0 10 1 L",
    "HETATM 15 O O . HOH W 3 . 20 20 20 1.0 10 1 W", "HETATM 16 H H1 . LIG L 2 . 2.5 -1.0 4.5 1.0 10 1 L", "ATOM 17 C XX . ALA A 1 1 ? 0 0 1.0 10 1 A",
]


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("cif")
    (d / "one.cif").write_text(HEAD + "\n".join(ATOMS) + "\n#\n")
    (d / "two.cif.gz").write_bytes(gzip.compress((HEAD + "\n".join(ATOMS[:4])).encode()))
    (d / "bad.cif.gz").write_bytes(b"not gzip")
    (d / "other.txt").write_text("no")
    return src.read_structures(spark, str(d)).persist()


def test_star_grammar():
    x = parse_star("data_a\n_k.one 'it''s a b' # note\n_k.two\n;line 1\nline 2\n;\nloop_\n_t.a\n_t.b\n1 \"x y\" ? .\n3\nb\n4\n_k.one last\n")
    assert x["_k.two"] == ["line 1\nline 2"] and x["_t.a"] == ["1", "", "3"] and x["_t.b"] == ["x y", "", "b"] and x["_k.one"] == ["last"]


def test_operator_expressions():
    assert src.operator_ids("1,2") == ["1", "2"] and src.operator_ids("(1-3)") == ["1", "2", "3"] and src.operator_ids("(1,2)(3-4)") == ["1_3", "1_4", "2_3", "2_4"] and src.operator_ids("P") == ["P"]


def test_files_to_atoms(parsed):
    rows = {r.structure_id: r for r in parsed.collect()}
    assert set(rows) == {"one", "two", "bad"} and rows["bad"].error and not rows["bad"].atoms
    one = rows["one"]
    assert (one.method, one.resolution, one.release_date) == ("X-RAY DIFFRACTION", 2.0, "2020-01-01")
    assert len(one.atoms) == 15 and len(one.bonds) == 1 and len(one.operators) == 2
    cb = [a for a in one.atoms if a.atom == "CB"]
    assert len(cb) == 1 and cb[0].alt_loc == "B" and cb[0].z == 1.22


def test_cleanup_tokens_bonds(parsed):
    atoms = src.atoms(parsed.filter("structure_id = 'one'"))
    clean = S.methionine(S.without_waters(atoms))
    assert clean.filter("residue = 'MET' AND atom = 'SD' AND element = 'S'").count() == 1
    chains = {r.chain_id: r for r in S.chains(S.residues(clean)).collect()}
    assert chains["A"].sequence == "AGM" and chains["A"].kind == "PROTEIN" and chains["L"].kind == "LIGAND" and "W" not in chains
    toks = S.tokens(clean).orderBy("token").collect()
    assert [(t.chain_id, t.residue, t.n_atoms) for t in toks] == [("A", "ALA", 5), ("A", "GLY", 4), ("A", "MET", 2), ("L", "LIG", 1), ("L", "LIG", 1)]
    assert (toks[0].x, toks[0].restype, toks[1].restype) == (1.458, 0, 7)
    bonds = S.bonded(S.without_hydrogens(clean))
    found = {(b.bond, b.atom_1, b.atom_2) for b in bonds.collect()}
    assert ("backbone", "C", "N") in found and ("ligand", "C1", "O1") in found and ("cross", "CB", "C1") in found
    pairs = {(r.token_1, r.token_2) for r in S.bond_tokens(bonds, S.tokens(clean)).collect()}
    assert (0, 1) in pairs and (1, 0) in pairs and all((b, a) in pairs for a, b in pairs)
    rel = {(r.i, r.j): r for r in S.token_pairs(S.tokens(clean)).collect()}
    assert rel[0, 1].relative == 33 and rel[1, 0].relative == 31 and rel[0, 3].relative == 65 and rel[0, 0].bin is None
    assert S.interfaces(clean, least=1).collect()[0].type == "ligand-protein" and S.interfaces(clean).count() == 0
    assert S.broken_chains(clean, 3.0).count() == 1 and S.broken_chains(clean).count() == 0
    assert S.clashing_chains(clean, 1.4).count() == 1
    valid = {r.chain_id: r for r in S.validation(S.residues(clean)).collect()}
    assert valid["A"].warning and valid["A"].valid


def test_assembly(parsed):
    one = parsed.filter("structure_id = 'one'")
    out = S.expanded(src.atoms(one), src.operators(one))
    got = {r.chain_id: r.x for r in out.filter("atom = 'CA' AND residue = 'ALA'").collect()}
    assert got == {"A": 1.458, "A_2": 30 - 1.458}


def test_arginine_swap(spark):
    rows = [("s", "A", 0, "ARG", a, x, 0.0, 0.0) for a, x in (("CD", 0.0), ("NH1", 3.0), ("NH2", 2.0))]
    df = spark.createDataFrame(rows, "structure_id string, chain_id string, residue_pos int, residue string, atom string, x double, y double, z double")
    assert {r.atom: r.x for r in S.arginine_names(df).collect()} == {"CD": 0.0, "NH1": 2.0, "NH2": 3.0}


def test_grid_join_is_exact(spark):
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.uniform(-3, 3, (150, 3)), [[0, 0, 0], [1, 0, 0], [-1, 0, 0]]])
    df = spark.createDataFrame([(i, i % 3, *map(float, x)) for i, x in enumerate(p)], "k int, chain int, x double, y double, z double")
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    for strict in (False, True):
        want = {(i, j) for i in range(len(p)) for j in range(i + 1, len(p)) if (d[i, j] < 1 if strict else d[i, j] <= 1)}
        assert {(r.a_k, r.b_k) for r in spatial.pairs_within(df, "k", 1.0, strict=strict).collect()} == want
    assert ("a_x" in spatial.within(df, df, 1.0).columns) and "BroadcastNestedLoop" not in spatial.within(df, df, 1.0)._jdf.queryExecution().toString()


def test_nearest_is_exact(spark):
    rng = np.random.default_rng(8)
    p = np.concatenate([rng.normal(size=(80, 3)) * 0.2, rng.normal(size=(5, 3)) * 30])
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)], "k int, x double, y double, z double")
    got = {(r.a_k, r["rank"]): r.b_k for r in spatial.nearest(df.filter("k % 3 = 0"), df, "k", 4, 0.05).collect()}
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    want = {(i, r + 1): int(j) for i in range(0, len(p), 3) for r, j in enumerate(np.argsort(d[i], kind="stable")[:4])}
    assert got == want
    few = spatial.nearest(df.filter("k = 0"), df.filter("k < 3"), "k", 4, 0.01).collect()
    assert len(few) == 2 and spatial.nearest(df.limit(0), df.limit(0), "k", 2, 1.0).count() == 0


def test_superposition_and_frames(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(20, 3))
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    b = a @ q.T + [1, 2, 3]
    r, t, rms = geometry.superposition(a, b)
    assert np.allclose(r, q) and np.allclose(t, [1, 2, 3]) and rms < 1e-9
    df = spark.createDataFrame([("g", *map(float, [*x, *y])) for x, y in zip(a, b, strict=True)] + [("h", *[0.0] * 6)], "k string, x double, y double, z double, u double, v double, w double")
    got = {r.k: r.rmsd for r in geometry.superposed(df, "k", ("x", "y", "z"), ("u", "v", "w")).collect()}
    assert got["g"] < 1e-9 and got["h"] is None
    f = geometry.frame(*np.array([[0.0, 1, 0], [0, 0, 0], [2, 0, 0]]))
    assert np.allclose(f, np.eye(3)) and geometry.frame(*np.array([[1.0, 0, 0], [0, 0, 0], [2, 0, 0]])) is None
    assert geometry.aligned("ACGT", "ACT") == ("ACGT", "AC-T") and geometry.symmetry_label(4, [90, 180]) == "C4" and round(geometry.rotation_angle(np.diag([-1.0, -1, 1]))) == 180
    assert geometry.greedy_distinct(["AAAA", "AAAA", "AAAB", "AAAA", "CCCC"]) == [0, 1, 2, 4]


def test_alignment_files(spark, tmp_path):
    (tmp_path / "q.a3m").write_text(">query d\nAGHK\n>hit1 OS=Homo sapiens OX=1\nAacG-\nK\n>hit2\nag.AGHKxx\n")
    rows = A.read_a3m(spark, str(tmp_path / "q.a3m")).orderBy("row").collect()
    assert [(r.sequence, list(r.deletions)) for r in rows] == [("AGHK", [0, 0, 0, 0]), ("AG-K", [0, 2, 0, 0]), ("AGHK", [2, 0, 0, 0])]
    (tmp_path / "x.sto").write_text("# STOCKHOLM 1.0\nb_B/1-4 AC\na DE\n\nb_B/1-4 GT\na FG\n//\n")
    sto = A.read_stockholm(spark, str(tmp_path / "x.sto"))
    assert [(r.id, r.sequence) for r in sto.orderBy("row").collect()] == [("b_B/1-4", "ACGT"), ("a", "DEFG")]
    (tmp_path / "t.tbl").write_text("# c\nb_B - x - 1e-5 33.5 0\n")
    hits = {h.id: h for h in A.template_hits(sto, A.read_tblout(spark, str(tmp_path / "t.tbl"))).collect()}
    assert (hits["b_B/1-4"].score, hits["b_B/1-4"].chain_id, hits["a"].e_value, hits["a"].chain_id) == (33.5, "B", 1.0, "A")
    (tmp_path / "m.tsv").write_text("k1\tv1\nshort\nk1\tv2\nk2\tv3\n")
    assert {r.key: r.value for r in A.read_mapping(spark, str(tmp_path / "m.tsv")).collect()} == {"k1": "v2", "k2": "v3"}
    assert {(r.member, r.cluster) for r in A.read_clusters(spark, str(tmp_path / "m.tsv")).collect()} == {("v1", "cluster_0"), ("v2", "cluster_0"), ("v3", "cluster_1")}
    (tmp_path / "o.dat").write_text("HEADER\nOBSLTE  31-JUL-94 116l 216L\n")
    assert [r.pdb_id for r in A.read_obsolete(spark, str(tmp_path / "o.dat")).collect()] == ["116L"]
    (tmp_path / "j.meme").write_text("MEME\nMOTIF MA1 name\nletter-probability matrix\n0.1 0.2 0.3 0.4\n0 0 0 1\nx y z w\nMOTIF MA2\n1 0 0 0\n")
    assert [(r.motif, r.pos, r.t) for r in A.read_meme(spark, str(tmp_path / "j.meme")).orderBy("motif", "pos").collect()] == [("MA1", 0, 0.4), ("MA1", 1, 1.0), ("MA2", 0, 0.0)]
    (tmp_path / "d.tsv").write_text("h\n1abc\tA\tACD\t1\t2\nshort\n")
    assert A.read_disorder(spark, str(tmp_path / "d.tsv")).count() == 1
    A.write_fasta(spark.createDataFrame([("a", "ACGT" * 25)], "id string, sequence string"), str(tmp_path / "f"))
    assert [(r.id, len(r.sequence)) for r in A.read_fasta(spark, str(tmp_path / "f")).collect()] == [("a", 100)]


def test_alignment_operators(spark):
    rows = [("m", i, s, d, x) for i, (s, d, x) in enumerate([("AGHK", "", [0] * 4), ("AGHK", "x OS=Mus musculus OX=", [0] * 4), ("AG-K", "y [Homo sapiens]", [1, 1, 1, 0]), ("agHK", "z", [0] * 4), ("----", "w", None), ("AG-K", "v", [9, 0, 0, 0])])]
    df = spark.createDataFrame(rows, "msa string, row int, sequence string, description string, deletions array<int>")
    ids = lambda x: sorted(r.row for r in x.collect())
    assert ids(msa.deduplicated(df, F.col("sequence"))) == [0, 1, 2, 3, 4] and ids(msa.deduplicated(df, F.lower("sequence"), keep_query=False)) == [0, 2, 4]
    assert ids(msa.without_block_deletions(df)) == [0, 1, 3, 4] and ids(msa.covered(df)) == [0, 1, 2, 3, 5] and ids(msa.cropped(df, 2)) == [0, 1]
    assert ids(msa.subsampled(df, 3, 1))[0] == 0 and len(ids(msa.subsampled(df, 3, 1))) == 3
    assert {r.sequence for r in msa.without_gappy_columns(df, 0.5).filter("row = 0").collect()} == {"AGK"}
    assert [r.row for r in msa.dense_stack(df).orderBy("place").collect()] == [1, 3, 2, 5, 4]
    both = df.union(df.withColumn("msa", F.lit("n")).filter("row <> 1"))
    assert {(r.pair, r.species, r.msa) for r in msa.paired_by_species(both).collect()} == {(0, "Homo sapiens", "m"), (0, "Homo sapiens", "n")}
    assert {len(r.sequence) for r in msa.side_by_side(both).collect()} == {8}
    assert msa.merged(df, [df, df]).count() == 4
    p = {(r.pos, r.letter): (r.share, r.deletion_mean) for r in msa.profile(df.filter("row < 3")).collect()}
    assert p[2, "-"] == (1 / 3, 1 / 3) and p[0, "A"][0] == 1.0
    assert geometry.greedily_deduplicated(df).count() >= 2


def test_crops(spark):
    rows = [("s", "A" if i < 6 else "B", i // 2, i, float(i), 0.0, 0.0, 3) for i in range(12)]
    df = spark.createDataFrame(rows, "structure_id string, chain_id string, residue_pos int, token int, x double, y double, z double, n_atoms int")
    ids = lambda x: sorted(r.token for r in x.collect())
    refs = spark.createDataFrame([("s", 0, 0.0, 0.0, 0.0)], "structure_id string, ref_token int, ref_x double, ref_y double, ref_z double")
    assert ids(crop.spatial_crop(df, refs, 5)) == [0, 1, 2, 3] and ids(crop.first_tokens(df, 3)) == [0, 1, 2] and ids(crop.within_atom_budget(df, 10)) == [0, 1, 2]
    assert ids(crop.interface_tokens(df, 1.5)) == [5, 6] and crop.reference_tokens(df, 3).count() == 1
    got = ids(crop.contiguous_crop(df, 5, 1))
    assert 0 < len(got) <= 5 and got == ids(crop.contiguous_crop(df, 5, 1))
    assert ids(crop.renumbered(df.filter("token > 8"))) == [0, 1, 2]
    assert df.select(crop.crop_method(1)).first()[0] in crop.WEIGHTS


def test_file_stream_resumes_and_keeps_failures(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    for i in range(5):
        (d / f"f{i}").write_text("bad" if i == 2 else f"text {i}")

    def size(path: str, content: bytes) -> str:
        if content == b"bad":
            raise ValueError("bad content")
        return str(len(content))

    def run():
        files.stream_files(spark, str(d), str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "log"), size, batch=2).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count(), spark.read.parquet(str(tmp_path / "dead")).collect()

    n, dead = run()
    assert n == 4 and len(dead) == 1 and "bad content" in dead[0].error
    (d / "g.gz").write_bytes(gzip.compress(b"later"))
    assert run()[0] == 5
    assert files.retry_delay(2, draw=0.5) == 4.0 and files.retry_delay(9, draw=0.0) == 30.0


def test_task_states(spark, tmp_path):
    rows = [("a", 1, "started"), ("a", 2, "failed"), ("a", 3, "started"), ("a", 4, "completed"), ("a", 5, "failed"), ("b", 1, "started"), ("b", 2, "lost"), ("c", 1, "queued")] + [("d", i, ("started", "failed")[i % 2]) for i in range(6)]
    spark.createDataFrame(rows, "task string, at long, report string").write.parquet(str(tmp_path / "r"))
    stream = spark.readStream.schema("task string, at long, report string").parquet(str(tmp_path / "r"))
    q = tasks.task_states(stream).writeStream.outputMode("update").format("memory").queryName("states").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.task: (r.state, r.tried) for r in spark.table("states").collect()}
    assert got == {"a": ("completed", 2), "b": ("pending", 1), "c": ("pending", 0), "d": ("dead_letter", 3)}
    p = tasks.progress(spark.table("states").withColumn("job", F.lit(1)), "job").first()
    assert (p.total, p.completed, p.failed, p.percent) == (4, 1, 1, 25.0)
