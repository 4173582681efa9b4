"""The mmCIF source against whole parses: equal rows, and what it doesn't read."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from helixframe.sources import mmcif
from helixframe.sources import structures as src
from helixframe.sources.star import parse_star

from .test_structures import ATOMS, HEAD

BODY = HEAD + "\n".join(ATOMS) + "\n#\n"
LATE = HEAD.replace("_refine.ls_d_res_high 2.00\n", "_reflns.d_resolution_high 3.5\n").replace("_exptl.method 'X-RAY DIFFRACTION'\n", "_exptl.method\n;x-ray\n diffraction\n;\n") + "\n".join(ATOMS) + "\n_em_3d_reconstruction.resolution 2.75\n_refine.ls_d_res_high ?\n"
PAIRS = BODY + "_struct_conn.other 1\n"
ODD = "data_X\nloop_ _exptl.method\nNMR\n_refine.ls_d_res_high 1.5 _database_pdb_rev.date_original 1999-1-1\n" + HEAD[HEAD.index("loop_") :] + "\n".join(ATOMS[:3])
LOOPED = "data_L\nloop_\n_exptl.entry_id\n_exptl.method\nL nmr\nL other\n_struct_conn.conn_type_id covale\n_struct_conn.ptnr1_auth_seq_id 1\n_struct_conn.ptnr2_auth_seq_id\n2\n_database_pdb_rev.date_original 2001-2-3\n_pdbx_database_status.recvd_initial_deposition_date ?\n"


def counted(text: str, table: str, columns: list[str]) -> tuple[list[str], int]:
    """The lines kept, and how many were read."""
    read = []
    lines = list(mmcif.wanted_lines((read.append(x) or x for x in text.splitlines(keepends=True)), mmcif.Needed(table, columns)))
    return lines, len(read)


def test_metadata_reads_no_atoms():
    for columns in (["method"], ["resolution"], ["release_date"], ["structure_id", "method", "resolution", "release_date"]):
        lines, read = counted(BODY, "structures", columns)
        assert read <= 6 and not any("ATOM" in x for x in lines), columns
    lines, read = counted(BODY, "operators", ["op"])
    assert read < BODY.count("\n") - len(ATOMS) and not any("ATOM" in x for x in lines) and len(lines) == 21
    lines, read = counted(LATE, "structures", ["resolution"])
    assert not any("ATOM" in x for x in lines) and read == LATE.count("\n")  # an item of higher priority might still come
    assert [x for x in counted(BODY, "atoms", ["x"])[0] if not x.startswith(("ATOM", "HETATM", "_atom_site"))] == ["loop_\n"]


@pytest.mark.parametrize("text", [BODY, LATE, PAIRS, ODD, LOOPED, "", "data_x\n", BODY.replace("\n", "\r\n")])
def test_pruned_parses_are_whole_ones(text):
    whole = parse_star(text)
    open_lines = lambda: mmcif.lines_of([text.encode()[i : i + 7] for i in range(0, len(text.encode()), 7)])
    for table, f in mmcif.ROWS.items():
        assert f(mmcif.parsed_items(open_lines, lambda t=table: mmcif.Needed(t, ["x"]))) == f(whole)
    for column, f in (("method", lambda d: src.first_of(d, "_exptl.method")), ("resolution", src.resolution_of), ("release_date", lambda d: src.first_of(d, *src.DATE_KEYS))):
        assert f(mmcif.parsed_items(open_lines, lambda c=column: mmcif.Needed("structures", [c]))) == f(whole), column


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("mmcif")
    (d / "one.cif").write_text(BODY)
    (d / "late.mmcif").write_text(LATE)
    (d / "sub").mkdir()
    (d / "sub" / "two.cif.gz").write_bytes(gzip.compress((HEAD + "\n".join(ATOMS[:4])).encode()))
    (d / "bad.cif.gz").write_bytes(b"not gzip")
    (d / "bytes.cif").write_bytes(b"\xff\xfe")
    (d / "notes.txt").write_text("data_no")
    return str(d)


def test_source_gives_what_whole_files_give(spark, folder):
    whole = src.read_structures(spark, folder)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    known = ["structure_id", "method", "resolution", "release_date"]
    assert same(mmcif.scan(spark, folder, columns=known).filter("structure_id not like 'b%'"), whole.filter("error is null").select(*known))
    assert {r.structure_id for r in mmcif.scan(spark, folder, columns=["structure_id", "error"]).filter("error is not null").collect()} == {"bad", "bytes"}
    for table, rows in (("atoms", src.atoms(whole)), ("bonds", src.bonds(whole)), ("operators", src.operators(whole))):
        assert same(mmcif.scan(spark, folder, table), rows.select(*mmcif.scan(spark, folder, table).columns))
    assert mmcif.scan(spark, folder, "atoms", ["atom", "structure_id"]).columns == ["atom", "structure_id"]
    assert mmcif.scan(spark, f"{folder}/one.cif", "atoms").select("structure_id").distinct().collect()[0][0] == "one"
    with pytest.raises(Exception, match="nothing"):
        spark.read.format("mmcif").option("table", "nothing").load(folder).count()


def test_files_go_to_tasks_by_bytes_and_names(spark, folder):
    from pyspark.sql.datasource import EqualTo, In

    schema = mmcif.scan(spark, folder, "structures").schema
    assert mmcif.scan(spark, folder, partition_bytes=1000).rdd.getNumPartitions() == 4
    reader = mmcif.PushdownReader({"path": folder}, schema)
    assert len(list(reader.pushFilters([In(("structure_id",), ("one", "two", "x")), EqualTo(("structure_id",), "two"), EqualTo(("method",), "one")]))) == 3
    assert [p.rsplit("/", 1)[-1] for part in reader.partitions() for p in part.paths] == ["two.cif.gz"]
    spark.conf.set(mmcif.PUSHDOWN, "true")
    try:
        assert mmcif.scan(spark, folder).filter(F.col("structure_id").isin("one", "late")).count() == 2
    finally:
        spark.conf.set(mmcif.PUSHDOWN, "false")


def test_written_files_are_read_again(spark, tmp_path):
    files = spark.createDataFrame([("in/a.cif", BODY.encode()), ("b.cif", LATE.encode())], "path string, content binary")
    for _ in range(2):
        mmcif.write_files(files, f"file:{tmp_path}/out")
    assert {r.structure_id: r.resolution for r in mmcif.scan(spark, f"file:{tmp_path}/out", columns=["structure_id", "resolution"]).collect()} == {"a": 2.0, "b": 2.75}
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.cif", "b.cif"]


def test_rows_are_split_as_tokens_are():
    """Lines without quoted blanks, comments and blocks are split at white space: a third of the time, the same values."""
    import random
    import time

    from helixframe.sources import star

    def plain(text):
        return [v for v, _ in star.tokens(text)]

    rng = random.Random(3)
    words = ["x", ".", "?", "'q r'", "\"C4'\"", "'a", "b'", "#c d", "\n", "\n", ";t", "\n;blk\nmore\n;\n", "1.5", "''", "\"", "a_b", "x#y"]
    for _ in range(20_000):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 16)))
        want = [star.clean(v) if bare else v for v, bare in star.tokens(text)]
        got = [v if isinstance(v, str) else star.clean(v[0]) if v[1] else v[0] for line in star.lines_of_tokens(text) for v in line]
        assert got == want, text
    assert star.parse_star("loop_\n_a.x\n_a.x\n1 2\n3 4")["_a.x"] == ["1", "2", "3", "4"]
    rows = "data_X\nloop_\n" + "\n".join(f"_atom_site.c{k}" for k in range(15)) + "\n" + "\n".join(f"ATOM {i} C . ALA CA A 1 {i} ? 1.25 2.5 3.5 1.0 ." for i in range(20_000))
    start = time.process_time()
    words = plain(rows)
    middle = time.process_time()
    assert star.parse_star(rows)["_atom_site.c1"] == [str(i) for i in range(20_000)] and len(words) > 300_000
    assert time.process_time() - middle < middle - start


def test_tables_not_asked_for_are_not_made():
    from helixframe.sources import structures as M

    text = b"data_x\n_exptl.method 'X-ray diffraction'\nloop_\n_atom_site.auth_asym_id\n_atom_site.Cartn_x\n_atom_site.Cartn_y\n_atom_site.Cartn_z\nA 1 2 3\n"
    assert len(M.parse_structure("x.cif", text)["atoms"]) == 1
    row = M.parse_structure("x.cif", text, ("bonds",))
    assert row["atoms"] == [] and row["error"] is None and row["method"] == "X-RAY DIFFRACTION"


def test_small_files_are_dealt_by_number(spark, tmp_path, monkeypatch):
    """A few large tasks would be all there is of many small files."""
    from pyspark.sql.types import StructType

    for i in range(25):
        (tmp_path / f"{i:03d}.cif").write_text("data_x\n_exptl.method X\n")
    monkeypatch.setattr(mmcif, "PARTITION_FILES", 10)
    reader = mmcif.MmcifReader({"path": str(tmp_path)}, StructType.fromDDL(mmcif.TABLES["structures"]))
    parts = reader.partitions()
    assert [len(p.paths) for p in parts] == [10, 10, 5] and sorted(x for p in parts for x in p.paths) == [f"{tmp_path}/{i:03d}.cif" for i in range(25)]


def test_rows_that_look_like_keywords():
    """Rows of a loop are passed on quickly; what may be a keyword, an item, a text or a note is still looked at."""
    rows = ["loop1 1 2 3 A", "data1x 1 2 3 A", "x 4 5 6 B", " y 7 8 9 C", "# note", "'q r' 1 1 1 D", "z . 1 1 E"]
    names = ("label_atom_id", "Cartn_x", "Cartn_y", "Cartn_z", "auth_asym_id")
    text = "data_x\nloop_\n" + "".join(f"_atom_site.{n}\n" for n in names) + "".join(f"{r}\n" for r in rows) + "loop_\n_other.a\n1\n"
    got = mmcif.file_rows("atoms", ["atom"], "a/x.cif", lambda: iter(text.splitlines(True)))
    assert [(r["atom"], r["chain_id"], r["x"], r["occupancy"]) for r in got] == [("loop1", "A", 1.0, 1.0), ("data1x", "A", 1.0, 1.0), ("x", "B", 4.0, 1.0), ("y", "C", 7.0, 1.0), ("q r", "D", 1.0, 1.0)]
