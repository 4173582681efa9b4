"""Each command from its arguments to what it writes and says."""

from __future__ import annotations

import json

from helixframe.__main__ import main

from .test_structures import ATOMS, HEAD


def test_curated_folder(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.cif").write_text(HEAD + "\n".join(ATOMS) + "\n#\n")
    (tmp_path / "in" / "late.cif").write_text((HEAD + "\n".join(ATOMS)).replace("2020-01-01", "2023-01-01"))
    (tmp_path / "c.json").write_text(json.dumps({"filtering": {"min_residues": 1}}))
    assert main(["curate", f"{tmp_path}/in", f"{tmp_path}/out", "--config", f"{tmp_path}/c.json"]) == 0
    inputs = spark.read.parquet(f"{tmp_path}/out/inputs").collect()
    assert [r.structure_id for r in inputs] == ["one"] and inputs[0].n_tokens == len(inputs[0].msa) > 0
    capsys.readouterr()
    assert main(["dataset", "stats", f"{tmp_path}/out"]) == 0
    said = json.loads(capsys.readouterr().out)
    assert said["structures"] == {"passed": 1, "date": 1} and said["chains"]["PROTEIN"] == 1 and said["residues"] >= 3
    assert main(["dataset", "sample", f"{tmp_path}/out", "--n", "7", "--target", f"{tmp_path}/drawn"]) == 0
    assert [r.structure_id for r in spark.read.parquet(f"{tmp_path}/drawn").collect()] == ["one"] * 7


def test_search_without_its_program(spark, tmp_path, capsys):
    (tmp_path / "q.fasta").write_text(">a\nACDE\n>b\nGG\n>a\nAC\n")
    assert main(["search", f"{tmp_path}/q.fasta", f"{tmp_path}/out", "--database", "uniprot"]) == 0
    assert json.loads(capsys.readouterr().out) == {"jackhmmer is not installed": 2}
    assert {r.id: r.output for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {"a": ">a\nAC\n", "b": ">b\nGG\n"}


def test_stores(spark, tmp_path, capsys):
    (tmp_path / "a" / "sub").mkdir(parents=True)
    for name, text in (("x", "1"), ("sub/y", "22"), ("z", "333")):
        (tmp_path / "a" / name).write_text(text)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x").write_text("kept")
    assert main(["store", "list", f"{tmp_path}/a"]) == 0
    assert [x.split() for x in capsys.readouterr().out.splitlines()] == [["2", "sub/y"], ["1", "x"], ["3", "z"]]
    assert main(["store", "sync", f"{tmp_path}/a", f"{tmp_path}/b"]) == 0 and json.loads(capsys.readouterr().out) == {"copied": 2}
    assert {p: (tmp_path / "b" / p).read_text() for p in ("x", "sub/y", "z")} == {"x": "kept", "sub/y": "22", "z": "333"}
    assert main(["store", "sync", f"{tmp_path}/a", f"{tmp_path}/b", "--overwrite"]) == 0 and (tmp_path / "b" / "x").read_text() == "1"
    assert main(["store", "sync", f"{tmp_path}/a", f"{tmp_path}/new"]) == 0 and (tmp_path / "new" / "sub" / "y").read_text() == "22"


def test_jobs(spark, tmp_path, capsys):
    (tmp_path / "keys").mkdir()
    for k in range(3):
        (tmp_path / "keys" / f"k{k}").write_text("content")
    folder = f"{tmp_path}/jobs"
    assert main(["jobs", "submit", folder, "--job", "j", "--keys", f"{tmp_path}/keys"]) == 0
    assert main(["jobs", "submit", folder, "--job", "other", "--keys", f"{tmp_path}/keys", "--priority", "2"]) == 0
    assert main(["jobs", "fetch", folder, "--workers", "2"]) == 0
    tasks = spark.read.parquet(f"{folder}/v2").collect()
    assert sorted((r.task, r.state, r.tried) for r in tasks if r.job == "j") == [("j_000000", "assigned", 1), ("j_000001", "assigned", 1), ("j_000002", "pending", 0)]
    capsys.readouterr()
    assert main(["jobs", "status", folder]) == 0
    assert [(r["job"], r["total"], r["status"]) for r in json.loads(capsys.readouterr().out)] == [("j", 3, "pending"), ("other", 3, "pending")]


def test_help_without_a_command(capsys):
    assert main([]) == 1 and "curate" in capsys.readouterr().out
