from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helixframe.operators import assemble
from helixframe.operators import structures as S
from helixframe.sources import store
from helixframe.sources import structures as src

from .test_structures import ATOMS, HEAD


def test_shards(spark, tmp_path):
    df = spark.range(0, 2500, 2).withColumn("v", F.col("id") * 2)
    store.write_shards(df, str(tmp_path), "id", 500)
    assert store.read_manifest(spark, str(tmp_path)) == {"num_shards": 3, "total_count": 1250}
    one = store.read_shards(spark, str(tmp_path), ["shard_000002"])
    assert one.count() == 250 and one.agg(F.min("id")).first()[0] == 2000 and store.read_shards(spark, str(tmp_path)).count() == 1250


def test_shards_share_files(spark, tmp_path, monkeypatch):
    """There are no more files than rows fill, and some shards are read from their own folders."""
    monkeypatch.setattr(store, "BUNDLE_ROWS", 1000)
    df = spark.range(3000).withColumn("v", F.col("id") * 2)
    store.write_shards(df, str(tmp_path), "id", 10)
    assert store.read_manifest(spark, str(tmp_path)) == {"num_shards": 300, "total_count": 3000}
    assert len(list(tmp_path.glob("data/**/*.parquet"))) < 30
    some = store.read_shards(spark, str(tmp_path), ["shard_000000", "shard_000299", "shard_000400"])
    assert sorted((r.id, r.v, r.shard) for r in some.collect()) == [(i, 2 * i, f"shard_{i // 10:06d}") for i in (*range(10), *range(2990, 3000))]
    assert {f.split("bundle=")[1].split("/")[0] for f in some.inputFiles()} >= {"0", "2"} and some.columns == ["id", "v", "shard"]
    assert store.read_shards(spark, str(tmp_path), ["shard_000400"]).count() == 0 and store.read_shards(spark, str(tmp_path)).count() == 3000


def test_alignment_texts(spark, tmp_path):
    df = spark.createDataFrame([("m", 1, "", "A-"), ("m", 0, "q one", "AC"), ("n", 0, "z", "G")], "msa string, row int, description string, sequence string")
    for form, want in (("a3m", ">q one\nAC\n>sequence_1\nA-"), ("stockholm", "# STOCKHOLM 1.0\n\nq AC\nsequence_1 A-\n//"), ("json", '{"msa":"m","rows":[{"description":"q one","sequence":"AC"},{"description":"","sequence":"A-"}]}')):
        store.write_alignments(df, str(tmp_path / form), form)
        assert spark.read.text(str(tmp_path / form / "msa=m"), wholetext=True).first()[0].strip() == want
    with pytest.raises(ValueError, match="not a format"):
        store.write_alignments(df, str(tmp_path / "x"), "xml")


def test_assembled_features(spark, tmp_path):
    (tmp_path / "one.cif").write_text(HEAD + "\n".join(ATOMS) + "\n")
    atoms = S.methionine(S.without_waters(src.atoms(src.read_structures(spark, str(tmp_path)))))
    tokens = S.tokens(atoms)
    row = assemble.assembled(atoms, tokens, S.bond_tokens(S.bonded(S.without_hydrogens(atoms)), tokens)).first()
    assert row.n_tokens == 5 and row.token == [0, 1, 2, 3, 4] and row.asym_id == [0, 0, 0, 1, 1] and row.is_protein == [1, 1, 1, 0, 0]
    assert row.restype[:2] == [0, 7] and row.n_atoms == 13 and row.atom_to_token == sorted(row.atom_to_token) and row.atom_to_token.count(0) == 5
    assert row.atom_element[:3] == [6, 5, 5] and row.atom_frame[:5] == [1, 1, 1, 0, 0] and row.atom_name[0] == [13, 36, 36, 36]
    assert (0, 1) in [(b.token_1, b.token_2) for b in row.token_bonds]
