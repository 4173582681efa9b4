"""The stages of the corpus pipeline against plain versions, and the queries against their SQL."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helixframe.llm import op08_language as op8
from helixframe.llm.queries import ORACLES, QUERIES

from .test_operators import DOCS, awkward, plain_set, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(17)
    rows = awkward(rng) + [(100 + i, " ".join(f"q{rng.randrange(5000)}" for _ in range(60)), "de", "s", 5) for i in range(20)]
    item = " ".join(f"b{i}" for i in range(20))
    rows.append((500, "start " + item + " end", "en", "t", 9))
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCS).withColumn("leaks", F.lit("clash")).withColumn("score", F.lit("clash")).withColumn("dropped_lines", F.lit("clash")).withColumn("leaks_", F.lit("clash")).withColumn("a.b", F.lit("clash")).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, folder).checkpoint()
        had, has = [r.asDict() for r in before.collect()], [r.asDict() for r in after.collect()]
        if name == "sentencepiece":
            assert len(has) == len(had) and all(r["n_tokens"] == len(r["ids"]) for r in has)
            break
        assert after.columns == docs.columns
        if name == "language_id":
            assert sorted(map(str, has)) == sorted(str(r) for r in had if op8.normal(r["text"] or "").size)
        if name == "line_dedup":
            assert len(has) == len(had)
        if name == "ngram_jaccard":
            kept = [plain_set(r["text"]) for r in has if words(r["text"])]
            assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(kept) for b in kept[:i])
            assert all(any(len(s & k) >= 0.8 * len(s | k) for k in kept) for s in (plain_set(r["text"]) for r in had) if s)
        if name == "decontamination":
            assert sorted(str(r["doc_id"]) for r in had if r["doc_id"] != 500) == sorted(str(r["doc_id"]) for r in has)
        before = after
    assert corpus_pipeline.run(spark, folder).count() == len(has)


def test_language_stage_rejects_by_parsing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rng = random.Random(3)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(n)) for n in (60, 300, 3000)]
    foreign = ["Съешь ещё этих мягких французских булок, да выпей же чаю", "Powyższe zdanie zawiera wszystkie polskie litery i nie ma sensu", "山高月小水落石出曾日月之几何而江山不可复识矣"]
    more = spark.createDataFrame([(10**6 + i, t, None, "s", 1) for i, t in enumerate([*noise, *foreign, "a", "123"])], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(more), sf).collect()}
    assert {r.doc_id for r in docs.collect() if op8.normal(r.text or "").size} | {10**6 + 6} == kept
    for unlabelled in (docs.withColumn("lang", F.lit(None).cast("string")), docs.withColumn("lang", F.when(op8.fold("doc_id", 4) == 2, F.col("lang")))):
        kept = corpus_pipeline.language(spark, unlabelled.unionByName(more), sf)
        assert kept.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count() + 7


def test_line_stage_on_small_sites(spark):
    """A menu on all four documents of a site goes; a line on one document stays."""
    rows = [(i, f"menu\nown line {i}", "en", "small", 0) for i in range(4)]
    got = corpus_pipeline.lines(spark, spark.createDataFrame(rows, DOCS), "").orderBy("doc_id").collect()
    assert [(r.text, r.n_chars) for r in got] == [(f"own line {i}", 10) for i in range(4)]


def test_pipeline_on_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
