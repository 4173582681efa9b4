from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import distillation as D


def test_filters_and_families(spark):
    df = spark.createDataFrame([("a", "A" * 15), ("b", "A" * 16), ("c", "A" * 2001), ("d", "A" * 40)], "id string, sequence string")
    assert sorted(r.id for r in D.samples(df, "mgnify").collect()) == ["b", "d"] and sorted(r.id for r in D.samples(df, "short").collect()) == ["a", "b", "d"]
    assert D.samples(df, "mgnify", 1, 3).count() == 1
    sto = spark.createDataFrame([("f", i, f"s{i}", ("A-.~" * 20) if i else "AC") for i in range(9)], "file string, row int, id string, sequence string")
    got = D.families(sto).orderBy("row").collect()
    assert [r.row for r in got] == [1, 2, 3, 4, 5] and got[0].sequence == "A" * 20
    conf = spark.createDataFrame([(None,), (69.0,), (70.0,)], "c double").select(D.acceptable("mgnify", F.lit("A" * 20), F.col("c")).alias("ok"))
    assert [r.ok for r in conf.collect()] == [True, False, True]


def test_motif_draws_follow_weights(spark):
    m = spark.createDataFrame([("m", 0, 1.0, 0.0, 0.0, 0.0), ("m", 1, 0.0, 0.0, 0.5, 0.5), ("m", 2, 0.0, 1.0, 0.0, 0.0)], "motif string, pos int, a double, c double, g double, t double")
    got = [r.sequence for r in D.drawn_from_motifs(m, 200, 1).collect()]
    assert len(got) == 200 and set(got) == {"AGC", "ATC"} and 60 < got.count("AGC") < 140
    assert sorted(got) == sorted(r.sequence for r in D.drawn_from_motifs(m, 200, 1).collect())


def test_draws_by_source(spark):
    rows = [("mgnify", f"m{i}", "A") for i in range(50)] + [("short", f"s{i}", "C") for i in range(5)] + [("jaspar", "j", "G")]
    df = spark.createDataFrame(rows, "source string, id string, sequence string")
    got = D.sampled_by_source(df, 500, 7, {"mgnify": 0.7, "short": 0.3, "jaspar": 0.0, "none": 1.0}).collect()
    n = sum(r.source == "mgnify" for r in got)
    assert len(got) == 500 and 300 < n < 400 and {r.source for r in got} == {"mgnify", "short"} and len({r.id for r in got}) > 40
    assert D.sampled_by_source(df.limit(0), 10, 1).count() == 0
    s = {r.source: r for r in D.statistics(df).collect()}
    assert s["mgnify"].samples == 50 and s["short"].median == 1.0
