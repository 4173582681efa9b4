"""Queries of distance operators: embeddings as points, their labels as chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import spatial
from ..operators.relational import expand_symmetry
from ..sources.tables import checkpoint_folder, read_table

NEAR, CONTACT, CLASH = 0.05, 0.08, 0.02
POINTS = "p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"
DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


def points(spark, d: str) -> DataFrame:
    at = [F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz")]
    return read_table(spark, d, "embeddings").select("vec_id", "label", *at)


def _pairs(strict: bool, same: bool | None):
    def query(spark, d: str) -> DataFrame:
        p = points(spark, d)
        out = spatial.pairs_within(p, "vec_id", NEAR, ("label",) if same else (), strict)
        if same is False:
            out = out.filter("a_label <> b_label")
        return out.select(F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j"), F.round("distance", 9).alias("distance"))

    also = {True: "AND a.label = b.label", False: "AND a.label <> b.label", None: ""}[same]
    return query, f"WITH {POINTS} SELECT a.vec_id AS i, b.vec_id AS j, round({DIST}, 9) AS distance FROM p a JOIN p b ON a.vec_id < b.vec_id {also} AND {DIST} {'<' if strict else '<='} {NEAR}::DOUBLE"


def d04_nearest(spark, d: str) -> DataFrame:
    """The three nearest points of every twentieth point among all points, exactly."""
    checkpoint_folder(spark)
    p = points(spark, d)
    near = spatial.nearest(p.filter(F.col("vec_id") % 20 == 0), p, "vec_id", 3, NEAR)
    return near.select(F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j"), "rank", F.round("distance", 9).alias("distance"))


def d08_contacts(spark, d: str) -> DataFrame:
    out = spatial.contacts_by_chain(points(spark, d), "vec_id", "label", CONTACT)
    return out.withColumn("min_distance", F.round("min_distance", 9))


def d10_interfaces(spark, d: str) -> DataFrame:
    return d08_contacts(spark, d).filter("n_pairs >= 5")


def e05_clashes(spark, d: str) -> DataFrame:
    out = spatial.clash_fractions(points(spark, d), "vec_id", "label", CLASH)
    return out.select("label", "n", "n_clash", F.round("fraction", 9).alias("fraction"), (F.col("fraction") >= 0.3).alias("clashing"))


def e26_centroids(spark, d: str) -> DataFrame:
    return spatial.centroids(points(spark, d), "label").select("label", "n", *(F.round(f"c{c}", 9).alias(f"c{c}") for c in "xyz"))


def e27_radii(spark, d: str) -> DataFrame:
    return spatial.radii(points(spark, d), "label").select("label", F.round("radius", 9).alias("radius"))


def l20_symmetry(spark, d: str) -> DataFrame:
    """Every label is an assembly with two operators of its own."""
    p = points(spark, d)
    identity = {f"r{i}{j}": float(i == j) for i in (1, 2, 3) for j in (1, 2, 3)} | {"t1": 0.0, "t2": 0.0, "t3": 0.0}
    turned = identity | {"r11": -1.0, "r22": -1.0, "t1": 0.5, "t3": 0.25}
    both = F.array(*(F.struct(F.lit(op).alias("op"), *(F.lit(v).alias(k) for k, v in m.items())) for op, m in (("1", identity), ("2", turned))))
    ops = p.select("label").distinct().select("label", F.explode(both).alias("o")).select("label", "o.*")
    return expand_symmetry(p, ops, ["label"]).select("vec_id", "op", *(F.round(c, 9).alias(c) for c in "xyz"))


QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _name, _args in {"d03_pairs": (False, None), "d05_pairs_same_chain": (False, True), "d06_pairs_cross_chain": (True, False)}.items():
    QUERIES[_name], ORACLES[_name] = _pairs(*_args)
QUERIES |= {"d04_nearest": d04_nearest, "d08_contacts": d08_contacts, "d10_interfaces": d10_interfaces, "e05_clashes": e05_clashes, "e26_centroids": e26_centroids, "e27_radii": e27_radii, "l20_symmetry": l20_symmetry}
_CONTACTS = f"SELECT a.label AS chain_1, b.label AS chain_2, count(DISTINCT a.vec_id) AS n_1, count(DISTINCT b.vec_id) AS n_2, count(*) AS n_pairs, round(min({DIST}), 9) AS min_distance FROM p a JOIN p b ON a.label < b.label AND {DIST} <= {CONTACT}::DOUBLE GROUP BY 1, 2"
ORACLES |= {
    "d04_nearest": f"WITH {POINTS}, r AS (SELECT a.vec_id AS i, b.vec_id AS j, {DIST} AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY {DIST}, b.vec_id)::INTEGER AS rank FROM p a JOIN p b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) SELECT i, j, rank, round(d, 9) AS distance FROM r WHERE rank <= 3",
    "d08_contacts": f"WITH {POINTS} {_CONTACTS}",
    "d10_interfaces": f"WITH {POINTS} SELECT * FROM ({_CONTACTS}) WHERE n_pairs >= 5",
    "e05_clashes": f"WITH {POINTS}, h AS (SELECT DISTINCT a.vec_id FROM p a JOIN p b ON a.label <> b.label AND {DIST} <= {CLASH}::DOUBLE) SELECT label, count(*) AS n, count(h.vec_id) AS n_clash, round(count(h.vec_id) / count(*), 9) AS fraction, count(h.vec_id) / count(*) >= 0.3 AS clashing FROM p LEFT JOIN h USING (vec_id) GROUP BY label",
    "e26_centroids": f"WITH {POINTS} SELECT label, count(*) AS n, round(avg(x), 9) AS cx, round(avg(y), 9) AS cy, round(avg(z), 9) AS cz FROM p GROUP BY label",
    "e27_radii": f"WITH {POINTS}, b AS (SELECT label, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM p GROUP BY label) SELECT label, round(max({DIST}), 9) AS radius FROM p a JOIN b USING (label) GROUP BY label",
    "l20_symmetry": f"WITH {POINTS} SELECT vec_id, '1' AS op, round(x, 9) AS x, round(y, 9) AS y, round(z, 9) AS z FROM p UNION ALL SELECT vec_id, '2', round(-x + 0.5, 9), round(-y, 9), round(z + 0.25, 9) FROM p",
}
