"""Rigid motions of tables of points: weighted superposition by mergeable sums, symmetry groups of operator tables, random augmentation.

A superposition needs of its points only sums (weight, means, nine products, squares), which combine before the exchange; a group of
any size is spread over all tasks, and what is left of it, a row, is decomposed in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.tables import workers_find_package
from .relational import uniform

XYZ = ("x", "y", "z")
#: Points that a superposition needs, and how far (in degrees, and by components) angles and axes may be from each other to be the same.
LEAST, DEGREES, AXIS_PLACES = 3, 1.0, 2


def covariances(pairs: DataFrame, keys: list[str], mobile: tuple[str, str, str], target: tuple[str, str, str], weight: str | None = None) -> DataFrame:
    """For each group its points, their ``weight``, both ``centroids``, the 3 x 3 ``covariance`` (mobile by target, by rows) and the sum of ``squares`` about the centroids.

    Points with a null coordinate or without weight don't count. Means are subtracted at the end, so coordinates should not be far larger than the
    groups are wide (those of structures aren't).
    """
    there = F.lit(True)
    for c in (*mobile, *target):
        there = there & F.col(c).isNotNull() & ~F.isnan(c)
    w = F.lit(1.0) if weight is None else F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    given = pairs.select(*keys, *(F.col(c).cast("double").alias(f"__{s}{k}") for s, cols in (("m", mobile), ("t", target)) for k, c in enumerate(cols)), w.alias("__w")).filter(there & (w > 0))
    col = lambda s, k: F.col(f"__{s}{k}")
    sums = [F.sum(F.col("__w") * col(s, k)).alias(f"__s{s}{k}") for s in "mt" for k in range(3)]
    products = [F.sum(F.col("__w") * col("m", i) * col("t", j)).alias(f"__p{i}{j}") for i in range(3) for j in range(3)]
    squares = F.sum(F.col("__w") * sum((col(s, k) * col(s, k) for s in "mt" for k in range(3)), F.lit(0.0))).alias("__q")
    out = given.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("__w").alias("weight"), *sums, *products, squares)
    mean = lambda s, k: F.col(f"__s{s}{k}") / F.col("weight")
    centred = F.array(*(F.col(f"__p{i}{j}") - F.col("weight") * mean("m", i) * mean("t", j) for i in range(3) for j in range(3)))
    about = F.col("__q") - F.col("weight") * sum((mean(s, k) * mean(s, k) for s in "mt" for k in range(3)), F.lit(0.0))
    return out.select(*keys, "n", "weight", F.array(*(mean("m", k) for k in range(3))).alias("mobile_centroid"), F.array(*(mean("t", k) for k in range(3))).alias("target_centroid"), centred.alias("covariance"), about.alias("squares"))


def superpositions(pairs: DataFrame, keys: list[str], mobile: tuple[str, str, str], target: tuple[str, str, str], weight: str | None = None) -> DataFrame:
    """The best rigid fit of each group's ``mobile`` points onto its ``target`` ones: ``rotation`` (by rows), ``translation`` and ``rmsd`` beside the columns of ``covariances``.

    ``weight`` is a mask or any weight of 0 or more. Groups of fewer than three points have no fit (nulls).
    """
    found = covariances(pairs, keys, mobile, target, weight)
    workers_find_package(found.sparkSession)
    schema = StructType([*found.schema.fields, *StructType.fromDDL("rotation array<double>, translation array<double>, rmsd double").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            h = np.stack([np.asarray(x, float) for x in b["covariance"]]).reshape(-1, 3, 3)
            a, t = (np.stack([np.asarray(x, float) for x in b[c]]) for c in ("mobile_centroid", "target_centroid"))
            u, s, vt = np.linalg.svd(h)
            sign = np.where(np.linalg.det(u) * np.linalg.det(vt) < 0, -1.0, 1.0)
            vt[:, 2] *= sign[:, None]
            r = np.swapaxes(vt, 1, 2) @ np.swapaxes(u, 1, 2)
            shift = t - np.einsum("nij,nj->ni", r, a)
            left = b["squares"].to_numpy(float) - 2 * (s[:, 0] + s[:, 1] + sign * s[:, 2])
            rmsd = np.sqrt(np.maximum(left, 0) / b["weight"].to_numpy(float))
            enough = (b["n"] >= LEAST).to_numpy()
            none = lambda rows: [x.tolist() if k else None for x, k in zip(rows, enough, strict=True)]
            yield b.assign(rotation=none(r.reshape(-1, 9)), translation=none(shift), rmsd=pd.Series(np.where(enough, rmsd, np.nan), index=b.index).astype(object).where(enough, None))

    return found.mapInPandas(run, schema)


def fitted(points: DataFrame, fits: DataFrame, keys: list[str], columns: tuple[str, str, str] = XYZ, keep: tuple[str, ...] = ()) -> DataFrame:
    """Points with their group's rotation and translation (of ``superpositions``) applied; those of a group without a fit stay. ``keep`` names columns of the fits that come along."""
    own = fits.select(*keys, *keep, F.col("rotation").alias("__r"), F.col("translation").alias("__t"))
    at = [F.col(f"`{c}`") for c in columns]
    turned = {c: F.when(F.col("__r").isNull(), at[i]).otherwise(sum((F.col("__r")[3 * i + j] * at[j] for j in range(3)), F.lit(0.0)) + F.col("__t")[i]) for i, c in enumerate(columns)}
    return points.join(own, keys, "left").withColumns(turned).drop("__r", "__t")


# Symmetry


def rotation_facts(operators: DataFrame) -> DataFrame:
    """Operators (``r11`` to ``r33``) with ``angle`` in degrees, ``axis`` (of length 1, the first component that isn't 0 positive; null for the identity) and ``order``, how often it gives the identity."""
    r = lambda i, j: F.col(f"r{i}{j}")
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (r(1, 1) + r(2, 2) + r(3, 3) - 1) / 2))
    out = operators.withColumn("angle", F.degrees(F.acos(cosine)))
    skew = [r(3, 2) - r(2, 3), r(1, 3) - r(3, 1), r(2, 1) - r(1, 2)]
    # Half turns have no skew part; there R + I is twice the axis by itself, of which the longest column is taken.
    plus = lambda j: F.array(*(r(i, j) + (1.0 if i == j else 0.0) for i in (1, 2, 3)))
    longest = F.array_max(F.array(*(F.struct((r(j, j) + 1).alias("length"), plus(j).alias("v")) for j in (1, 2, 3))))["v"]
    raw = F.when(F.col("angle") < DEGREES, None).when(F.col("angle") > 180 - DEGREES, longest).otherwise(F.array(*skew))
    out = out.withColumn("__v", raw)
    length = F.sqrt(F.aggregate("__v", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.transform("__v", lambda x: x / length)
    out = out.withColumn("__v", unit)
    first = F.get(F.filter("__v", lambda x: F.abs(x) > 10.0**-AXIS_PLACES), F.lit(0))
    out = out.withColumn("axis", F.transform("__v", lambda x: x * F.signum(first)))
    order = F.coalesce(*(F.when(F.abs(F.col("angle") * n - 360 * F.round(F.col("angle") * n / 360)) < DEGREES, n) for n in range(2, 13)), F.round(360 / F.col("angle")).cast("int"))
    return out.withColumn("order", F.when(F.col("angle") < DEGREES, 1).otherwise(order)).drop("__v")


def symmetry_groups(operators: DataFrame, keys: list[str]) -> DataFrame:
    """The point group of each operator table: ``operators`` (distinct turns), ``axes`` by order, and ``symmetry``: Cn, Dn, T, O, I or unknown.

    Cn has one axis with all turns; Dn, of 2 n turns, an axis of order n and n half turns across it (D2: three of them across each other); T, O and I have
    their numbers of turns and of axes of each order.
    """
    facts = rotation_facts(operators)
    rounded = F.transform("axis", lambda x: F.round(x, AXIS_PLACES) + 0.0)
    turns = facts.select(*keys, "order", rounded.alias("axis"), F.round("angle").alias("angle")).distinct()
    turn = F.struct("axis", "angle")
    one = operators.groupBy(*keys).agg(F.countDistinct(*(F.round(f"r{i}{j}", AXIS_PLACES) + 0.0 for i in (1, 2, 3) for j in (1, 2, 3))).alias("operators"))
    by_axis = turns.filter("axis IS NOT NULL").groupBy(*keys, "axis").agg(F.max("order").alias("order"), F.countDistinct(turn).alias("turns"))
    axes = by_axis.groupBy(*keys).agg(*(F.count_if(F.col("order") == n).alias(f"axes_{n}") for n in (2, 3, 4, 5)), F.count("*").alias("axes"), F.max("order").alias("highest"), F.max_by("axis", "order").alias("main"))
    across = by_axis.join(axes.select(*keys, "main", "highest"), keys).filter("order = 2")
    level = across.groupBy(*keys).agg(F.count_if(F.abs(F.aggregate(F.zip_with("axis", "main", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)) < 0.05).alias("across"))
    out = one.join(axes, keys, "left").join(level, keys, "left")
    n = F.col("operators")

    def counted(total: int, by: dict[int, int]) -> Column:
        out = n == total
        for order, axes_ in by.items():
            out = out & (F.col(f"axes_{order}") == axes_)
        return out

    label = (
        F.when(n == 1, "C1").when(F.col("axes").isNull(), "unknown").when((F.col("axes") == 1) & (F.col("highest") == n), F.concat(F.lit("C"), n.cast("string")))
        .when(counted(12, {3: 4, 2: 3}), "T").when(counted(24, {4: 3, 3: 4, 2: 6}), "O").when(counted(60, {5: 6, 3: 10, 2: 15}), "I")
        .when((n == 4) & (F.col("axes_2") == 3) & (F.col("across") == 2), "D2").when((n == 2 * F.col("highest")) & (F.col("across") == F.col("highest")) & (F.col("axes") == F.col("highest") + 1), F.concat(F.lit("D"), F.col("highest").cast("string")))
        .otherwise("unknown")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select(*keys, "operators", zero("axes").alias("axes"), *(zero(f"axes_{k}").alias(f"axes_{k}") for k in (2, 3, 4, 5)), label.alias("symmetry"))


# Augmentation


def normal(seed: int, part: int, *keys: str) -> Column:
    """A standard normal number from hashes of the keys (Box and Muller)."""
    u, v = uniform(2 * (seed * 16 + part), *keys), uniform(2 * (seed * 16 + part) + 1, *keys)
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)


def random_rotation(seed: int, *keys: str) -> list[list[Column]]:
    """Rows of a rotation, uniform over all, from a quaternion of four normal numbers."""
    parts = F.array(*(normal(seed, k, *keys) for k in range(4)))
    length = F.sqrt(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x * x))
    w, x, y, z = (parts[k] / length for k in range(4))
    return [[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]]


def augmented(points: DataFrame, keys: list[str], seed: int, spread: float = 1.0, centred: bool = True, rotated: bool = True, shifted: bool = True) -> DataFrame:
    """Each group's points about their mean, turned at random and moved by normal numbers times ``spread``. The same motion in every run for the same keys and seed."""
    group = Window.partitionBy(*keys)
    middle = [F.avg(c).over(group) if centred else F.lit(0.0) for c in XYZ]
    facts = points.select(*keys).distinct()
    turn = random_rotation(seed, *keys) if rotated else [[F.lit(float(i == j)) for j in range(3)] for i in range(3)]
    move = [normal(seed, 4 + i, *keys) * spread if shifted else F.lit(0.0) for i in range(3)]
    facts = facts.select(*keys, F.array(*(F.array(*row) for row in turn)).alias("__turn"), F.array(*move).alias("__move"))
    given = points.withColumns({f"__{c}": F.col(c) - m for c, m in zip(XYZ, middle, strict=True)}).join(facts, keys)
    new = {c: sum((F.col("__turn")[i][j] * F.col(f"__{d}") for j, d in enumerate(XYZ)), F.lit(0.0)) + F.col("__move")[i] for i, c in enumerate(XYZ)}
    return given.withColumns(new).drop("__turn", "__move", *(f"__{c}" for c in XYZ))
