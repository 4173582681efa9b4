"""Distance joins: a grid of cells turns them into equi-joins.

Points of one side also go to those cells around theirs that the threshold reaches from where they lie, so each pair within the threshold
meets once; the residual predicate keeps these. The work follows the number of points near each other, not the product of the sides.
In a join of points with themselves copies go to half of the cells around, and only what a caller asks for goes through the join. Points and
copies are then one table that is joined with itself, so they are exchanged once. Wider cells mean fewer copies and so less disk, but more pairs to look at.

Both sides are dealt by cell and merged, whatever their estimated sizes: coordinates on a lattice compress so well that a file of a few MB may
hold millions of points, and a side that is estimated by its file would be broadcast through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

XYZ = ("x", "y", "z")


def squared(a: str, b: str) -> Column:
    return sum((((F.col(a + c) - F.col(b + c)) * (F.col(a + c) - F.col(b + c))) for c in XYZ), F.lit(0.0))


def distance(a: str = "a_", b: str = "b_") -> Column:
    return F.sqrt(squared(a, b))


#: Width of a cell in thresholds: narrower ones mean more copies, wider ones more pairs to look at.
CELLS = 1.5
AXIS = 1 << 21


def _along(axis: str, width: float) -> Column:
    """Where a point lies along an axis, in cells. One cell has the origin in its middle, so that flat things around it are not cut."""
    return F.col(axis) / width + 0.5


def _cell(width: float, prefix: str = "", steps: tuple | None = None) -> Column:
    """The number of a point's cell, or of one beside it; cells 2**21 apart along an axis share theirs."""
    at = [F.floor(_along(prefix + c, width)).cast("long") for c in XYZ]
    x, y, z = (F.pmod(i if steps is None else i + F.col(d), F.lit(AXIS)) for i, d in zip(at, steps or XYZ, strict=True))
    return (x * AXIS + y) * AXIS + z


def _copies(points: DataFrame, width: float, threshold: float, half: bool, prefix: str) -> DataFrame:
    """A row for each cell (``__cell_b``) that a point reaches; ``__own`` in its own. ``half``: of two cells beside each other one alone reaches the other.

    An axis at a time, so that few steps are tried and the code of a row stays small enough to be compiled.
    """
    steps = tuple(f"__d{c}" for c in XYZ)
    out = points.withColumns({f"__i{c}": _along(prefix + c, width) - F.floor(_along(prefix + c, width)) for c in XYZ}).withColumn("__gap", F.lit(0.0))
    for k, (c, d) in enumerate(zip(XYZ, steps, strict=True)):
        gap = F.when(F.col(d) == 0, 0.0).when(F.col(d) > 0, (1 - F.col(f"__i{c}")) * width).otherwise(F.col(f"__i{c}") * width)
        out = out.select("*", F.explode(F.array(*map(F.lit, (0, 1) if half and not k else (-1, 0, 1)))).alias(d))
        if half:
            ahead = F.col(d) >= 0
            for before in steps[:k]:
                ahead = ahead | (F.col(before) > 0)
            out = out.filter(ahead)
        out = out.withColumn("__gap", F.col("__gap") + gap * gap).filter(F.col("__gap") <= threshold * threshold * (1 + 1e-6))
    own = F.lit(True)
    for d in steps:
        own = own & (F.col(d) == 0)
    return out.select(*(F.col(f"`{c}`") for c in points.columns), _cell(width, prefix, steps).alias("__cell_b"), own.alias("__own"))


def within(left: DataFrame, right: DataFrame, threshold: float, keys: tuple[str, ...] = (), strict: bool = False, width: float | None = None) -> DataFrame:
    """All pairs of rows (columns prefixed ``a_`` and ``b_``) with equal ``keys`` whose ``x, y, z`` are within ``threshold``, and their ``distance``. ``right`` is copied to the cells around, so give the smaller one there. ``width`` as in ``near_pairs``."""
    width = width or CELLS * threshold
    a = left.select(*(F.col(c).alias(f"a_{c}") for c in left.columns), _cell(width).alias("__cell_a"))
    b = _copies(right.select(*(F.col(c).alias(f"b_{c}") for c in right.columns)), width, threshold, False, "b_")
    on = [F.col("__cell_a") == F.col("__cell_b")] + [F.col(f"a_{k}") == F.col(f"b_{k}") for k in keys]
    pairs = a.hint("merge").join(b, on).withColumn("distance", distance())
    near = F.col("distance") < threshold if strict else F.col("distance") <= threshold
    return pairs.filter(near).drop("__cell_a", "__cell_b", "__own")


def near_pairs(points: DataFrame, order: str | tuple[str, ...], threshold: float, keys: tuple[str, ...] = (), strict: bool = False, width: float | None = None) -> DataFrame:
    """The self-join: each unordered pair of different ``order`` (a column or some) once, the smaller one as ``a_``. All columns of ``points`` go through the join, so give it few.

    ``width`` is that of the cells (at least the threshold). Both sides are the same table of points and copies, so that their exchange is made once;
    of two copies neither is in its own cell, so they don't count.
    """
    width = width or CELLS * threshold
    reached = _copies(points, width, threshold, True, "")
    side = lambda s: reached.select(*(F.col(f"`{c}`").alias(f"{s}_{c}") for c in points.columns), F.col("__cell_b").alias(f"__cell_{s}"), F.col("__own").alias(f"__own_{s}"))
    on = [F.col("__cell_a") == F.col("__cell_b")] + [F.col(f"a_{k}") == F.col(f"b_{k}") for k in keys]
    place = lambda s: F.col(f"{s}_{order}") if isinstance(order, str) else F.struct(*(F.col(f"{s}_{c}").alias(c) for c in order))
    pairs = side("a").hint("merge").join(side("b"), on).filter(F.col("__own_a") | F.col("__own_b")).withColumn("distance", distance())
    near = pairs.filter(F.col("distance") < threshold if strict else F.col("distance") <= threshold)
    # A row for the first order of the two: as a filter this would be worked out for all candidates inside the join.
    once = near.select("*", F.explode(F.when(place("a") < place("b"), F.array(F.lit(1)))).alias("__once"))
    return once.select(*(f"`{s}_{c}`" for s in "ab" for c in points.columns), "distance")


def ends(pairs: DataFrame, *columns: str) -> DataFrame:
    """Both points of each pair as rows."""
    sides = F.array(*(F.struct(*(F.col(f"{s}_{c}").alias(c) for c in columns)) for s in "ab"))
    return pairs.select(F.explode(sides).alias("__e")).select("__e.*")


def pairs_within(points: DataFrame, key: str, threshold: float, keys: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """The self-join, each unordered pair once (smaller ``key`` first)."""
    return near_pairs(points, key, threshold, keys, strict)


def contacts_by_chain(points: DataFrame, key: str, chain: str, threshold: float) -> DataFrame:
    """For each two chains in contact: points of each side in contact, pairs, and the least distance."""
    own = points.select(key, chain, *XYZ)
    found = near_pairs(own, (chain, key), threshold).filter(F.col(f"a_{chain}") < F.col(f"b_{chain}"))
    return found.groupBy(F.col(f"a_{chain}").alias("chain_1"), F.col(f"b_{chain}").alias("chain_2")).agg(
        F.countDistinct(f"a_{key}").alias("n_1"), F.countDistinct(f"b_{key}").alias("n_2"), F.count("*").alias("n_pairs"), F.min("distance").alias("min_distance")
    )


def clash_fractions(points: DataFrame, key: str, chain: str, threshold: float) -> DataFrame:
    """For each chain the share of its points that have a point of another chain within ``threshold``."""
    near = near_pairs(points.select(key, chain, *XYZ), key, threshold).filter(F.col(f"a_{chain}") != F.col(f"b_{chain}"))
    hit = ends(near, key).distinct().withColumn("hit", F.lit(1))
    return points.join(hit, key, "left").groupBy(chain).agg(F.count("*").alias("n"), F.count("hit").alias("n_clash"), (F.count("hit") / F.count("*")).alias("fraction"))


def centroids(points: DataFrame, chain: str) -> DataFrame:
    return points.groupBy(chain).agg(*(F.avg(c).alias(f"c{c}") for c in XYZ), F.count("*").alias("n"))


def radii(points: DataFrame, chain: str) -> DataFrame:
    """The largest distance of a chain's points from their centroid."""
    c = centroids(points, chain).select(F.col(chain).alias("__chain"), *(F.col(f"c{x}").alias(f"b_{x}") for x in XYZ))
    a = points.select(F.col(chain), *(F.col(x).alias(f"a_{x}") for x in XYZ))
    return a.join(c, F.col(chain) == F.col("__chain")).groupBy(chain).agg(F.max(distance()).alias("radius"))


def nearest(queries: DataFrame, points: DataFrame, key: str, k: int, radius: float) -> DataFrame:
    """The ``k`` nearest other points of each query, exactly (equal distances by ``key``); ``rank`` from 1.

    Queries with ``k`` points within the radius are done, the rest go on with twice the radius, so each pass is a grid
    join; the last pass, over the whole extent, takes what there is. ``key`` is an integer without repeats.
    """
    from .relational import top_per_key

    low_high = points.agg(*(f(c) for c in XYZ for f in (F.min, F.max))).first()
    extent = None if low_high[0] is None else sum((low_high[2 * i + 1] - low_high[2 * i]) ** 2 for i in range(3)) ** 0.5
    left, out = queries, None
    while True:
        found = within(left, points, radius).filter(F.col(f"a_{key}") != F.col(f"b_{key}"))
        best = top_per_key(found, [f"a_{key}"], [F.col("distance"), F.col(f"b_{key}")], k)
        last = extent is None or radius > extent
        if last:
            return best if out is None else out.unionByName(best)
        best = best.checkpoint()
        done = best.groupBy(f"a_{key}").agg(F.count("*").alias("__n")).filter(F.col("__n") == k).select(f"a_{key}")
        whole = best.join(done, f"a_{key}", "left_semi").select(*best.columns)
        out = whole if out is None else out.unionByName(whole)
        left = left.join(done.withColumnRenamed(f"a_{key}", key), key, "left_anti").checkpoint()
        if not left.limit(1).count():
            return out
        radius *= 2


def between(a: Column, b: Column) -> Column:
    """The distance of two points given as structs of ``x, y, z``."""
    return F.sqrt(sum(((a[c] - b[c]) * (a[c] - b[c]) for c in XYZ), F.lit(0.0)))


def pairs_of(points: DataFrame, key: str, group: str) -> DataFrame:
    """All pairs inside a group (columns prefixed ``a_`` and ``b_``), smaller ``key`` first. Groups are cropped ones: their pairs are the result."""
    a, b = (points.select(*(F.col(c).alias(f"{s}_{c}") for c in points.columns)) for s in "ab")
    return a.join(b, (F.col(f"a_{group}") == F.col(f"b_{group}")) & (F.col(f"a_{key}") < F.col(f"b_{key}")))


def unit_vector(least: float = 1e-8) -> list[Column]:
    """From ``a`` to ``b``, of length 0 where the points are the same."""
    return [(F.col(f"b_{c}") - F.col(f"a_{c}")) / F.greatest(distance(), F.lit(least)) for c in XYZ]


def same(column: str) -> Column:
    return F.col(f"a_{column}") == F.col(f"b_{column}")


def contact_sets(points: DataFrame, key: str, chain: str, threshold: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each two chains in contact: the points of each side, in order, and the least distance."""
    own = points.select(*dict.fromkeys([*keys, key, chain]), *XYZ)
    found = near_pairs(own, (chain, key), threshold, keys).filter(F.col(f"a_{chain}") < F.col(f"b_{chain}"))
    names = [F.col(f"a_{k}").alias(k) for k in keys]
    return found.groupBy(*names, F.col(f"a_{chain}").alias("chain_1"), F.col(f"b_{chain}").alias("chain_2")).agg(
        F.array_sort(F.collect_set(f"a_{key}")).alias("points_1"), F.array_sort(F.collect_set(f"b_{key}")).alias("points_2"), F.min("distance").alias("min_distance")
    )


def weighted_centres(points: DataFrame, chain: list[str], weight: str) -> DataFrame:
    """The centre by weight, at the origin where there is no weight."""
    mass = F.sum(weight)
    return points.groupBy(*chain).agg(*(F.coalesce(F.sum(F.col(c) * F.col(weight)) / F.nullif(mass, F.lit(0)), F.lit(0.0)).alias(f"c{c}") for c in XYZ))
