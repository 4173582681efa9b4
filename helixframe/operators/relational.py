"""Filters with reasons, clustering, deduplication, weights, sampling and alignment operators over any columns.

Every operator is a function of DataFrames and column names. Windows are partitioned by a key; a global order is only
taken over aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import checkpoint_folder

# Bins of contact counts.
SIZE_BINS = (10, 25, 50, 100, 200)
# End of fixed values.


def first_failing(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """``passed`` and ``reason``: the first rule (name, whether it holds) that fails; null counts as failing."""
    reason = None
    for name, holds in rules:
        fails = ~F.coalesce(holds, F.lit(False))
        reason = F.when(fails, name) if reason is None else reason.when(fails, name)
    return df.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def date_rule(date: Column, cutoff: str, mode: str = "before") -> Column:
    """Dates of one- or two-digit months and days; ``before`` and ``after`` include the cut-off."""
    d, c = F.coalesce(F.try_to_date(date, "yyyy-M-d"), F.lit(None).cast("date")), F.lit(cutoff).cast("date")
    return {"before": d <= c, "after": d >= c, "on": d == c}[mode]


def resolution_rule(resolution: Column, method: Column, most: float) -> Column:
    return F.coalesce(resolution <= most, F.contains(F.upper(method), F.lit("NMR")), F.lit(False))


def identity_clusters(df: DataFrame, id_col: str, key: Column) -> DataFrame:
    """Rows with equal keys: ``representative`` (smallest id), ``size`` and ``cluster``, numbered by representative.

    The numbering is a window over clusters, after the aggregation; ids in their range parts are counted by part, so no
    task takes all clusters.
    """
    groups = df.groupBy(key.alias("__key")).agg(F.min(id_col).alias("representative"), F.count("*").alias("size"))
    return groups.drop("__key")


#: Rows of a range that one task numbers, and ranges at least.
RANGE_ROWS, RANGES = 250_000, 16


def numbered(df: DataFrame, order: str, name: str, start: int = 0) -> DataFrame:
    """A gapless number in ascending ``order`` (a column without ties) without a window over all rows.

    Rows are exchanged into ranges that Spark samples, so that they hold about as many rows however the values lie, and are
    kept in the checkpoint folder; a row's number is its place in its range and the rows of the ranges before.
    """
    placed = in_ranges(df, order)
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))  # a row for each range
    return placed.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__at") + start).drop("__part", "__before", "__at")


def majority(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each key; of equals, the one seen first."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    best = counts.groupBy(key).agg(F.max(F.struct(F.col("n"), (-F.col("__first")).alias("f"), F.col(value).alias("value"))).alias("best"))
    return best.select(key, F.col("best.value").alias(value), F.col("best.n").alias("n"))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1).drop("rank")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)


def common_keys(df: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that occur in every group."""
    groups = df.select(group).distinct().agg(F.count("*").alias("__all"))
    have = df.groupBy(key).agg(F.countDistinct(group).alias("n_groups"))
    return have.join(F.broadcast(groups), F.col("n_groups") == F.col("__all")).drop("__all")


def round_robin(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``turn``: the row's rank in its group; ordering by (turn, group) interleaves the groups."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def prefix_budget(df: DataFrame, key: str, order: str, size: str, budget: int) -> DataFrame:
    """Rows of each key up to the first that would exceed the budget."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running", F.sum(size).over(w)).filter(F.col("running") <= budget)


def uniform(seed: int, *columns: str) -> Column:
    """A uniform number in [0, 1) from a row's columns and the seed: the same in every run and engine."""
    text = F.concat_ws("|", *(F.col(c).cast("string") for c in columns), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def weighted_sample(df: DataFrame, key: str, weight: Column, n: int, seed: int) -> DataFrame:
    """``n`` rows without replacement, each drawn in proportion to its weight (the largest keys log(u) / w)."""
    u = uniform(seed, key)
    return df.withColumn("draw", F.log(F.greatest(u, F.lit(1e-12))) / weight).orderBy(F.col("draw").desc(), key).limit(n)


def profile(df: DataFrame, sequence: str) -> DataFrame:
    """For each position and letter its count and frequency over all sequences."""
    cells = df.select(F.posexplode(F.split(sequence, "")).alias("pos", "letter")).filter(F.col("letter") != "")
    counts = cells.groupBy("pos", "letter").agg(F.count("*").alias("n"))
    total = counts.groupBy("pos").agg(F.sum("n").alias("total"))
    return counts.join(total, "pos").select("pos", "letter", "n", (F.col("n") / F.col("total")).alias("frequency"))


def expand_symmetry(points: DataFrame, operators: DataFrame, keys: list[str]) -> DataFrame:
    """Every point under every operator (``op``, ``r11``..``r33``, ``t1``..``t3``) of its own ``keys`` (a structure or an assembly)."""
    x, y, z = (F.col(c) for c in "xyz")
    moved = [F.col(f"r{i}1") * x + F.col(f"r{i}2") * y + F.col(f"r{i}3") * z + F.col(f"t{i}") for i in (1, 2, 3)]
    keep = [c for c in points.columns if c not in "xyz"]
    return points.join(operators, keys).select(*keep, "op", *(m.alias(c) for m, c in zip(moved, "xyz", strict=True)))


# Groups and their members


def without_whole(df: DataFrame, key: str, flag: Column) -> DataFrame:
    """``key`` and ``n`` of the groups in which some row isn't flagged (null counts as not)."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.bool_and(F.coalesce(flag, F.lit(False))).alias("every")).filter(~F.col("every")).drop("every")


def largest_step(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """``key`` and ``max_step``, the largest absolute difference of successive values (null for a single row)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__step", F.abs(F.col(value) - F.lag(value).over(w))).groupBy(key).agg(F.max("__step").alias("max_step"))


def without_cluster(df: DataFrame, key: str, members: DataFrame, target: str) -> DataFrame:
    """Rows of the keys that have no member in the target cluster; ``members`` has ``key`` and ``cluster``."""
    return df.join(members.filter(F.col("cluster") == target).select(key).distinct(), key, "left_anti")


def with_cluster(df: DataFrame, key: str, clusters: DataFrame) -> DataFrame:
    """``cluster`` of each row by its key, null where there is none."""
    return df.join(clusters.select(key, "cluster"), key, "left")


def in_bounds(size: Column, low: int = 4, high: int = 10_000) -> Column:
    return size.between(low, high)


def of_kinds(kind: Column, allowed: list[str] | None = None, excluded: list[str] | None = None) -> Column:
    """Excluded kinds go first, then those that are not allowed."""
    keep = ~kind.isin(*excluded) if excluded else F.lit(True)
    return keep & kind.isin(*allowed) if allowed else keep


def composed_of(df: DataFrame, key: str, low: int, high: int, required: dict[str, Column]) -> DataFrame:
    """Groups of ``low`` to ``high`` rows in which each requirement holds for some row."""
    found = df.groupBy(key).agg(F.count("*").alias("n"), *(F.bool_or(c).alias(f"__{k}") for k, c in required.items()))
    for k in required:
        found = found.filter(F.col(f"__{k}")).drop(f"__{k}")
    return found.filter(F.col("n").between(low, high))


def dominant(df: DataFrame, key: str, value: str, share: float = 0.8, default: str = "unknown", out: str = "kind") -> DataFrame:
    """The value with more than ``share`` of a group's rows, else ``default``."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    total = counts.groupBy(key).agg(F.sum("n").alias("total"), F.max(F.struct(F.col("n"), F.col(value).alias("value"))).alias("best"))
    return total.select(key, F.when(F.col("best.n") > share * F.col("total"), F.col("best.value")).otherwise(default).alias(out))


def counts_by_kind(df: DataFrame, key: str, kind: str, names: dict[str, str]) -> DataFrame:
    """Rows of each kind (``names``: column -> kind) and in all."""
    return df.groupBy(key).agg(*(F.count_if(F.col(kind) == v).alias(k) for k, v in names.items()), F.count("*").alias("n"))


def size_bin(size: Column, bins: tuple = SIZE_BINS) -> Column:
    """How many of the thresholds the size reaches."""
    return sum((F.when(size >= t, 1).otherwise(0) for t in bins), F.lit(0))


def types_of(kind: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(kind)), "+")


def type_clusters(df: DataFrame, key: str, kind: str, size: str) -> DataFrame:
    """Groups with the same set of kinds and the same bin of summed sizes: ``types``, ``bin``, ``n`` and the first key."""
    each = df.groupBy(key).agg(types_of(kind).alias("types"), F.sum(size).alias("__size"))
    return each.groupBy("types", size_bin(F.col("__size")).alias("bin")).agg(F.count("*").alias("n"), F.min(key).alias("first"))


def signature(df: DataFrame, key: str, kind: str) -> DataFrame:
    """``types:rows`` of each group."""
    return df.groupBy(key).agg(F.concat_ws(":", types_of(kind), F.count("*").cast("string")).alias("signature"))


def fingerprint(df: DataFrame, key: str, kind: str) -> DataFrame:
    """The md5 of a group's kinds with their rows, in order."""
    parts = df.groupBy(key, kind).agg(F.count("*").alias("n")).select(key, F.concat(F.col(kind), F.lit(":"), F.col("n").cast("string")).alias("f"))
    return parts.groupBy(key).agg(F.md5(F.array_join(F.array_sort(F.collect_list("f")), "|")).alias("fingerprint"))


def similarity(same_type: Column, a: Column, b: Column) -> Column:
    """0 for different types, else the smaller size over the larger."""
    return F.when(~same_type, 0.0).otherwise(F.least(a, b) / F.greatest(a, b))


def index_of(df: DataFrame, key: str, members: dict[str, str]) -> DataFrame:
    """How many distinct members (``members``: column -> member) each key has."""
    return df.groupBy(key).agg(*(F.countDistinct(c).alias(k) for k, c in members.items()))


def described(df: DataFrame, key: str, value: str, distinct: dict[str, str] | None = None) -> DataFrame:
    """Rows, mean, median, least and most of a value, and distinct members."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"), F.min(value).alias("least"), F.max(value).alias("most"), *(F.countDistinct(c).alias(k) for k, c in (distinct or {}).items()))


def failures(df: DataFrame, reason: str) -> DataFrame:
    """Rows by what stands before the first colon of their reason."""
    return df.groupBy(F.split_part(reason, F.lit(":"), F.lit(1)).alias("reason")).agg(F.count("*").alias("n"))


def first_of_equal(df: DataFrame, key: Column, order: str, name: str = "key") -> DataFrame:
    """The smallest ``order`` of each key."""
    return df.groupBy(key.alias(name)).agg(F.min(order).alias(order))


def best_per_key(df: DataFrame, key: str, score: str, order: list[str]) -> DataFrame:
    """The row with the highest score of each key, of equals the first in ``order``; other columns are left out."""
    best = F.max(F.struct(F.col(score).alias("score"), *((-F.col(c)).alias(c) for c in order)))
    return df.groupBy(key).agg(best.alias("b")).select(key, F.col("b.score").alias(score), *((-F.col(f"b.{c}")).alias(c) for c in order))


def distinct_first(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Distinct values with the place at which each is first seen."""
    return df.groupBy(*columns).agg(F.min(order).alias("first"))


def first_by_name(parts: list[DataFrame], name: str, order: list[str]) -> DataFrame:
    """Of rows in several tables the first of each name, by the table's number (``part``) and ``order``."""
    every = None
    for i, p in enumerate(parts):
        numbered_part = p.withColumn("part", F.lit(i))
        every = numbered_part if every is None else every.unionByName(numbered_part)
    return every.groupBy(name).agg(F.min(F.struct("part", *order)).alias("m")).select(name, "m.*")


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """``batch``: rows in order, ``size`` to a batch, the last one with the rest."""
    if size < 1:
        raise ValueError("a batch holds one row at least")
    return numbered(df, order, "__row").withColumn("batch", F.floor(F.col("__row") / size)).drop("__row")


def flattened(column: Column, depth: int) -> Column:
    """Nested arrays, ``depth`` levels made one."""
    for _ in range(depth):
        column = F.flatten(column)
    return column


# Weights


def static_weight(name: Column, weights: dict[str, float]) -> Column:
    """1.0 for names without a weight."""
    pairs = [F.lit(x) for kv in weights.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), name), F.lit(1.0))


def inverse_cluster_weight(df: DataFrame, key: str, cluster: str) -> DataFrame:
    """For each key 1 over the size (distinct keys) of the smallest cluster it is in."""
    size = df.groupBy(cluster).agg(F.countDistinct(key).alias("__size"))
    return df.join(size, cluster).groupBy(key).agg((1 / F.min("__size")).alias("weight"))


def cluster_weight(df: DataFrame, cluster: str, factor: Column, dataset: str) -> DataFrame:
    """``weight``: 1 over the rows of the cluster times ``factor``, as a share of the dataset's sum."""
    size = df.groupBy(cluster).agg(F.count("*").alias("__size"))
    raw = df.join(size, cluster).withColumn("__w", (1 / F.col("__size")) * factor)
    total = raw.groupBy(dataset).agg(F.sum("__w").alias("__total"))
    return raw.join(total, dataset).withColumn("weight", F.col("__w") / F.col("__total")).drop("__size", "__w", "__total")


def chain_weight(types: Column) -> Column:
    return 1 + 0.5 * F.size(types)


def interface_weight(types: Column, tags: tuple[str, ...] = ("ligand-protein", "dna-protein", "protein-rna")) -> Column:
    """Twice for an interface of a protein with a ligand or a nucleic acid."""
    return F.when(F.arrays_overlap(types, F.array(*map(F.lit, tags))), 2.0).otherwise(1.0)


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """Rows in ranges that Spark samples, so that they hold about as many rows however the values lie, with ``__part`` and their place ``__at`` in it; kept in the checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    ranges = max(RANGES, -(-df.count() // RANGE_ROWS))
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__at")).checkpoint()


def drawn(df: DataFrame, key: str, weight: str, n: int, seed: int) -> DataFrame:
    """``n`` draws with replacement in proportion to ``weight``: ``draw`` and ``key`` (a column without ties). Rows without a weight above 0 are not drawn.

    Weights are cumulated in the order of keys, in sampled ranges. Then draws and the rows' spans are sorted together, again in sampled ranges, and a
    draw takes the last span that begins before it; what the ranges before a range hold is a row for each of them.
    """
    placed = in_ranges(df.select(F.col(key).alias("__key"), F.col(weight).cast("double").alias("__w")).filter("__w > 0"), "__key")
    sums = placed.groupBy("__part").agg(F.sum("__w").alias("__sum"))
    before = sums.select("__part", (F.sum("__sum").over(Window.orderBy("__part")) - F.col("__sum")).alias("__before"))  # a row for each range
    total = sums.agg(F.sum("__sum")).first()[0]
    if not total:
        return df.sparkSession.range(0).select(F.col("id").alias("draw")).crossJoin(df.select(key).limit(0))
    inside = F.sum("__w").over(Window.partitionBy("__part").orderBy("__at"))
    spans = placed.withColumn("__high", inside).join(F.broadcast(before), "__part").select((F.col("__before") + F.col("__high") - F.col("__w")).alias("__u"), F.lit(0).alias("__kind"), F.col("__key"), F.lit(None).cast("long").alias("draw"))
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw").select((uniform(seed, "draw") * total).alias("__u"), F.lit(1).alias("__kind"), F.lit(None).cast(placed.schema["__key"].dataType).alias("__key"), "draw")
    both = in_ranges(spans.unionByName(draws), "__u", "__kind")
    last = both.groupBy("__part").agg(F.max_by("__key", F.when(F.col("__kind") == 0, F.col("__at"))).alias("__last"))
    carried = last.select("__part", F.last("__last", ignorenulls=True).over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)).alias("__carried"))  # a row for each range
    found = both.withColumn("__found", F.last("__key", ignorenulls=True).over(Window.partitionBy("__part").orderBy("__at")))
    return found.filter("__kind = 1").join(F.broadcast(carried), "__part").select("draw", F.coalesce("__found", "__carried").alias(key))


def composed(df: DataFrame, steps: list) -> DataFrame:
    """Functions from DataFrames to DataFrames, one after the other."""
    for step in steps:
        df = step(df)
    return df
