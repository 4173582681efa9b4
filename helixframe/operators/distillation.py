"""Samples for distillation: sequences with their source, filters, motif draws and weights by source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import in_ranges, uniform

# Lengths, confidence and weights of the sources.
LENGTHS = {"mgnify": (16, 2000), "rfam": (16, 2000), "disordered": (16, 2000), "short": (10, 50)}
CONFIDENCE = 70.0
WEIGHTS = {"mgnify": 0.495, "disordered": 0.02, "rfam": 0.05, "short": 0.005, "jaspar": 0.0}
FAMILY_ROWS = 5
# End of fixed values.


def acceptable(source: str, sequence: Column, confidence: Column | None = None) -> Column:
    low, high = LENGTHS.get(source, LENGTHS["mgnify"])
    good = F.length(sequence).between(low, high)
    return good if confidence is None else good & F.coalesce(confidence >= CONFIDENCE, F.lit(True))


def samples(df: DataFrame, source: str, rows: int | None = None, seed: int = 0) -> DataFrame:
    """``source, id, sequence`` of acceptable rows; of more than ``rows`` those with the smallest hash."""
    good = df.filter(acceptable(source, F.col("sequence"))).select(F.lit(source).alias("source"), F.col("id").cast("string").alias("id"), "sequence")
    return good if rows is None else good.withColumn("__u", uniform(seed, "id")).orderBy("__u", "id").limit(rows).drop("__u")


def families(stockholm: DataFrame, rows: int = FAMILY_ROWS) -> DataFrame:
    """The first acceptable members of each family file, without gap characters; a name's last line counts."""
    bare = stockholm.withColumn("sequence", F.regexp_replace("sequence", "[.~-]", "")).filter(acceptable("rfam", F.col("sequence")))
    return bare.withColumn("__n", F.row_number().over(Window.partitionBy("file").orderBy("row"))).filter(F.col("__n") <= rows).drop("__n")


def drawn_from_motifs(matrix: DataFrame, draws: int, seed: int) -> DataFrame:
    """``draws`` sequences of each motif (``motif, pos, a, c, g, t``): a base for each position by its weights, by hash."""
    u = uniform(seed, "motif", "pos", "draw") * (F.col("a") + F.col("c") + F.col("g") + F.col("t"))
    base = F.when(u < F.col("a"), "A").when(u < F.col("a") + F.col("c"), "C").when(u < F.col("a") + F.col("c") + F.col("g"), "G").otherwise("T")
    cells = matrix.select("*", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")).withColumn("base", base)
    return cells.groupBy("motif", "draw").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("sequence"))


def statistics(df: DataFrame) -> DataFrame:
    n = F.length("sequence")
    return df.groupBy("source").agg(F.count("*").alias("samples"), F.avg(n).alias("mean"), F.median(n).alias("median"), F.min(n).alias("least"), F.max(n).alias("most"))


def sampled_by_source(df: DataFrame, size: int, seed: int, weights: dict[str, float] | None = None) -> DataFrame:
    """``size`` draws with replacement: a source by weight, then a row of it, each by hash; sources without weight or rows are left out.

    Rows are numbered by source and id in sampled ranges, so a large source is not one task's window; a draw finds its
    row by number.
    """
    weights = {k: w for k, w in (weights or WEIGHTS).items() if w > 0}
    keyed = in_ranges(df.filter(F.col("source").isin(list(weights))), "source", "id")
    counts = keyed.groupBy("source", "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    w = Window.partitionBy("source").orderBy("__part")
    before = counts.select("source", "__part", (F.sum("__n").over(w) - F.col("__n") - F.col("__first")).alias("__before"))  # a row for each range and source
    placed = keyed.join(F.broadcast(before), ["source", "__part"]).withColumn("__at", F.col("__before") + F.col("__at"))
    totals = {r["source"]: r["n"] for r in counts.groupBy("source").agg(F.sum("__n").alias("n")).collect()}
    there = {k: w for k, w in weights.items() if totals.get(k)}
    if not there:
        return df.limit(0).withColumn("draw", F.lit(0).cast("long"))
    edge, chosen = sum(there.values()), F.lit(None).cast("string")
    u = uniform(seed, "draw") * edge
    for k in reversed(there):
        chosen = F.when(u < edge, k).otherwise(chosen)
        edge -= there[k]
    draws = df.sparkSession.range(size).withColumnRenamed("id", "draw").withColumn("source", chosen)
    total = F.element_at(F.create_map(*(F.lit(x) for kv in totals.items() for x in kv)), F.col("source"))
    draws = draws.withColumn("__at", F.floor(uniform(seed + 1, "draw") * total).cast("long"))
    return draws.join(placed, ["source", "__at"]).select("draw", *df.columns)


def mean_confidence(scores: Column) -> Column:
    """The mean over all chains' scores (a map of arrays), null where there are none."""
    flat = F.flatten(F.map_values(scores))
    return F.aggregate(flat, F.lit(0.0), lambda t, x: t + x) / F.nullif(F.size(flat), F.lit(0))


def every_source(parts: dict[str, DataFrame], rows: int | None = None, seed: int = 0) -> DataFrame:
    """The samples of all sources (``id, sequence`` each)."""
    out = None
    for name, df in parts.items():
        own = samples(df, name, rows, seed)
        out = own if out is None else out.unionByName(own)
    return out


def source_weights(sources: DataFrame) -> DataFrame:
    """``source`` with its fixed weight; one without is never drawn."""
    pairs = [F.lit(x) for kv in WEIGHTS.items() for x in kv]
    return sources.withColumn("weight", F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0)))


def disordered(annotations: DataFrame) -> DataFrame:
    """``id`` and ``sequence`` of disorder annotations (``pdb_id, chain_id, sequence``)."""
    return annotations.select(F.concat_ws("_", "pdb_id", "chain_id").alias("id"), "sequence")


def with_motifs(proteins: DataFrame, drawn: DataFrame) -> DataFrame:
    """A sample for each protein (``motif, protein``) and each DNA drawn from its motif."""
    return proteins.join(drawn, "motif").select("motif", "draw", "protein", F.col("sequence").alias("dna"))
