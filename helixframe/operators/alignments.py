"""Operators on alignment rows (``msa``, ``row``, ``sequence``, ``description``, ``deletions``); row 0 is the query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequences
from .relational import uniform


def deduplicated(df: DataFrame, key: Column, keep_query: bool = True) -> DataFrame:
    """The first row of each key; the query stays and, if ``keep_query``, is not compared."""
    first = F.row_number().over(Window.partitionBy("msa", F.when((F.col("row") == 0) & F.lit(keep_query), F.lit("\0query")).otherwise(key)).orderBy("row"))
    return df.withColumn("__n", first).filter("__n = 1").drop("__n")


def cropped(df: DataFrame, rows: int) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy("msa").orderBy("row"))).filter(F.col("__n") <= rows).drop("__n")


def acceptable_deletions(deletions: Column, total: int = 1000, share: float = 0.5, run: int = 3) -> Column:
    """Few deletions: in all, by column, and next to each other. None is acceptable."""
    summed = F.aggregate(deletions, F.lit(0), lambda s, d: s + d)
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))
    longest = F.aggregate(deletions, zero, lambda s, d: F.struct(F.when(d > 0, s["now"] + 1).otherwise(0).alias("now"), F.greatest(s["top"], F.when(d > 0, s["now"] + 1).otherwise(0)).alias("top")))["top"]
    good = (summed <= total) & (summed <= share * F.size(deletions)) & (longest < run)
    return F.coalesce((F.size(deletions) <= 0) | good, F.lit(True))


def without_block_deletions(df: DataFrame) -> DataFrame:
    return df.filter((F.col("row") == 0) | F.col("deletions").isNull() | acceptable_deletions(F.col("deletions")))


def covered(df: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows whose letters (not ``-`` or ``X``) cover ``least`` of the query's length."""
    query = df.filter("row = 0").select("msa", F.length("sequence").alias("__length"))
    share = F.length(F.regexp_replace("sequence", "[-X]", "")) / F.col("__length")
    return df.join(query, "msa").filter((F.col("row") == 0) | (share >= least)).drop("__length")


def without_gappy_columns(df: DataFrame, most: float = 0.9) -> DataFrame:
    """Only columns with a share of gaps under ``most``, in every row of an alignment."""
    cells = df.select("msa", F.posexplode(sequences.letters(F.col("sequence"))).alias("pos", "c"))
    kept = cells.groupBy("msa", "pos").agg(F.avg((F.col("c") == "-").cast("double")).alias("gap")).filter(F.col("gap") < most)
    columns = kept.groupBy("msa").agg(F.array_sort(F.collect_list("pos")).alias("__kept"))
    pick = F.array_join(F.transform("__kept", lambda p: F.substring(F.col("sequence"), p + 1, F.lit(1))), "")
    return df.join(columns, "msa", "left").withColumn("sequence", F.coalesce(pick, F.lit(""))).drop("__kept")


def merged(first: DataFrame, others: list[DataFrame], rows: int = 16_384) -> DataFrame:
    """The query with all rows but the first of each alignment, exact repeats dropped, cropped and numbered anew."""
    parts = [first.withColumn("__part", F.lit(0))] + [o.filter("row > 0").withColumn("__part", F.lit(i)) for i, o in enumerate(others, 1)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    order = Window.partitionBy("msa").orderBy("__part", "row")
    seen = F.row_number().over(Window.partitionBy("msa", "sequence").orderBy("__part", "row"))
    unique = every.withColumn("__seen", seen).filter("__seen = 1").withColumn("row", F.row_number().over(order) - 1)
    return unique.filter(F.col("row") < rows).drop("__seen", "__part")


def paired_by_species(df: DataFrame, chain: str = "msa", species: Column | None = None, require_all: bool = True, rows: int = 8191) -> DataFrame:
    """The first row of each species and chain, for species that all chains have (or two at least); ``pair`` numbers species in order."""
    kind = sequences.species(F.col("description")) if species is None else species
    found = df.filter("row > 0").withColumn("species", kind).filter(F.col("species").isNotNull())
    first = found.groupBy("species", chain).agg(F.min(F.struct("row", "sequence")).alias("m"))
    chains = df.select(chain).distinct().agg(F.count("*").alias("__all"))
    have = first.groupBy("species").agg(F.count("*").alias("__n")).join(F.broadcast(chains), F.col("__n") == F.col("__all") if require_all else F.col("__n") >= 2).select("species")
    ordered = have.orderBy("species").limit(rows).withColumn("pair", F.row_number().over(Window.orderBy("species")) - 1)
    return first.join(F.broadcast(ordered), "species").select("pair", "species", chain, "m.row", "m.sequence")


def dense_stack(df: DataFrame, chain: str = "msa", rows: int = 16_384) -> DataFrame:
    """Rows by falling coverage, one chain after the other in turn; ``place`` is the row in the stack."""
    turn = F.row_number().over(Window.partitionBy(chain).orderBy(sequences.coverage(F.col("sequence")).desc(), "row"))
    best = df.filter("row > 0").withColumn("turn", turn).filter(F.col("turn") <= rows).orderBy("turn", chain).limit(rows)
    return best.withColumn("place", F.row_number().over(Window.orderBy("turn", chain)) - 1)


def subsampled(df: DataFrame, rows: int, seed: int) -> DataFrame:
    """The query and ``rows - 1`` others by hash, in their old order."""
    rank = F.row_number().over(Window.partitionBy("msa").orderBy(F.when(F.col("row") == 0, -1.0).otherwise(uniform(seed, "msa", "row")), "row"))
    return df.withColumn("__n", rank).filter(F.col("__n") <= rows).drop("__n")


#: Alignments that may stand next to each other.
MOST_CHAINS = 10_000


def side_by_side(df: DataFrame, chain: str = "msa") -> DataFrame:
    """Alignments next to each other by row; one that is too short is filled with gaps. Their widths, a list, go to all tasks."""
    widths = df.groupBy(chain).agg(F.max(F.length("sequence")).alias("width"))
    listed = widths.agg(F.array_sort(F.collect_list(F.struct(F.col(chain).alias("chain"), "width"))).alias("widths"))
    if (n := widths.count()) > MOST_CHAINS:
        raise ValueError(f"{n} alignments are more than {MOST_CHAINS}")
    own = df.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct(F.col(chain).alias("chain"), "sequence"))).alias("own"))
    full = F.transform("widths", lambda w: F.coalesce(F.try_element_at("own", w["chain"]), F.repeat(F.lit("-"), w["width"])))
    return own.crossJoin(F.broadcast(listed)).select("row", F.array_join(full, "").alias("sequence"))  # the other side is one row


def chain_offsets(df: DataFrame, assembly: str, chain: str = "msa") -> DataFrame:
    """``offset`` and ``n``: where each chain's query begins in its assembly, and its length."""
    n = df.filter("row = 0").groupBy(assembly, chain).agg(F.length(F.max("sequence")).cast("long").alias("n"))
    return n.withColumn("offset", F.sum("n").over(Window.partitionBy(assembly).orderBy(chain)) - F.col("n"))


def mapped_to_clusters(df: DataFrame, key: str, description: str, mapping: DataFrame) -> DataFrame:
    """``description`` with `` UniRef90:`` and the cluster that ``mapping`` (key, cluster) has for the key, if any."""
    return df.join(mapping, key, "left").withColumn(description, F.when(F.col("cluster").isNull(), F.col(description)).otherwise(F.concat(description, F.lit(" UniRef90:"), "cluster"))).drop("cluster")


def profile(df: DataFrame) -> DataFrame:
    """For each alignment, column and letter its share; and the mean deletions of the column."""
    cells = df.select("msa", F.posexplode(F.arrays_zip(sequences.letters(F.col("sequence")).alias("c"), F.col("deletions").alias("d"))).alias("pos", "z"))
    counts = cells.groupBy("msa", "pos", F.col("z.c").alias("letter")).agg(F.count("*").alias("n"), F.sum(F.coalesce("z.d", F.lit(0))).alias("d"))
    total = counts.groupBy("msa", "pos").agg(F.sum("n").alias("rows"), (F.sum("d") / F.sum("n")).alias("deletion_mean"))
    return counts.join(total, ["msa", "pos"]).select("msa", "pos", "letter", (F.col("n") / F.col("rows")).alias("share"), "deletion_mean")


def stacked(first: DataFrame, other: DataFrame) -> DataFrame:
    """The rows of both, the second's after the first's; alignments of other widths are an error."""
    width = lambda t: t.groupBy("msa").agg(F.max(F.length("sequence")).alias("w"))
    uneven = width(first).join(width(other).withColumnRenamed("w", "v"), "msa").filter("w <> v").limit(1).collect()
    if uneven:
        raise ValueError(f"alignments of {uneven[0].w} and {uneven[0].v} columns")
    return appended(first, other, least=0)


def appended(first: DataFrame, other: DataFrame, least: int = 1) -> DataFrame:
    """The rows of ``other`` from ``least`` on (its query is left out) after those of ``first``, numbered anew."""
    both = first.withColumn("__part", F.lit(0)).unionByName(other.filter(F.col("row") >= least).withColumn("__part", F.lit(1)))
    return both.withColumn("row", F.row_number().over(Window.partitionBy("msa").orderBy("__part", "row")) - 1).drop("__part")


def by_cluster(df: DataFrame, mapping: DataFrame, accession: Column) -> DataFrame:
    """The first row of each cluster (``key, cluster``; a row without one is its own by its accession); the query stays and isn't compared."""
    named = df.withColumn("__key", accession).join(mapping.select(F.col("key").alias("__key"), "cluster"), "__key", "left")
    return deduplicated(named, F.coalesce("cluster", "__key")).drop("__key", "cluster")


def code_profile(df: DataFrame, codes: Column, pseudocount: float = 0.0) -> DataFrame:
    """For each column and class its share of the rows (plus a pseudocount)."""
    cells = df.select("msa", F.posexplode(codes).alias("pos", "code"))
    counts = cells.groupBy("msa", "pos", "code").agg(F.count("*").alias("n"))
    total = counts.groupBy("msa", "pos").agg(F.sum("n").alias("rows"))
    return counts.join(total, ["msa", "pos"]).select("msa", "pos", "code", (F.col("n") / (F.col("rows") + pseudocount)).alias("share"))


def letter_profile(df: DataFrame, alphabet: str = "ACDEFGHIKLMNPQRSTVWY-") -> DataFrame:
    """For each column the shares of the alphabet's letters among themselves."""
    cells = df.select("msa", F.posexplode(sequences.letters(F.col("sequence"))).alias("pos", "letter")).filter(F.instr(F.lit(alphabet), F.col("letter")) > 0)
    counts = cells.groupBy("msa", "pos", "letter").agg(F.count("*").alias("n"))
    total = counts.groupBy("msa", "pos").agg(F.sum("n").alias("rows"))
    return counts.join(total, ["msa", "pos"]).select("msa", "pos", "letter", (F.col("n") / F.col("rows")).alias("share"))


def deletion_columns(df: DataFrame) -> DataFrame:
    """For each column the mean deletions, the mean of their transformed values, and the rows that have some."""
    cells = df.select("msa", F.posexplode("deletions").alias("pos", "d"))
    return cells.groupBy("msa", "pos").agg(F.avg(F.coalesce("d", F.lit(0))).alias("mean"), F.avg(sequences.deletion_value(F.coalesce("d", F.lit(0)))).alias("value"), F.count_if(F.col("d") > 0).alias("rows"))


def query_columns(df: DataFrame) -> DataFrame:
    """``msa, pos, residue``: the query's columns with a letter, and which of its residues each is."""
    cells = df.filter("row = 0").select("msa", F.posexplode(sequences.letters(F.col("sequence"))).alias("pos", "letter")).filter("letter <> '-'")
    return cells.withColumn("residue", F.row_number().over(Window.partitionBy("msa").orderBy("pos")) - 1)


def on_residues(df: DataFrame) -> DataFrame:
    """Every row's letter and deletions at each residue of the query (columns where the query has a gap belong to none)."""
    cells = df.select("msa", "row", F.posexplode(F.arrays_zip(sequences.letters(F.col("sequence")).alias("letter"), F.col("deletions").alias("deletions"))).alias("pos", "c")).select("msa", "row", "pos", "c.*")
    return cells.join(query_columns(df).select("msa", "pos", "residue"), ["msa", "pos"]).drop("pos")


def shifted_on_tokens(df: DataFrame) -> DataFrame:
    """Every row's letters without its gaps on tokens from 0 on: what follows a gap moves to the left."""
    bare = F.filter(sequences.letters(F.col("sequence")), lambda c: c != "-")
    return df.select("msa", "row", F.posexplode(bare).alias("token", "letter"))


def paired_stack(df: DataFrame, species: Column, chain: str = "msa", rows: int = 8191) -> DataFrame:
    """Row 0 of all queries side by side, then a row for each paired species; a chain without the species has gaps."""
    paired = paired_by_species(df, chain, species, require_all=False, rows=rows).select((F.col("pair") + 1).alias("row"), chain, "sequence")
    return side_by_side(df.filter("row = 0").select("row", chain, "sequence").unionByName(paired), chain)


def processed(df: DataFrame, mapping: DataFrame, rows: int = 16_384) -> DataFrame:
    """One chain's alignment made ready: repeats and block deletions go, descriptions get their cluster, the first ``rows`` stay."""
    kept = without_block_deletions(deduplicated(df, F.md5(F.upper("sequence"))))
    described = kept.withColumn("__key", sequences.accession(F.col("description")))
    return cropped(mapped_to_clusters(described, "__key", "description", mapping.withColumnRenamed("key", "__key")).drop("__key"), rows)


def members_by_species(df: DataFrame, species: Column) -> DataFrame:
    """Rows of each species, the query left out."""
    return df.filter("row > 0").withColumn("species", species).filter("species IS NOT NULL").groupBy("msa", "species").agg(F.count("*").alias("n"), F.min("row").alias("first"))


def subsampled_if_larger(df: DataFrame, most: int, seed: int) -> DataFrame:
    """Alignments of up to ``most`` rows as they are, of others the query and ``most`` - 1 by hash."""
    return subsampled(df, most, seed)


def subsampled_at_random(df: DataFrame, seed: int) -> DataFrame:
    """The query and others by hash, between one row and all of them, as many as the alignment's own hash says."""
    n = df.groupBy("msa").agg(F.count("*").alias("__rows"))
    rank = F.row_number().over(Window.partitionBy("msa").orderBy(F.when(F.col("row") == 0, -1.0).otherwise(uniform(seed, "msa", "row")), "row"))
    return df.join(n, "msa").withColumn("__n", rank).filter(F.col("__n") <= 1 + F.floor(uniform(seed + 1, "msa") * F.col("__rows"))).drop("__n", "__rows")
