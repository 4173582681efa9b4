"""FASTA, A3M, Stockholm, hit tables, motifs and two-column files as DataFrames, and FASTA and A3M sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequences


def _records(spark: SparkSession, path: str, sep: str = "\n") -> DataFrame:
    """``file, block, at, value``: pieces of files between separators, in the order of (block, at) in a file.

    Files are split between tasks as Spark likes, so none has to fit in one row.
    """
    rows = spark.read.option("lineSep", sep).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return rows.select("file", "block", F.monotonically_increasing_id().alias("at"), "value")


def _numbered(records: DataFrame, name: str) -> DataFrame:
    """A gapless number in each file, from counts by block and ranks inside a block."""
    counts = records.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = counts.select("file", "block", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))
    ranked = records.withColumn("rank", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")))
    return ranked.join(before, ["file", "block"]).select("file", (F.col("before") + F.col("rank") - 1).cast("int").alias(name), "value")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """A file's lines in order, numbered inside the file."""
    return _numbered(_records(spark, path), "line").select("file", "line", F.rtrim(F.col("value"), F.lit("\r")).alias("text"))


def read_fasta(spark: SparkSession, path: str, keep: str = "all") -> DataFrame:
    """``file, pos, id, description, sequence``; ``keep="last"`` leaves the last record of each id of a file."""
    found = _records(spark, path, "\n>").withColumn("value", F.when(F.col("block") == 0, F.regexp_replace("value", r"^\s*>", "")).otherwise(F.col("value"))).filter(F.trim("value") != "")
    records = _numbered(found, "pos").select("file", "pos", F.split("value", r"\r?\n", 2).alias("parts"))
    records = records.select("file", "pos", F.trim(F.col("parts")[0]).alias("description"), F.regexp_replace(F.coalesce(F.get("parts", F.lit(1)), F.lit("")), r"\s", "").alias("sequence"))
    out = records.withColumn("id", F.split("description", r"\s+")[0]).select("file", "pos", "id", "description", "sequence")
    if keep == "last":
        last = F.row_number().over(Window.partitionBy("file", "id").orderBy(F.col("pos").desc()))
        out = out.withColumn("__n", last).filter("__n = 1").drop("__n")
    return out


def read_a3m(spark: SparkSession, path: str) -> DataFrame:
    """``file, row, description, sequence, deletions``: aligned columns and the insertions before each."""
    raw = read_fasta(spark, path)
    return raw.select("file", F.col("pos").alias("row"), "description", sequences.a3m_aligned(F.col("sequence")).alias("sequence"), sequences.a3m_deletions(F.col("sequence")).alias("deletions"))


def read_stockholm(spark: SparkSession, path: str) -> DataFrame:
    """``file, row, id, sequence``: blocks joined for each name, names in order of first appearance."""
    rows = _lines(spark, path).filter(~F.col("text").rlike(r"^\s*(#|//|$)")).select("file", "line", F.split(F.trim("text"), r"\s+").alias("p")).filter(F.size("p") >= 2)
    pieces = rows.select("file", "line", F.col("p")[0].alias("id"), F.col("p")[1].alias("s"))
    joined = pieces.groupBy("file", "id").agg(F.min("line").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "s"))), lambda x: x["s"]), "").alias("sequence"))
    return joined.withColumn("row", F.row_number().over(Window.partitionBy("file").orderBy("first")) - 1).select("file", "row", "id", "sequence")


def read_tblout(spark: SparkSession, path: str) -> DataFrame:
    rows = _lines(spark, path).filter(~F.col("text").rlike(r"^\s*(#|$)")).select("file", "line", F.split(F.trim("text"), r"\s+").alias("p")).filter(F.size("p") >= 6)
    return rows.select("file", "line", F.col("p")[0].alias("name"), F.expr("try_cast(p[4] AS double)").alias("e_value"), F.expr("try_cast(p[5] AS double)").alias("score"))


def template_hits(stockholm: DataFrame, scores: DataFrame) -> DataFrame:
    """Alignment rows named ``1abc_A/1-100`` with their scores (e-value 1 and score 0 where there is none)."""
    key = F.split_part("id", F.lit("/"), F.lit(1))
    parts = F.split(key, "_")
    hits = stockholm.select("id", "sequence", F.lower(parts[0]).alias("pdb_id"), F.coalesce(F.get(parts, F.lit(1)), F.lit("A")).alias("chain_id"), key.alias("__key"))
    best = scores.groupBy(F.col("name").alias("__name")).agg(F.min(F.struct("line", "e_value", "score")).alias("s"))
    return hits.join(best, F.col("__key") == F.col("__name"), "left").select("id", "pdb_id", "chain_id", "sequence", F.coalesce("s.e_value", F.lit(1.0)).alias("e_value"), F.coalesce("s.score", F.lit(0.0)).alias("score"))


def read_mapping(spark: SparkSession, path: str, columns: tuple[str, str] = ("key", "value"), last: bool = True) -> DataFrame:
    """Two-column tab-separated lines; short lines go, and a key's last (or first) line counts."""
    rows = _records(spark, path).select("file", "block", "at", F.split(F.rtrim(F.col("value"), F.lit("\r")), "\t").alias("p")).filter(F.size("p") >= 2)
    pick = F.max if last else F.min
    one = rows.groupBy(F.trim(F.col("p")[0]).alias(columns[0])).agg(pick(F.struct("file", "block", "at", F.trim(F.col("p")[1]).alias("v"))).alias("b"))
    return one.select(columns[0], F.col("b.v").alias(columns[1]))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """``representative, member, cluster``: clusters numbered by their representative's first line."""
    rows = _records(spark, path).select("file", "block", "at", F.split(F.rtrim(F.col("value"), F.lit("\r")), "\t").alias("p")).filter(F.size("p") >= 2).select("file", "block", "at", F.col("p")[0].alias("representative"), F.col("p")[1].alias("member"))
    first = rows.groupBy("representative").agg(F.min(F.struct("file", "block", "at")).alias("first")).select("representative", "first.*")
    counts = first.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = counts.select("file", "block", (F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")).alias("before"))  # a row for each block of the files
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))).join(before, ["file", "block"])
    named = ranked.select("representative", F.concat(F.lit("cluster_"), (F.col("before") + F.col("rank") - 1).cast("string")).alias("cluster"))
    return rows.join(named, "representative").select("representative", "member", "cluster")


def read_obsolete(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(F.col("value").startswith("OBSLTE")).select(F.upper(F.get(F.split(F.trim("value"), r"\s+"), F.lit(2))).alias("pdb_id")).filter(F.col("pdb_id").isNotNull()).distinct()


def read_meme(spark: SparkSession, path: str) -> DataFrame:
    """``motif, name, pos, a, c, g, t``: rows of exactly four numbers under their ``MOTIF`` line."""
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    lines = _lines(spark, path).withColumn("p", F.split(F.trim("text"), r"\s+"))
    head = F.when(F.col("text").startswith("MOTIF"), F.struct(F.get("p", F.lit(1)).alias("motif"), F.coalesce(F.get("p", F.lit(2)), F.lit("")).alias("name")))
    carried = lines.withColumn("m", F.last(head, ignorenulls=True).over(w)).filter(F.col("m").isNotNull() & (F.size("p") == 4))
    values = carried.select("file", "line", "m.*", F.transform("p", lambda x: x.try_cast("double")).alias("v")).filter(~F.exists("v", lambda x: x.isNull()))
    at = F.row_number().over(Window.partitionBy("file", "motif").orderBy("line")) - 1
    return values.select("motif", "name", at.alias("pos"), *(F.col("v")[i].alias(b) for i, b in enumerate("acgt")))


def read_disorder(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated lines of five columns after a header line."""
    rows = _lines(spark, path).filter("line > 0").select(F.split("text", "\t").alias("p")).filter(F.size("p") >= 5)
    return rows.select(*(F.col("p")[i].alias(c) for i, c in enumerate(("pdb_id", "chain_id", "sequence", "start", "end"))))


def fasta_text(id_: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), id_, F.lit("\n"), sequences.fasta_wrapped(sequence))


def write_fasta(df: DataFrame, path: str, id_col: str = "id", sequence_col: str = "sequence") -> None:
    df.select(fasta_text(F.col(id_col), F.col(sequence_col)).alias("value")).write.text(path)


def a3m_text(row: Column, description: Column, sequence: Column) -> Column:
    return F.concat(F.lit(">"), F.coalesce(F.nullif(description, F.lit("")), F.concat(F.lit("sequence_"), row.cast("string"))), F.lit("\n"), sequence)


def read_motif_json(spark: SparkSession, path: str) -> DataFrame:
    """``motif, name, pos, a, c, g, t`` of JSON motifs (``matrix_id, name, pfm`` by base), a list or single objects."""
    rows = spark.read.schema("matrix_id string, name string, pfm struct<A: array<double>, C: array<double>, G: array<double>, T: array<double>>").option("multiLine", "true").json(path)
    cells = rows.select(F.col("matrix_id").alias("motif"), "name", F.posexplode(F.arrays_zip(*(F.col(f"pfm.{b}").alias(b.lower()) for b in "ACGT"))).alias("pos", "c"))
    return cells.select("motif", "name", "pos", "c.*")
