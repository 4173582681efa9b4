"""Sharded tables with a manifest, and alignments in their text formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import numbered
from .alignments import a3m_text


#: Rows of a folder of shards: a shard is a range of rows, not a file, so that there are no more files than the rows fill.
BUNDLE_ROWS = 1_000_000
MANIFEST = "shard string, bundle long, n long, first long"


def write_shards(df: DataFrame, path: str, key: str, rows: int = 1000) -> DataFrame:
    """Rows in ascending ``key`` (an integer without ties), ``rows`` to a shard; gives the manifest (``shard, bundle, n, first``).

    Rows stay in the ranges that they were numbered in; shards next to each other share a folder (``bundle``) of ``BUNDLE_ROWS`` rows, in order.
    """
    shard = F.floor(F.col("__row") / rows)
    placed = numbered(df, key, "__row").withColumns({"shard": F.format_string("shard_%06d", shard), "bundle": F.floor(shard / max(1, BUNDLE_ROWS // rows))})
    placed.drop("__row").sortWithinPartitions("bundle", key).write.mode("overwrite").partitionBy("bundle").parquet(f"{path}/data")
    manifest = placed.groupBy("shard", "bundle").agg(F.count("*").alias("n"), F.min(key).alias("first"))
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def read_shards(spark: SparkSession, path: str, shards: list[str] | None = None) -> DataFrame:
    """All shards, or some: the files of other bundles are not opened, and in theirs Parquet passes over pages of other shards."""
    df = spark.read.parquet(f"{path}/data")
    if shards is not None:
        known = spark.read.schema(MANIFEST).json(f"{path}/manifest").filter(F.col("shard").isin(shards))
        bundles = [r[0] for r in known.select("bundle").distinct().collect()]
        df = df.filter(F.col("bundle").isin(bundles) & F.col("shard").isin(shards))
    return df.drop("bundle")


def read_manifest(spark: SparkSession, path: str) -> dict:
    total = spark.read.schema(MANIFEST).json(f"{path}/manifest").agg(F.count("*"), F.sum("n")).first()
    return {"num_shards": total[0], "total_count": total[1] or 0}


def write_alignments(df: DataFrame, path: str, form: str = "a3m") -> None:
    """A text for each alignment (``msa, row, description, sequence``), in a folder by alignment."""
    ordered = lambda x: F.transform(F.array_sort(F.collect_list(F.struct("row", x.alias("t")))), lambda r: r["t"])
    if form == "a3m":
        text = F.array_join(ordered(a3m_text(F.col("row"), F.col("description"), F.col("sequence"))), "\n")
    elif form == "stockholm":
        name = F.regexp_replace(F.coalesce(F.nullif("description", F.lit("")), F.concat(F.lit("sequence_"), F.col("row").cast("string"))), r"\s+.*", "")
        text = F.concat(F.lit("# STOCKHOLM 1.0\n\n"), F.array_join(ordered(F.concat(name, F.lit(" "), F.col("sequence"))), "\n"), F.lit("\n//"))
    elif form == "json":
        text = F.to_json(F.struct(F.first("msa").alias("msa"), ordered(F.struct("description", "sequence")).alias("rows")))
    else:
        raise ValueError(f"not a format: {form!r}")
    df.groupBy("msa").agg(text.alias("value")).repartition("msa").write.mode("overwrite").partitionBy("msa").text(path)


def checksum(content: Column, algorithm: str = "md5") -> Column:
    """The hex digest of text or bytes."""
    if algorithm == "md5":
        return F.md5(content)
    if algorithm == "sha1":
        return F.sha1(content)
    if algorithm.startswith("sha") and algorithm[3:] in ("224", "256", "384", "512"):
        return F.sha2(content, int(algorithm[3:]))
    raise ValueError(f"not an algorithm: {algorithm!r}")


def write_features(df: DataFrame, path: str) -> None:
    """A row a structure, arrays as columns."""
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All features, or some: the others are not read."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def write_tokens(tokens: DataFrame, path: str) -> None:
    """A JSON object a token."""
    tokens.write.mode("overwrite").json(path)


def read_tokens(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """With the columns of ``like``, whatever the objects lack."""
    return spark.read.schema(like.schema).json(path)


def read_alignments(spark: SparkSession, path: str, form: str = "a3m") -> DataFrame:
    """What ``write_alignments`` wrote: ``msa`` and the rows of its format's reader."""
    from .alignments import read_a3m, read_stockholm

    files = f"{path}/msa=*/"
    rows = {"a3m": read_a3m, "stockholm": read_stockholm}[form](spark, files)
    return rows.withColumn("msa", F.regexp_extract("file", r"msa=([^/]*)/", 1)).drop("file")
