"""Five stages from raw documents to token ids; each stage's rows are written as Parquet and read by the next.

1. language ID: documents without a letter and those in none of the languages learned from the labelled ones go; with
   no labelled document to learn from only the former go;
2. line dedup by site-relative frequency, a document's site being its source; the ratio alone decides on lines of two
   distinct documents or more; ``n_chars`` follows the text;
3. n-gram Jaccard join: one document of each group of near duplicates stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. SentencePiece encoding and decoding: ids and digests of every document left.

Rows with nulls: a null text has no language and goes in stage 1; a null source is no site, so its lines stay; a null
id is an id like any other, and so are repeated ones. Empty tables pass through all stages. Columns beyond those of
``documents`` are carried up to the last stage, whatever their names. A document of which all lines are its site's boilerplate
keeps its row with an empty text: it is in no group of near duplicates, holds no item, and is encoded as begin and end alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.op01_benchmark import find_leaks
from helixframe.llm.op03_lines import dedup_lines
from helixframe.llm.op07_jaccard import one_of_each
from helixframe.llm.op08_language import in_known_languages
from helixframe.llm.op10_pieces import encode_pieces
from helixframe.llm.session import fold, free_name, prepare, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_known_languages(docs, docs.filter(fold("doc_id", 4) != 2))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs.columns, "dropped_lines")
    out = dedup_lines(docs, "source", out=name)
    return out.withColumn("n_chars", F.when(F.col(name) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs.columns, "leaks")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), out=name)
    return found.filter(F.size(f"`{name}`") == 0).select(*(F.col(f"`{c}`") for c in docs.columns))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Executors come here with what the stages before have left in their memory, so the workers take little.
    return encode_pieces(docs, outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"), chars=500_000, chunks=100_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontaminated),
    ("sentencepiece", pieces),
]

#: Language ID, the chosen-path join and the encoder are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What stands between them is kept in the session's checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{prepare(spark).sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
