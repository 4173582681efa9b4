"""Sharding by histogram sort: splitters from exact counts, then one exchange.

The rows are ordered by id. Every round counts the exact bytes and rows below probes inside each
splitter's bracket, in one aggregation over a narrow table of ids and sizes, and narrows the bracket around the
splitter's target, until the bytes below it are within ``tolerance`` of the target or the bracket is one id. Then the rows are
exchanged once, by shard and cell (a key range within the shard), and sorted; a row's slot is the rows in the shard's cells before its own plus its
rank in its cell.

Cells are ranges of equal width between a shard's least and largest id, whose rows are counted. One with over twice ``CELL_ROWS`` rows is cut
again between its own least and largest id, until none is left but those of a single id, so ids may lie as unevenly as they like.
An id that holds so many rows itself, or that a splitter must cut (many rows share it), has its rows numbered and written to the
checkpoint folder; its splitters and cells are then found by these numbers.

The narrow table (id, bytes) is written to the checkpoint folder, so that counting rounds read no text. Counts that reach the driver
are ``shards`` x ``PROBES`` rows a round (more for each bracket while there are few brackets), and a row for each cell or id that is cut.
All of it is DataFrame operations.

Sizes: UTF-8 bytes of the text (none for null) plus 8, so every row weighs something and empty texts count. Integer ids sort by
value, any others by their 64-bit hash; null ids sort first. Rows with equal ids sort by a hash of their columns (map columns do not count);
rows that are alike in all of these may change places. Repeated rows are rows of their own. An empty table gives an empty result. With
fewer rows than shards some shards stay empty. Columns of the input are kept, but for those that carry an output column's name.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, MapType

from .session import prepare, table

SHARDS, PROBES, TOLERANCE = 24, 64, 0.001
#: Rows of a cell that one task numbers, cells of a shard at least, and the most cells that are broadcast.
CELL_ROWS, CELLS, BROADCAST = 250_000, 64, 100_000
LOWEST = -(1 << 63)


def whole(n: int) -> Column:
    """A constant that may lie just beyond 64 bits."""
    return F.lit(str(n)).cast("decimal(20,0)")


def _splitters(narrow: DataFrame, key: str, low: int, high: int, targets: list[tuple[int, int]], slack: float) -> dict[int, tuple[int, int, bool]]:
    """For each (number, bytes): the largest found key such that the bytes of rows at or below it come nearest.

    Gives number -> (key, bytes at or below it, whether that is within ``slack``).
    """
    open_: dict[int, list[int]] = {n: [low - 1, 0, high, -1] for n, _ in targets}  # key below, bytes there, key above, bytes there
    want, done = dict(targets), {}
    while open_:
        brackets = sorted({(b[0], b[2]) for b in open_.values()})
        probes = max(PROBES, PROBES * SHARDS // len(brackets))
        widths = [max(1, -(-(hi - lo) // probes)) for lo, hi in brackets]
        place = F
        for i, (lo, hi) in enumerate(brackets):
            place = place.when((F.col(key) > lo if lo >= LOWEST else F.lit(True)) & (F.col(key) <= hi), i)
        counted = narrow.select(key, "__bytes", place.alias("b")).filter(F.col("b").isNotNull())
        edge, width = (F.element_at(F.array(*map(whole, x)), F.col("b") + 1) for x in ([lo for lo, _ in brackets], widths))
        counted = counted.select("b", F.floor((F.col(key).cast("decimal(20,0)") - edge - 1) / width).cast("int").alias("p"), "__bytes")
        found: dict[int, dict[int, tuple[int, int]]] = {}
        for b, p, size, rows in counted.groupBy("b", "p").agg(F.sum("__bytes"), F.count("*")).collect():
            found.setdefault(b, {})[p] = (size, rows)
        for n in list(open_):
            lo, base, hi, _ = open_[n]
            at = brackets.index((lo, hi))
            w, held = widths[at], found.get(at, {})
            below = [(lo, base)]
            for p in range(-(-(hi - lo) // w)):
                below.append((min(lo + (p + 1) * w, hi), below[-1][1] + held.get(p, (0, 0))[0]))
            best = min(below, key=lambda x: abs(x[1] - want[n]))
            if abs(best[1] - want[n]) <= slack:
                done[n] = (*best, True)
                del open_[n]
                continue
            i = next((i for i in range(1, len(below)) if below[i][1] >= want[n]), len(below) - 1)
            if below[i][0] - below[i - 1][0] == 1:
                # The next key holds too much: a single row goes to the nearer side, of more rows the caller takes a part.
                done[n] = (*best, True) if held.get(i - 1, (0, 0))[1] <= 1 else (*below[i - 1], False)
                del open_[n]
            else:
                open_[n] = [*below[i - 1], *below[i]]
    return done


def cut(rows: DataFrame, edges: DataFrame, by: str) -> DataFrame:
    """Adds to ``cell`` (a path of numbers) the place between the ``low`` and ``width`` that ``edges`` has for its ``shard`` and ``cell``."""
    place = F.floor((F.col(by).cast("decimal(20,0)") - F.col("low").cast("decimal(20,0)")) / F.col("width")).cast("long")
    found = rows.join(F.broadcast(edges), ["shard", "cell"], "left").withColumn("cell", F.when(F.col("low").isNotNull(), F.array_append("cell", place)).otherwise(F.col("cell")))
    return found.drop("low", "width")


def edges_of(spark: SparkSession, found: list[tuple], rows: int) -> DataFrame:
    """From (shard, cell, rows, least, largest) the ``low`` and ``width`` of so many parts that each would have a quarter of ``rows``."""
    parts = [(s, c, low, -(-(high - low + 1) // (4 * -(-n // rows)))) for s, c, n, low, high in found]
    return spark.createDataFrame([(s, c, low, str(w)) for s, c, low, w in parts], "shard int, cell array<long>, low long, width string").withColumn("width", F.col("width").cast("decimal(20,0)"))


def shard_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """All rows and columns of ``df`` with ``size``, ``shard`` and ``slot``."""
    spark = prepare(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name.lower() not in ("size", "shard", "slot")]
    column = lambda c: F.col(f"`{c}`")
    id_ = column(id_col).cast("long") if isinstance(df.schema[id_col].dataType, IntegralType) else F.when(column(id_col).isNotNull(), F.xxhash64(column(id_col).cast("string")))
    tie = F.xxhash64(*(column(f.name) for f in keep if not isinstance(f.dataType, MapType)))
    rows = df.select(F.struct(*(column(f.name) for f in keep)).alias("row"), F.coalesce(id_, F.lit(LOWEST)).alias("key"), (F.coalesce(F.octet_length(column(text_col)), F.lit(0)).cast("long") + 8).alias("__bytes"), tie.alias("tie"))
    narrow = rows.select("key", "__bytes").checkpoint()
    bytes_, count, low, high = narrow.agg(F.sum("__bytes"), F.count("*"), F.min("key"), F.max("key")).first()
    if not count:
        return rows.select("row.*", F.col("__bytes").alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    slack = tolerance * bytes_ / shards
    targets = [(i, bytes_ * i // shards) for i in range(1, shards)]
    found = _splitters(narrow, "key", low, high, targets, slack)
    ends: list[tuple[int, int | None]] = [(k if good else k + 1, None) for k, _, good in (found[n] for n, _ in targets)]  # of each shard but the last: its last key, and the last number of that key's rows if it is cut
    cut_keys = {found[n][0] + 1 for n, _ in targets if not found[n][2]}

    def placed(t: DataFrame) -> DataFrame:
        beyond = [(F.col("key") > k) if r is None else (F.col("key") > k) | ((F.col("key") == k) & (F.col("number") > r)) for k, r in ends]
        return t.withColumn("shard", functools.reduce(operator.add, (b.cast("int") for b in beyond), F.lit(0)))

    # Ids whose rows are numbered: cut ones, which lie before or after all others of a shard, and those that the cells below show to have too many rows.
    cells = max(CELLS, 4 * -(-count // (shards * CELL_ROWS)))
    cold = placed(narrow.filter(~F.col("key").isin(*cut_keys)) if cut_keys else narrow).withColumn("cell", F.array().cast("array<long>"))
    first = [(s, [], lo, str(-(-(hi - lo + 1) // cells))) for s, lo, hi in cold.groupBy("shard").agg(F.min("key"), F.max("key")).collect()]
    levels = [spark.createDataFrame(first, "shard int, cell array<long>, low long, width string").withColumn("width", F.col("width").cast("decimal(20,0)"))]
    hot_keys = set(cut_keys)
    while True:
        cold = cut(cold, levels[-1], "key")
        heavy = cold.groupBy("shard", "cell").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).filter(F.col("n") > 2 * CELL_ROWS).collect()
        hot_keys |= {r.lo for r in heavy if r.lo == r.hi}
        wide = [tuple(r) for r in heavy if r.lo < r.hi]
        if not wide:
            break
        levels.append(edges_of(spark, wide, CELL_ROWS))
    number = F.lit(0).cast("long").alias("number")
    if not hot_keys:
        every, small = rows.select("*", number), cold.select("shard", "cell")
    else:
        hot = rows.filter(F.col("key").isin(*hot_keys)).select("*", F.monotonically_increasing_id().alias("number")).checkpoint()
        last = hot.agg(F.max("number")).first()[0]
        for i, (n, want) in enumerate(targets):
            if not found[n][2]:
                own = hot.filter(F.col("key") == ends[i][0]).select("number", "__bytes")
                ends[i] = (ends[i][0], _splitters(own, "number", 0, last, [(n, want - found[n][1])], slack)[n][0])
        every = rows.filter(~F.col("key").isin(*hot_keys)).select("*", number).unionByName(hot)
        small = cold.filter(~F.col("key").isin(*hot_keys)).select("shard", "cell")
    every = placed(every).withColumn("cell", F.array().cast("array<long>"))
    for level in levels:
        every = cut(every, level, "key")
    if hot_keys:
        hot = placed(hot).withColumn("cell", F.array().cast("array<long>"))
        for level in levels:
            hot = cut(hot, level, "key")
        # The cells of a numbered id go on by its key, then by number; it shares them with no other id.
        keyed = lambda t: t.withColumn("cell", F.when(F.col("key").isin(*hot_keys), F.array_append("cell", F.col("key"))).otherwise(F.col("cell")))
        hot, every = keyed(hot), keyed(every)
        spans = edges_of(spark, [tuple(r) for r in hot.groupBy("shard", "cell").agg(F.count("*"), F.min("number"), F.max("number")).collect()], CELL_ROWS)
        every, small = cut(every, spans, "number"), small.unionByName(cut(hot, spans, "number").select("shard", "cell"))
    counts = small.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "cell", (F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")).alias("before"))
    ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", "number", "tie")))
    few = shards * cells <= BROADCAST and len(levels) == 1
    out = ranked.join(F.broadcast(offsets) if few else offsets, ["shard", "cell"])
    return out.select("row.*", F.col("__bytes").alias("size"), "shard", (F.col("before") + F.col("rank") - 1).alias("slot"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    given = docs.select("doc_id", "text", crc.alias("text_crc32"))
    return shard_documents(given).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op5_shards": op5_shards}
ORACLES: dict[str, str] = {}
