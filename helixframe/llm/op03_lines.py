"""Line dedup by site-relative frequency.

For each host, the pages that contain a line are divided by the host's pages; lines over ``ratio`` are boilerplate and
are dropped from all pages of that host. A line that only one page has repeats nothing, so on a host of few pages it is no
boilerplate whatever its ratio (``MIN_PAGES``). Exact copies of a page count once,
on both sides of the division, so a page that was fetched often is no boilerplate.

A line stands for its 96-bit hash. Counts are aggregated before each exchange, so a host or line with a third of the
rows is no burden; the counts of lines on ``min_pages`` pages are checkpointed, to be read for lines and hosts. A host's
boilerplate has at most (mean distinct lines of its pages) / ``ratio`` entries, so it is
one array a host; pages meet it in one join on host, which adaptive execution splits where a host is hot and
broadcasts where the arrays are small. Pages are never taken apart and put together again. The lines of a page are
looked up in the host's array by one intersection of 64-bit hashes, and whole hashes are compared for the few that are in it.

Lines are trimmed of blanks, tabs and carriage returns for comparison and kept as they were. Blank lines count for
nothing and stay. Null texts stay null; a page without a host (null or empty) keeps all lines. A page of which all
lines go has an empty text. Repeated rows are treated alike; an empty table gives an empty result. All columns are
kept, but for those that carry an output column's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import free_name, prepare, table

RATIO, MIN_PAGES = 0.1, 2
BLOCKS = "p|div|li|ul|ol|nav|article|header|footer|section|main|aside|h[1-6]|br|hr|tr|td|th|table|title|body|head|html"
BLANK = " \t\r"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def line_key(line: Column) -> Column:
    """Of a trimmed line."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(df: DataFrame, host: str, text: str, ratio: float, min_pages: int) -> DataFrame:
    """``__host`` and ``__drop``, the array of its boilerplate lines' keys.

    Each page also has one entry without a line, so one aggregation counts the pages of lines and of hosts.
    """
    pages = df.select(F.col(f"`{host}`").alias("__host"), F.col(f"`{text}`").alias("__text")).filter(F.col("__host") != "")
    split = pages.select("__host", F.xxhash64("__text").alias("__page"), F.hash("__text").alias("__page2"), F.filter(F.transform(F.split("__text", "\n"), trimmed), lambda x: x != "").alias("__lines"))
    keys = F.array_append(F.array_distinct(F.transform("__lines", line_key)), F.lit(None).cast("struct<a: bigint, b: int>"))
    lines = split.select("__host", "__page", "__page2", F.explode(keys).alias("__line")).distinct()
    counts = lines.groupBy("__host", "__line").agg(F.count("*").alias("__n")).filter(F.col("__line").isNull() | (F.col("__n") >= min_pages)).checkpoint()
    totals = counts.filter(F.col("__line").isNull()).select(F.col("__host").alias("__h"), F.col("__n").alias("__pages"))
    often = counts.filter(F.col("__line").isNotNull())
    over = often.join(totals, F.col("__host") == F.col("__h")).filter(F.col("__n") > ratio * F.col("__pages"))
    return over.groupBy("__host").agg(F.collect_set("__line").alias("__drop"))


def dedup_lines(df: DataFrame, host: str, text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, out: str = "dropped_lines") -> DataFrame:
    """``df`` with its boilerplate lines dropped from ``text``, and ``out``, their number."""
    prepare(df.sparkSession)
    keep = [c for c in df.columns if c.lower() != out.lower()]
    names = keep.copy()
    own = []
    for n in ("host", "drop", "short", "keys", "seen", "left"):
        own.append(free_name(names, n + "_"))
        names.append(own[-1])
    site, drop, short, keys, seen, left = own
    # A key made anew asks for an exchange on this side too: only then can a hot host's pages be split between tasks.
    over = boilerplate(df, host, text, ratio, min_pages).select(F.concat("__host", F.lit("")).alias(site), F.col("__drop").alias(drop), F.transform("__drop", lambda x: x["a"]).alias(short))
    lines = F.split(F.col(f"`{text}`"), "\n")
    joined = df.select(*(F.col(f"`{c}`") for c in keep)).join(over, F.col(f"`{host}`") == F.col(site), "left")
    keyed = joined.withColumn(keys, F.when(F.col(drop).isNotNull(), F.transform(lines, lambda x: line_key(trimmed(x)))))
    met = keyed.withColumn(seen, F.array_intersect(F.transform(keys, lambda x: x["a"]), F.col(short)))
    few = F.filter(drop, lambda d: F.array_contains(F.col(seen), d["a"]))
    staying = F.transform(F.filter(F.arrays_zip(lines.alias("line"), F.col(keys).alias("key")), lambda x: ~F.array_contains(F.col(drop), x["key"])), lambda x: x["line"])
    found = met.withColumn(drop, few).withColumn(left, F.when(F.size(seen) > 0, staying))
    columns = [F.when(F.col(left).isNotNull(), F.array_join(left, "\n")).otherwise(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in keep]
    return found.select(*columns, F.when(F.col(left).isNotNull(), F.size(lines) - F.size(left)).otherwise(0).alias(out))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def html_lines(html: Column) -> Column:
    """The visible text, with a line for each block element."""
    bare = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", "")
    return F.regexp_replace(F.regexp_replace(bare, rf"(?i)</?(?:{BLOCKS})(?:\s[^>]*)?/?>", "\n"), "<[^>]*>", "")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text"))
    return dedup_lines(pages, "host").select("page_id", "host", "dropped_lines", "text")


SQL = rf"""
WITH p AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '', 'g'), '(?i)</?(?:{BLOCKS})(?:\s[^>]*)?/?>', chr(10), 'g'), '<[^>]*>', '', 'g') AS text FROM pages),
l AS (SELECT n, page_id, host, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM p WHERE text IS NOT NULL),
t AS (SELECT host, count(DISTINCT text) AS pages FROM p WHERE host <> '' GROUP BY host),
b AS (SELECT host, trim(line, ' ' || chr(9) || chr(13)) AS line FROM l JOIN t USING (host) WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
      GROUP BY 1, 2, pages HAVING count(DISTINCT text) >= {MIN_PAGES} AND count(DISTINCT text) > {RATIO} * pages),
k AS (SELECT n, count(b.line) AS dropped, string_agg(l.line, chr(10) ORDER BY pos) FILTER (b.line IS NULL) AS text
      FROM l LEFT JOIN b ON l.host = b.host AND trim(l.line, ' ' || chr(9) || chr(13)) = b.line GROUP BY n)
SELECT page_id, host, coalesce(dropped, 0)::INTEGER AS dropped_lines, CASE WHEN p.text IS NOT NULL THEN coalesce(k.text, '') END AS text FROM p LEFT JOIN k USING (n)
"""
QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES = {"op3_line_dedup": SQL}
