"""Queries of filters, clustering, deduplication, weights, sampling, alignments and task progress on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequences
from ..operators import alignments as A
from ..operators import relational as R
from ..sources.tables import read_table
from ..streaming import tasks

HASH_SQL = "(('0x' || substr(md5({} || '|{}'), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"


def orders_with_lines(spark, d: str) -> DataFrame:
    lines = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.bool_or(F.col("l_returnflag").isin("A", "R")).alias("polymer"))
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    return o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def c01_filter_reason(spark, d: str) -> DataFrame:
    date = F.date_format("o_orderdate", "yyyy-M-d")
    rules = [("date", R.date_rule(date, "1996-06-30")), ("resolution", R.resolution_rule(F.col("o_totalprice") / 50000, F.col("o_orderpriority"), 6.0)), ("composition", F.col("polymer")), ("size", F.col("n_lines") >= 4)]
    return R.first_failing(orders_with_lines(spark, d), rules).select("o_orderkey", "passed", "reason")


FILTER_SQL = """WITH l AS (SELECT l_orderkey, count(*) AS n_lines, bool_or(l_returnflag IN ('A', 'R')) AS polymer FROM lineitem GROUP BY 1)
SELECT o_orderkey, reason IS NULL AS passed, reason FROM (SELECT o_orderkey, CASE WHEN NOT coalesce(o_orderdate::DATE <= DATE '1996-06-30', false) THEN 'date'
 WHEN NOT coalesce(o_totalprice / 50000 <= 6.0, upper(o_orderpriority) LIKE '%NMR%', false) THEN 'resolution' WHEN NOT coalesce(polymer, false) THEN 'composition' WHEN NOT coalesce(n_lines >= 4, false) THEN 'size' END AS reason
 FROM orders LEFT JOIN l ON o_orderkey = l_orderkey)"""


def c01_filter_stats(spark, d: str) -> DataFrame:
    return c01_filter_reason(spark, d).groupBy(F.coalesce("reason", F.lit("passed")).alias("outcome")).agg(F.count("*").alias("n"))


def c06_excluded(spark, d: str) -> DataFrame:
    """Orders of which every part is excluded go; an order without lines goes too."""
    part = read_table(spark, d, "part").select("p_partkey", F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#13").alias("out"))
    lines = read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return R.without_whole(lines, "l_orderkey", F.col("out"))


def c07_broken_chains(spark, d: str) -> DataFrame:
    e = R.largest_step(read_table(spark, d, "events").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], "value")
    return e.select("user_id", F.round("max_step", 6).alias("max_gap")).withColumn("broken", F.coalesce(F.col("max_gap") > 90, F.lit(False)))


def c10_cluster_holdout(spark, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "source")
    return R.without_cluster(docs, "doc_id", docs.select("doc_id", F.col("source").alias("cluster")), "src3")


def c12_length_filter(spark, d: str) -> DataFrame:
    return read_table(spark, d, "documents").filter(R.in_bounds(F.col("n_chars"), 400, 10000)).select("doc_id", "n_chars")


def c14_date_modes(spark, d: str) -> DataFrame:
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    return read_table(spark, d, "orders").select("o_orderkey", *(R.date_rule(date, "1996-06-30", m).alias(m) for m in ("before", "after", "on")))


def c16_composition(spark, d: str) -> DataFrame:
    return R.composed_of(read_table(spark, d, "lineitem"), "l_orderkey", 2, 6, {"returned": F.col("l_returnflag") == "R"})


def e01_majority(spark, d: str) -> DataFrame:
    return R.majority(read_table(spark, d, "events").select("user_id", "event_type", "event_id"), "user_id", "event_type", "event_id")


def e02_dominant(spark, d: str) -> DataFrame:
    """A user's kind: the event type with over 80 % of the events, else unknown."""
    return R.dominant(read_table(spark, d, "events"), "user_id", "event_type")


def e06_identity_clusters(spark, d: str) -> DataFrame:
    """Documents with the same text but for case and gaps: representative, size and number of each cluster."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    clusters = R.identity_clusters(docs, "doc_id", F.md5(sequences.cluster_key(F.col("text"))))
    return R.numbered(clusters, "representative", "cluster")


def e07_interface_clusters(spark, d: str) -> DataFrame:
    """Orders by their set of return flags and a bin of their quantity."""
    return R.type_clusters(read_table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", "l_quantity")


def e11_signature(spark, d: str) -> DataFrame:
    return R.signature(read_table(spark, d, "lineitem"), "l_orderkey", "l_linestatus")


def e12_similarity(spark, d: str) -> DataFrame:
    """Successive orders' sizes: 0 where the priorities differ, else smaller over larger."""
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = o.withColumn("p", F.lag("o_orderpriority").over(w)).withColumn("t", F.lag("o_totalprice").over(w)).filter("p IS NOT NULL")
    return o.select("o_orderkey", F.round(R.similarity(F.col("p") == F.col("o_orderpriority"), F.col("t"), F.col("o_totalprice")), 9).alias("similarity"))


def e13_inverted(spark, d: str) -> DataFrame:
    return R.index_of(read_table(spark, d, "lineitem"), "l_partkey", {"n_orders": "l_orderkey", "n_suppliers": "l_suppkey"})


def e14_profile(spark, d: str) -> DataFrame:
    return R.profile(read_table(spark, d, "part").select("p_brand"), "p_brand").select("pos", "letter", "n", F.round("frequency", 9).alias("frequency"))


def e15_deletion_mean(spark, d: str) -> DataFrame:
    cells = read_table(spark, d, "part").select(F.posexplode(sequences.a3m_deletions(F.translate("p_brand", "#", "-"))).alias("pos", "deletions"))
    return cells.groupBy("pos").agg(F.count("*").alias("n"), F.round(F.avg("deletions"), 9).alias("mean"), F.count_if(F.col("deletions") > 0).alias("n_deleted"), F.round(sequences.deletion_value(F.avg("deletions")), 9).alias("value"))


def e29_dataset_stats(spark, d: str) -> DataFrame:
    return R.described(read_table(spark, d, "documents"), "lang", "n_chars", {"n_sources": "source"}).withColumn("mean", F.round("mean", 6))


def e33_progress(spark, d: str) -> DataFrame:
    states = read_table(spark, d, "events").select("user_id", F.when(F.col("event_type") == "purchase", "completed").otherwise("pending").alias("state"))
    return tasks.progress(states, "user_id").select("user_id", "total", F.col("completed").alias("done"), F.round("percent", 6).alias("percent"))


def f06_budget(spark, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("source", "doc_id", "n_chars")
    return R.prefix_budget(docs, "source", "doc_id", "n_chars", 50_000)


def f08_weights(spark, d: str) -> DataFrame:
    """Inverse cluster size times a factor of price, normalised in each priority."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return R.cluster_weight(o, "o_custkey", 1 + F.col("o_totalprice") / 1_000_000, "o_orderpriority").select("o_orderkey", F.round("weight", 12).alias("weight"))


def f12_round_robin(spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return R.round_robin(li, "l_orderkey", [F.col("l_quantity").desc(), F.col("l_linenumber"), F.col("l_partkey")]).select("l_orderkey", "l_linenumber", "l_partkey", "turn")


def d19_paired(spark, d: str) -> DataFrame:
    """Customers' nations that occur in every market segment, with the first customer of each."""
    c = read_table(spark, d, "customer").select("c_nationkey", "c_mktsegment", "c_custkey")
    both = R.common_keys(c, "c_nationkey", "c_mktsegment")
    first = c.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_custkey").alias("first"))
    return first.join(both, "c_nationkey").select("c_nationkey", "c_mktsegment", "first", "n_groups")


def d21_mapping(spark, d: str) -> DataFrame:
    """Suppliers' names with their nation's, where the nation has a customer."""
    served = read_table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    n = read_table(spark, d, "nation").join(served, "n_nationkey", "left_semi").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("cluster"))
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.col("s_name").alias("description"))
    return A.mapped_to_clusters(s, "s_nationkey", "description", n).select("s_suppkey", "description")


def g01_dedup(spark, d: str) -> DataFrame:
    return R.first_of_equal(read_table(spark, d, "documents").select("doc_id", "text"), F.md5("text"), "doc_id")


def g07_best_per_key(spark, d: str) -> DataFrame:
    best = R.best_per_key(read_table(spark, d, "lineitem"), "l_partkey", "l_extendedprice", ["l_orderkey", "l_linenumber"])
    return best.select("l_partkey", F.col("l_extendedprice").alias("price"), "l_orderkey")


def g10_top4(spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return R.top_per_key(li, ["l_suppkey"], [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 4).select("l_suppkey", "l_orderkey", "rank")


def h02_common(spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").filter(F.col("l_returnflag").isin("A", "N"))
    return R.common_keys(li, "l_partkey", "l_returnflag").select("l_partkey")


def h03_horizontal(spark, d: str) -> DataFrame:
    c = read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    parts = {r: F.when(F.col("role") == r, F.md5("text")) for r in ("user", "assistant", "system")}
    out = c.groupBy("conv_id").agg(*(F.coalesce(F.min(x), F.lit("-")).alias(k) for k, x in parts.items()))
    return out


def h05_merged(spark, d: str) -> DataFrame:
    """Rows of two tables, the first of each name, with the table that gave it."""
    c = read_table(spark, d, "customer").select(F.substring("c_name", -3, 3).alias("name"), F.col("c_custkey").alias("key"))
    s = read_table(spark, d, "supplier").select(F.substring("s_name", -3, 3).alias("name"), F.col("s_suppkey").alias("key"))
    return R.first_by_name([c, s], "name", ["key"])


def i02_balanced(spark, d: str) -> DataFrame:
    """Twenty rows of each priority, chosen by hash."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority").withColumn("u", R.uniform(42, "o_orderkey"))
    return R.top_per_key(o, ["o_orderpriority"], [F.col("u"), F.col("o_orderkey")], 20).select("o_orderpriority", "o_orderkey", "rank")


def i03_weighted(spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.weighted_sample(o, "o_orderkey", F.col("o_totalprice"), 100, 7).select("o_orderkey", F.round("draw", 15).alias("draw"))


def a45_shards(spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey").distinct()
    return R.batches(R.numbered(o, "o_orderkey", "row"), "row", 1000).withColumnRenamed("batch", "shard")


def l06_relative_positions(spark, d: str) -> DataFrame:
    from ..functions.chem import relative_position

    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    a, b = (li.select(*(F.col(c).alias(f"{s}_{c[2:]}") for c in li.columns)) for s in "ab")
    pairs = a.join(b, F.col("a_orderkey") == F.col("b_orderkey"))
    rel = relative_position(F.col("a_linenumber"), F.col("b_linenumber"), F.col("a_suppkey") % 2 == F.col("b_suppkey") % 2, 4)
    return pairs.groupBy(rel.alias("rel")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (c01_filter_reason, c01_filter_stats, c06_excluded, c07_broken_chains, c10_cluster_holdout, c12_length_filter, c14_date_modes, c16_composition, d19_paired, d21_mapping, e01_majority, e02_dominant, e06_identity_clusters, e07_interface_clusters, e11_signature, e12_similarity, e13_inverted, e14_profile, e15_deletion_mean, e29_dataset_stats, e33_progress, f06_budget, f08_weights, f12_round_robin, g01_dedup, g07_best_per_key, g10_top4, h02_common, h03_horizontal, h05_merged, i02_balanced, i03_weighted, a45_shards, l06_relative_positions)}
_U = HASH_SQL.format("o_orderkey", 42)
_V = HASH_SQL.format("o_orderkey", 7)
_DEL = "regexp_extract_all(regexp_replace(replace(p_brand, '#', '-'), '[^A-Za-z-]', '', 'g'), '[a-z]*[A-Z-]')"
ORACLES = {
    "c01_filter_reason": FILTER_SQL,
    "c01_filter_stats": f"SELECT coalesce(reason, 'passed') AS outcome, count(*) AS n FROM ({FILTER_SQL}) GROUP BY 1",
    "c06_excluded": "SELECT l_orderkey, count(*) AS n FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING NOT bool_and(coalesce(p_brand IN ('Brand#11', 'Brand#12', 'Brand#13'), false))",
    "c07_broken_chains": "SELECT user_id, round(max(gap), 6) AS max_gap, coalesce(round(max(gap), 6) > 90, false) AS broken FROM (SELECT user_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events) GROUP BY 1",
    "c10_cluster_holdout": "SELECT doc_id, source FROM documents WHERE source IS DISTINCT FROM 'src3'",
    "c12_length_filter": "SELECT doc_id, n_chars FROM documents WHERE n_chars BETWEEN 400 AND 10000",
    "c14_date_modes": "SELECT o_orderkey, o_orderdate::DATE <= DATE '1996-06-30' AS before, o_orderdate::DATE >= DATE '1996-06-30' AS after, o_orderdate::DATE = DATE '1996-06-30' AS \"on\" FROM orders",
    "c16_composition": "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) BETWEEN 2 AND 6 AND bool_or(l_returnflag = 'R')",
    "d19_paired": "WITH a AS (SELECT count(DISTINCT c_mktsegment) AS k FROM customer), b AS (SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n_groups FROM customer GROUP BY 1) SELECT c_nationkey, c_mktsegment, min(c_custkey) AS first, n_groups FROM customer JOIN b USING (c_nationkey) JOIN a ON n_groups = k GROUP BY 1, 2, 4",
    "d21_mapping": "SELECT s_suppkey, s_name || coalesce(' UniRef90:' || n_name, '') AS description FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)) ON s_nationkey = n_nationkey",
    "e01_majority": "SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS k FROM events GROUP BY 1, 2) WHERE k = 1",
    "e02_dominant": "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT user_id, sum(n) AS total FROM c GROUP BY 1) SELECT user_id, coalesce(max(CASE WHEN n > 0.8 * total THEN event_type END), 'unknown') AS kind FROM c JOIN t USING (user_id) GROUP BY 1",
    "e06_identity_clusters": "SELECT representative, size, row_number() OVER (ORDER BY representative) - 1 AS cluster FROM (SELECT min(doc_id) AS representative, count(*) AS size FROM documents GROUP BY md5(lower(replace(text, '-', ''))))",
    "e07_interface_clusters": "WITH q AS (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, '+' ORDER BY l_returnflag) AS types, sum(l_quantity) AS q FROM lineitem GROUP BY 1) SELECT types, ((q >= 10)::INTEGER + (q >= 25)::INTEGER + (q >= 50)::INTEGER + (q >= 100)::INTEGER + (q >= 200)::INTEGER)::INTEGER AS bin, count(*) AS n, min(l_orderkey) AS first FROM q GROUP BY 1, 2",
    "e11_signature": "SELECT l_orderkey, string_agg(DISTINCT l_linestatus, '+' ORDER BY l_linestatus) || ':' || count(*) AS signature FROM lineitem GROUP BY 1",
    "e12_similarity": "SELECT o_orderkey, round(CASE WHEN p <> o_orderpriority THEN 0 ELSE least(t, o_totalprice) / greatest(t, o_totalprice) END, 9) AS similarity FROM (SELECT *, lag(o_orderpriority) OVER w AS p, lag(o_totalprice) OVER w AS t FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) WHERE p IS NOT NULL",
    "e13_inverted": "SELECT l_partkey, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1",
    "e14_profile": "WITH c AS (SELECT unnest(string_split(p_brand, '')) AS letter, unnest(range(length(p_brand))) AS pos FROM part), n AS (SELECT pos, letter, count(*) AS n FROM c GROUP BY 1, 2) SELECT pos::INTEGER AS pos, letter, n, round(n / sum(n) OVER (PARTITION BY pos), 9) AS frequency FROM n",
    "e15_deletion_mean": f"WITH c AS (SELECT unnest(list_transform({_DEL}, lambda x: length(x) - 1)) AS deletions, unnest(range(len({_DEL}))) AS pos FROM part) SELECT pos::INTEGER AS pos, count(*) AS n, round(avg(deletions), 9) AS mean, count(*) FILTER (deletions > 0) AS n_deleted, round(2 / pi() * atan(avg(deletions) / 3), 9) AS value FROM c GROUP BY 1",
    "e29_dataset_stats": "SELECT lang, count(*) AS n, round(avg(n_chars), 6) AS mean, median(n_chars) AS median, min(n_chars) AS least, max(n_chars) AS most, count(DISTINCT source) AS n_sources FROM documents GROUP BY 1",
    "e33_progress": "SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'purchase') AS done, round(100 * count(*) FILTER (event_type = 'purchase') / count(*), 6) AS percent FROM events GROUP BY 1",
    "f06_budget": "SELECT * FROM (SELECT source, doc_id, n_chars, (sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS running FROM documents) WHERE running <= 50000",
    "f08_weights": "WITH s AS (SELECT o_custkey, count(*) AS size FROM orders GROUP BY 1), w AS (SELECT o_orderkey, o_orderpriority, 1 / size * (1 + o_totalprice / 1000000) AS w FROM orders JOIN s USING (o_custkey)) SELECT o_orderkey, round(w / sum(w) OVER (PARTITION BY o_orderpriority), 12) AS weight FROM w",
    "f12_round_robin": "SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey)::INTEGER AS turn FROM lineitem",
    "g01_dedup": "SELECT min(doc_id) AS doc_id, md5(text) AS key FROM documents GROUP BY md5(text)",
    "g07_best_per_key": "SELECT l_partkey, l_extendedprice AS price, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1",
    "g10_top4": "SELECT l_suppkey, l_orderkey, k::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS k FROM lineitem) WHERE k <= 4",
    "h02_common": "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N'",
    "h03_horizontal": "SELECT conv_id, coalesce(min(CASE WHEN role = 'user' THEN md5(text) END), '-') AS user, coalesce(min(CASE WHEN role = 'assistant' THEN md5(text) END), '-') AS assistant, coalesce(min(CASE WHEN role = 'system' THEN md5(text) END), '-') AS system FROM conversations GROUP BY 1",
    "h05_merged": "WITH u AS (SELECT 0 AS part, right(c_name, 3) AS name, c_custkey AS key FROM customer UNION ALL SELECT 1, right(s_name, 3), s_suppkey FROM supplier) SELECT name, part, key FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY part, key) AS k FROM u) WHERE k = 1",
    "i02_balanced": f"SELECT o_orderpriority, o_orderkey, k::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_U}, o_orderkey) AS k FROM orders) WHERE k <= 20",
    "i03_weighted": f"SELECT o_orderkey, round(ln(greatest({_V}, 1e-12)) / o_totalprice, 15) AS draw FROM orders ORDER BY ln(greatest({_V}, 1e-12)) / o_totalprice DESC, o_orderkey LIMIT 100",
    "a45_shards": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS shard FROM (SELECT DISTINCT o_orderkey FROM orders)",
    "l06_relative_positions": "SELECT CASE WHEN a.l_suppkey % 2 = b.l_suppkey % 2 THEN greatest(-4, least(4, b.l_linenumber - a.l_linenumber)) + 4 ELSE 9 END AS rel, count(*) AS n FROM lineitem a JOIN lineitem b USING (l_orderkey) GROUP BY 1",
}
