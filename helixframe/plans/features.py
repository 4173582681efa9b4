"""Queries of alignment, pairing, crop, weight and pair-feature operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chem, sequences
from ..operators import alignments as A
from ..operators import crop, distillation, spatial
from ..operators import relational as R
from ..operators import templates as T
from ..sources import structures as structure_files
from ..sources.store import checksum
from ..sources.tables import read_table
from ..streaming import files
from .curation import HASH_SQL
from .spatial import DIST, POINTS, points

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


# Alignments: a supplier nation's parts are the rows of its alignment, their brands and types the sequences.
MSA_SQL = "m AS (SELECT p_size AS msa, (row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) - 1)::INTEGER AS \"row\", translate(p_brand, '#2', '--') AS sequence, p_name AS description FROM part)"


def msa(spark, d: str) -> DataFrame:
    row = F.row_number().over(Window.partitionBy("p_size").orderBy("p_partkey")) - 1
    p = read_table(spark, d, "part").select(F.col("p_size").alias("msa"), row.alias("row"), F.translate("p_brand", "#2", "--").alias("sequence"), F.col("p_name").alias("description"))
    return p.withColumn("deletions", F.transform(sequences.letters(F.col("sequence")), lambda c: F.when(c == "-", 1).otherwise(0)))


@query(f"WITH {MSA_SQL} SELECT msa, \"row\" FROM (SELECT *, row_number() OVER (PARTITION BY msa, CASE WHEN \"row\" = 0 THEN 'q' ELSE 'k' || sequence END ORDER BY \"row\") AS k FROM m) WHERE k = 1")
def g03_deduplicated(spark, d: str) -> DataFrame:
    return A.deduplicated(msa(spark, d), F.concat(F.lit("k"), "sequence")).select("msa", "row")


@query(f"WITH {MSA_SQL} SELECT msa, min(\"row\")::INTEGER AS \"row\", lower(replace(sequence, '-', '')) AS key FROM m GROUP BY msa, key")
def g05_gapless_keys(spark, d: str) -> DataFrame:
    return msa(spark, d).groupBy("msa", sequences.cluster_key(F.col("sequence")).alias("key")).agg(F.min("row").alias("row"))


@query(f"WITH {MSA_SQL} SELECT msa, \"row\" FROM m WHERE \"row\" < 5")
def g02_cropped(spark, d: str) -> DataFrame:
    return A.cropped(msa(spark, d), 5).select("msa", "row")


@query(f"WITH {MSA_SQL}, q AS (SELECT msa, length(sequence) AS n FROM m WHERE \"row\" = 0) SELECT msa, \"row\" FROM m JOIN q USING (msa) WHERE \"row\" = 0 OR length(regexp_replace(sequence, '[-X]', '', 'g')) / n >= 0.75")
def c21_covered(spark, d: str) -> DataFrame:
    return A.covered(msa(spark, d), 0.75).select("msa", "row")


@query(f"WITH {MSA_SQL} SELECT msa, \"row\" FROM m WHERE \"row\" = 0 OR NOT (length(sequence) - length(replace(sequence, '-', '')) > 0.25 * length(sequence) OR regexp_matches(sequence, '---'))")
def c20_block_deletions(spark, d: str) -> DataFrame:
    m = msa(spark, d)
    return m.filter((F.col("row") == 0) | A.acceptable_deletions(F.col("deletions"), share=0.25)).select("msa", "row")


@query(f"WITH {MSA_SQL}, c AS (SELECT msa, \"row\", unnest(string_split(sequence, '')) AS c, unnest(range(length(sequence))) AS pos FROM m), g AS (SELECT msa, pos FROM c GROUP BY msa, pos HAVING avg((c = '-')::INTEGER) < 0.6) SELECT msa, \"row\", string_agg(c, '' ORDER BY pos) AS sequence FROM c JOIN g USING (msa, pos) GROUP BY msa, \"row\"")
def c22_gappy_columns(spark, d: str) -> DataFrame:
    return A.without_gappy_columns(msa(spark, d), 0.6).filter(F.length("sequence") > 0).select("msa", "row", "sequence")


@query(f"WITH {MSA_SQL}, c AS (SELECT msa, unnest(string_split(sequence, '')) AS letter, unnest(range(length(sequence))) AS pos FROM m) SELECT msa, pos::INTEGER AS pos, letter, round(count(*) / sum(count(*)) OVER (PARTITION BY msa, pos), 9) AS share, round(sum(sum((letter = '-')::INTEGER)) OVER (PARTITION BY msa, pos) / sum(count(*)) OVER (PARTITION BY msa, pos), 9) AS deletion_mean FROM c GROUP BY msa, pos, letter")
def e21_profile(spark, d: str) -> DataFrame:
    return A.profile(msa(spark, d)).select("msa", "pos", "letter", F.round("share", 9).alias("share"), F.round("deletion_mean", 9).alias("deletion_mean"))


@query(f"WITH {MSA_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY msa ORDER BY length(replace(sequence, '-', '')) / length(sequence) DESC, \"row\") AS turn FROM m WHERE \"row\" > 0) SELECT msa, \"row\", turn::INTEGER AS turn, (row_number() OVER (ORDER BY turn, msa) - 1)::INTEGER AS place FROM t ORDER BY turn, msa LIMIT 300")
def f12_dense_stack(spark, d: str) -> DataFrame:
    return A.dense_stack(msa(spark, d), rows=300).select("msa", "row", "turn", "place")


@query(f"WITH {MSA_SQL}, w AS (SELECT msa, max(length(sequence)) AS w FROM m GROUP BY msa), r AS (SELECT DISTINCT \"row\" FROM m) SELECT \"row\", md5(string_agg(coalesce(sequence, repeat('-', w)), '' ORDER BY msa)) AS digest FROM r CROSS JOIN w LEFT JOIN m USING (\"row\", msa) GROUP BY \"row\"")
def h03_side_by_side(spark, d: str) -> DataFrame:
    return A.side_by_side(msa(spark, d)).select("row", F.md5("sequence").alias("digest"))


@query(f"WITH {MSA_SQL}, u AS (SELECT *, CASE WHEN \"row\" = 0 THEN -1.0 ELSE {HASH_SQL.format("msa || '|' || \"row\"", 5)} END AS u FROM m) SELECT msa, \"row\" FROM (SELECT *, row_number() OVER (PARTITION BY msa ORDER BY u, \"row\") AS k FROM u) WHERE k <= 6")
def i08_subsampled(spark, d: str) -> DataFrame:
    return A.subsampled(msa(spark, d), 6, 5).select("msa", "row")


@query("WITH m AS (SELECT c_mktsegment AS msa, c_nationkey AS species, c_custkey AS k FROM customer), f AS (SELECT species, msa, min(k) AS \"first\" FROM m GROUP BY 1, 2), h AS (SELECT species, row_number() OVER (ORDER BY species) - 1 AS pair FROM f GROUP BY species HAVING count(*) = (SELECT count(DISTINCT msa) FROM m)) SELECT pair::INTEGER AS pair, msa, \"first\" FROM f JOIN h USING (species)")
def d20_species_pairs(spark, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select(F.col("c_mktsegment").alias("msa"), (F.col("c_custkey") + 1).alias("row"), F.col("c_name").alias("sequence"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation"))
    return A.paired_by_species(c, species=F.col("nation")).select("pair", "msa", (F.col("row") - 1).alias("first"))


@query(f"WITH {MSA_SQL} SELECT msa % 5 AS assembly, msa, (sum(n) OVER (PARTITION BY msa % 5 ORDER BY msa) - n)::BIGINT AS \"offset\", n FROM (SELECT msa, length(max(CASE WHEN \"row\" = 0 THEN sequence END)) AS n FROM m GROUP BY msa)")
def f13_chain_offsets(spark, d: str) -> DataFrame:
    return A.chain_offsets(msa(spark, d).withColumn("assembly", F.col("msa") % 5), "assembly")


# Templates: orders are hits of their customer; the price is the score.
@query("SELECT o_custkey, o_orderkey, k::INTEGER AS rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders WHERE o_orderdate::DATE <= DATE '1997-01-01' AND o_orderpriority NOT IN ('1-URGENT')) WHERE k <= 4")
def g10_template_hits(spark, d: str) -> DataFrame:
    hits = read_table(spark, d, "orders").filter((F.col("o_orderdate").cast("date") <= F.lit("1997-01-01").cast("date")) & (F.col("o_orderpriority") != "1-URGENT"))
    return R.top_per_key(hits, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 4).select("o_custkey", "o_orderkey", "rank")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END ASC NULLS LAST, o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def g09_best_by_cluster(spark, d: str) -> DataFrame:
    resolution = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    return R.first_per_key(read_table(spark, d, "orders"), ["o_custkey"], [resolution.asc_nulls_last(), F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END <= DATE '1996-01-01', true) AS kept, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END <= DATE '1996-01-01', false) AS dated FROM orders")
def c25_date_filters(spark, d: str) -> DataFrame:
    date = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    return read_table(spark, d, "orders").select("o_orderkey", T.dated_before(date, "1996-01-01", True).alias("kept"), T.dated_before(date, "1996-01-01", False).alias("dated"))


@query("SELECT s_suppkey FROM supplier WHERE upper(s_name) NOT IN (SELECT upper(s_name) FROM supplier WHERE s_nationkey < 5)")
def c26_obsolete(spark, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier")
    return T.without_obsolete(s, "s_name", s.filter("s_nationkey < 5").select(F.lower("s_name").alias("pdb_id"))).select("s_suppkey")


@query("SELECT t.o_orderkey, count(e.o_orderkey) AS allowed FROM orders t LEFT JOIN orders e ON e.o_custkey = t.o_custkey AND e.o_orderdate::DATE <= t.o_orderdate::DATE - 60 GROUP BY t.o_orderkey")
def k16_sixty_days_before(spark, d: str) -> DataFrame:
    """Orders of the same customer at least 60 days before: a range in an equi-join."""
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return T.allowed_before(o, o, "o_custkey", "o_orderkey", "day", "o_orderkey")


# Chains and structures: an order is a structure, its lines are residues.
@query("SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS n_a, count(*) FILTER (l_returnflag = 'N') AS n_n, count(*) FILTER (l_returnflag = 'R') AS n_r, count(*) AS n FROM lineitem GROUP BY 1")
def e03_metrics(spark, d: str) -> DataFrame:
    return R.counts_by_kind(read_table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", {f"n_{x.lower()}": x for x in "ANR"})


@query("SELECT l_orderkey, md5(string_agg(f, '|' ORDER BY f)) AS fingerprint FROM (SELECT l_orderkey, l_returnflag || ':' || count(*) AS f FROM lineitem GROUP BY l_orderkey, l_returnflag) GROUP BY 1")
def e10_fingerprint(spark, d: str) -> DataFrame:
    return R.fingerprint(read_table(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


@query("WITH s AS (SELECT l_suppkey, count(DISTINCT l_orderkey) AS size FROM lineitem GROUP BY 1) SELECT l_orderkey, round(1 / min(size), 9) AS weight FROM lineitem JOIN s USING (l_suppkey) GROUP BY 1")
def f07_inverse_cluster_weight(spark, d: str) -> DataFrame:
    return R.inverse_cluster_weight(read_table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey").withColumn("weight", F.round("weight", 9))


@query("SELECT user_id, round(avg(value), 6) AS mean, round(median(value), 6) AS median, min(value) AS least, max(value) AS most, count(*) AS n FROM events GROUP BY 1")
def e30_statistics(spark, d: str) -> DataFrame:
    return R.described(read_table(spark, d, "events"), "user_id", "value").withColumns({c: F.round(c, 6) for c in ("mean", "median")})


@query("SELECT split_part(event_type || ':' || user_id, ':', 1) AS reason, count(*) AS n FROM events GROUP BY 1")
def e32_failures(spark, d: str) -> DataFrame:
    return R.failures(read_table(spark, d, "events").select(F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("reason")), "reason")


@query("SELECT l_returnflag AS kind, count(DISTINCT l_orderkey) AS n, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1")
def e09_cluster_sizes(spark, d: str) -> DataFrame:
    return R.index_of(read_table(spark, d, "lineitem"), "l_returnflag", {"n": "l_orderkey", "n_suppliers": "l_suppkey"}).withColumnRenamed("l_returnflag", "kind")


# Points: embeddings, labels as chains.
@query(f"WITH {POINTS} SELECT DISTINCT a.vec_id FROM p a JOIN p b ON a.label <> b.label AND {DIST} < 0.05::DOUBLE")
def j01_interface_tokens(spark, d: str) -> DataFrame:
    p = points(spark, d)
    near = spatial.near_pairs(p, "vec_id", 0.05, strict=True).filter("a_label <> b_label")
    return p.join(spatial.ends(near, "vec_id").distinct(), "vec_id", "left_semi").select("vec_id")


@query(f"WITH {POINTS}, r AS (SELECT label, x, y, z FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {HASH_SQL.format("label || '|' || vec_id", 9)}, vec_id) AS k FROM p) WHERE k = 1), n AS (SELECT b.vec_id, b.label, row_number() OVER (PARTITION BY b.label ORDER BY {DIST} + b.vec_id * 1e-6::DOUBLE, b.vec_id) AS k FROM p b JOIN r a USING (label)) SELECT label, vec_id FROM n WHERE k <= 12")
def j05_spatial_crop(spark, d: str) -> DataFrame:
    p = points(spark, d).select(F.col("label").alias("structure_id"), F.lit("A").alias("chain_id"), F.col("vec_id").alias("residue_pos"), F.col("vec_id").alias("token"), "x", "y", "z")
    out = crop.spatial_crop(p, crop.reference_tokens(p, 9), 12)
    return out.select(F.col("structure_id").alias("label"), F.col("token").alias("vec_id"))


@query(f"WITH {POINTS} SELECT label, vec_id, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INTEGER AS token FROM p QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= 20")
def j08_token_limit(spark, d: str) -> DataFrame:
    p = points(spark, d).select(F.col("label").alias("structure_id"), F.col("vec_id").alias("token"), F.col("vec_id").alias("id"))
    return crop.renumbered(crop.first_tokens(p, 20)).select(F.col("structure_id").alias("label"), F.col("id").alias("vec_id"), "token")


@query(f"WITH {POINTS}, q AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i, x, y, z FROM p) SELECT a.label, round(sqrt(avg((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))), 9) AS rmsd FROM q a JOIN q b ON b.label = a.label + 1 AND a.i = b.i GROUP BY 1")
def l15_rmsd(spark, d: str) -> DataFrame:
    """Successive labels' points, paired by rank."""
    q = points(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")))
    a, b = (q.select("label", "i", *(F.col(c).alias(f"{s}_{c}") for c in "xyz")) for s in "ab")
    pairs = a.join(b.withColumn("label", F.col("label") - 1), ["label", "i"])
    return pairs.groupBy("label").agg(F.round(F.sqrt(F.avg(spatial.squared("a_", "b_"))), 9).alias("rmsd"))


@query("SELECT p_partkey, greatest(0, least(38, floor((p_retailprice / 40 - 3.25::DOUBLE) / ((50.75::DOUBLE - 3.25::DOUBLE) / 39))))::INTEGER AS fine, least(63, floor(p_retailprice / 40 / (22::DOUBLE / 64)))::INTEGER AS template FROM part")
def l05_other_bins(spark, d: str) -> DataFrame:
    x = F.col("p_retailprice") / 40
    return read_table(spark, d, "part").select("p_partkey", chem.fine_distance_bin(x).alias("fine"), chem.template_distance_bin(x).alias("template"))


@query("SELECT a.l_returnflag = b.l_returnflag AS same_chain, a.l_linestatus = b.l_linestatus AS same_entity, count(*) AS n FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND (a.l_linenumber, a.l_partkey, a.l_suppkey, a.l_quantity, a.l_extendedprice) < (b.l_linenumber, b.l_partkey, b.l_suppkey, b.l_quantity, b.l_extendedprice) GROUP BY 1, 2")
def l07_pair_masks(spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("line"), "l_returnflag", "l_linestatus")
    return spatial.pairs_of(li, "line", "l_orderkey").groupBy(spatial.same("l_returnflag").alias("same_chain"), spatial.same("l_linestatus").alias("same_entity")).agg(F.count("*").alias("n"))


# Sampling by hash, and batches.
@query(f"SELECT o_orderkey, CASE WHEN u < 0.2 THEN 'contiguous' WHEN u < 0.6 THEN 'spatial' ELSE 'interface' END AS method FROM (SELECT o_orderkey, {HASH_SQL.format('o_orderkey', 3)} AS u FROM orders)")
def j06_crop_method(spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("structure_id"))
    return o.select("o_orderkey", crop.crop_method(3).alias("method"))


@query(f"SELECT c_custkey, c_mktsegment FROM (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {HASH_SQL.format('c_custkey', 11)}, c_custkey) AS k FROM customer) WHERE k <= 7")
def i05_source_items(spark, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment").withColumn("u", R.uniform(11, "c_custkey"))
    return R.top_per_key(c, ["c_mktsegment"], [F.col("u"), F.col("c_custkey")], 7).select("c_custkey", "c_mktsegment")


@query(f"WITH c AS (SELECT p_type AS motif, p_size AS pos, draw, {HASH_SQL.format("p_type || '|' || p_size || '|' || draw", 13)} * (1.0::DOUBLE + 2.0::DOUBLE + 3.0::DOUBLE + 2.0::DOUBLE) AS u FROM (SELECT DISTINCT p_type, p_size FROM part), (SELECT unnest([0, 1, 2]) AS draw)) SELECT motif, draw, string_agg(CASE WHEN u < 1 THEN 'A' WHEN u < 3 THEN 'C' WHEN u < 6 THEN 'G' ELSE 'T' END, '' ORDER BY pos) AS sequence FROM c GROUP BY 1, 2")
def i07_drawn_bases(spark, d: str) -> DataFrame:
    matrix = read_table(spark, d, "part").select(F.col("p_type").alias("motif"), F.col("p_size").alias("pos")).distinct().select("*", *(F.lit(w).alias(b) for b, w in zip("acgt", (1.0, 2.0, 3.0, 2.0), strict=True)))
    return distillation.drawn_from_motifs(matrix, 3, 13)


@query("SELECT event_type, count(*) AS n, round(CASE event_type WHEN 'purchase' THEN 2.0 WHEN 'click' THEN 0.5 ELSE 1.0 END, 1)::DOUBLE AS weight FROM events GROUP BY 1")
def i04_dataset_weights(spark, d: str) -> DataFrame:
    return read_table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).withColumn("weight", R.static_weight(F.col("event_type"), {"purchase": 2.0, "click": 0.5}))


@query("SELECT k // 10 AS batch, count(*) AS n, min(c_custkey) AS \"first\" FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS k FROM customer) GROUP BY 1")
def n15_batches(spark, d: str) -> DataFrame:
    c = R.batches(read_table(spark, d, "customer").select("c_custkey"), "c_custkey", 10)
    return c.groupBy("batch").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"))


@query("SELECT lang, source, min(doc_id) AS \"first\" FROM documents GROUP BY 1, 2")
def g14_distinct(spark, d: str) -> DataFrame:
    return R.distinct_first(read_table(spark, d, "documents"), ["lang", "source"], "doc_id")


@query("SELECT DISTINCT c_nationkey AS path FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def a50_missing_keys(spark, d: str) -> DataFrame:
    """What one listing has and another lacks."""
    listing = read_table(spark, d, "customer").select(F.col("c_nationkey").alias("path")).distinct()
    return files.missing(listing, read_table(spark, d, "supplier").select(F.col("s_nationkey").alias("path")))


@query("SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def b42_checksums(spark, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", *(checksum(F.col("text"), a).alias(a) for a in ("md5", "sha256")))


@query("SELECT p_partkey, array_to_string(list_transform(range(1, 2 + p_size % 3), lambda i: i || '_' || p_size % 5), ',') AS ids FROM part")
def b40_operator_ids(spark, d: str) -> DataFrame:
    """Operator products ``(1-n)(m)`` as ids."""
    expression = F.format_string("(1-%d)(%d)", F.col("p_size") % 3 + 1, F.col("p_size") % 5)
    return read_table(spark, d, "part").select("p_partkey", F.array_join(structure_files.operator_ids_of(expression), ",").alias("ids"))
