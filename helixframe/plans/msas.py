"""Queries of the alignment, sequence, distillation and sampling operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequences
from ..operators import alignments as A
from ..operators import distillation
from ..operators import relational as R
from ..operators import templates as T
from ..sources.tables import read_table
from .base import Queries
from .curation import HASH_SQL
from .features import MSA_SQL, msa
from .scalar import GAPPED

q = Queries()
QUERIES, ORACLES = q.queries, q.oracles
MSA = f"WITH {MSA_SQL}"
CELLS = f"{MSA}, cells AS (SELECT msa, \"row\", unnest(string_split(sequence, '')) AS c, unnest(range(length(sequence)))::INTEGER AS pos FROM m)"
AMINO = sequences.MSA_ALPHABET[:20]
CODE = f"CASE WHEN {{0}} = '-' THEN 31 WHEN instr('{AMINO}', {{0}}) > 0 THEN instr('{AMINO}', {{0}}) - 1 ELSE 20 END"
ACCESSION = f"coalesce(nullif(regexp_extract({{0}}, '{sequences.ACCESSION}', 1), ''), regexp_split_to_array(trim({{0}}), '\\s+')[1])"


def listed(column):
    return F.array_join(column.cast("array<string>"), ",")


def gapped(spark, d: str) -> DataFrame:
    return read_table(spark, d, "part").select("p_partkey", F.translate("p_name", "aeiou ", "------").alias("s"))


# Sequences

DESCRIBED = "(SELECT *, 'sp|P1|X ' || CASE turn % 4 WHEN 0 THEN 'OS=' || role || ' TAX=' WHEN 1 THEN '[' || role || ']' WHEN 2 THEN 'X_HUMAN [ ] ' ELSE 'tr|Q' || turn || '|Y text' END AS t FROM conversations)"


def described(spark, d: str) -> DataFrame:
    kind = F.col("turn") % 4
    text = F.when(kind == 0, F.concat(F.lit("OS="), "role", F.lit(" TAX="))).when(kind == 1, F.concat(F.lit("["), "role", F.lit("]"))).when(kind == 2, F.lit("X_HUMAN [ ] ")).otherwise(F.concat(F.lit("tr|Q"), F.col("turn").cast("string"), F.lit("|Y text")))
    return read_table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("sp|P1|X "), text).alias("t"))


@q(f"SELECT conv_id, turn, coalesce({', '.join(f"CASE WHEN regexp_matches(t, '{p}') THEN trim(regexp_extract(t, '{p}', 1)) END" for p in sequences.SPECIES)}) AS species FROM {DESCRIBED}")
def b25_species_or_empty(spark, d: str) -> DataFrame:
    return described(spark, d).select("conv_id", "turn", sequences.species_or_empty(F.col("t")).alias("species"))


@q(f"SELECT conv_id, turn, coalesce({', '.join(f"nullif(trim(regexp_extract(t, '{p}', 1)), '')" for p in (*sequences.SPECIES[:2], sequences.OTHER_SPECIES))}) AS species FROM {DESCRIBED}")
def b26_other_species(spark, d: str) -> DataFrame:
    return described(spark, d).select("conv_id", "turn", sequences.other_species(F.col("t")).alias("species"))


@q(f"SELECT conv_id, turn, {ACCESSION.format('t')} AS accession FROM {DESCRIBED}")
def b27_accession(spark, d: str) -> DataFrame:
    return described(spark, d).select("conv_id", "turn", sequences.accession(F.col("t")).alias("accession"))


ZEROS = "list_transform(range({}), lambda z: 0)"


@q(f"SELECT p_partkey, array_to_string(flatten(list_transform(regexp_extract_all({GAPPED}, '-*[^-]|-+$'), lambda p: CASE WHEN right(p, 1) = '-' THEN {ZEROS.format('length(p)')} WHEN length(p) = 1 THEN [0] ELSE list_concat({ZEROS.format('length(p) - 2')}, [length(p) - 1, 0]) END)), ',') AS runs FROM part")
def b30_gap_runs(spark, d: str) -> DataFrame:
    return gapped(spark, d).select("p_partkey", listed(sequences.gap_runs(F.col("s"))).alias("runs"))


for _name in ("b31_residue_codes", "p60_alignment_codes"):
    q.put(_name, lambda spark, d: gapped(spark, d).select("p_partkey", listed(sequences.residue_codes(F.col("s"))).alias("codes")), f"SELECT p_partkey, array_to_string(list_transform(string_split(upper({GAPPED}), ''), lambda c: {CODE.format('c')}), ',') AS codes FROM part")


@q(f"SELECT p_partkey, array_to_string(list_transform(string_split({GAPPED}, ''), lambda c: CASE WHEN instr('{AMINO}', c) > 0 THEN instr('{AMINO}', c) - 1 ELSE 20 END), ',') AS codes FROM part")
def b44_sequence_codes(spark, d: str) -> DataFrame:
    return gapped(spark, d).select("p_partkey", listed(sequences.sequence_codes(F.col("s"))).alias("codes"))


# Alignments


@q(f"{MSA} SELECT msa, \"row\", array_to_string(list_transform(string_split(sequence, ''), lambda c: (c = '-')::INTEGER), ',') AS mask FROM m")
def e16_has_deletion(spark, d: str) -> DataFrame:
    return msa(spark, d).select("msa", "row", listed(sequences.has_deletion(F.col("deletions"))).alias("mask"))


@q(f"{CELLS} SELECT msa, \"row\", round(sum(2 / pi() * atan((c = '-')::INTEGER / 3)), 6) AS total FROM cells GROUP BY 1, 2")
def e17_deletion_values(spark, d: str) -> DataFrame:
    total = F.aggregate(sequences.deletion_values(F.col("deletions")), F.lit(0.0), lambda t, x: t + x)
    return msa(spark, d).select("msa", "row", F.round(total, 6).alias("total"))


for _name, _pseudo in (("e18_code_profile", 0.0), ("e20_profile_with_pseudocount", 1e-8), ("p67_profile_of_sequences", 0.0)):
    q.put(
        _name, lambda spark, d, p=_pseudo: A.code_profile(msa(spark, d), sequences.residue_codes(F.col("sequence")), p).withColumn("share", F.round("share", 6)),
        f"{CELLS} SELECT msa, pos, {CODE.format('upper(c)')} AS code, round(count(*) / (sum(count(*)) OVER (PARTITION BY msa, pos) + {_pseudo}::DOUBLE), 6) AS share FROM cells GROUP BY 1, 2, 3",
    )


@q(f"{CELLS} SELECT msa, pos, c AS letter, round(count(*) / sum(count(*)) OVER (PARTITION BY msa, pos), 6) AS share FROM cells WHERE instr('ABrand-13', c) > 0 GROUP BY 1, 2, 3")
def e19_letter_profile(spark, d: str) -> DataFrame:
    return A.letter_profile(msa(spark, d), "ABrand-13").withColumn("share", F.round("share", 6))


for _name in ("e22_deletion_columns", "p92_deletion_means"):
    q.put(
        _name, lambda spark, d: A.deletion_columns(msa(spark, d)).withColumns({c: F.round(c, 6) for c in ("mean", "value")}),
        f"{CELLS} SELECT msa, pos, round(avg((c = '-')::INTEGER), 6) AS mean, round(avg(2 / pi() * atan((c = '-')::INTEGER / 3)), 6) AS value, count(*) FILTER (c = '-') AS \"rows\" FROM cells GROUP BY 1, 2",
    )


@q(f"{CELLS} SELECT msa, \"row\", pos, (c = '-')::INTEGER AS deletions FROM cells")
def p91_deletion_matrix(spark, d: str) -> DataFrame:
    return msa(spark, d).select("msa", "row", F.posexplode("deletions").alias("pos", "deletions"))


def clusters(spark, d: str) -> DataFrame:
    """Names of parts of small size belong to a cluster."""
    return read_table(spark, d, "part").filter("p_partkey % 3 = 0").select(F.split("p_name", r"\s+")[0].alias("key"), F.lit("c1").alias("cluster")).distinct()


CLUSTERED = f"{MSA}, k AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS key FROM part WHERE p_partkey % 3 = 0)"
for _name in ("g04_by_cluster", "p98_deduplicated_by_cluster"):
    q.put(
        _name, lambda spark, d: A.by_cluster(msa(spark, d), clusters(spark, d), sequences.accession(F.col("description"))).select("msa", "row"),
        f"{CLUSTERED}, n AS (SELECT msa, \"row\", CASE WHEN \"row\" = 0 THEN 'query' WHEN k.key IS NOT NULL THEN 'c:c1' ELSE 'a:' || split_part(description, ' ', 1) END AS c FROM m LEFT JOIN k ON split_part(description, ' ', 1) = key) SELECT msa, min(\"row\")::INTEGER AS \"row\" FROM n GROUP BY msa, c",
    )


@q(f"{CLUSTERED} SELECT DISTINCT key, 'c1' AS cluster FROM k")
def p97_mapped_sequences(spark, d: str) -> DataFrame:
    keys = msa(spark, d).select(sequences.accession(F.col("description")).alias("key")).distinct()
    return R.with_cluster(keys, "key", clusters(spark, d)).filter("cluster IS NOT NULL")


def halves(spark, d: str) -> tuple[DataFrame, DataFrame]:
    m = msa(spark, d).withColumn("sequence", F.rpad("sequence", 9, "-"))
    return m.filter("row % 2 = 0"), m.filter("row % 2 = 1")


HALVES = f"{MSA}, h AS (SELECT msa, \"row\", rpad(sequence, 9, '-') AS sequence, \"row\" % 2 AS part FROM m)"


@q(f"{HALVES} SELECT msa, (row_number() OVER (PARTITION BY msa ORDER BY part, \"row\") - 1)::INTEGER AS \"row\", sequence FROM h")
def h01_stacked(spark, d: str) -> DataFrame:
    return A.stacked(*halves(spark, d)).select("msa", "row", "sequence")


@q(f"{HALVES} SELECT msa, (row_number() OVER (PARTITION BY msa ORDER BY part, \"row\") - 1)::INTEGER AS \"row\", sequence FROM h WHERE part = 0 OR \"row\" >= 3")
def h04_appended(spark, d: str) -> DataFrame:
    one, two = halves(spark, d)
    return A.appended(one, two, least=3).select("msa", "row", "sequence")


@q("SELECT p_brand, array_to_string(list_sort(flatten(list(l))), ',') AS flat FROM (SELECT p_brand, p_size, list(p_partkey) AS l FROM part GROUP BY 1, 2) GROUP BY 1")
def h07_flattened(spark, d: str) -> DataFrame:
    nested = read_table(spark, d, "part").groupBy("p_brand", "p_size").agg(F.collect_list("p_partkey").alias("l")).groupBy("p_brand").agg(F.collect_list("l").alias("l"))
    return nested.select("p_brand", listed(F.array_sort(R.flattened(F.col("l"), 1))).alias("flat"))


U = HASH_SQL.format("msa || '|' || \"row\"", 5)


@q(f"{MSA}, u AS (SELECT *, CASE WHEN \"row\" = 0 THEN -1.0 ELSE {U} END AS u, count(*) OVER (PARTITION BY msa) AS n FROM m), k AS (SELECT *, row_number() OVER (PARTITION BY msa ORDER BY u, \"row\") AS k FROM u) SELECT msa, \"row\" FROM k WHERE k <= 1 + floor({HASH_SQL.format('msa', 6)} * n)")
def i09_random_depth(spark, d: str) -> DataFrame:
    return A.subsampled_at_random(msa(spark, d), 5).select("msa", "row")


@q(f"{MSA}, k AS (SELECT *, row_number() OVER (PARTITION BY msa ORDER BY CASE WHEN \"row\" = 0 THEN -1.0 ELSE {U} END, \"row\") AS k FROM m) SELECT msa, \"row\" FROM k WHERE k <= 4")
def i10_subsampled_if_larger(spark, d: str) -> DataFrame:
    return A.subsampled_if_larger(msa(spark, d), 4, 5).select("msa", "row")


RESIDUES = f"{CELLS}, rp AS (SELECT msa, pos, (row_number() OVER (PARTITION BY msa ORDER BY pos) - 1)::INTEGER AS residue FROM cells WHERE \"row\" = 0 AND c <> '-')"


@q(f"{RESIDUES} SELECT msa, \"row\", residue, c AS letter, (c = '-')::INTEGER AS deletions FROM cells JOIN rp USING (msa, pos)")
def m04_alignment_on_residues(spark, d: str) -> DataFrame:
    return A.on_residues(msa(spark, d))


@q(f"{CELLS} SELECT msa, \"row\", (row_number() OVER (PARTITION BY msa, \"row\" ORDER BY pos) - 1)::INTEGER AS token, c AS letter FROM cells WHERE c <> '-'")
def m12_shifted_rows(spark, d: str) -> DataFrame:
    return A.shifted_on_tokens(msa(spark, d))


SPECIES = f"{MSA}, z AS (SELECT *, CASE WHEN \"row\" > 0 THEN split_part(description, ' ', 1) END AS species FROM m)"
FIRST_WORD = r"^(\S+)"


@q(f"{SPECIES} SELECT msa, species, count(*) AS n, min(\"row\")::INTEGER AS \"first\" FROM z WHERE species IS NOT NULL GROUP BY 1, 2")
def p96_members_by_species(spark, d: str) -> DataFrame:
    return A.members_by_species(msa(spark, d), F.regexp_extract("description", FIRST_WORD, 1))


PAIRED = f"""{SPECIES}, f AS (SELECT species, msa, arg_min(sequence, "row") AS sequence FROM z WHERE species IS NOT NULL GROUP BY 1, 2), s AS (SELECT species, row_number() OVER (ORDER BY species) AS "row" FROM f GROUP BY 1 HAVING count(*) >= 2),
e AS (SELECT 0 AS "row", msa, sequence FROM m WHERE "row" = 0 UNION ALL SELECT s."row", msa, sequence FROM f JOIN s USING (species)), w AS (SELECT msa, max(length(sequence)) AS w FROM e GROUP BY 1), g AS (SELECT * FROM (SELECT DISTINCT "row" FROM e), w)
SELECT "row"::INTEGER AS "row", md5(string_agg(coalesce(sequence, repeat('-', w)), '' ORDER BY msa)) AS digest FROM g LEFT JOIN e USING ("row", msa) GROUP BY 1"""
for _name in ("m23_paired_stack", "m25_chains_paired"):
    q.put(_name, lambda spark, d: A.paired_stack(msa(spark, d), F.regexp_extract("description", FIRST_WORD, 1)).select("row", F.md5("sequence").alias("digest")), PAIRED)

PROCESSED = f"""{CLUSTERED}, a AS (SELECT *, row_number() OVER (PARTITION BY msa, CASE WHEN "row" = 0 THEN 'q' ELSE upper(sequence) END ORDER BY "row") AS n FROM m),
b AS (SELECT * FROM a WHERE n = 1 AND ("row" = 0 OR NOT (length(sequence) - length(replace(sequence, '-', '')) > 0.5 * length(sequence) OR regexp_matches(sequence, '---')))),
c AS (SELECT *, row_number() OVER (PARTITION BY msa ORDER BY "row") AS n2 FROM b) SELECT msa, "row", description || CASE WHEN key IS NOT NULL THEN ' UniRef90:c1' ELSE '' END AS description FROM c LEFT JOIN k ON split_part(description, ' ', 1) = key WHERE n2 <= 5"""
for _name in ("m24_single_chain", "p100_processed_alignment"):
    q.put(_name, lambda spark, d: A.processed(msa(spark, d), clusters(spark, d), 5).select("msa", "row", "description"), PROCESSED)


@q(f"{MSA} SELECT msa, \"row\" FROM m WHERE \"row\" = 0 OR NOT (length(sequence) - length(replace(sequence, '-', '')) > 0.5 * length(sequence) OR regexp_matches(sequence, '---'))")
def p95_without_block_deletions(spark, d: str) -> DataFrame:
    return A.without_block_deletions(msa(spark, d)).select("msa", "row")


# Template hits: orders of a customer


def hits(spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("query"), F.col("o_orderkey").alias("hit"), F.concat(F.lit("p"), (F.col("o_orderkey") % 97).cast("string")).alias("pdb_id"), F.substring("o_orderpriority", 1, 1).alias("sequence"), F.col("o_totalprice").alias("score"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("date"))


HITS = "hits AS (SELECT o_custkey AS query, o_orderkey AS hit, 'p' || (o_orderkey % 97) AS pdb_id, substr(o_orderpriority, 1, 1) AS sequence, o_totalprice AS score, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS date FROM orders)"


@q(f"WITH {HITS} SELECT hit FROM hits WHERE coalesce(date <= DATE '1996-05-05', true)")
def c23_unknown_dates_stay(spark, d: str) -> DataFrame:
    return hits(spark, d).filter(T.dated_before(F.col("date"), "1996-05-05", True)).select("hit")


GOOD = f"WITH {HITS}, g AS (SELECT *, (hit % 10) / 10.0::DOUBLE AS coverage, (hit % 7) / 6.0::DOUBLE AS length_share, (hit % 5) / 4.0::DOUBLE AS identity FROM hits) SELECT query, hit, row_number() OVER (PARTITION BY query ORDER BY score DESC, hit)::INTEGER AS rank FROM g WHERE coverage >= 0.1::DOUBLE AND NOT (length_share > 0.95::DOUBLE AND identity > 0.95::DOUBLE)"


@q(GOOD)
def c24_good_hits(spark, d: str) -> DataFrame:
    h = hits(spark, d).withColumns({"coverage": (F.col("hit") % 10) / 10.0, "length_share": (F.col("hit") % 7) / 6.0, "identity": (F.col("hit") % 5) / 4.0})
    return T.good_hits(h, ["query"]).select("query", "hit", "rank")


@q(f"WITH {HITS} SELECT query, pdb_id, hit FROM (SELECT *, row_number() OVER (PARTITION BY query, lower(pdb_id) ORDER BY score DESC, hit) AS k FROM hits) WHERE k = 1")
def g08_best_by_entry(spark, d: str) -> DataFrame:
    h = hits(spark, d).withColumn("entry", F.lower("pdb_id"))
    return R.first_per_key(h, ["query", "entry"], [F.col("score").desc(), F.col("hit")]).select("query", "pdb_id", "hit")


@q(f"WITH {HITS}, k AS (SELECT *, row_number() OVER (PARTITION BY query, sequence ORDER BY score DESC, hit) AS n FROM hits WHERE date <= DATE '1997-01-01' AND upper(pdb_id) NOT IN ('P1', 'P2', 'P3')) SELECT query, hit, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, hit)::INTEGER AS rank FROM k WHERE n = 1) WHERE rank <= 4")
def g10_best_hits(spark, d: str) -> DataFrame:
    obsolete = spark.createDataFrame([("P1",), ("p2",), ("P3",)], "pdb_id string")
    return T.best_hits(hits(spark, d), ["query"], "1997-01-01", obsolete).select("query", "hit", "rank")


for _name in ("p102_dates_filled_in", "p103_known_dates", "p109_dates_of_entries"):
    q.put(
        _name, lambda spark, d: T.with_dates(hits(spark, d), read_table(spark, d, "customer").select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("pdb_id"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_custkey").cast("int")).alias("date"))).select("hit", "date"),
        f"WITH {HITS} SELECT hit, coalesce(date, DATE '1990-01-01' + c_custkey::INTEGER) AS date FROM hits LEFT JOIN customer ON pdb_id = 'p' || c_custkey",
    )


# Distillation: parts are sequences

SAMPLE = "repeat(replace(p_name, ' ', ''), 1 + p_size % 6)"


def sampled(spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), F.expr(SAMPLE).alias("sequence"), F.when(F.col("p_size") % 4 > 0, F.col("p_size") * 2.0).alias("confidence"))


@q(f"SELECT p_partkey AS id, length({SAMPLE}) BETWEEN 16 AND 2000 AND coalesce(CASE WHEN p_size % 4 > 0 THEN p_size * 2.0 END >= 70, true) AS good FROM part")
def c19_acceptable_samples(spark, d: str) -> DataFrame:
    return sampled(spark, d).select("id", distillation.acceptable("mgnify", F.col("sequence"), F.col("confidence")).alias("good"))


@q(f"SELECT id FROM (SELECT p_partkey::VARCHAR AS id, {HASH_SQL.format('p_partkey', 3)} AS u FROM part WHERE length({SAMPLE}) BETWEEN 16 AND 2000) ORDER BY u, id LIMIT 40")
def p41_sampled_sequences(spark, d: str) -> DataFrame:
    return distillation.samples(sampled(spark, d), "mgnify", 40, 3).select("id")


@q(f"SELECT p_partkey::VARCHAR AS id, length({SAMPLE})::INTEGER AS n FROM part WHERE length({SAMPLE}) BETWEEN 10 AND 50")
def p45_short_sequences(spark, d: str) -> DataFrame:
    return distillation.samples(sampled(spark, d), "short").select("id", F.length("sequence").alias("n"))


@q(f"SELECT source, count(*) AS n FROM (SELECT 'mgnify' AS source FROM part WHERE length({SAMPLE}) BETWEEN 16 AND 2000 UNION ALL SELECT 'short' FROM part WHERE length({SAMPLE}) BETWEEN 10 AND 50) GROUP BY 1")
def p46_every_source(spark, d: str) -> DataFrame:
    s = sampled(spark, d).select("id", "sequence")
    return distillation.every_source({"mgnify": s, "short": s}).groupBy("source").agg(F.count("*").alias("n"))


@q("SELECT p_type AS file, \"row\", id, sequence FROM (SELECT p_type, \"row\", id, sequence, row_number() OVER (PARTITION BY p_type ORDER BY \"row\") AS k FROM (SELECT p_type, p_partkey AS \"row\", p_brand AS id, repeat(replace(p_name, ' ', ''), 2) AS sequence FROM part) WHERE length(sequence) BETWEEN 16 AND 2000) WHERE k <= 5")
def p42_families(spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part").select(F.col("p_type").alias("file"), F.col("p_partkey").alias("row"), F.col("p_brand").alias("id"), F.concat(F.lit("-.~"), F.repeat(F.translate("p_name", " ", "-"), F.lit(2))).alias("sequence"))
    return distillation.families(p).select("file", "row", "id", "sequence")


@q("SELECT s_name || '_' || s_nationkey AS id, s_name AS sequence FROM supplier")
def p44_disordered(spark, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier").select(F.col("s_name").alias("pdb_id"), F.col("s_nationkey").cast("string").alias("chain_id"), F.col("s_name").alias("sequence"))
    return distillation.disordered(s)


@q("SELECT l_orderkey, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1")
def e31_mean_confidence(spark, d: str) -> DataFrame:
    by_chain = read_table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.collect_list("l_quantity").alias("v"))
    scores = by_chain.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "v"))).alias("scores"))
    return scores.select("l_orderkey", F.round(distillation.mean_confidence(F.col("scores")), 6).alias("mean"))


SEGMENTS = {"AUTOMOBILE": "mgnify", "BUILDING": "disordered", "FURNITURE": "rfam", "HOUSEHOLD": "short", "MACHINERY": "jaspar"}


@q(f"SELECT source, coalesce(weight, 0) AS weight FROM (SELECT DISTINCT CASE c_mktsegment {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENTS.items())} ELSE 'other' END AS source FROM customer) LEFT JOIN (VALUES ('mgnify', 0.495::DOUBLE), ('disordered', 0.02::DOUBLE), ('rfam', 0.05::DOUBLE), ('short', 0.005::DOUBLE), ('jaspar', 0.0::DOUBLE)) v(source, weight) USING (source)")
def i06_source_weights(spark, d: str) -> DataFrame:
    """Market segments stand for sources; one that has no weight of its own gets none."""
    segment = F.col("c_mktsegment")
    name = F.coalesce(*(F.when(segment == k, v) for k, v in SEGMENTS.items()), F.lit("other"))
    return distillation.source_weights(read_table(spark, d, "customer").select(name.alias("source")).distinct())


DRAWN = f"WITH c AS (SELECT p_type AS motif, p_size AS pos, draw, {HASH_SQL.format("p_type || '|' || p_size || '|' || draw", 13)} * (1.0::DOUBLE + 2.0::DOUBLE + 3.0::DOUBLE + 2.0::DOUBLE) AS u FROM (SELECT DISTINCT p_type, p_size FROM part), (SELECT unnest([0, 1]) AS draw)), g AS (SELECT motif, draw, string_agg(CASE WHEN u < 1 THEN 'A' WHEN u < 3 THEN 'C' WHEN u < 6 THEN 'G' ELSE 'T' END, '' ORDER BY pos) AS dna FROM c GROUP BY 1, 2)"


@q(f"{DRAWN} SELECT motif, draw, p_name AS protein, dna FROM g JOIN part ON p_type = motif AND p_partkey < 40")
def p43_proteins_with_motifs(spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part")
    matrix = p.select(F.col("p_type").alias("motif"), F.col("p_size").alias("pos")).distinct().select("*", *(F.lit(w).alias(b) for b, w in zip("acgt", (1.0, 2.0, 3.0, 2.0), strict=True)))
    proteins = p.filter("p_partkey < 40").select(F.col("p_type").alias("motif"), F.col("p_name").alias("protein"))
    return distillation.with_motifs(proteins, distillation.drawn_from_motifs(matrix, 2, 13))


# Rules, weights and draws on orders


@q("SELECT o_orderkey, coalesce(o_orderdate::DATE <= DATE '1996-06-30', false) AS good FROM orders")
def c02_date(spark, d: str) -> DataFrame:
    return read_table(spark, d, "orders").select("o_orderkey", F.coalesce(R.date_rule(F.date_format("o_orderdate", "yyyy-M-d"), "1996-06-30"), F.lit(False)).alias("good"))


for _name, _allow in (("c03_resolution", True), ("c15_resolution_without_nmr", False)):
    q.put(
        _name, lambda spark, d, allow=_allow: read_table(spark, d, "orders").select("o_orderkey", R.resolution_rule(F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice") / 50000), F.when(F.col("o_orderkey") % 2 == 0, "SOLUTION NMR") if allow else F.lit(""), 6.0).alias("good")),
        f"SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice / 50000 END <= 6.0, CASE WHEN o_orderkey % 2 = 0 THEN {_allow} END, false) AS good FROM orders",
    )

RULES = "o_orderdate::DATE <= DATE '1996-06-30' AND o_totalprice <= 200000 AND o_orderstatus <> 'P'"


def steps():
    return [lambda df: df.filter(F.coalesce(R.date_rule(F.date_format("o_orderdate", "yyyy-M-d"), "1996-06-30"), F.lit(False))), lambda df: df.filter("o_totalprice <= 200000"), lambda df: df.filter("o_orderstatus <> 'P'")]


for _name in ("o05_filter_pipeline", "o07_batch_filter", "o08_filtered_batch", "o09_composed_steps", "p56_filtered"):
    q.put(_name, lambda spark, d: R.composed(read_table(spark, d, "orders"), steps()).select("o_orderkey"), f"SELECT o_orderkey FROM orders WHERE {RULES}")


@q(f"WITH o AS (SELECT * FROM orders WHERE {RULES}) SELECT o_orderkey, o_custkey AS cluster, round(1 / count(*) OVER (PARTITION BY o_custkey), 9) AS weight FROM o")
def o06_curated_with_weights(spark, d: str) -> DataFrame:
    o = R.composed(read_table(spark, d, "orders"), steps()).select("o_orderkey", F.col("o_custkey").alias("cluster"))
    return o.join(R.inverse_cluster_weight(o, "o_orderkey", "cluster"), "o_orderkey").select("o_orderkey", "cluster", F.round("weight", 9).alias("weight"))


@q("WITH e AS (SELECT 'pdb' AS dataset, o_orderkey AS entry, o_custkey AS cluster FROM orders UNION ALL SELECT 'other', p_partkey, p_size FROM part) SELECT dataset, entry, count(*) OVER (PARTITION BY cluster) AS cluster_size FROM e")
def p53_entries_of_datasets(spark, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select(F.lit("pdb").alias("dataset"), F.col("o_orderkey").alias("entry"), F.col("o_custkey").cast("long").alias("cluster"))
    every = o.unionByName(read_table(spark, d, "part").select(F.lit("other").alias("dataset"), F.col("p_partkey").alias("entry"), F.col("p_size").cast("long").alias("cluster")))
    return every.join(every.groupBy("cluster").agg(F.count("*").alias("cluster_size")), "cluster").select("dataset", "entry", "cluster_size")


def whole_draws(spark, d: str) -> DataFrame:
    """Draws of customers in proportion to their number, a whole weight, so that sums are exact."""
    c = read_table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 9).cast("double").alias("w"))
    return R.drawn(c, "c_custkey", "w", 200, 17)


DRAWN = f"""WITH w AS (SELECT c_custkey, (c_custkey % 9)::DOUBLE AS w, sum((c_custkey % 9)::DOUBLE) OVER (ORDER BY c_custkey) AS high FROM customer),
u AS (SELECT draw, {HASH_SQL.format('draw', 17)} * (SELECT sum(w) FROM w) AS u FROM (SELECT unnest(range(200))::BIGINT AS draw)) SELECT draw, c_custkey FROM u JOIN w ON w > 0 AND u >= high - w AND u < high"""
for _name in ("i01_drawn_entries", "p55_drawn_structures"):
    q.put(_name, whole_draws, DRAWN)
