"""Queries of token frames and model inputs: the fixture's structures with alignments and templates taken from each other.

The chains AF and AO of a structure are aligned with those of the next three structures, and the next two structures are its
templates, two places to the right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chem
from ..operators import inputs as I
from ..operators import structures as S
from ..operators import templates as T
from .base import Queries
from .fixture import atoms
from .msas import CODE
from .scalar import INDEX, sql_map
from .structures import ASYM, CHAINS, FLAT, KEYS, PAIRS, RES, TOKEN_ATOMS, TOKENS, chains, laid

q = Queries()
QUERIES, ORACLES = q.queries, q.oracles

ANGLE = "degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (ux * vx + uy * vy + uz * vz) / (sqrt(ux * ux + uy * uy + uz * uz) * sqrt(vx * vx + vy * vy + vz * vz))))))"
POLYMER = "CASE f.kind WHEN 'PROTEIN' THEN '{}' ELSE '{}' END"
FRAMES = f"""standard AS (SELECT f.structure_id, f.token, {', '.join(f"min(flat) FILTER (f.atom = {POLYMER.format(p, n.replace(chr(39), chr(39) * 2))}) AS {k}" for k, p, n in zip('abc', I.FRAME['PROTEIN'], I.FRAME['RNA'], strict=True))} FROM flat f WHERE unit = -1 GROUP BY 1, 2),
around AS (SELECT b.structure_id, b.token, b.flat AS b, n.flat AS n, row_number() OVER (PARTITION BY b.structure_id, b.flat ORDER BY (n.x - b.x) * (n.x - b.x) + (n.y - b.y) * (n.y - b.y) + (n.z - b.z) * (n.z - b.z), n.flat) AS k FROM flat b JOIN flat n ON b.unit >= 0 AND (b.structure_id, b.chain_id, b.residue_pos) = (n.structure_id, n.chain_id, n.residue_pos) AND b.flat <> n.flat),
three AS (SELECT * FROM standard UNION ALL SELECT structure_id, token, min(n) FILTER (k = 1), min(b), min(n) FILTER (k = 2) FROM around GROUP BY 1, 2),
sides AS (SELECT t.*, {', '.join(f'pa.{c} - pb.{c} AS u{c}, pc.{c} - pb.{c} AS v{c}' for c in 'xyz')} FROM three t JOIN flat pa ON (pa.structure_id, pa.flat) = (t.structure_id, t.a) JOIN flat pb ON (pb.structure_id, pb.flat) = (t.structure_id, t.b) JOIN flat pc ON (pc.structure_id, pc.flat) = (t.structure_id, t.c)),
frames AS (SELECT structure_id, token, coalesce(a, -1) AS a, coalesce(b, -1) AS b, coalesce(c, -1) AS c FROM (SELECT structure_id, token FROM tokens) LEFT JOIN (SELECT * FROM sides WHERE {ANGLE} > 25 AND {ANGLE} < 155) USING (structure_id, token))"""
PLACED = f"{TOKENS}, {TOKEN_ATOMS}, {FLAT}, {FRAMES}"


def listed(column: str):
    return F.array_join(F.col(column).cast("array<string>"), ",")


@q(f"{PLACED} SELECT structure_id, token, (a >= 0)::INTEGER AS has_frame, a || ',' || b || ',' || c AS frame_atoms FROM frames")
def l10_token_frames(spark, d: str) -> DataFrame:
    return I.token_frames(I.residue_blocks(atoms(spark, d))).select("structure_id", "token", "has_frame", listed("frame_atoms").alias("frame_atoms"))


FAMILY = "fam AS (SELECT structure_id, chain_id, sequence, n_residues::INTEGER AS n, row_number() OVER (PARTITION BY chain_id ORDER BY structure_id) AS idx FROM chains WHERE chain_id IN ('AF', 'AO'))"
CELLS = f"""{FAMILY}, al AS (SELECT q.structure_id, q.chain_id, q.n, k AS "row", rpad(substr(h.sequence, 1, q.n), q.n, '-') AS sequence FROM fam q JOIN (SELECT unnest(range(4))::INTEGER AS k) ON true JOIN fam h ON h.chain_id = q.chain_id AND h.idx = q.idx + k),
cells AS (SELECT structure_id, chain_id, "row", pos, {CODE.format('c')} AS code, (pos + "row") % 4 AS d FROM (SELECT *, unnest(string_split(sequence, '')) AS c, unnest(range(n))::INTEGER AS pos FROM al)),
deep AS (SELECT structure_id, max("row")::INTEGER + 1 AS n_rows FROM al GROUP BY 1),
columns AS (SELECT structure_id, chain_id, pos, sum(code + 1) / count(*) AS profile, avg(d) AS deletion_mean FROM cells GROUP BY 1, 2, 3),
letters AS (SELECT t.structure_id, t.token, string_agg(coalesce(c.code, 31)::VARCHAR, ',' ORDER BY k) AS codes, string_agg(coalesce(c.d, 0)::VARCHAR, ',' ORDER BY k) AS deletions FROM tokens t JOIN deep USING (structure_id) JOIN (SELECT unnest(range(4))::INTEGER AS k) ON k < n_rows LEFT JOIN cells c ON (c.structure_id, c.chain_id, c.pos, c."row") = (t.structure_id, t.chain_id, t.residue_pos, k) GROUP BY 1, 2)"""
BETA = "CASE WHEN residue <> 'GLY' THEN max({0}) FILTER (atom = 'CB') END"
TEMPLATES = f"""tr AS (SELECT {KEYS}, residue, {', '.join(f"coalesce({BETA.format(c)}, max({c}) FILTER (atom = 'CA')) AS b{c}" for c in 'xyz')}, (count(*) FILTER (atom IN ('N', 'CA', 'C')) = 3)::INTEGER AS frame_mask FROM ak WHERE kind = 'PROTEIN' AND chain_id = 'AF' GROUP BY {KEYS}, residue),
ts AS (SELECT q.structure_id, k - 1 AS slot, tr.residue_pos + 2 AS pos, {sql_map(INDEX, '20', 'tr.residue')} AS aatype, tr.bx, (tr.bx IS NOT NULL)::INTEGER AS beta, tr.frame_mask FROM fam q JOIN (SELECT unnest([1, 2])::INTEGER AS k) ON true JOIN fam h ON h.chain_id = 'AF' AND q.chain_id = 'AF' AND h.idx = q.idx + k JOIN tr ON tr.structure_id = h.structure_id)"""


def family(spark, d: str) -> DataFrame:
    own = chains(spark, d).filter(F.col("chain_id").isin("AF", "AO"))
    return own.select(*S.CHAIN, "sequence", F.col("n_residues").cast("int").alias("n"), F.row_number().over(Window.partitionBy("chain_id").orderBy("structure_id")).alias("idx"))


def alignments(spark, d: str) -> DataFrame:
    f = family(spark, d)
    hit = f.select("chain_id", F.col("idx").alias("__idx"), F.col("sequence").alias("__other"))
    rows = f.withColumn("row", F.explode(F.array(*map(F.lit, range(4))))).withColumn("__idx", F.col("idx") + F.col("row")).join(hit, ["chain_id", "__idx"])
    deletions = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda p: ((p + F.col("row")) % 4).cast("int"))
    return rows.select(*S.CHAIN, "row", F.rpad(F.substring("__other", F.lit(1), F.col("n")), F.col("n"), F.lit("-")).alias("sequence"), deletions.alias("deletions"))


def templates(spark, d: str) -> DataFrame:
    f = family(spark, d).filter("chain_id = 'AF'").select("structure_id", "idx")
    hit = f.select(F.col("structure_id").alias("hit"), F.col("idx").alias("__idx"))
    pairs = f.withColumn("slot", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("__idx", F.col("idx") + F.col("slot") + 1).join(hit, "__idx").select("structure_id", "slot", "hit")
    own = laid(spark, d).filter("chain_id = 'AF'").withColumnRenamed("structure_id", "hit")
    return pairs.join(own, "hit").select("structure_id", "chain_id", "slot", (F.col("residue_pos") + 2).alias("pos"), chem.restype_index(F.col("residue")).alias("aatype"), "pseudo_beta", "pseudo_beta_mask", "frame_mask")


def inputs(spark, d: str) -> DataFrame:
    a = atoms(spark, d)
    return I.model_inputs(a, alignments(spark, d), templates(spark, d), S.bond_tokens(S.bonded(a), S.tokens(a)))


def digest(column: str):
    """Of a matrix."""
    return F.md5(F.array_join(F.transform(column, lambda x: F.array_join(x.cast("array<string>"), ",")), ";"))


def total(column, places: int = 4):
    return F.round(F.aggregate(column, F.lit(0.0), lambda s, x: s + x), places)


LIST = "list({} ORDER BY token)"
EVERY = f"{CHAINS}{PAIRS[len(RES):]}, {TOKEN_ATOMS}, {FLAT}, {FRAMES}, {ASYM}, {CELLS}, {TEMPLATES}"


@q(
    f"""{EVERY},
t AS (SELECT structure_id, count(*)::INTEGER AS n_tokens, md5(array_to_string({LIST.format('restype')}, ',')) AS restype, md5(array_to_string({LIST.format('asym_id')}, ',')) AS asym_id, md5(array_to_string({LIST.format("a || ',' || b || ',' || c")}, ';')) AS frame_atoms, sum((a >= 0)::INTEGER)::INTEGER AS n_frames FROM asym JOIN frames USING (structure_id, token) GROUP BY 1),
a AS (SELECT structure_id, count(*)::INTEGER AS n_atoms, md5(array_to_string(list(token ORDER BY flat), ',')) AS atom_to_token FROM flat GROUP BY 1),
m AS (SELECT structure_id, md5(array_to_string({LIST.format('codes')}, ';')) AS msa, md5(array_to_string({LIST.format('deletions')}, ';')) AS deletions FROM letters GROUP BY 1),
p AS (SELECT t.structure_id, round(sum(coalesce(profile, 0)), 4) AS profile, round(sum(coalesce(deletion_mean, 0)), 4) AS deletion_mean FROM tokens t LEFT JOIN columns c ON (c.structure_id, c.chain_id, c.pos) = (t.structure_id, t.chain_id, t.residue_pos) GROUP BY 1),
x AS (SELECT t.structure_id, s.slot, t.token, coalesce(aatype, 31) AS aatype, coalesce(beta, 0) AS beta, coalesce(frame_mask, 0) AS frame_mask, coalesce(bx, 0) AS bx FROM tokens t CROSS JOIN (SELECT unnest(range(4))::INTEGER AS slot) s LEFT JOIN ts ON t.chain_id = 'AF' AND (ts.structure_id, ts.slot, ts.pos) = (t.structure_id, s.slot, t.residue_pos)),
y AS (SELECT structure_id, md5(string_agg(v, ';' ORDER BY slot)) AS template_aatype, sum(beta)::INTEGER AS template_betas, sum(frames)::INTEGER AS template_frames, round(sum(bx), 4) AS template_x FROM (SELECT structure_id, slot, array_to_string({LIST.format('aatype')}, ',') AS v, sum(beta) AS beta, sum(frame_mask) AS frames, sum(bx) AS bx FROM x GROUP BY 1, 2) GROUP BY 1),
b AS (SELECT structure_id, count(*)::INTEGER AS n_bonds FROM both_ways GROUP BY 1)
SELECT structure_id, n_tokens, restype, asym_id, frame_atoms, n_frames, n_atoms, atom_to_token, n_rows, msa, deletions, profile, deletion_mean, template_aatype, template_betas, template_frames, template_x, coalesce(n_bonds, 0) AS n_bonds
FROM t JOIN a USING (structure_id) JOIN deep USING (structure_id) JOIN m USING (structure_id) JOIN p USING (structure_id) JOIN y USING (structure_id) LEFT JOIN b USING (structure_id)"""
)
def m18_model_inputs(spark, d: str) -> DataFrame:
    out = inputs(spark, d)
    count = lambda c: F.aggregate(F.flatten(c), F.lit(0), lambda s, x: s + x)
    mean = F.transform("profile", lambda p: F.aggregate(F.transform(p, lambda x, k: x * (k + 1)), F.lit(0.0), lambda s, x: s + x))
    places = F.transform(F.flatten("template_pseudo_beta"), lambda x: x[0])
    return out.select(
        "structure_id", "n_tokens", F.md5(listed("restype")).alias("restype"), F.md5(listed("asym_id")).alias("asym_id"), digest("frame_atoms").alias("frame_atoms"), F.aggregate("has_frame", F.lit(0), lambda s, x: s + x).alias("n_frames"), "n_atoms",
        F.md5(listed("atom_to_token")).alias("atom_to_token"), "n_rows", digest("msa").alias("msa"), digest("deletions").alias("deletions"), total(mean).alias("profile"), total("deletion_mean").alias("deletion_mean"), digest("template_aatype").alias("template_aatype"),
        count("template_pseudo_beta_mask").alias("template_betas"), count("template_frame_mask").alias("template_frames"), total(places).alias("template_x"), F.size("token_bonds").alias("n_bonds"),
    )


KEPT = "kept AS (SELECT structure_id, token, (row_number() OVER (PARTITION BY structure_id ORDER BY token) - 1)::INTEGER AS new FROM tokens WHERE chain_id IN ('AO', 'RF'))"


@q(
    f"""{EVERY}, {KEPT},
own AS (SELECT f.structure_id, flat, new, (row_number() OVER (PARTITION BY f.structure_id ORDER BY flat) - 1)::INTEGER AS place FROM flat f JOIN kept USING (structure_id, token)),
moved AS (SELECT k.structure_id, k.new, pa.place || ',' || pb.place || ',' || pc.place AS placed FROM kept k JOIN frames f USING (structure_id, token) LEFT JOIN own pa ON (pa.structure_id, pa.flat) = (k.structure_id, f.a) LEFT JOIN own pb ON (pb.structure_id, pb.flat) = (k.structure_id, f.b) LEFT JOIN own pc ON (pc.structure_id, pc.flat) = (k.structure_id, f.c)),
t AS (SELECT structure_id, count(*)::INTEGER AS n_tokens, md5(array_to_string(list(coalesce(placed, '-1,-1,-1') ORDER BY new), ';')) AS frame_atoms FROM moved GROUP BY 1),
m AS (SELECT structure_id, md5(array_to_string(list(codes ORDER BY token), ';')) AS msa FROM letters JOIN kept USING (structure_id, token) GROUP BY 1),
a AS (SELECT structure_id, count(*)::INTEGER AS n_atoms, md5(array_to_string(list(new ORDER BY place), ',')) AS atom_to_token FROM own GROUP BY 1),
b AS (SELECT p.structure_id, count(*)::INTEGER AS n_bonds, sum(x.new * 3 + y.new)::BIGINT AS bonds FROM both_ways p JOIN kept x ON (x.structure_id, x.token) = (p.structure_id, p.token_1) JOIN kept y ON (y.structure_id, y.token) = (p.structure_id, p.token_2) GROUP BY 1)
SELECT structure_id, n_tokens, frame_atoms, msa, n_atoms, atom_to_token, coalesce(n_bonds, 0) AS n_bonds, coalesce(bonds, 0) AS bonds FROM t JOIN m USING (structure_id) JOIN a USING (structure_id) LEFT JOIN b USING (structure_id)"""
)
def m19_cropped_inputs(spark, d: str) -> DataFrame:
    """The crop that two chains make."""
    kept = S.tokens(atoms(spark, d)).filter(F.col("chain_id").isin("AO", "RF"))
    out = I.cropped_inputs(inputs(spark, d), kept)
    ends = F.aggregate(F.transform("token_bonds", lambda b: b["token_1"] * 3 + b["token_2"]), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return out.select("structure_id", "n_tokens", digest("frame_atoms").alias("frame_atoms"), digest("msa").alias("msa"), "n_atoms", F.md5(listed("atom_to_token")).alias("atom_to_token"), F.size("token_bonds").alias("n_bonds"), ends.alias("bonds"))


@q(
    f"""{TOKENS}, {KEPT}, crop AS (SELECT t.*, new FROM tokens t JOIN kept USING (structure_id, token)),
p AS (SELECT a.structure_id, a.new AS i, string_agg(CASE WHEN a.chain_id = b.chain_id THEN greatest(-32, least(32, b.seq_id - a.seq_id)) + 32 ELSE 65 END::INTEGER::VARCHAR, ',' ORDER BY b.new) AS relative, string_agg(CASE WHEN a.new <> b.new THEN greatest(0, least(38, floor((sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) - 3.25::DOUBLE) / 1.25::DOUBLE)))::INTEGER::VARCHAR END, ',' ORDER BY b.new) AS bins FROM crop a JOIN crop b ON a.structure_id = b.structure_id GROUP BY 1, 2)
SELECT structure_id, md5(string_agg(relative, ';' ORDER BY i)) AS relative_position, md5(string_agg(coalesce(bins, ''), ';' ORDER BY i)) AS distogram FROM p GROUP BY 1"""
)
def m20_pair_inputs(spark, d: str) -> DataFrame:
    """Pair features of the same crop, as matrices of the row."""
    a = atoms(spark, d)
    kept = S.tokens(a).filter(F.col("chain_id").isin("AO", "RF"))
    out = I.with_pairs(I.cropped_inputs(I.model_inputs(a, frames=False), kept))
    return out.select("structure_id", digest("relative_position").alias("relative_position"), digest("distogram").alias("distogram"))


# Template frames: the hits' files are scanned for what is needed of them

HITS = f"""{CHAINS}, {FAMILY}, bb AS (SELECT structure_id, chain_id, residue_pos, {', '.join(f"max({c}) FILTER (atom = '{n}') AS {k}{c}" for k, n in (('a', 'N'), ('o', 'CA'), ('b', 'C')) for c in 'xyz')} FROM ak WHERE kind = 'PROTEIN' AND chain_id = 'AF' GROUP BY 1, 2, 3),
xx AS (SELECT *, sqrt((bx - ox) * (bx - ox) + (by_ - oy) * (by_ - oy) + (bz - oz) * (bz - oz)) AS lx FROM (SELECT * RENAME ("by" AS by_) FROM bb)),
yy AS (SELECT *, (bx - ox) / lx AS xx, (by_ - oy) / lx AS xy, (bz - oz) / lx AS xz FROM xx), tt AS (SELECT *, (ox - ax) * xx + (oy - ay) * xy + (oz - az) * xz AS t FROM yy),
vv AS (SELECT *, ox - ax - t * xx AS vx, oy - ay - t * xy AS vy, oz - az - t * xz AS vz FROM tt), ww AS (SELECT *, sqrt(vx * vx + vy * vy + vz * vz) AS lv FROM vv),
fr AS (SELECT structure_id, residue_pos, ox AS x, oy AS y, oz AS z, xx, xy, xz, vx / lv AS yx, vy / lv AS yy, vz / lv AS yz, coalesce(lx >= 1e-6 AND lv >= 1e-6, false) AS framed FROM ww WHERE ox IS NOT NULL),
on_query AS (SELECT q.structure_id AS query, k - 1 AS slot, f.residue_pos + 2 AS pos, f.* EXCLUDE (structure_id, residue_pos) FROM fam q JOIN (SELECT unnest([1, 2])::INTEGER AS k) ON true JOIN fam h ON h.chain_id = 'AF' AND q.chain_id = 'AF' AND h.idx = q.idx + k JOIN fr f ON f.structure_id = h.structure_id AND f.residue_pos < q.n AND f.residue_pos + 2 < q.n)"""


def hits_of_files(spark, d: str) -> DataFrame:
    """Each structure's chain AF has those of the next two as hits, two places to the right."""
    f = family(spark, d).filter("chain_id = 'AF'")
    hit = f.select(F.col("structure_id").alias("hit"), F.col("idx").alias("__idx"), F.col("sequence").alias("__other"))
    pairs = f.withColumn("slot", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("__idx", F.col("idx") + F.col("slot") + 1).join(hit, "__idx")
    own = F.concat("sequence", F.lit("--"))
    other = F.concat(F.lit("--"), F.rpad(F.substring("__other", F.lit(1), F.col("n")), F.col("n"), F.lit("-")))
    return pairs.select(F.col("structure_id").alias("query"), "slot", "hit", "chain_id", "n", own.alias("query_aligned"), other.alias("template_aligned"), F.lit(0).alias("query_start"), F.lit(0).alias("template_start"))


def frames_of_files(spark, d: str) -> DataFrame:
    from ..sources import mmcif
    from .files import structure_files

    hits = hits_of_files(spark, d)
    found = mmcif.scan(spark, structure_files(spark, d), "atoms", ["structure_id", "chain_id", "residue_pos", "residue", "atom", "atom_pos", "x", "y", "z"])
    return T.template_frames(found, hits, hits.select("query", "n").distinct())


@q(
    f"""{HITS}, own AS (SELECT query, slot, sum(framed::INTEGER)::INTEGER AS n_frames, count(*)::INTEGER AS n_places, round(sum(CASE WHEN framed THEN xx * yy - xy * yx ELSE 0 END) / sqrt(2), 4) AS zz FROM on_query GROUP BY 1, 2)
SELECT query, slot, n_places, n_frames, zz FROM own"""
)
def l12_template_frames(spark, d: str) -> DataFrame:
    out = frames_of_files(spark, d)
    count = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    last = F.transform("frame", lambda f: F.coalesce(f[2][2], F.lit(0.0)))
    return out.select("query", "slot", count("mask").alias("n_places"), count("frame_mask").alias("n_frames"), F.round(F.aggregate(last, F.lit(0.0), lambda s, x: s + x) / F.sqrt(F.lit(2.0)), 4).alias("zz")).filter("n_places > 0")


PLACES = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


@q(f"{HITS} SELECT a.query, a.slot, a.pos, sum((b.pos + 1) * greatest(0, least(38, floor(({PLACES} - 3.25::DOUBLE) / ((50.75::DOUBLE - 3.25::DOUBLE) / 39)))))::BIGINT AS bins, count(*) AS n FROM on_query a JOIN on_query b ON a.query = b.query AND a.slot = b.slot GROUP BY 1, 2, 3")
def p68_template_distograms(spark, d: str) -> DataFrame:
    rows = frames_of_files(spark, d).select("query", "slot", F.posexplode("distogram").alias("pos", "row"))
    there = F.filter("row", lambda b: b >= 0)
    bins = F.aggregate(F.transform("row", lambda b, j: F.when(b >= 0, b * (j + 1)).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return rows.select("query", "slot", "pos", bins.cast("long").alias("bins"), F.size(there).cast("long").alias("n")).filter("n > 0")


@q(f"{HITS} SELECT a.query, a.slot, a.pos, round(sum((a.x - b.x) / greatest({PLACES}, 1e-8)) / sqrt(2), 4) AS ux, round(sum(CASE WHEN a.framed THEN ((b.x - a.x) * a.yx + (b.y - a.y) * a.yy + (b.z - a.z) * a.yz) / greatest({PLACES}, 1e-8) ELSE 0 END) / sqrt(2), 4) AS ly FROM on_query a JOIN on_query b ON a.query = b.query AND a.slot = b.slot GROUP BY 1, 2, 3")
def p69_template_unit_vectors(spark, d: str) -> DataFrame:
    rows = frames_of_files(spark, d).select("query", "slot", F.posexplode(F.arrays_zip("mask", "unit_vector", "local_vector")).alias("pos", "r")).filter("r.mask = 1")
    total = lambda c, k: F.round(F.aggregate(F.transform(F.col(f"r.{c}"), lambda v: v[k]), F.lit(0.0), lambda s, x: s + x) / F.sqrt(F.lit(2.0)), 4)
    return rows.select("query", "slot", "pos", total("unit_vector", 0).alias("ux"), total("local_vector", 1).alias("ly"))
