"""Structures made of the line items: a supplier is a structure, a flag and a status name a chain, and five lines are a residue.

Chains AF and AO are proteins (AO with a selenomethionine now and then), NF is RNA, NO is DNA, RF has ligands, RO ions and waters. Residues
follow each other along x as in a backbone, chains lie 4 apart along y, and discounts and taxes shift the atoms a little. In some
structures AO is broken or runs into AF, both have a cysteine that leans to the other, and RF has nothing but excluded ligands. ``ATOMS`` is
the same table in SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chem
from ..sources.tables import checkpoint_folder, exists, read_table

CHAINS = ("AF", "AO", "NF", "NO", "RF", "RO")
CODES = {
    "AF": chem.AMINO_ACIDS, "AO": (*chem.AMINO_ACIDS[4:], "UNK", "MSE", "CYS"), "NF": chem.RNA, "NO": chem.DNA, "RF": ("ATP", "HEM", "NAG", "SO4", "GOL"), "RO": ("ZN", "MG", "HOH", "CL", "NA"),
}
EXCLUDED = ("SO4", "GOL", "EDO", "PO4", "ACT")
SPECIAL = {"GLY": ("N", "CA", "C", "O", "HA"), "CYS": ("N", "CA", "C", "CB", "SG"), "ARG": ("N", "CA", "CD", "NH1", "NH2"), "MSE": ("N", "CA", "C", "CB", "SE"), "PHE": ("CA", "CB", "C", "CD1", "CD2"), "HOH": ("O", "H1", "H2", "O2", "H3")}
NAMES = {"AF": ("N", "CA", "C", "CB", "O"), "AO": ("N", "CA", "C", "CB", "O"), "NF": ("P", "C4'", "C3'", "C1'", "O3'"), "NO": ("P", "C4'", "C3'", "C1'", "O3'"), "RF": ("C1", "C2", "O1", "N1", "H1"), "RO": ("M1", "M2", "M3", "M4", "M5")}
SHIFT = ((-1.2, 0.0, 1.3, 0.3, 1.9), (0.3, 0.0, 0.4, 1.2, 0.1), (0.0, 0.5, 0.0, -0.7, 0.9))


def text(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _sql() -> str:
    codes = " ".join(f"WHEN '{c}' THEN [{text(v)}][(sid * 7 + residue_pos * 3) % {len(v)} + 1]" for c, v in CODES.items())
    special = " ".join(f"WHEN '{c}' THEN [{text(v)}][a + 1]" for c, v in SPECIAL.items())
    names = " ".join(f"WHEN '{c}' THEN [{text(v)}][a + 1]" for c, v in NAMES.items())
    shift = [f"([{', '.join(f'{x}::DOUBLE' for x in v)}])[a + 1]" for v in SHIFT]
    return f"""k AS MATERIALIZED (SELECT l_suppkey::INTEGER AS sid, l_returnflag || l_linestatus AS chain_id, (row_number() OVER (PARTITION BY l_suppkey, l_returnflag, l_linestatus ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax) - 1)::INTEGER AS k, l_discount AS d, l_tax AS t FROM lineitem),
r AS (SELECT *, k // 5 AS residue_pos, k % 5 AS a, list_position([{text(CHAINS)}], chain_id) - 1 AS ci FROM k),
c AS (SELECT *, CASE WHEN ci < 2 AND residue_pos = 2 AND sid % 2 = 0 THEN 'CYS' WHEN chain_id = 'RF' AND sid % 3 = 0 THEN [{text(EXCLUDED)}][(sid + residue_pos) % 5 + 1] ELSE CASE chain_id {codes} END END AS residue FROM r),
n AS (SELECT *, CASE residue {special} ELSE CASE chain_id {names} END END AS atom FROM c),
atoms AS MATERIALIZED (SELECT 's' || lpad(sid::VARCHAR, 6, '0') AS structure_id, chain_id, residue_pos, residue_pos + 1 AS seq_id, residue, a AS atom_pos, atom, CASE WHEN residue IN ('ZN', 'MG', 'CL', 'NA') THEN residue WHEN atom = 'SE' THEN 'SE' ELSE substr(atom, 1, 1) END AS element,
  3.8::DOUBLE * residue_pos + {shift[0]} + 5 * d + CASE WHEN chain_id = 'AO' AND sid % 5 = 0 AND residue_pos >= 10 THEN 12.0::DOUBLE ELSE 0.0::DOUBLE END AS x,
  4.0::DOUBLE * ci + {shift[1]} + 5 * t - CASE WHEN chain_id = 'AO' AND sid % 4 = 1 THEN 3.7::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN residue_pos = 2 AND atom = 'SG' AND chain_id = 'AF' THEN 1.0::DOUBLE WHEN residue_pos = 2 AND atom = 'SG' AND chain_id = 'AO' THEN -0.9::DOUBLE ELSE 0.0::DOUBLE END AS y,
  {shift[2]} + 0.01::DOUBLE * (sid % 7) AS z, t AS tax, chain_id LIKE 'R%' AS is_hetero, sid FROM n)"""


ATOMS = _sql()


_kept: dict[tuple[str, str], str] = {}


def atoms(spark, d: str) -> DataFrame:
    """The atom table of ``sources.structures``, made once for a session and folder and kept in the checkpoint folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _kept or not exists(spark, _kept[key]):
        path = f"{checkpoint_folder(spark)}/structures-{uuid.uuid4()}"
        made(spark, d).write.parquet(path)
        _kept[key] = path
    return spark.read.parquet(_kept[key])


def made(spark, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    w = Window.partitionBy("l_suppkey", "l_returnflag", "l_linestatus").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    k = li.select(F.col("l_suppkey").cast("int").alias("sid"), F.concat("l_returnflag", "l_linestatus").alias("chain_id"), (F.row_number().over(w) - 1).alias("k"), F.col("l_discount").alias("d"), F.col("l_tax").alias("t"))
    # Lists of lists are literals and looked up by place: chains of CASE over them make a method too large to be compiled.
    listed = lambda rows: F.array(*(F.array(*map(F.lit, r)) for r in rows))
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), i + 1)
    r = k.withColumns({"residue_pos": F.floor(F.col("k") / 5).cast("int"), "a": (F.col("k") % 5).cast("int"), "ci": F.array_position(F.array(*map(F.lit, CHAINS)), F.col("chain_id")).cast("int") - 1})
    codes = F.get(listed(CODES[c] for c in CHAINS), F.col("ci"))
    many = F.get(F.array(*(F.lit(len(CODES[c])) for c in CHAINS)), F.col("ci"))
    code = F.element_at(codes, ((F.col("sid") * 7 + F.col("residue_pos") * 3) % many).cast("int") + 1)
    cysteine = (F.col("ci") < 2) & (F.col("residue_pos") == 2) & (F.col("sid") % 2 == 0)
    c = r.withColumn("residue", F.when(cysteine, "CYS").when((F.col("chain_id") == "RF") & (F.col("sid") % 3 == 0), pick(EXCLUDED, ((F.col("sid") + F.col("residue_pos")) % 5).cast("int"))).otherwise(code))
    special = F.coalesce(F.array_position(F.array(*map(F.lit, SPECIAL)), F.col("residue")), F.lit(0)).cast("int")
    names = F.get(listed([*(NAMES[c] for c in CHAINS), *SPECIAL.values()]), F.when(special > 0, special + len(CHAINS) - 1).otherwise(F.col("ci")))
    n = c.withColumn("atom", F.element_at(names, F.col("a") + 1))
    broken, clash = (F.col("chain_id") == "AO") & (F.col("sid") % 5 == 0) & (F.col("residue_pos") >= 10), (F.col("chain_id") == "AO") & (F.col("sid") % 4 == 1)
    dx, dy, dz = (pick(v, F.col("a")) for v in SHIFT)
    sulfur = (F.col("residue_pos") == 2) & (F.col("atom") == "SG")
    lean = F.when(sulfur & (F.col("chain_id") == "AF"), 1.0).when(sulfur & (F.col("chain_id") == "AO"), -0.9).otherwise(0.0)
    return n.select(
        F.concat(F.lit("s"), F.lpad(F.col("sid").cast("string"), 6, "0")).alias("structure_id"), "chain_id", F.col("chain_id").alias("label_chain_id"), F.substring("chain_id", 1, 1).alias("entity_id"), (F.col("residue_pos") + 1).alias("seq_id"), F.lit("").alias("ins_code"),
        "residue", "residue_pos", "atom", F.col("a").alias("atom_pos"), F.when(F.col("residue").isin("ZN", "MG", "CL", "NA"), F.col("residue")).when(F.col("atom") == "SE", "SE").otherwise(F.substring("atom", 1, 1)).alias("element"),
        (3.8 * F.col("residue_pos") + dx + 5 * F.col("d") + F.when(broken, 12.0).otherwise(0.0)).alias("x"), (4.0 * F.col("ci") + dy + 5 * F.col("t") - F.when(clash, 3.7).otherwise(0.0) + lean).alias("y"), (dz + 0.01 * (F.col("sid") % 7)).alias("z"),
        F.lit(1.0).alias("occupancy"), (F.col("t") * 100).alias("b_factor"), F.lit(0).alias("charge"), F.col("chain_id").startswith("R").alias("is_hetero"), F.lit("").alias("alt_loc"), F.col("k").alias("serial"),
    )
