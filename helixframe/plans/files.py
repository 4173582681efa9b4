"""Queries of sources and sinks: tables are written in a format, read back and compared with what they were."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import search
from ..operators import structures as S
from ..sources import alignments as L
from ..sources import components as C
from ..sources import mmcif, storage, store
from ..sources import structures as M
from ..sources.tables import checkpoint_folder, exists, read_table
from ..streaming import files as X
from .base import Queries
from .features import MSA_SQL, msa
from .fixture import ATOMS, atoms
from .structures import ASYM, TOKENS, toks

q = Queries()
QUERIES, ORACLES = q.queries, q.oracles
MSA = f"WITH {MSA_SQL}"
PIECES = "regexp_extract_all(regexp_replace(sequence, '[^A-Za-z-]', '', 'g'), '[a-z]*[A-Z-]')"


def folder(spark) -> str:
    return f"{checkpoint_folder(spark)}/files-{uuid.uuid4()}"


def lines(df: DataFrame, spark, order: str, files: int = 4) -> str:
    """The column ``value`` as text files, each with a range of rows in order (one where rows belong to what others began)."""
    path = folder(spark)
    df.repartitionByRange(files, order).sortWithinPartitions(order).select("value").write.text(path)
    return path


# Alignments and lists


def alignment_files(spark, d: str, form: str) -> str:
    path = folder(spark)
    store.write_alignments(msa(spark, d).withColumn("description", F.concat(F.lit("p"), F.col("row").cast("string"))), path, form)
    return path


@q(f"{MSA} SELECT msa, \"row\", 'p' || \"row\" AS description, array_to_string(list_transform({PIECES}, lambda x: right(x, 1)), '') AS sequence, array_to_string(list_transform({PIECES}, lambda x: length(x) - 1), ',') AS deletions FROM m")
def a10_read_a3m(spark, d: str) -> DataFrame:
    out = store.read_alignments(spark, alignment_files(spark, d, "a3m"))
    return out.select(F.col("msa").cast("int").alias("msa"), "row", "description", "sequence", F.array_join(F.col("deletions").cast("array<string>"), ",").alias("deletions"))


@q(f"{MSA} SELECT msa, \"row\", 'p' || \"row\" AS id, sequence FROM m")
def a12_read_stockholm(spark, d: str) -> DataFrame:
    return store.read_alignments(spark, alignment_files(spark, d, "stockholm"), "stockholm").select(F.col("msa").cast("int").alias("msa"), "row", "id", "sequence")


for _name in ("a13_a3m_text", "a41_written_alignments"):
    q.put(
        _name, lambda spark, d: spark.read.text(alignment_files(spark, d, "a3m") + "/msa=*/", wholetext=True).select(F.md5("value").alias("digest"), F.length("value").alias("n")),
        f"{MSA} SELECT md5(t) AS digest, length(t)::INTEGER AS n FROM (SELECT string_agg('>p' || \"row\" || chr(10) || sequence, chr(10) ORDER BY \"row\") || chr(10) AS t FROM m GROUP BY msa)",
    )


@q(f"{MSA} SELECT msa, count(*) AS n, md5(string_agg(sequence, ',' ORDER BY \"row\")) AS digest FROM m GROUP BY 1")
def a42_alignments_as_json(spark, d: str) -> DataFrame:
    rows = spark.read.json(alignment_files(spark, d, "json") + "/msa=*/").select("msa", F.posexplode("rows").alias("pos", "r"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("r.sequence").alias("s")))), lambda x: x["s"]), ",")
    return rows.groupBy(F.col("msa").cast("int").alias("msa")).agg(F.count("*").alias("n"), F.md5(ordered).alias("digest"))


@q("SELECT p_brand AS id, arg_max(repeat(replace(p_name, ' ', ''), 20), p_partkey) AS sequence FROM part GROUP BY 1")
def a14_last_fasta_records(spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("id"), F.repeat("p_name", F.lit(20)).alias("sequence"))
    path = folder(spark)
    L.write_fasta(p.repartition(1).sortWithinPartitions("p_partkey"), path)
    return L.read_fasta(spark, path, keep="last").select("id", "sequence")


@q("SELECT p_partkey, rtrim(regexp_replace(repeat(p_name, 20), '(.{80})', '\\1' || chr(10), 'g'), chr(10)) AS wrapped FROM part")
def a22_wrapped_fasta(spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part").select("p_partkey", L.fasta_text(F.lit("id"), F.repeat("p_name", F.lit(20))).alias("t"))
    return p.select("p_partkey", F.regexp_replace("t", "^>id\n", "").alias("wrapped"))


def pairs_file(spark, d: str) -> str:
    """Lines of a brand and a size; short lines between."""
    p = read_table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 == 0, F.col("p_brand")).otherwise(F.concat_ws("\t", "p_brand", F.concat(F.lit(" "), F.col("p_size").cast("string")))).alias("value"))
    return lines(p, spark, "p_partkey")


for _name in ("a19_clusters_of_sequences", "a23_mapping"):
    q.put(_name, lambda spark, d: L.read_mapping(spark, pairs_file(spark, d)), "SELECT p_brand AS key, arg_max(p_size, p_partkey)::VARCHAR AS value FROM part WHERE p_partkey % 10 <> 0 GROUP BY 1")


@q("SELECT p_brand AS key, arg_min(p_size, p_partkey)::INTEGER AS size FROM part WHERE p_partkey % 10 <> 0 GROUP BY 1")
def a20_cluster_sizes(spark, d: str) -> DataFrame:
    return L.read_mapping(spark, pairs_file(spark, d), last=False).select("key", F.col("value").cast("int").alias("size"))


@q("WITH f AS (SELECT p_brand, min(p_partkey) AS f FROM part GROUP BY 1), n AS (SELECT p_brand, 'cluster_' || (row_number() OVER (ORDER BY f) - 1) AS cluster FROM f) SELECT p_brand AS representative, p_partkey::VARCHAR AS member, cluster FROM part JOIN n USING (p_brand)")
def a21_clusters(spark, d: str) -> DataFrame:
    p = read_table(spark, d, "part").select("p_partkey", F.concat_ws("\t", "p_brand", F.col("p_partkey").cast("string")).alias("value"))
    return L.read_clusters(spark, lines(p, spark, "p_partkey"))


@q("SELECT DISTINCT upper('x' || s_nationkey) AS pdb_id FROM supplier WHERE s_suppkey % 2 = 0")
def a24_obsolete_entries(spark, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier").select("s_suppkey", F.concat_ws(" ", F.when(F.col("s_suppkey") % 2 == 0, "OBSLTE").otherwise("HEADER"), F.lit("31-JUL-94"), F.concat(F.lit("x"), F.col("s_nationkey").cast("string")), F.lit("1new")).alias("value"))
    return L.read_obsolete(spark, lines(s, spark, "s_suppkey"))


@q("SELECT s_name AS pdb_id, 'A' AS chain_id, 'SEQ' AS sequence, s_suppkey::VARCHAR AS \"start\", s_nationkey::VARCHAR AS \"end\" FROM supplier WHERE s_suppkey % 5 <> 1")
def a18_disorder_annotations(spark, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 5 == 1, F.col("s_name")).otherwise(F.concat_ws("\t", "s_name", F.lit("A"), F.lit("SEQ"), F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string"))).alias("value"))
    head = spark.createDataFrame([(-1, "pdb\tchain\tsequence\tstart\tend")], "s_suppkey long, value string")
    return L.read_disorder(spark, lines(head.unionByName(s), spark, "s_suppkey", 1))


MOTIF = "(SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS pos, p_size / 2.0::DOUBLE AS a, p_size / 4.0::DOUBLE AS c, 1.0::DOUBLE AS g, 0.5::DOUBLE AS t FROM part)"


def motif_rows(spark, d: str) -> DataFrame:
    at = F.row_number().over(Window.partitionBy("p_type").orderBy("p_partkey")) - 1
    return read_table(spark, d, "part").select("p_type", at.alias("pos"), (F.col("p_size") / 2.0).alias("a"), (F.col("p_size") / 4.0).alias("c"), F.lit(1.0).alias("g"), F.lit(0.5).alias("t"))


@q(f"SELECT p_type AS motif, 'name' AS name, pos::INTEGER AS pos, a, c, g, t FROM {MOTIF}")
def a17_read_meme(spark, d: str) -> DataFrame:
    rows = motif_rows(spark, d).withColumn("value", F.concat_ws(" ", *(F.col(b).cast("string") for b in "acgt")))
    heads = rows.select("p_type").distinct().select(F.concat(F.col("p_type"), F.lit("|0000000")).alias("at"), F.concat(F.lit("MOTIF "), "p_type", F.lit(" name")).alias("value"))
    body = rows.select(F.concat("p_type", F.lit("|"), F.lpad((F.col("pos") + 1).cast("string"), 7, "0")).alias("at"), "value")
    return L.read_meme(spark, lines(heads.unionByName(body), spark, "at", 1))


@q(f"SELECT p_type AS motif, 'name' AS name, pos::INTEGER AS pos, a, c, g, t FROM {MOTIF}")
def a16_motifs_as_json(spark, d: str) -> DataFrame:
    listed = lambda b: F.transform(F.array_sort(F.collect_list(F.struct("pos", b))), lambda x: x[b]).alias(b.upper())
    out = motif_rows(spark, d).groupBy(F.col("p_type").alias("matrix_id")).agg(*(listed(b) for b in "acgt"))
    text = out.select("matrix_id", F.to_json(F.struct("matrix_id", F.lit("name").alias("name"), F.struct("A", "C", "G", "T").alias("pfm"))).alias("value"))
    path = folder(spark)
    text.select(F.concat(F.lit("["), F.array_join(F.collect_list("value").over(Window.partitionBy("matrix_id")), ","), F.lit("]")).alias("value"), "matrix_id").write.partitionBy("matrix_id").text(path)
    return L.read_motif_json(spark, path + "/*/")


HIT = "(SELECT p_partkey, 'x' || p_partkey || '_B/1-9' AS id, replace(p_name, ' ', '-') AS sequence, p_size / 8.0::DOUBLE AS e_value, p_retailprice AS score FROM part WHERE p_partkey % 2 = 0)"


@q("SELECT 'x' || p_partkey || '_B' AS name, p_size / 8.0::DOUBLE AS e_value, p_retailprice AS score FROM part WHERE p_partkey % 4 = 0")
def a27_hit_table(spark, d: str) -> DataFrame:
    return L.read_tblout(spark, hit_files(spark, d)[1]).select("name", "e_value", "score")


def hit_files(spark, d: str) -> tuple[str, str]:
    p = read_table(spark, d, "part")
    name = F.concat(F.lit("x"), F.col("p_partkey").cast("string"), F.lit("_B"))
    sto = p.filter("p_partkey % 2 = 0").select("p_partkey", F.concat(name, F.lit("/1-9 "), F.translate("p_name", " ", "-")).alias("value"))
    tbl = p.filter("p_partkey % 4 = 0").select("p_partkey", F.concat_ws("  ", name, F.lit("-"), F.lit("query"), F.lit("-"), (F.col("p_size") / 8.0).cast("string"), F.col("p_retailprice").cast("string"), F.lit("0.0")).alias("value"))
    head = spark.createDataFrame([(-1, "# STOCKHOLM 1.0")], "p_partkey long, value string")
    return lines(head.unionByName(sto), spark, "p_partkey", 1), lines(head.unionByName(tbl), spark, "p_partkey", 1)


@q(f"SELECT 'x' || p_partkey AS pdb_id, 'B' AS chain_id, sequence, CASE WHEN p_partkey % 4 = 0 THEN e_value ELSE 1.0::DOUBLE END AS e_value, CASE WHEN p_partkey % 4 = 0 THEN score ELSE 0.0::DOUBLE END AS score FROM {HIT}")
def a28_template_hits(spark, d: str) -> DataFrame:
    sto, tbl = hit_files(spark, d)
    return L.template_hits(L.read_stockholm(spark, sto), L.read_tblout(spark, tbl)).select("pdb_id", "chain_id", "sequence", "e_value", "score")


# Structure files: the fixture's structures as mmCIF text


def contents(spark, d: str) -> DataFrame:
    """``path`` and ``content``. In every fourth residue the second atom has another place, with more weight; resolutions stand under three keys."""
    a = atoms(spark, d)
    text = lambda c: F.concat(F.lit("'"), c, F.lit("'")) if c == "atom" else F.col(c).cast("string")
    quoted = F.when(F.contains("atom", F.lit("'")), F.concat(F.lit('"'), "atom", F.lit('"'))).otherwise(F.col("atom"))
    row = lambda alt, x, weight: F.concat_ws(" ", F.when(F.col("is_hetero"), "HETATM").otherwise("ATOM"), F.col("serial").cast("string"), F.col("element"), F.lit(alt), F.col("residue"), quoted, F.col("chain_id"), F.col("entity_id"), F.col("seq_id").cast("string"), F.lit("?"), x.cast("string"), text("y"), text("z"), F.lit(weight), F.lit("."))
    other = (F.col("atom_pos") == 1) & (F.col("residue_pos") % 4 == 0)
    rows = F.when(other, F.concat(row("A", F.col("x") + 1, "0.4"), F.lit("\n"), row("B", F.col("x"), "0.6"))).otherwise(row(".", F.col("x"), "1.0"))
    body = a.groupBy("structure_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chain_id", "serial", rows.alias("t")))), lambda r: r["t"]), "\n").alias("body"))
    n = F.substring("structure_id", 2, 6).cast("int")
    names = "group_PDB id type_symbol label_alt_id auth_comp_id auth_atom_id auth_asym_id label_entity_id auth_seq_id pdbx_PDB_ins_code Cartn_x Cartn_y Cartn_z occupancy B_iso_or_equiv".split()
    key = F.element_at(F.array(*map(F.lit, ("_refine.ls_d_res_high", "_em_3d_reconstruction.resolution", "_reflns.d_resolution_high"))), n % 3 + 1)
    head = F.concat(F.lit("data_"), "structure_id", F.lit("\n_exptl.method 'X-ray diffraction'\n"), key, F.lit(" "), (n % 8 / 2).cast("string"), F.lit("\n_pdbx_database_status.recvd_initial_deposition_date "), F.format_string("20%02d-3-%d", n % 20, n % 28 + 1))
    conn = F.lit("\nloop_\n_struct_conn.conn_type_id\n_struct_conn.ptnr1_auth_asym_id\n_struct_conn.ptnr1_auth_seq_id\n_struct_conn.ptnr1_label_atom_id\n_struct_conn.ptnr2_auth_asym_id\n_struct_conn.ptnr2_auth_seq_id\n_struct_conn.ptnr2_label_atom_id\ncovale AF 3 CA RF 1 C1\nhydrog AF 1 N AO 1 O\nmetalc AO 2 O RO 4 M1\ncovale AF x N AO 1 O\n")
    axes = "\n".join(f"_pdbx_struct_oper_list.{x}" for x in ["id", *(f"matrix[{i}][{j}]" for i in (1, 2, 3) for j in (1, 2, 3)), *(f"vector[{i}]" for i in (1, 2, 3))])
    ops = F.lit(f"loop_\n{axes}\n1 1 0 0 0 1 0 0 0 1 0 0 0\n2 -1 0 0 0 -1 0 0 0 1 0 0 5\nloop_\n_pdbx_struct_assembly_gen.assembly_id\n_pdbx_struct_assembly_gen.oper_expression\n_pdbx_struct_assembly_gen.asym_id_list\n1 1,2 AF,AO\n2 (1-2)(2) NF\n3 7 NF\n")
    loop = F.lit("\nloop_\n" + "\n".join(f"_atom_site.{x}" for x in names) + "\n")
    return body.select(F.concat(F.lit("in/"), "structure_id", F.lit(".cif")).alias("path"), F.concat(head, conn, ops, loop, "body", F.lit("\n#\n")).cast("binary").alias("content"))


STRUCTURES = f"WITH {ATOMS}, s AS (SELECT DISTINCT structure_id, sid FROM atoms)"
_written: dict[tuple[str, str], str] = {}


def structure_files(spark, d: str) -> str:
    """A folder with a file for each structure, made once for a session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _written or not exists(spark, _written[key]):
        path = folder(spark)
        mmcif.write_files(contents(spark, d), path)
        _written[key] = path
    return _written[key]


KNOWN_OF_FILES = "SELECT {} FROM ({} SELECT structure_id, 'X-RAY DIFFRACTION' AS method, sid % 8 / 2.0::DOUBLE AS resolution, '20' || lpad((sid % 20)::VARCHAR, 2, '0') || '-3-' || (sid % 28 + 1) AS release_date, NULL::VARCHAR AS error FROM s)"
for _name, _columns in {"a01_structures": "structure_id, method, resolution, release_date, error", "p08_parsed_structures": "structure_id, resolution, method"}.items():
    q.put(_name, lambda spark, d, columns=_columns: M.parsed(contents(spark, d), *([] if "error" in columns else [""])).select(*columns.split(", ")), KNOWN_OF_FILES.format(_columns, STRUCTURES))
for _name, _columns in {"a06_resolutions": "structure_id, resolution", "a07_deposition_dates": "structure_id, release_date", "p03_methods": "structure_id, method"}.items():
    q.put(_name, lambda spark, d, columns=_columns: mmcif.scan(spark, structure_files(spark, d), "structures", columns.split(", ")), KNOWN_OF_FILES.format(_columns, STRUCTURES))

PLACES = f"WITH {ATOMS} SELECT structure_id, chain_id, residue_pos, seq_id, residue, atom, atom_pos, element, round(x, 6) AS x, round(y, 6) AS y, is_hetero FROM atoms"
for _name in ("a04_atom_rows", "a03_quoted_values"):
    q.put(_name, lambda spark, d: M.atoms(M.parsed(contents(spark, d), "atoms")).select("structure_id", "chain_id", "residue_pos", "seq_id", "residue", "atom", "atom_pos", "element", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "is_hetero"), PLACES)


@q(f"{STRUCTURES} SELECT structure_id, chain_1, seq_1, atom_1, chain_2, seq_2, atom_2, kind FROM s, (VALUES ('AF', 3, 'CA', 'RF', 1, 'C1', 'covale'), ('AO', 2, 'O', 'RO', 4, 'M1', 'metalc')) v(chain_1, seq_1, atom_1, chain_2, seq_2, atom_2, kind)")
def a05_bond_rows(spark, d: str) -> DataFrame:
    return M.bonds(M.parsed(contents(spark, d), "bonds"))


ASSEMBLIES = f"{STRUCTURES} SELECT structure_id, assembly, op, chain_id, t3 FROM s, (VALUES ('1', '1', 'AF', 0.0::DOUBLE), ('1', '1', 'AO', 0.0::DOUBLE), ('1', '2', 'AF', 5.0::DOUBLE), ('1', '2', 'AO', 5.0::DOUBLE), ('2', '1_2', 'NF', 5.0::DOUBLE), ('2', '2_2', 'NF', 10.0::DOUBLE)) v(assembly, op, chain_id, t3)"
for _name in ("a08_assembly_definitions", "p04_assembly_operators", "p05_chosen_assembly", "p09_definitions"):
    q.put(_name, lambda spark, d: mmcif.scan(spark, structure_files(spark, d), "operators", ["structure_id", "assembly", "op", "chain_id", "t3"]), ASSEMBLIES)


@q(f"{STRUCTURES} SELECT structure_id AS pdb_id, make_date(2000 + sid % 20, 3, sid % 28 + 1) AS date FROM s")
def a25_release_dates(spark, d: str) -> DataFrame:
    known = mmcif.scan(spark, structure_files(spark, d), "structures", ["structure_id", "release_date"])
    return known.select(F.col("structure_id").alias("pdb_id"), F.try_to_date("release_date", "yyyy-M-d").alias("date"))


@q("SELECT r_name AS region, n_name AS name, n_nationkey::VARCHAR AS key, '' AS note FROM nation JOIN region ON n_regionkey = r_regionkey")
def a02_star_rows(spark, d: str) -> DataFrame:
    """A file a region with a loop of its nations: quoted names, unknown values, rows over two lines."""
    n = read_table(spark, d, "nation").join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    row = F.concat(F.col("n_nationkey").cast("string"), F.lit("\n'"), "n_name", F.lit("' ?"))
    text = n.groupBy("r_name").agg(F.array_join(F.collect_list(row), "\n").alias("rows"))
    files = text.select(F.col("r_name").alias("path"), F.concat(F.lit("data_x\n# note\nloop_\n_nation.key\n_nation.name\n_nation.note\n"), "rows", F.lit("\n")).cast("binary").alias("content"))
    return M.star_rows(files, "nation").select(F.col("path").alias("region"), *(F.col("values")[c].alias(c) for c in ("name", "key", "note")))


COMPONENT = "data_C{0}\n_chem_comp.id C{0}\n_chem_comp.name 'part {0}'\nloop_\n_chem_comp_atom.atom_id\n_chem_comp_atom.type_symbol\n_chem_comp_atom.charge\n_chem_comp_atom.pdbx_leaving_atom_flag\n_chem_comp_atom.pdbx_model_Cartn_x_ideal\n_chem_comp_atom.pdbx_model_Cartn_y_ideal\n_chem_comp_atom.pdbx_model_Cartn_z_ideal\n_chem_comp_atom.model_Cartn_x\n_chem_comp_atom.model_Cartn_y\n_chem_comp_atom.model_Cartn_z\nC1 C 0 N {0}.5 1.0 2.0 9.0 9.0 9.0\nO1 O -1 Y {1} 2.0 3.0 8.0 8.0 8.0\nH1 H 0 N 0.0 0.0 0.0 0.0 0.0 0.0\nloop_\n_chem_comp_bond.atom_id_1\n_chem_comp_bond.atom_id_2\n_chem_comp_bond.value_order\nC1 O1 SING\nC1 H1 SING\nloop_\n_pdbx_chem_comp_descriptor.type\n_pdbx_chem_comp_descriptor.descriptor\nSMILES 'CO{0}'\n"


def components(spark, d: str) -> DataFrame:
    """A component for each nation in one file; those of odd keys lack an ideal place."""
    n = read_table(spark, d, "nation").withColumn("key", F.col("n_nationkey").cast("string"))
    text = F.replace(F.replace(F.lit(COMPONENT.rstrip("\n")), F.lit("{0}"), F.col("key")), F.lit("{1}"), F.when(F.col("n_nationkey") % 2 == 1, "?").otherwise("4.0"))
    return C.read_components(spark, lines(n.select("n_nationkey", text.alias("value")), spark, "n_nationkey"))


@q("SELECT 'C' || n_nationkey AS code, 'part ' || n_nationkey AS name, 'CO' || n_nationkey AS smiles, 3 AS n_atoms, 2 AS n_bonds FROM nation")
def a29_components(spark, d: str) -> DataFrame:
    return components(spark, d).select("code", "name", "smiles", F.size("atoms").alias("n_atoms"), F.size("bonds").alias("n_bonds"))


IDEAL = "SELECT 'C' || n_nationkey AS code, atom, CASE WHEN n_nationkey % 2 = 1 THEN model ELSE CASE atom WHEN 'C1' THEN n_nationkey + 0.5::DOUBLE ELSE 4.0::DOUBLE END END AS x, CASE WHEN n_nationkey % 2 = 1 THEN 'model' ELSE 'ideal' END AS origin FROM nation, (VALUES ('C1', 9.0::DOUBLE), ('O1', 8.0::DOUBLE)) v(atom, model)"
for _name in ("a30_ideal_places", "l18_ideal_coordinates", "p66_places_of_component"):
    q.put(_name, lambda spark, d: C.conformers(components(spark, d)).select("code", "atom", "x", "origin"), IDEAL)


@q("SELECT 'C' || n_nationkey AS code, 'CO' || n_nationkey AS smiles FROM nation")
def p24_smiles(spark, d: str) -> DataFrame:
    return components(spark, d).select("code", "smiles")


@q("SELECT 'C' || n_nationkey AS code, 'C1' AS atom_1, a AS atom_2, 'SING' AS kind FROM nation, (VALUES ('O1'), ('H1')) v(a)")
def p25_component_bonds(spark, d: str) -> DataFrame:
    return components(spark, d).select("code", F.explode("bonds").alias("b")).select("code", "b.*")


REFERENCE = f"WITH {ATOMS}, m AS (SELECT structure_id, chain_id, residue_pos, avg(x) AS mx FROM atoms GROUP BY 1, 2, 3) SELECT a.structure_id, a.chain_id, a.residue_pos, atom, round(CASE WHEN residue = 'ATP' AND atom = 'C1' THEN 7.5::DOUBLE ELSE x - mx END, 6) + 0.0::DOUBLE AS ref_x, CASE WHEN residue = 'ATP' AND atom = 'C1' THEN 'ideal' ELSE 'observed' END AS origin FROM atoms a JOIN m USING (structure_id, chain_id, residue_pos)"
for _name in ("l19_reference_conformers", "p26_conformers_of_structures"):
    q.put(
        _name, lambda spark, d: C.reference_conformers(atoms(spark, d), spark.createDataFrame([("ATP", "C1", 7.5, 1.0, 2.0, "ideal")], "code string, atom string, x double, y double, z double, origin string")).select(*S.RESIDUE, "atom", F.round("ref_x", 6).alias("ref_x"), "origin"),
        REFERENCE,
    )


# Tables and objects


def objects(spark, root: str, pattern: str = "*") -> DataFrame:
    """``key`` and ``content`` of the objects below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return found.select(F.substring_index("path", f"{root.rsplit('/', 1)[-1]}/", -1).alias("key"), "content")


@q("SELECT 'nation/' || lpad(n_nationkey::VARCHAR, 2, '0') AS key, length(n_name)::INTEGER AS n, md5(n_name) AS digest FROM nation")
def a31_objects(spark, d: str) -> DataFrame:
    """Objects that tasks put and get again; one that is deleted is gone."""
    root = folder(spark)
    n = read_table(spark, d, "nation")
    storage.put_all(n.select(F.format_string("nation/%02d", "n_nationkey").alias("key"), F.col("n_name").cast("binary").alias("content")), root)
    box = storage.create_storage(spark, root)
    box.put("nation/99", b"gone")
    box.delete("nation/99")
    return objects(spark, root).select("key", F.length("content").alias("n"), F.md5("content").alias("digest"))


@q("SELECT 'r' || r_regionkey || '.json' AS key, r_name AS name FROM region")
def a32_listed_objects(spark, d: str) -> DataFrame:
    root = folder(spark)
    r = read_table(spark, d, "region")
    named = r.select(F.format_string("r%d.json", "r_regionkey").alias("key"), F.to_json(F.struct(F.col("r_name").alias("name"))).cast("binary").alias("content"))
    storage.put_all(named.unionByName(r.select(F.format_string("other/%d", "r_regionkey").alias("key"), F.lit(b"").alias("content"))), root)
    return objects(spark, root, "r*.json").select("key", F.get_json_object(F.decode("content", "UTF-8"), "$.name").alias("name"))


for _name, _store, _scheme in (("a33_s3_paths", "s3", "s3a"), ("a34_google_paths", "gcs", "gs"), ("a35_azure_paths", "azure", "abfss"), ("a36_stores", "local", "file")):
    q.put(
        _name, lambda spark, d, s=_store: read_table(spark, d, "supplier").select("s_suppkey", storage.uri(s, "bucket", F.concat(F.lit("in/"), "s_name", F.lit(".cif"))).alias("path")),
        f"SELECT s_suppkey, '{_scheme}://' || {"''" if _store == 'local' else "'bucket'"} || '/' || 'in/' || s_name || '.cif' AS path FROM supplier",
    )


def kept_features(spark, d: str) -> DataFrame:
    from ..operators import assemble

    path = folder(spark)
    store.write_features(assemble.token_features(toks(spark, d)), path)
    return store.read_features(spark, path, ["structure_id", "n_tokens", "restype"]).select("structure_id", "n_tokens", F.array_join(F.col("restype").cast("array<string>"), ",").alias("restype"))


for _name in ("a37_written_features", "a38_read_features"):
    q.put(_name, kept_features, f"{TOKENS}, {ASYM} SELECT structure_id, count(*)::INTEGER AS n_tokens, array_to_string(list(restype ORDER BY token), ',') AS restype FROM asym GROUP BY 1")


def kept_tokens(spark, d: str) -> DataFrame:
    path, t = folder(spark), toks(spark, d)
    store.write_tokens(t, path)
    return store.read_tokens(spark, path, t).select("structure_id", "token", "chain_id", "residue", "kind", "atom", F.round("x", 6).alias("x"))


for _name in ("a39_written_tokens", "a40_read_tokens"):
    q.put(_name, kept_tokens, f"{TOKENS} SELECT structure_id, token, chain_id, residue, kind, atom, round(x, 6) AS x FROM tokens")


def sharded(spark, d: str) -> str:
    path = folder(spark)
    store.write_shards(read_table(spark, d, "orders").select("o_orderkey", "o_totalprice"), path, "o_orderkey", 100)
    return path


SHARD = "(SELECT o_orderkey, o_totalprice, 'shard_' || lpad(((row_number() OVER (ORDER BY o_orderkey) - 1) // 100)::VARCHAR, 6, '0') AS shard FROM orders)"
for _name in ("a43_written_batches", "a46_read_shards"):
    q.put(_name, lambda spark, d: store.read_shards(spark, sharded(spark, d)).select("o_orderkey", "o_totalprice", F.col("shard").cast("string").alias("shard")), f"SELECT * FROM {SHARD}")


@q(f"SELECT o_orderkey, shard FROM {SHARD} WHERE shard IN ('shard_000000', 'shard_000002')")
def a44_some_batches(spark, d: str) -> DataFrame:
    return store.read_shards(spark, sharded(spark, d), ["shard_000000", "shard_000002"]).select("o_orderkey", F.col("shard").cast("string").alias("shard"))


def listing(spark, d: str) -> DataFrame:
    n = read_table(spark, d, "nation")
    return n.select(F.concat(F.lit("in/"), "n_name", F.when(F.col("n_nationkey") % 2 == 0, ".txt").otherwise(".gz.x")).alias("path"), F.col("n_name").cast("binary").alias("content"))


@q("SELECT 'in/' || n_name || CASE WHEN n_nationkey % 2 = 0 THEN '.txt' ELSE '.gz.x' END AS path, upper(n_name) AS result FROM nation")
def a48_processed_objects(spark, d: str) -> DataFrame:
    """Packed, then unpacked on the way to the function."""
    out = X.processed(X.packed(listing(spark, d)), lambda path, content: content.upper())
    return out.filter("ok").select(F.regexp_replace("path", r"\.gz$", "").alias("path"), F.col("result").cast("string").alias("result"))


@q("SELECT 'in/' || n_name || CASE WHEN n_nationkey % 2 = 0 THEN '.txt' ELSE '.gz.x' END || '.gz' AS path, '1f8b' AS magic FROM nation")
def a49_packed_objects(spark, d: str) -> DataFrame:
    return X.packed(listing(spark, d)).select("path", F.lower(F.hex(F.substring("content", 1, 2))).alias("magic"))


@q("SELECT 'in/' || n_name || '.txt' AS path FROM nation WHERE n_nationkey % 2 = 0")
def a47_listed_by_extension(spark, d: str) -> DataFrame:
    return listing(spark, d).filter(F.col("path").endswith(".txt") & (F.length("content") <= X.MOST_BYTES)).select("path")


@q("SELECT n_name AS path FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def a51_to_be_copied(spark, d: str) -> DataFrame:
    n = read_table(spark, d, "nation").select(F.col("n_name").alias("path"), "n_nationkey")
    there = n.join(read_table(spark, d, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"), "left_semi")
    return X.missing(n.select("path"), there)


# Searches where no program is installed: each query's alignment is the query alone


SEARCHED = "SELECT s_suppkey::VARCHAR AS id, false AS found, '>' || s_suppkey || chr(10) || 'ACDEF' || chr(10) AS output, '{} is not installed' AS error FROM supplier"


def queries_of(spark, d: str) -> DataFrame:
    return read_table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("ACDEF").alias("sequence"))


for _name, _search, _program in (
    ("k01_search", "uniref90", "jackhmmer"), ("k03_uniref90", "uniref90", "jackhmmer"), ("k04_uniprot", "uniprot", "jackhmmer"), ("k05_reduced_bfd", "reduced_bfd", "jackhmmer"), ("k06_mgnify", "mgnify", "jackhmmer"), ("k07_hhblits", "bfd", "hhblits"),
    ("k08_uniclust30", "uniclust30", "hhblits"), ("k09_nhmmer", "nt", "nhmmer"), ("k11_rfam", "rfam", "nhmmer"), ("k12_rnacentral", "rnacentral", "nhmmer"), ("k13_nt", "nt", "nhmmer"), ("k15_bfd", "bfd", "hhblits"),
):
    q.put(_name, lambda spark, d, s=_search: search.searched(queries_of(spark, d), search.named_search(s)), SEARCHED.format(_program))
for _name, _command, _program in (("k17_model", lambda x, o, n: search.hmmbuild(x, o), "hmmbuild"), ("k18_protein_clusters", lambda x, o, n: search.mmseqs(x, o, o + "-tmp"), "mmseqs"), ("k19_nucleic_clusters", lambda x, o, n: search.mmseqs(x, o, o + "-tmp", identity=1.0), "mmseqs"), ("p39_mmseqs", lambda x, o, n: search.mmseqs(x, o, o + "-tmp"), "mmseqs"), ("p101_model_of_sequences", lambda x, o, n: search.hmmbuild(x, o), "hmmbuild")):
    q.put(_name, lambda spark, d, c=_command: search.searched(queries_of(spark, d), c), SEARCHED.format(_program))
for _name in ("k10_realigned_hits", "k14_realigned"):
    q.put(
        _name, lambda spark, d: search.realigned(queries_of(spark, d).select("id", F.array(F.lit("query"), F.lit("hit")).alias("names"), F.array("sequence", F.lit("AC-EF")).alias("sequences"))),
        "SELECT s_suppkey::VARCHAR AS id, false AS realigned, '>query' || chr(10) || 'ACDEF' || chr(10) || '>hit' || chr(10) || 'AC-EF' || chr(10) AS output, 'hmmbuild is not installed' AS error FROM supplier",
    )

#: A part is a query of its own: its key names the files, its name's length is the sequence's.
COMMANDS = {
    "k02_jackhmmer_arguments": (lambda i, n: search.jackhmmer(f"q{i}", "d", f"o{i}", 4, 500_000, 138_515_945), "'jackhmmer -N 1 -E 0.0001 --incE 0.0001 --F1 0.0005 --F2 0.00005 --F3 0.0000005 --cpu 4 -A o' || p_partkey || ' --seq_limit 500000 -Z 138515945 q' || p_partkey || ' d'"),
    "p93_hhblits_arguments": (lambda i, n: search.hhblits(f"q{i}", "d", f"o{i}"), "'hhblits -i q' || p_partkey || ' -d d -oa3m o' || p_partkey || ' -n 3 -e 0.001 -cpu 4'"),
    "p94_nhmmer_arguments": (lambda i, n: search.nhmmer(f"q{i}", "d", f"o{i}", 4 * n), "'nhmmer -E 0.001 --incE 0.001 --rna --watson --F3 ' || CASE WHEN 4 * length(p_name) < 50 THEN '0.02' ELSE '0.00005' END || ' --cpu 4 -A o' || p_partkey || ' q' || p_partkey || ' d'"),
    "p108_hmmsearch_arguments": (lambda i, n: search.hmmsearch(f"m{i}", "d", f"a{i}", f"s{i}"), "'hmmsearch --noali --F1 0.1 --F2 0.1 --F3 0.1 -E 100 --incE 100 -Z 10000 --cpu 4 -A a' || p_partkey || ' --tblout s' || p_partkey || ' m' || p_partkey || ' d'"),
}


def commands(spark, d: str, command) -> DataFrame:
    text = F.pandas_udf(lambda i, n: (i.to_frame("i").assign(n=n)).apply(lambda r: " ".join(command(r.i, r.n)), axis=1), "string")
    return read_table(spark, d, "part").select("p_partkey", text("p_partkey", F.length("p_name")).alias("command"))


for _name, (_command, _text) in COMMANDS.items():
    q.put(_name, lambda spark, d, c=_command: commands(spark, d, c), f"SELECT p_partkey, {_text} AS command FROM part")
