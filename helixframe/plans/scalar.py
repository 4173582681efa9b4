"""Queries of scalar functions on the given tables; codes, names and sequences are made from their keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chem, sequences
from ..sources.tables import read_table

CODES = [*chem.AMINO_ACIDS, "UNK", *chem.RNA, *chem.DNA, "HOH", "ZN", "MG", "CL", "SO4", "GOL", "ATP", "HEM", "NAG", "MSE"]
LIST = "[" + ", ".join(f"'{c}'" for c in CODES) + "]"
CODE_SQL = f"{LIST}[(p_partkey % {len(CODES)}) + 1]"


def residues(spark, d: str) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("p_partkey") % len(CODES) + 1).cast("int"))
    return read_table(spark, d, "part").select("p_partkey", "p_size", "p_name", code.alias("code"))


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def sql_map(values: dict, default: str, key: str = "code") -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items())
    return f"CASE {key} {cases} ELSE {default} END"


KIND_SQL = f"CASE WHEN code IN ({sql_list([*chem.AMINO_ACIDS, 'UNK'])}) THEN 'PROTEIN' WHEN code IN ({sql_list(chem.RNA)}) THEN 'RNA' WHEN code IN ({sql_list(chem.DNA)}) THEN 'DNA' WHEN code IN ({sql_list(chem.IONS)}) THEN 'ION' WHEN code IN ('HOH') THEN 'WATER' ELSE 'LIGAND' END"
BASE = f"(SELECT p_partkey, p_size, p_name, {CODE_SQL} AS code FROM part)"
AA = dict(zip(chem.AMINO_ACIDS, chem.AA_LETTERS, strict=True))
INDEX = {r: i for i, r in enumerate(chem.AMINO_ACIDS)} | {r: 21 + i for i, r in enumerate("AGCU")} | {"D" + r: 26 + i for i, r in enumerate("AGCT")}

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


class Names:
    """The columns that the expressions below stand on; made when a session is there."""

    def __init__(self) -> None:
        self.code, self.size, self.name, self.brand = F.col("code"), F.col("p_size"), F.col("p_name"), F.translate("p_brand", "#", "-")
        self.kind = chem.chain_type(self.code)
        self.gapped = F.translate(self.name, "aeiou ", "------")
        self.mirrored = F.reverse(self.gapped)
        self.one_hot = chem.one_hot(chem.restype_index(self.code))


def joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def on_residues(name: str, columns: dict[str, tuple[Callable[[Names], Column], str]]) -> None:
    def query(spark, d: str) -> DataFrame:
        base, n = residues(spark, d), Names()
        return base.select("p_partkey", *(f(n).alias(k) for k, (f, _) in columns.items()))

    QUERIES[name] = query
    ORACLES[name] = "SELECT p_partkey, " + ", ".join(f"{q} AS {k}" for k, (_, q) in columns.items()) + f" FROM {BASE}"


def member(f: Callable[[Column], Column], values) -> dict:
    return {"member": (lambda n: f(n.code), f"upper(code) IN ({sql_list(values)})")}


STANDARD = [*chem.AMINO_ACIDS, "A", "G", "C", "U", "DA", "DG", "DC", "DT"]
BY_KIND = f"CASE {KIND_SQL} WHEN 'PROTEIN' THEN {sql_map({r: i for i, r in enumerate(chem.AMINO_ACIDS)}, '20')} WHEN 'RNA' THEN {sql_map({r: 21 + i for i, r in enumerate('AGCU')}, '25')} WHEN 'DNA' THEN {sql_map({'D' + r: 26 + i for i, r in enumerate('AGCT')}, '30')} ELSE 20 END::INTEGER"
ALPHABET = chem.ATOM_NAME_ALPHABET.replace("'", "''")
GAPPED = "translate(p_name, 'aeiou ', '------')"
PAIR = f"list_zip(string_split({GAPPED}, ''), string_split(reverse({GAPPED}), ''))"
A3M = "regexp_extract_all(regexp_replace(replace(p_brand, '#', '-'), '[^A-Za-z-]', '', 'g'), '[a-z]*[A-Z-]')"


def identity_sql(op: str) -> str:
    either = f"list_filter({PAIR}, lambda p: p[1] <> '-' {op} p[2] <> '-')"
    return f"round(coalesce(len(list_filter({either}, lambda p: p[1] = p[2] AND p[1] <> '-')) / nullif(len({either}), 0), 0), 9)"


on_residues("b01_chain_type", {"kind": (lambda n: n.kind, KIND_SQL)})
on_residues("b03_aa_letter", {"letter": (lambda n: chem.aa_letter(n.code), sql_map(AA, "'X'"))})
on_residues("b04_nucleotide_letter", {"letter": (lambda n: chem.nucleotide_letter(n.code), sql_map(chem.NUCLEOTIDE_LETTERS, "'N'"))})
on_residues("b05_is_peptide", {"peptide": (lambda n: chem.is_peptide(n.kind, n.size), f"({KIND_SQL}) = 'PROTEIN' AND p_size < 16")})
on_residues("b11_crystallization_aid", member(chem.is_crystallization_aid, chem.CRYSTALLIZATION_AIDS))
on_residues("b12_excluded_ligand", member(chem.is_excluded_ligand, chem.EXCLUDED_LIGANDS))
on_residues("b14_is_ion", member(chem.is_ion, chem.IONS))
on_residues("b15_standard_residue", member(chem.is_standard_residue, [*chem.AMINO_ACIDS, "UNK", *chem.RNA, *chem.DNA]))
on_residues("b16_standard_amino_acid", member(chem.is_standard_amino_acid, [*chem.AMINO_ACIDS, "UNK"]))
on_residues("b17_standard_nucleotide", member(chem.is_standard_nucleotide, [*chem.RNA, *chem.DNA]))
on_residues("b18_clustering_threshold", {"threshold": (lambda n: chem.clustering_threshold(n.kind, n.size), f"CASE WHEN ({KIND_SQL}) = 'PROTEIN' AND p_size >= 10 THEN 0.4::DOUBLE ELSE 1.0::DOUBLE END")})
on_residues("b19_filtered_for_training", {"filtered": (lambda n: chem.filtered_for_training(n.code, n.size % 2 == 0), f"upper(code) IN ({sql_list(chem.EXCLUDED_LIGANDS)}) OR (p_size % 2 = 0 AND upper(code) IN ({sql_list(chem.CRYSTALLIZATION_AIDS)}))")})
on_residues("b33_restype_one_hot", {"classes": (lambda n: F.size(F.filter(n.one_hot, lambda x: x == 1)), "1::INTEGER"), "at": (lambda n: F.array_position(n.one_hot, 1.0), f"({sql_map(INDEX, '20')} + 1)::BIGINT")})
on_residues("b34_chain_masks", {f"is_{k}": (lambda n, k=k: (n.kind == k.upper()).cast("int"), f"(({KIND_SQL}) = '{k.upper()}')::INTEGER") for k in ("protein", "rna", "dna", "ligand")})
on_residues("b35_restype_index", {"restype": (lambda n: chem.restype_index(n.code), f"{sql_map(INDEX, '20')}::INTEGER")})
on_residues("b45_restype_by_kind", {"restype": (lambda n: chem.restype_by_kind(n.code, n.kind), BY_KIND)})
on_residues("b47_modified_residue", {"modified": (lambda n: n.kind.isin("PROTEIN", "RNA", "DNA") & ~n.code.isin(*STANDARD), f"({KIND_SQL}) IN ('PROTEIN', 'RNA', 'DNA') AND code NOT IN ({sql_list(STANDARD)})")})
on_residues("b36_atom_name_codes", {"codes": (lambda n: joined(chem.atom_name_codes(n.name)), f"array_to_string(list_transform(range(1, 5), lambda i: greatest(instr('{ALPHABET}', substr(rpad(substr(upper(p_name), 1, 4), 4, ' '), i, 1)) - 1, 0)), ',')")})
on_residues("b22_coverage", {"coverage": (lambda n: F.round(sequences.coverage(n.gapped), 9), f"CASE WHEN length(p_name) = 0 THEN 0 ELSE round(1 - (length(p_name) - length(replace({GAPPED}, '-', ''))) / length(p_name), 9) END")})
on_residues("b23_num_gaps", {"gaps": (lambda n: sequences.gaps(n.gapped), f"(length(p_name) - length(replace({GAPPED}, '-', '')))::INTEGER")})
on_residues("b28_sequence_key", {"key": (lambda n: F.md5(F.upper(n.name)), "md5(upper(p_name))")})
on_residues("b29_deletion_value", {"value": (lambda n: F.round(sequences.deletion_value(n.size), 9), "round(2 / pi() * atan(p_size / 3), 9)")})
on_residues("b20_sequence_identity", {"identity": (lambda n: F.round(sequences.identity(n.gapped, n.mirrored), 9), identity_sql("OR"))})
on_residues("b21_template_identity", {"identity": (lambda n: F.round(sequences.aligned_identity(n.gapped, n.mirrored), 9), identity_sql("AND"))})
on_residues("b32_msa_codes", {"codes": (lambda n: joined(sequences.msa_codes(n.gapped)), f"array_to_string(list_transform(string_split(upper({GAPPED}), ''), lambda c: CASE WHEN instr('{sequences.MSA_ALPHABET}', c) > 0 THEN instr('{sequences.MSA_ALPHABET}', c) - 1 ELSE 21 END), ',')")})
on_residues("b41_safe_filename", {"name": (lambda n: sequences.safe_filename(F.concat(F.lit(" .<"), n.name, F.lit("?*."))), "coalesce(nullif(substr(regexp_replace(trim(regexp_replace(' .<' || p_name || '?*.', '[<>:\"/\\\\|?*\\x00-\\x1f]', '_', 'g'), '. '), '[_]+', '_', 'g'), 1, 255), ''), 'unnamed')")})
on_residues("b37_distance_bin", {"bin": (lambda n: chem.distance_bin(n.size * 1.3), "greatest(0, least(38, floor((p_size * 1.3::DOUBLE - 3.25::DOUBLE) / 1.25::DOUBLE)))::INTEGER")})
on_residues("f09_resolution_weight", {"weight": (lambda n: F.round(chem.resolution_weight(n.size / 5), 9), "round(CASE WHEN p_size = 0 THEN 1.0 WHEN p_size / 5 >= 9 THEN 0.1 ELSE 1 - 0.9::DOUBLE * (p_size / 5) / 9 END, 9)::DOUBLE")})
ORACLES["a11_a3m_sequence"] = f"SELECT p_partkey, array_to_string(list_transform({A3M}, lambda x: right(x, 1)), '') AS aligned, array_to_string(list_transform({A3M}, lambda x: length(x) - 1), ',') AS deletions FROM part"


def a11_a3m_sequence(spark, d: str) -> DataFrame:
    part, brand = read_table(spark, d, "part"), F.translate("p_brand", "#", "-")
    return part.select("p_partkey", sequences.a3m_aligned(brand).alias("aligned"), joined(sequences.a3m_deletions(brand)).alias("deletions"))


def b24_species(spark, d: str) -> DataFrame:
    turns = read_table(spark, d, "conversations")
    described = F.concat_ws(" ", F.lit("sp|P1|X"), F.when(F.col("turn") % 3 == 0, F.concat(F.lit("OS="), "role", F.lit(" TAX="))).when(F.col("turn") % 3 == 1, F.concat(F.lit("["), "role", F.lit("]"))).otherwise(F.col("text")))
    return turns.select("conv_id", "turn", sequences.species(described).alias("species"), sequences.accession(described).alias("accession"))


QUERIES |= {"a11_a3m_sequence": a11_a3m_sequence, "b24_species": b24_species}
_SPECIES = "coalesce(" + ", ".join(f"nullif(trim(regexp_extract(t, '{p}', 1)), '')" for p in sequences.SPECIES) + ")"
ORACLES["b24_species"] = f"SELECT conv_id, turn, {_SPECIES} AS species, coalesce(nullif(regexp_extract(t, '{sequences.ACCESSION}', 1), ''), regexp_split_to_array(trim(t), '\\s+')[1]) AS accession FROM (SELECT *, 'sp|P1|X ' || CASE turn % 3 WHEN 0 THEN 'OS=' || role || ' TAX=' WHEN 1 THEN '[' || role || ']' ELSE text END AS t FROM conversations)"
