"""Column expressions over residue, chain and atom codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes and cut-offs that results depend on.
AMINO_ACIDS = ("ALA", "ARG", "ASN", "ASP", "CYS", "GLN", "GLU", "GLY", "HIS", "ILE", "LEU", "LYS", "MET", "PHE", "PRO", "SER", "THR", "TRP", "TYR", "VAL")
UNKNOWN_AMINO_ACID = "UNK"
RNA, DNA = ("A", "G", "C", "U", "N"), ("DA", "DG", "DC", "DT", "DN")
AA_LETTERS = "ARNDCQEGHILKMFPSTWYV"
NUCLEOTIDE_LETTERS = {"A": "A", "G": "G", "C": "C", "U": "U", "DA": "A", "DG": "G", "DC": "C", "DT": "T"}
WATER = ("HOH",)
IONS = (
    "AG", "AL", "AU", "BA", "BR", "CA", "CD", "CE", "CL", "CO", "CR", "CS", "CU", "DY", "EU", "F", "FE", "GA", "GD", "HG", "IN", "IR", "K", "LA",
    "LI", "LU", "MG", "MN", "MO", "NA", "NI", "OS", "PB", "PD", "PR", "PT", "RB", "RU", "SB", "SM", "SR", "TB", "TH", "TL", "V", "W", "Y", "YB",
    "ZN", "ZR",
)
CRYSTALLIZATION_AIDS = (
    "SO4", "GOL", "EDO", "PO4", "ACT", "PEG", "DMS", "TRS", "PGE", "PG4", "FMT", "EPE", "MPD", "MES", "CD", "IOD",
)
EXCLUDED_LIGANDS = (
    "144", "15P", "1PE", "2F2", "2JC", "3HR", "3SY", "7N5", "7PE", "9JE", "AAE", "ABA", "ACE", "ACN", "ACT", "ACY", "AZI", "BAM", "BCN", "BCT",
    "BDN", "BEN", "BME", "BO3", "BTB", "BTC", "BU1", "C8E", "CAD", "CAQ", "CBM", "CCN", "CIT", "CL", "CLR", "CM", "CMO", "CO3", "CPT", "CXS", "D10",
    "DEP", "DIO", "DMS", "DN", "DOD", "DOX", "EDO", "EEE", "EGL", "EOH", "EOX", "EPE", "ETF", "FCY", "FJO", "FLC", "FMT", "FW5", "GOL", "GSH", "GTT",
    "GYF", "HED", "IHP", "IHS", "IMD", "IOD", "IPA", "IPH", "LDA", "MB3", "MEG", "MES", "MLA", "MLI", "MOH", "MPD", "MRD", "MSE", "MYR", "N", "NA",
    "NH2", "NH4", "NHE", "NO3", "O4B", "OHE", "OLA", "OLC", "OMB", "OME", "OXA", "P6G", "PE3", "PE4", "PEG", "PEO", "PEP", "PG0", "PG4", "PGE",
    "PGR", "PLM", "PO4", "POL", "POP", "PVO", "SAR", "SCN", "SEO", "SEP", "SIN", "SO4", "SPD", "SPM", "SR", "STE", "STO", "STU", "TAR", "TBU", "TME",
    "TPO", "TRS", "UNK", "UNL", "UNX", "UPL", "URE",
)
MAX_RESOLUTION, TRAINING_CUTOFF = 9.0, "2021-09-30"
PEPTIDE_RESIDUES, PEPTIDE_CLUSTER_RESIDUES, PROTEIN_IDENTITY = 16, 10, 0.4
ATOM_NAME_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 '"
# End of fixed values.


def lookup(values: dict, key: Column, default=None) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    found = F.element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def chain_type(residue: Column) -> Column:
    """The kind of chain that a residue belongs to; the order of the tests is part of the result."""
    return (
        F.when(residue.isin(*AMINO_ACIDS, UNKNOWN_AMINO_ACID), "PROTEIN").when(residue.isin(*RNA), "RNA").when(residue.isin(*DNA), "DNA")
        .when(residue.isin(*IONS), "ION").when(residue.isin(*WATER), "WATER").otherwise("LIGAND")
    )


def aa_letter(residue: Column) -> Column:
    return lookup(dict(zip(AMINO_ACIDS, AA_LETTERS, strict=True)), residue, "X")


def nucleotide_letter(residue: Column) -> Column:
    return lookup(NUCLEOTIDE_LETTERS, residue, "N")


def letter(residue: Column, kind: Column) -> Column:
    return F.when(kind == "PROTEIN", aa_letter(residue)).when(kind.isin("RNA", "DNA"), nucleotide_letter(residue)).otherwise("X")


def restype_index(residue: Column) -> Column:
    """0-19 amino acids, 20 unknown, 21-24 RNA, 26-29 DNA."""
    index = {r: i for i, r in enumerate(AMINO_ACIDS)} | {r: 21 + i for i, r in enumerate("AGCU")} | {"D" + r: 26 + i for i, r in enumerate("AGCT")}
    return lookup(index, residue, 20)


def restype_by_kind(residue: Column, kind: Column) -> Column:
    """The index with an unknown of its own for each kind: 20 protein, 25 RNA, 30 DNA."""
    aa = {r: i for i, r in enumerate(AMINO_ACIDS)}
    return (
        F.when(kind == "PROTEIN", lookup(aa, residue, 20))
        .when(kind == "RNA", lookup({r: 21 + i for i, r in enumerate("AGCU")}, residue, 25))
        .when(kind == "DNA", lookup({"D" + r: 26 + i for i, r in enumerate("AGCT")}, residue, 30)).otherwise(20)
    )


def one_hot(index: Column, classes: int = 32) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.when(i == index, 1.0).otherwise(0.0))


def is_crystallization_aid(code: Column) -> Column:
    return F.upper(code).isin(*CRYSTALLIZATION_AIDS)


def is_excluded_ligand(code: Column) -> Column:
    return F.upper(code).isin(*EXCLUDED_LIGANDS)


def is_ion(code: Column) -> Column:
    return F.upper(code).isin(*IONS)


def is_standard_amino_acid(code: Column) -> Column:
    return F.upper(code).isin(*AMINO_ACIDS, UNKNOWN_AMINO_ACID)


def is_standard_nucleotide(code: Column) -> Column:
    return F.upper(code).isin(*RNA, *DNA)


def is_standard_residue(code: Column) -> Column:
    return F.upper(code).isin(*AMINO_ACIDS, UNKNOWN_AMINO_ACID, *RNA, *DNA)


def filtered_for_training(code: Column, crystallography: Column) -> Column:
    return is_excluded_ligand(code) | (crystallography & is_crystallization_aid(code))


def clustering_threshold(kind: Column, residues: Column) -> Column:
    return F.when((kind == "PROTEIN") & (residues >= PEPTIDE_CLUSTER_RESIDUES), PROTEIN_IDENTITY).otherwise(1.0)


def is_peptide(kind: Column, residues: Column) -> Column:
    return (kind == "PROTEIN") & (residues < PEPTIDE_RESIDUES)


def atom_name_codes(name: Column) -> Column:
    """Four places of an atom's name in the name alphabet; other characters count as the first."""
    padded = F.rpad(F.substring(F.upper(name), 1, 4), 4, " ")
    return F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.greatest(F.instr(F.lit(ATOM_NAME_ALPHABET), F.substring(padded, i, F.lit(1))) - 1, F.lit(0)))


def resolution_weight(resolution: Column) -> Column:
    return F.when(resolution.isNull() | (resolution == 0), 1.0).when(resolution >= MAX_RESOLUTION, 0.1).otherwise(1 - 0.9 * resolution / MAX_RESOLUTION)


def distance_bin(distance: Column, bins: int = 39, low: float = 3.25, width: float = 1.25) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((distance - low) / width).cast("int")))


def relative_position(a: Column, b: Column, same: Column, most: int = 32) -> Column:
    """The clipped difference of residue numbers, or its own class for another chain."""
    return F.when(same, F.greatest(F.lit(-most), F.least(F.lit(most), b - a)) + most).otherwise(2 * most + 1)


def kind_masks(kind: Column, kinds: tuple[str, ...] = ("protein", "rna", "dna", "ligand")) -> dict[str, Column]:
    """``is_protein`` and so on, 0 or 1."""
    return {f"is_{k}": (kind == k.upper()).cast("int") for k in kinds}


def is_modified(code: Column, kind: Column) -> Column:
    """A residue of a polymer that is none of its standard ones (unknown ones count as modified)."""
    return kind.isin("PROTEIN", "RNA", "DNA") & ~code.isin(*AMINO_ACIDS, *RNA[:-1], *DNA[:-1])


def clustering_threshold_by_kind(kind: Column) -> Column:
    return F.when(kind == "PROTEIN", PROTEIN_IDENTITY).otherwise(1.0)


def fine_distance_bin(distance: Column, bins: int = 39, low: float = 3.25, high: float = 50.75) -> Column:
    """Bins between evenly spaced edges, both of them among the edges."""
    return distance_bin(distance, bins, low, (high - low) / bins)


def template_distance_bin(distance: Column, bins: int = 64, high: float = 22.0) -> Column:
    """From 0; all beyond is in the last bin."""
    return F.least(F.lit(bins - 1), F.floor(distance / (high / bins)).cast("int"))


def token_kind(code: Column) -> Column:
    """The kind of a token: its polymer's for a standard residue, else ion or ligand."""
    kind = chain_type(code)
    return F.when(is_standard_residue(code), kind).when(kind == "ION", "ION").otherwise("LIGAND")
