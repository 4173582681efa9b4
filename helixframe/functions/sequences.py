"""Column expressions over sequences, alignments and their descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of species and accessions in descriptions, and alphabets.
SPECIES = (r"OS=([^=]+?)(?:\s+[A-Z]{2}=|$)", r"\[([^\]]+)\]", r"_([A-Z0-9]{3,5})(?:\s|$)")
OTHER_SPECIES = r"_([A-Z]+)\s"
ACCESSION = r"(?:sp|tr)\|([^|]+)\|"
MSA_ALPHABET = "ARNDCQEGHILKMFPSTWYV-X"
# End of fixed values.


def letters(s: Column) -> Column:
    """The characters, none for an empty string."""
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, ""))


def gaps(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit("-"), F.lit("")))


def coverage(s: Column) -> Column:
    return F.when(F.length(s) == 0, 0.0).otherwise(1 - gaps(s) / F.length(s))


def cluster_key(s: Column) -> Column:
    """Case and gaps do not count. (Lower case: it is the same in all engines.)"""
    return F.lower(F.replace(s, F.lit("-"), F.lit("")))


def _share(a: Column, b: Column, both: bool) -> Column:
    pairs = F.arrays_zip(letters(a).alias("x"), letters(b).alias("y"))
    counted = F.filter(pairs, lambda p: (p["x"] != "-") & (p["y"] != "-") if both else (p["x"] != "-") | (p["y"] != "-"))
    same = F.filter(counted, lambda p: (p["x"] == p["y"]) & (p["x"] != "-"))
    return F.when(F.length(a) != F.length(b), 0.0).otherwise(F.coalesce(F.size(same) / F.nullif(F.size(counted), F.lit(0)), F.lit(0.0)))


def identity(a: Column, b: Column) -> Column:
    """Equal letters by positions where either has a letter; 0 for other lengths."""
    return _share(a, b, both=False)


def aligned_identity(a: Column, b: Column) -> Column:
    """Equal letters by positions where both have a letter."""
    return _share(a, b, both=True)


def species(description: Column, patterns: tuple[str, ...] = SPECIES) -> Column:
    """The first pattern that finds something."""
    return F.coalesce(*(F.nullif(F.trim(F.regexp_extract(description, p, 1)), F.lit("")) for p in patterns))


def accession(description: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(description, ACCESSION, 1), F.lit("")), F.get(F.split(F.trim(description), r"\s+"), F.lit(0)))


def deletion_value(count: Column) -> Column:
    return 2 / F.pi() * F.atan(count / 3)


def a3m_columns(s: Column) -> Column:
    """An A3M row's aligned columns; each piece ends in the column and begins with its insertions."""
    return F.regexp_extract_all(F.regexp_replace(s, "[^A-Za-z-]", ""), F.lit("[a-z]*[A-Z-]"), 0)


def a3m_deletions(s: Column) -> Column:
    return F.transform(a3m_columns(s), lambda x: F.length(x) - 1)


def a3m_aligned(s: Column) -> Column:
    return F.array_join(F.transform(a3m_columns(s), lambda x: F.right(x, F.lit(1))), "")


def msa_codes(s: Column) -> Column:
    """Places in the alignment alphabet; other letters count as X."""
    last = len(MSA_ALPHABET) - 1
    return F.transform(letters(F.upper(s)), lambda c: F.when(F.instr(F.lit(MSA_ALPHABET), c) > 0, F.instr(F.lit(MSA_ALPHABET), c) - 1).otherwise(last))


def safe_filename(name: Column, replacement: str = "_", most: int = 255) -> Column:
    """A name without reserved characters, with runs of the replacement made one and blanks and dots cut at the ends."""
    clean = F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]', replacement)
    clean = F.regexp_replace(F.btrim(clean, F.lit(". ")), f"[{replacement}]+", replacement)
    return F.coalesce(F.nullif(F.substring(clean, 1, most), F.lit("")), F.lit("unnamed"))


def fasta_wrapped(s: Column, width: int = 80) -> Column:
    return F.regexp_replace(s, f"(.{{{width}}})(?=.)", "$1\n")


def species_or_empty(description: Column, patterns: tuple[str, ...] = SPECIES) -> Column:
    """The first pattern that matches, even if it finds nothing but blanks."""
    return F.coalesce(*(F.when(F.regexp_like(description, F.lit(p)), F.trim(F.regexp_extract(description, p, 1))) for p in patterns))


def other_species(description: Column) -> Column:
    """As ``species``, but a mnemonic of any length that a blank follows."""
    return species(description, (*SPECIES[:2], OTHER_SPECIES))


def gap_runs(s: Column) -> Column:
    """For each place the length of the run of gaps that ends there, where a letter follows; else 0."""
    pieces = F.regexp_extract_all(s, F.lit("-*[^-]|-+$"), 0)
    zeros = lambda n: F.array_repeat(F.lit(0), n)
    cells = lambda p: F.when(p.endswith("-"), zeros(F.length(p))).when(F.length(p) == 1, zeros(F.lit(1))).otherwise(F.concat(zeros(F.length(p) - 2), F.array(F.length(p) - 1), zeros(F.lit(1))))
    return F.flatten(F.transform(pieces, cells))


def residue_codes(s: Column, gap: int = 31) -> Column:
    """0 to 19 for the amino acids' letters in any case, ``gap`` for a gap, 20 for all else."""
    alphabet = MSA_ALPHABET[:20]
    return F.transform(letters(F.upper(s)), lambda c: F.when(c == "-", gap).when(F.instr(F.lit(alphabet), c) > 0, F.instr(F.lit(alphabet), c) - 1).otherwise(20))


def sequence_codes(s: Column) -> Column:
    """The same by letter as it stands: lower case and gaps are unknown."""
    alphabet = MSA_ALPHABET[:20]
    return F.transform(letters(s), lambda c: F.when(F.instr(F.lit(alphabet), c) > 0, F.instr(F.lit(alphabet), c) - 1).otherwise(20))


def has_deletion(deletions: Column) -> Column:
    return F.transform(deletions, lambda d: (d > 0).cast("int"))


def deletion_values(deletions: Column) -> Column:
    return F.transform(deletions, deletion_value)
