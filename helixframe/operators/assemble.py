"""Model inputs: one row a structure, its token and atom features as arrays in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chem
from .structures import BACKBONE, RESIDUE, without_hydrogens
from .structures import tokens as made_tokens

# Elements in order of atomic number, as far as structures have them.
ELEMENTS = (
    "H", "HE", "LI", "BE", "B", "C", "N", "O", "F", "NE", "NA", "MG", "AL", "SI", "P", "S", "CL", "AR", "K", "CA", "SC", "TI", "V", "CR", "MN", "FE",
    "CO", "NI", "CU", "ZN", "GA", "GE", "AS", "SE", "BR", "KR", "RB", "SR", "Y", "ZR", "NB", "MO", "TC", "RU", "RH", "PD", "AG", "CD", "IN", "SN",
    "SB", "TE", "I", "XE",
)
AMBIGUOUS = {"ARG": ("NH1", "NH2"), "ASP": ("OD1", "OD2"), "GLU": ("OE1", "OE2"), "LEU": ("CD1", "CD2"), "PHE": ("CD1", "CD2", "CE1", "CE2"), "TYR": ("CD1", "CD2", "CE1", "CE2"), "VAL": ("CG1", "CG2")}
# End of fixed values.


def element_index(element):
    """The place in the list, whatever the case; unknown elements are one past its end."""
    return chem.lookup({e: i for i, e in enumerate(ELEMENTS)}, F.upper(element), len(ELEMENTS))


def token_columns(tokens: DataFrame) -> DataFrame:
    """Chain numbers by first appearance, kinds as masks, and the pseudo-beta's place (the centre's)."""
    first = F.min("token").over(Window.partitionBy("structure_id", "chain_id"))
    asym = F.dense_rank().over(Window.partitionBy("structure_id").orderBy("__first")) - 1
    masks = {f"is_{k}": (F.col("kind") == k.upper()).cast("int") for k in ("protein", "rna", "dna", "ligand", "ion")}
    return tokens.withColumn("__first", first).withColumn("asym_id", asym).withColumns(masks).drop("__first")


def token_features(tokens: DataFrame) -> DataFrame:
    """Arrays by token. Of tokens that have their atoms (``members``, by ``atom_entry``) those by atom too."""
    t = token_columns(tokens)
    names = ["token", "seq_id", "asym_id", "restype", "is_protein", "is_rna", "is_dna", "is_ligand", "is_ion", "n_atoms"]
    atoms = ["members"] if "members" in tokens.columns else []
    entry = F.struct("token", *(F.col(n).alias(f"f_{n}") for n in names), F.array("x", "y", "z").alias("f_centre"), *atoms)
    rows = t.groupBy("structure_id").agg(F.sort_array(F.collect_list(entry)).alias("r"))
    if atoms:
        rows = rows.withColumns({"m": F.flatten("r.members"), "__to": F.flatten(F.transform("r", lambda x: F.transform(x["members"], lambda _: x["token"])))})
    return rows.select(
        "structure_id", F.size("r").alias("n_tokens"), *(F.col(f"r.f_{n}").alias("atoms_in_token" if n == "n_atoms" else n) for n in (*names, "centre")),
        *([F.size("m").alias("n_atoms"), F.col("__to").alias("atom_to_token"), *(F.col(f"m.{n}").alias(f"atom_{n}") for n in OF_ATOM)] if atoms else []),
    )


#: What an atom's entry has after its place in the token.
OF_ATOM = ("pos", "element", "name", "charge", "frame", "ambiguous", "exists")


def atom_entry(*first: str) -> Column:
    kind = chem.chain_type(F.col("residue"))
    frame = F.when(kind == "PROTEIN", F.col("atom").isin(*BACKBONE["PROTEIN"])).when(kind.isin("RNA", "DNA"), F.col("atom").isin(*BACKBONE["RNA"])).otherwise(F.col("atom_pos") < 3)
    twofold = F.lit(False)
    for residue, names in AMBIGUOUS.items():
        twofold = F.when(F.col("residue") == residue, F.col("atom").isin(*names)).otherwise(twofold)
    exists = ~(F.isnan("x") | F.isnan("y") | F.isnan("z"))
    return F.struct(*first, "atom_pos", F.array("x", "y", "z").alias("pos"), element_index(F.col("element")).alias("element"), chem.atom_name_codes(F.col("atom")).alias("name"), "charge", frame.cast("int").alias("frame"), twofold.cast("int").alias("ambiguous"), exists.cast("int").alias("exists"))


def atom_features(atoms: DataFrame, tokens: DataFrame) -> DataFrame:
    """Heavy atoms in token order: place, element, name codes, charge, token, residue's number, whether they are in the frame or ambiguous."""
    keys = tokens.select(*RESIDUE, "token", F.col("atom").alias("__atom"))
    joined = without_hydrogens(atoms).join(keys.hint("merge"), RESIDUE).filter(F.col("__atom").isNull() | (F.col("__atom") == F.col("atom")))
    rows = joined.groupBy("structure_id").agg(F.array_sort(F.collect_list(atom_entry("token"))).alias("r"))
    return rows.select("structure_id", F.size("r").alias("n_atoms"), *(F.col(f"r.{n}").alias(f"atom_{n}" if n != "token" else "atom_to_token") for n in ("token", *OF_ATOM)))


def assembled(atoms: DataFrame, tokens: DataFrame | None = None, bonds: DataFrame | None = None) -> DataFrame:
    """Token and atom features of each structure, and its bonded token pairs. All joins here merge: rows with arrays are larger than their files let expect.

    Without ``tokens`` they are made here and keep their atoms, so that all features come from one exchange of the atoms; tokens that are given are joined with these.
    """
    out = token_features(made_tokens(atoms, atom_entry())) if tokens is None else token_features(tokens).hint("merge").join(atom_features(atoms, tokens), "structure_id")
    if bonds is not None:
        pairs = bonds.groupBy("structure_id").agg(F.array_sort(F.collect_list(F.struct("token_1", "token_2"))).alias("token_bonds"))
        out = out.join(pairs.hint("merge"), "structure_id", "left")
    return out
