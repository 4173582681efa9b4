"""Model inputs: one row a structure with its tokens, atoms, frames, alignments, templates and bonds, in one co-partitioned plan.

Every input goes through one exchange, by ``structure_id``; all that follows (residues, running numbers, columns of alignments,
the row of a structure and the joins of the inputs) keeps that partitioning. A structure's tokens are the array's places, so that
crops and pair features are functions of the row and need no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chem, sequences
from .assemble import AMBIGUOUS, element_index
from .structures import CHAIN, NUCLEIC, RESIDUE, let, without_hydrogens

# Atoms of a token's frame, and between which angles it counts; the gap's code, classes, template slots.
FRAME = {"PROTEIN": ("N", "CA", "C"), "RNA": ("C1'", "C3'", "C4'"), "DNA": ("C1'", "C3'", "C4'")}
ANGLES = (25.0, 155.0)
GAP, CLASSES, SLOTS = 31, 32, 4
# End of fixed values.
MOST_ROWS = 16_384


def by_structure(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The one exchange of an input."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "structure_id")


def _place(names: Column, name: str) -> Column:
    """Where a name stands first (from 0), null where it doesn't."""
    return F.nullif(F.array_position(names, F.lit(name)).cast("int"), F.lit(0)) - 1


def _is_place(a: Column) -> Column:
    return ~(F.isnan(a["x"]) | F.isnan(a["y"]) | F.isnan(a["z"]))


def _minus(a: Column, b: Column) -> Column:
    return F.array(*(a[c] - b[c] for c in "xyz"))


def _dot(u: Column, v: Column) -> Column:
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def _bent(a: Column, b: Column, c: Column) -> Column:
    """Whether the angle at ``b`` is between the bounds."""

    def inside(u: Column, v: Column) -> Column:
        lengths = F.sqrt(_dot(u, u)), F.sqrt(_dot(v, v))
        cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(u, v) / (lengths[0] * lengths[1])))
        angle = F.degrees(F.acos(cosine))
        return (lengths[0] >= 1e-8) & (lengths[1] >= 1e-8) & ~F.isnan(angle) & (angle > ANGLES[0]) & (angle < ANGLES[1])

    return let(_minus(a, b), lambda u: let(_minus(c, b), lambda v: inside(u, v)))


def _frame(atoms: Column, at: Column) -> Column:
    """The places ``at`` (a, b, c; null where there is none) if they make a frame, else null."""
    good = (F.size(F.array_compact(at)) == 3) & _is_place(atoms[at[0]]) & _is_place(atoms[at[1]]) & _is_place(atoms[at[2]])
    return F.when(good & _bent(atoms[at[0]], atoms[at[1]], atoms[at[2]]), at)


def _nearest_frame(atoms: Column, centre: Column) -> Column:
    """The two nearest other atoms of the residue around ``centre``, of equal distances the first in the file."""

    def squared(i: Column) -> Column:
        return let(_minus(atoms[i], atoms[centre]), lambda v: _dot(v, v))

    others = F.filter(F.sequence(F.lit(0), F.size(atoms) - 1), lambda i: (i != centre) & _is_place(atoms[i]))
    near = F.array_sort(F.transform(others, lambda i: F.struct(squared(i).alias("d"), i.alias("i"))))
    return let(near, lambda n: F.array(F.get(n, F.lit(0))["i"], centre, F.get(n, F.lit(1))["i"]))


def residue_blocks(atoms: DataFrame, frames: bool = True) -> DataFrame:
    """Residues with their heavy atoms in order, the number of their first token and atom, and ``frames``: for each token the places of its frame's atoms or null.

    A standard residue is one token; of others every atom is. A polymer token's frame has fixed atoms, any other's its atom and the two
    nearest ones of the residue. An atom name that is repeated counts once, where it stands first. ``frames`` may be left out.
    """
    entry = F.struct("atom_pos", "atom", "element", "x", "y", "z", "charge")
    one = without_hydrogens(atoms).groupBy(*RESIDUE).agg(F.min("seq_id").alias("seq_id"), F.min("residue").alias("residue"), F.array_sort(F.collect_list(entry)).alias("atoms"))
    standard, kind = chem.is_standard_residue(F.col("residue")), chem.chain_type(F.col("residue"))
    own = one.withColumns({"standard": standard, "kind": chem.token_kind(F.col("residue")), "restype": chem.restype_index(F.col("residue")), "n_atoms": F.size("atoms")})
    own = own.withColumn("n_tokens", F.when(F.col("standard"), 1).otherwise(F.col("n_atoms")))
    names = F.transform("atoms", lambda a: a["atom"])
    fixed = lambda n: F.coalesce(*(F.when(kind.isin(*kinds), F.array(*(_place(n, x) for x in FRAME[kinds[0]]))) for kinds in (("PROTEIN",), NUCLEIC)))
    framed = F.when(F.col("standard"), F.array(_frame(F.col("atoms"), let(names, fixed)))).otherwise(F.transform(F.sequence(F.lit(0), F.col("n_atoms") - 1), lambda t: let(_nearest_frame(F.col("atoms"), t), lambda at: _frame(F.col("atoms"), at))))
    order = Window.partitionBy("structure_id").orderBy("chain_id", "residue_pos").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(order), F.lit(0)).cast("int")
    asym = F.dense_rank().over(Window.partitionBy("structure_id").orderBy("chain_id")) - 1
    return (own.withColumn("frames", framed) if frames else own).withColumns({"first_token": before("n_tokens"), "first_atom": before("n_atoms"), "asym_id": asym})


def token_frames(blocks: DataFrame) -> DataFrame:
    """``structure_id, token, has_frame, frame_atoms``: the flat numbers of the atoms a, b, c, or -1."""
    tokens = blocks.select("structure_id", "first_token", "first_atom", F.posexplode("frames").alias("i", "frame"))
    flat = F.transform(F.coalesce("frame", F.array(*[F.lit(-1)] * 3)), lambda p: F.when(F.col("frame").isNotNull(), p + F.col("first_atom")).otherwise(-1))
    return tokens.select("structure_id", (F.col("first_token") + F.col("i")).alias("token"), F.col("frame").isNotNull().cast("int").alias("has_frame"), flat.alias("frame_atoms"))


def _centre(b: Column) -> Column:
    """A token's centre for each token of a residue."""
    named = F.when(b["kind"] == "PROTEIN", "CA").when(b["kind"].isin(*NUCLEIC), "C1'")
    at = let(F.filter(b["atoms"], lambda a: a["atom"] == named), lambda f: F.coalesce(F.get(f, F.lit(0)), b["atoms"][0]))
    place = lambda a: F.array(a["x"], a["y"], a["z"])
    return F.when(b["standard"], F.array(place(at))).otherwise(F.transform(b["atoms"], place))


def _beta(b: Column) -> Column:
    """A protein token's beta carbon (alpha of glycine or where there is none), null for others."""
    named = lambda n: F.get(F.filter(b["atoms"], lambda a: a["atom"] == n), F.lit(0))
    beta = F.coalesce(F.when(b["residue"] != "GLY", named("CB")), named("CA"))
    return F.when(b["standard"] & (b["kind"] == "PROTEIN"), let(beta, lambda a: F.when(a.isNotNull(), F.array(a["x"], a["y"], a["z"]))))


def structure_rows(blocks: DataFrame) -> DataFrame:
    """A row a structure: token arrays, atom arrays (flat, with ``atom_to_token``), frames, chains; ``r`` keeps its residues in order."""
    names = ("chain_id", "residue_pos", "seq_id", "residue", "kind", "standard", "restype", "n_atoms", "n_tokens", "first_token", "first_atom", "asym_id", "atoms", *(["frames"] if "frames" in blocks.columns else []))
    rows = blocks.groupBy("structure_id").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("r"))

    def per_token(f) -> Column:
        return F.flatten(F.transform("r", lambda b: F.array_repeat(f(b), b["n_tokens"])))

    def per_atom(f) -> Column:
        return F.flatten(F.transform("r", lambda b: F.transform(b["atoms"], lambda a, i: f(b, a, i))))

    twofold = lambda b, a: F.coalesce(*(F.when(b["residue"] == code, a["atom"].isin(*names)) for code, names in AMBIGUOUS.items()), F.lit(False)).cast("int")
    flat = lambda b: F.transform(b["frames"], lambda f: F.transform(F.coalesce(f, F.array(*[F.lit(-1)] * 3)), lambda p: F.when(p < 0, -1).otherwise(p + b["first_atom"])))
    chains = F.array_distinct(F.transform("r", lambda b: F.struct(b["asym_id"].alias("asym_id"), b["chain_id"].alias("chain_id"))))
    tokens = {
        "seq_id": per_token(lambda b: b["seq_id"]), "asym_id": per_token(lambda b: b["asym_id"]), "restype": per_token(lambda b: b["restype"]), "kind": per_token(lambda b: b["kind"]),
        "atoms_in_token": F.flatten(F.transform("r", lambda b: F.when(b["standard"], F.array(b["n_atoms"])).otherwise(F.array_repeat(F.lit(1), b["n_tokens"])))),
        "centre": F.flatten(F.transform("r", _centre)), "pseudo_beta": per_token(_beta), **({"frame_atoms": F.flatten(F.transform("r", flat))} if "frames" in names else {}),
    }
    atoms = {
        "atom_to_token": per_atom(lambda b, a, i: b["first_token"] + F.when(b["standard"], 0).otherwise(i)), "atom_pos": per_atom(lambda b, a, i: F.array(a["x"], a["y"], a["z"])), "atom_element": per_atom(lambda b, a, i: element_index(a["element"])),
        "atom_name": per_atom(lambda b, a, i: chem.atom_name_codes(a["atom"])), "atom_charge": per_atom(lambda b, a, i: a["charge"]), "atom_ambiguous": per_atom(lambda b, a, i: twofold(b, a)),
    }
    out = rows.select("structure_id", "r", chains.alias("chains"), *(c.alias(n) for n, c in (tokens | atoms).items()))
    masks = {"pseudo_beta_mask": F.transform("pseudo_beta", lambda p: p.isNotNull().cast("int"))}
    if "frames" in names:
        masks["has_frame"] = F.transform("frame_atoms", lambda f: (f[0] >= 0).cast("int"))
    return out.withColumns({"n_tokens": F.size("restype"), "n_atoms": F.size("atom_to_token"), **masks})


def alignment_columns(alignments: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """A row a structure with ``msa``: chain -> its columns in order, each with ``codes`` and ``deletions`` of the first rows, ``profile`` and ``deletion_mean`` of all.

    ``alignments`` has ``structure_id, chain_id, row, sequence, deletions``; column i belongs to the chain's residue i (``alignments.on_residues`` makes it so).
    """
    cells = alignments.select(*CHAIN, "row", F.posexplode(F.arrays_zip(sequences.residue_codes(F.col("sequence")).alias("code"), F.coalesce("deletions", F.array().cast("array<int>")).alias("d"))).alias("pos", "c"))
    column = F.array_sort(F.collect_list(F.struct("row", F.col("c.code").alias("code"), F.coalesce("c.d", F.lit(0)).alias("d"))))
    one = cells.groupBy(*CHAIN, "pos").agg(column.alias("cells"))
    codes, deletions = F.transform("cells", lambda x: x["code"]), F.transform("cells", lambda x: x["d"])
    share = F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda k: (F.size("codes") - F.size(F.array_remove(F.col("codes"), k))) / F.size("codes"))
    mean = F.aggregate("deletions", F.lit(0.0), lambda s, d: s + d) / F.size("deletions")
    known = one.select(*CHAIN, "pos", codes.alias("codes"), deletions.alias("deletions")).withColumns({"profile": share, "deletion_mean": mean})
    entry = F.struct("pos", F.slice("codes", 1, most_rows).alias("codes"), F.slice("deletions", 1, most_rows).alias("deletions"), "profile", "deletion_mean")
    chains = known.groupBy(*CHAIN).agg(F.array_sort(F.collect_list(entry)).alias("columns"))
    return chains.groupBy("structure_id").agg(F.map_from_entries(F.collect_list(F.struct("chain_id", "columns"))).alias("msa_of"))


def template_rows(templates: DataFrame) -> DataFrame:
    """A row a structure with ``templates_of``: ``chain|slot`` -> its places on the query and features. ``templates`` has ``structure_id, chain_id, slot, pos, aatype, pseudo_beta, pseudo_beta_mask, frame_mask``."""
    entry = F.struct("pos", "aatype", "pseudo_beta", "pseudo_beta_mask", "frame_mask")
    one = templates.groupBy(*CHAIN, "slot").agg(F.array_sort(F.collect_list(entry)).alias("t"))
    key = F.concat("chain_id", F.lit("|"), F.col("slot").cast("string"))
    value = F.struct(F.transform("t", lambda x: x["pos"]).alias("pos"), F.col("t").alias("features"))
    return one.groupBy("structure_id").agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("templates_of"))


def model_inputs(atoms: DataFrame, alignments: DataFrame | None = None, templates: DataFrame | None = None, bonds: DataFrame | None = None, most_rows: int = MOST_ROWS, slots: int = SLOTS, partitions: int | None = None, frames: bool = True) -> DataFrame:
    """All features of each structure of ``atoms``; those of frames (``frame_atoms``, ``has_frame``) may be left out.

    ``bonds`` has ``structure_id, token_1, token_2``. ``msa`` and ``deletions`` are by token, then by row: the chains' alignments stand next to
    each other by row, and a shorter one (or a chain without one) has gaps. Template features are by slot, then by token; a residue that a template
    has no place for has the gap's class and masks of 0. Tokens of one residue share its column and template places.
    """
    out = structure_rows(residue_blocks(by_structure(atoms, partitions), frames))
    if alignments is not None:
        out = out.join(alignment_columns(by_structure(alignments, partitions), most_rows), "structure_id", "left")
        rows = F.coalesce(F.array_max(F.transform(F.flatten(F.map_values("msa_of")), lambda c: F.size(c["codes"]))), F.lit(0))
        columns = F.flatten(F.transform("r", lambda b: F.array_repeat(F.get(F.try_element_at("msa_of", b["chain_id"]), b["residue_pos"]), b["n_tokens"])))
        out = out.withColumns({"n_rows": rows, "__columns": columns})
        filled = lambda values, gap: F.slice(F.concat(F.coalesce(values, F.array().cast("array<int>")), F.array_repeat(F.lit(gap), F.col("n_rows"))), F.lit(1), F.col("n_rows"))
        none = F.array_repeat(F.lit(0.0), CLASSES)
        out = out.withColumns({
            "msa": F.transform("__columns", lambda c: filled(c["codes"], GAP)), "deletions": F.transform("__columns", lambda c: filled(c["deletions"], 0)), "profile": F.transform("__columns", lambda c: F.coalesce(c["profile"], none)),
            "deletion_mean": F.transform("__columns", lambda c: F.coalesce(c["deletion_mean"], F.lit(0.0))),
        }).drop("__columns", "msa_of")
        out = out.withColumn("has_deletion", F.transform("deletion_mean", lambda d: (d > 0).cast("int")))
    if templates is not None:
        out = out.join(template_rows(by_structure(templates, partitions)), "structure_id", "left")

        def slot(s: Column) -> Column:
            def of(b: Column) -> Column:
                own = F.try_element_at("templates_of", F.concat(b["chain_id"], F.lit("|"), s.cast("string")))
                found = let(own, lambda t: F.get(t["features"], (F.array_position(t["pos"], b["residue_pos"]) - 1).cast("int")))
                return F.array_repeat(found, b["n_tokens"])

            return F.flatten(F.transform("r", of))

        out = out.withColumn("__slots", F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), slot))
        each = lambda f: F.transform("__slots", lambda s: F.transform(s, f))
        zero = F.array(*[F.lit(0.0)] * 3)
        out = out.withColumns({
            "template_aatype": each(lambda t: F.coalesce(t["aatype"], F.lit(GAP))), "template_pseudo_beta": each(lambda t: F.coalesce(t["pseudo_beta"], zero)),
            "template_pseudo_beta_mask": each(lambda t: F.coalesce(t["pseudo_beta_mask"], F.lit(0))), "template_frame_mask": each(lambda t: F.coalesce(t["frame_mask"], F.lit(0))),
        }).drop("__slots", "templates_of")
    if bonds is not None:
        pairs = by_structure(bonds, partitions).groupBy("structure_id").agg(F.array_sort(F.collect_set(F.struct("token_1", "token_2"))).alias("token_bonds"))
        out = out.join(pairs, "structure_id", "left").withColumn("token_bonds", F.coalesce("token_bonds", F.array().cast("array<struct<token_1:int,token_2:int>>")))
    return out.drop("r")


BY_TOKEN = ("seq_id", "asym_id", "restype", "kind", "atoms_in_token", "centre", "pseudo_beta", "frame_atoms", "pseudo_beta_mask", "has_frame", "msa", "deletions", "profile", "deletion_mean", "has_deletion")
BY_ATOM = ("atom_to_token", "atom_pos", "atom_element", "atom_name", "atom_charge", "atom_ambiguous")
BY_SLOT = ("template_aatype", "template_pseudo_beta", "template_pseudo_beta_mask", "template_frame_mask")


def cropped_inputs(inputs: DataFrame, kept: DataFrame, partitions: int | None = None) -> DataFrame:
    """Model inputs of the tokens that ``kept`` (``structure_id, token``) names, in order, numbered anew; a structure of which none is kept goes.

    A frame of which an atom is cropped is none any more, as is a bond of which a token is.
    """
    chosen = by_structure(kept.select("structure_id", "token"), partitions).groupBy("structure_id").agg(F.array_sort(F.collect_set("token")).alias("__kept"))
    out = inputs.join(chosen, "structure_id").withColumn("__kept", F.filter("__kept", lambda t: (t >= 0) & (t < F.col("n_tokens"))))
    out = out.withColumn("__new", F.transform(F.sequence(F.lit(0), F.col("n_tokens") - 1), lambda t: F.array_position("__kept", t).cast("int") - 1))
    out = out.withColumn("__atoms", F.filter(F.sequence(F.lit(0), F.col("n_atoms") - 1), lambda a: F.col("__new")[F.col("atom_to_token")[a]] >= 0))
    pick = lambda values, at: F.transform(at, lambda i: F.get(values, i))
    there = set(inputs.columns)
    out = out.withColumns({c: pick(F.col(c), F.col("__kept")) for c in BY_TOKEN if c in there} | {c: F.transform(c, lambda s: pick(s, F.col("__kept"))) for c in BY_SLOT if c in there} | {c: pick(F.col(c), F.col("__atoms")) for c in BY_ATOM})
    out = out.withColumns({"atom_to_token": F.transform("atom_to_token", lambda t: F.col("__new")[t]), "n_tokens": F.size("__kept"), "n_atoms": F.size("__atoms")})
    if "frame_atoms" in there:
        place = lambda a: F.when(a < 0, -1).otherwise(F.array_position("__atoms", a).cast("int") - 1)
        frames = F.transform("frame_atoms", lambda f: let(F.transform(f, place), lambda g: F.when(F.array_min(g) >= 0, g).otherwise(F.array(*[F.lit(-1)] * 3))))
        out = out.withColumn("frame_atoms", frames).withColumn("has_frame", F.transform("frame_atoms", lambda f: (f[0] >= 0).cast("int")))
    if "token_bonds" in there:
        moved = F.transform("token_bonds", lambda b: F.struct(F.col("__new")[b["token_1"]].alias("token_1"), F.col("__new")[b["token_2"]].alias("token_2")))
        out = out.withColumn("token_bonds", F.filter(moved, lambda b: (b["token_1"] >= 0) & (b["token_2"] >= 0)))
    return out.filter(F.col("n_tokens") > 0).drop("__kept", "__new", "__atoms")


def with_pairs(inputs: DataFrame, most: int = 32) -> DataFrame:
    """``relative_position``, ``same_chain`` and ``distogram`` (null on the diagonal) of all token pairs, as a matrix in the row; meant for cropped inputs."""
    # Tokens are structs that the two loops go over: looking each value up by its number would take most of the time.
    tokens = F.arrays_zip(F.col("seq_id").alias("seq"), F.col("asym_id").alias("asym"))
    centres = F.transform("centre", lambda c: F.struct(*(c[k].alias(x) for k, x in enumerate("xyz"))))
    matrix = lambda values, f: let(values, lambda v: F.transform(v, lambda a, i: F.transform(v, lambda b, j: f(a, b, i, j))))
    apart = lambda a, b: F.sqrt(sum(((a[x] - b[x]) * (a[x] - b[x]) for x in "xyz"), F.lit(0.0)))
    return inputs.withColumns({
        "relative_position": matrix(tokens, lambda a, b, i, j: chem.relative_position(a["seq"], b["seq"], a["asym"] == b["asym"], most)), "same_chain": matrix(tokens, lambda a, b, i, j: (a["asym"] == b["asym"]).cast("int")),
        "distogram": matrix(centres, lambda a, b, i, j: F.when(i != j, chem.distance_bin(apart(a, b)))),
    })
