"""Clean-up, filters, tokens, interfaces and bonds on the atom table of ``sources.structures``.

A residue is (structure_id, chain_id, residue_pos). Each operator takes and gives whole tables, for all structures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chem
from . import spatial
from .relational import majority

RESIDUE = ["structure_id", "chain_id", "residue_pos"]
CHAIN = ["structure_id", "chain_id"]
# Frame atoms and distances.
BACKBONE = {"PROTEIN": ("N", "CA", "C"), "RNA": ("P", "C4'", "C3'"), "DNA": ("P", "C4'", "C3'")}
CENTRE = {"PROTEIN": "CA", "RNA": "C1'", "DNA": "C1'"}
MAX_CA_DISTANCE, BOND, CLASH, CLASH_SHARE, INTERFACE, CONTACT = 10.0, 2.4, 1.7, 0.3, 5.0, 8.0
DISULFIDE, GLYCOSIDIC = (1.8, 2.3), 1.6
# End of fixed values.


def without_waters(atoms: DataFrame) -> DataFrame:
    return atoms.filter(~F.col("residue").isin(*chem.WATER))


def is_heavy(element):
    """Both cases are listed: to upper-case each atom's element takes longer than all else of a scan."""
    return ~element.isin("H", "h")


def without_hydrogens(atoms: DataFrame) -> DataFrame:
    return atoms.filter(is_heavy(F.col("element")))


def without_crystallization_aids(atoms: DataFrame) -> DataFrame:
    return atoms.filter(~chem.is_crystallization_aid(F.col("residue")))


def methionine(atoms: DataFrame) -> DataFrame:
    """Selenomethionine as methionine."""
    mse = F.col("residue") == "MSE"
    se = mse & (F.upper("atom") == "SE")
    return atoms.withColumns({"atom": F.when(se, "SD").otherwise(F.col("atom")), "element": F.when(se, "S").otherwise(F.col("element")), "residue": F.when(mse, "MET").otherwise(F.col("residue"))})


def arginine_names(atoms: DataFrame) -> DataFrame:
    """NH1 is the one nearer to CD: the names change places where NH2 is strictly nearer."""
    at = lambda n: F.max(F.when(F.col("atom") == n, F.struct("x", "y", "z")))
    arg = atoms.filter("residue = 'ARG'").groupBy(*RESIDUE).agg(at("CD").alias("cd"), at("NH1").alias("n1"), at("NH2").alias("n2"))
    d = lambda a: sum((F.col(f"{a}.{c}") - F.col(f"cd.{c}")) * (F.col(f"{a}.{c}") - F.col(f"cd.{c}")) for c in "xyz")
    swap = arg.filter(d("n2") < d("n1")).select(*RESIDUE, F.lit(True).alias("__swap"))
    renamed = F.when(F.col("__swap") & (F.col("atom") == "NH1"), "NH2").when(F.col("__swap") & (F.col("atom") == "NH2"), "NH1").otherwise(F.col("atom"))
    return atoms.join(swap, RESIDUE, "left").withColumn("atom", renamed).drop("__swap")


def residues(atoms: DataFrame) -> DataFrame:
    """A row a residue: its kind and letter, and its atoms by name (of a name that is repeated the first one)."""
    keys = [*RESIDUE, "seq_id", "ins_code", "residue"]
    named = atoms.groupBy(*keys, "atom").agg(F.min_by(F.struct("x", "y", "z", "element", "atom_pos"), "atom_pos").alias("__value"), F.count("*").alias("__n"))
    out = named.withColumn("__entry", F.struct(F.col("atom").alias("key"), F.col("__value").alias("value"))).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list("__entry"))).alias("atoms"), F.sum("__n").alias("n_atoms"))
    kind = chem.chain_type(F.col("residue"))
    return out.withColumn("kind", kind).withColumn("letter", chem.letter(F.col("residue"), kind))


def chains(res: DataFrame) -> DataFrame:
    """A row a chain: the majority kind (of equals the first seen), residues and sequence."""
    keyed = res.withColumn("__key", F.struct(*CHAIN))
    kinds = majority(keyed, "__key", "kind", "residue_pos").select("__key.*", "kind")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("residue_pos", "letter"))), lambda x: x["letter"]), "")
    return res.groupBy(*CHAIN).agg(F.count("*").alias("n_residues"), text.alias("sequence")).join(kinds, CHAIN)


def without_excluded_ligands(atoms: DataFrame) -> DataFrame:
    """Ligand chains of which every residue is excluded go."""
    res = atoms.select(*RESIDUE, "residue").distinct()
    gone = res.groupBy(*CHAIN).agg(F.bool_and(chem.is_excluded_ligand(F.col("residue")) & (chem.chain_type(F.col("residue")) == "LIGAND")).alias("every")).filter("every")
    return atoms.join(gone.select(*CHAIN), CHAIN, "left_anti")


def broken_chains(atoms: DataFrame, most: float = MAX_CA_DISTANCE) -> DataFrame:
    """Protein chains with a step between present CA atoms over ``most``."""
    w = Window.partitionBy(*CHAIN).orderBy("residue_pos")
    ca = atoms.filter((F.col("atom") == "CA") & (chem.chain_type(F.col("residue")) == "PROTEIN"))
    step = F.sqrt(sum((F.col(c) - F.lag(c).over(w)) * (F.col(c) - F.lag(c).over(w)) for c in "xyz"))
    return ca.withColumn("step", step).groupBy(*CHAIN).agg(F.max("step").alias("max_step")).filter(F.col("max_step") > most)


def without_broken_chains(atoms: DataFrame, most: float = MAX_CA_DISTANCE) -> DataFrame:
    return atoms.join(broken_chains(atoms, most).select(*CHAIN), CHAIN, "left_anti")


def _keyed(atoms: DataFrame) -> DataFrame:
    return atoms.select("structure_id", "chain_id", "residue_pos", "residue", "atom", "atom_pos", "element", "x", "y", "z")


def cell_width(threshold: float) -> float:
    """Of the cells of a distance join of atoms, in A: wide enough for few atoms to be copied to the cells around, also where the distance is short."""
    return 1.5 * threshold + 5.0


#: What atoms need to be known by in a distance join; ``kind`` is the place in this list.
KINDS = ("PROTEIN", "RNA", "DNA", "ION", "WATER", "LIGAND")
CYSTEINES = ("CYS", "CYX")
#: Names by which atoms link residues; ``role`` is the place in this list from 1 on, 0 for other atoms (the sulfur counts in cysteines only). A distance join for bonds takes these, not names.
ROLES = ("C", "N", "O3'", "P", "SG")


def _kind():
    return F.array_position(F.array(*map(F.lit, KINDS)), chem.chain_type(F.col("residue"))).cast("tinyint") - F.lit(1).cast("tinyint")


def _role():
    sulfur = (F.col("atom") == "SG") & ~F.col("residue").isin(*CYSTEINES)
    return F.coalesce(F.when(~sulfur, F.array_position(F.array(*map(F.lit, ROLES)), F.col("atom"))), F.lit(0)).cast("tinyint")


def neighbours(atoms: DataFrame, threshold: float = CONTACT, width: float | None = None) -> DataFrame:
    """Pairs of a structure's atoms within ``threshold``, the first by chain, residue and atom as ``a_``: keys, names, ``kind``, ``heavy`` and ``role`` of both.

    Contacts, clashes and bonds are parts of the pairs within 8 A, and may be read from these. To keep them all takes far more disk than to join again for each
    distance, as bonds and clashes need few of those within 8 A, and interfaces the nearest of two residues.
    """
    own = atoms.select(*RESIDUE, "atom_pos", "atom", _kind().alias("kind"), is_heavy(F.col("element")).alias("heavy"), _role().alias("role"), *spatial.XYZ)
    near = spatial.near_pairs(own, ("chain_id", "residue_pos", "atom_pos"), threshold, ("structure_id",), width=width or cell_width(threshold))
    return near.drop("b_structure_id", *(f"{s}_{c}" for s in "ab" for c in spatial.XYZ))


def _across(near: DataFrame, threshold: float, strict: bool) -> DataFrame:
    """Pairs of different chains."""
    return near.filter((F.col("distance") < threshold if strict else F.col("distance") <= threshold) & (F.col("a_chain_id") != F.col("b_chain_id")))


def clashing_chains(atoms: DataFrame, distance: float = CLASH, share: float = CLASH_SHARE, near: DataFrame | None = None) -> DataFrame:
    """Chains of which ``share`` of the atoms or more have an atom of another chain within ``distance``. ``near`` may have the atoms' ``neighbours`` of a larger one."""
    pairs = _across(neighbours(atoms, distance) if near is None else near, distance, False).withColumn("b_structure_id", F.col("a_structure_id"))
    hit = spatial.ends(pairs, *RESIDUE, "atom_pos").distinct().groupBy(*CHAIN).agg(F.count("*").alias("hits"))
    total = atoms.groupBy(*CHAIN).agg(F.count("*").alias("atoms"))
    return total.join(hit, CHAIN).withColumn("fraction", F.col("hits") / F.col("atoms")).filter(F.col("fraction") >= share)


def clashes_by_pair(atoms: DataFrame, distance: float = CLASH, near: DataFrame | None = None) -> DataFrame:
    """For all ordered pairs of a structure's chains the atoms of the first with one of the other within ``distance``, their number in all and the share. ``near`` as in ``clashing_chains``."""
    pairs = _across(neighbours(atoms, distance) if near is None else near, distance, False)
    sides = F.array(*(F.struct(*(F.col(f"{s}_{c}").alias(c) for c in ("chain_id", "residue_pos", "atom_pos")), F.col(f"{o}_chain_id").alias("other")) for s, o in ("ab", "ba")))
    hit = pairs.select(F.col("a_structure_id").alias("structure_id"), F.explode(sides).alias("e")).select("structure_id", "e.*").distinct().groupBy(*CHAIN, "other").agg(F.count("*").alias("near"))
    sizes = atoms.groupBy(*CHAIN).agg(F.count("*").alias("n"))
    every = sizes.join(sizes.select("structure_id", F.col("chain_id").alias("other")), "structure_id").filter("chain_id <> other").join(hit, [*CHAIN, "other"], "left")
    return every.withColumn("near", F.coalesce("near", F.lit(0)).cast("long")).withColumn("fraction", F.col("near") / F.col("n"))


def interfaces(atoms: DataFrame, threshold: float = CONTACT, least: int = 5, near: DataFrame | None = None) -> DataFrame:
    """Chain pairs with ``least`` residue pairs strictly nearer than ``threshold`` by heavy atoms: contacts, residues, least distance, type. ``near`` as in ``clashing_chains``."""
    found = _across(neighbours(atoms, threshold) if near is None else near, threshold, True).filter("a_heavy AND b_heavy")
    pairs = found.groupBy(F.col("a_structure_id").alias("structure_id"), F.col("a_chain_id").alias("chain_1"), F.col("b_chain_id").alias("chain_2"), "a_residue_pos", "b_residue_pos").agg(F.min("distance").alias("distance"))
    out = pairs.groupBy("structure_id", "chain_1", "chain_2").agg(F.count("*").alias("contacts"), F.countDistinct("a_residue_pos").alias("residues_1"), F.countDistinct("b_residue_pos").alias("residues_2"), F.min("distance").alias("min_distance"))
    kinds = chains(residues(atoms)).select("structure_id", "chain_id", F.lower("kind").alias("kind"))
    one, two = (kinds.withColumnsRenamed({"chain_id": f"chain_{i}", "kind": f"kind_{i}"}) for i in (1, 2))
    typed = out.filter(F.col("contacts") >= least).join(one, ["structure_id", "chain_1"]).join(two, ["structure_id", "chain_2"])
    return typed.withColumn("type", F.array_join(F.array_sort(F.array("kind_1", "kind_2")), "-")).drop("kind_1", "kind_2")


def bonded(atoms: DataFrame, backbone: bool = True, near: DataFrame | None = None) -> DataFrame:
    """Covalent bonds by distance: inside ligands, along chains, and across chains unless both are polymers. ``near`` as in ``clashing_chains``."""
    pairs = (neighbours(atoms, BOND) if near is None else near).filter(F.col("distance") <= BOND)
    is_ = lambda s, *kinds: F.col(f"{s}_kind").isin(*(KINDS.index(k) for k in kinds))
    named = lambda s, name: F.col(f"{s}_role") == ROLES.index(name) + 1
    polymer = ("PROTEIN", "RNA", "DNA")
    same_chain = F.col("a_chain_id") == F.col("b_chain_id")
    inside = same_chain & (F.col("a_residue_pos") == F.col("b_residue_pos")) & is_("a", "LIGAND", "ION")
    across = ~same_chain & ~(is_("a", *polymer) & is_("b", *polymer))
    link = (named("a", "C") & named("b", "N") & is_("a", "PROTEIN")) | (named("a", "O3'") & named("b", "P") & is_("a", "RNA", "DNA"))
    along = same_chain & (F.col("b_residue_pos") == F.col("a_residue_pos") + 1) & link & F.lit(backbone)
    low, high = DISULFIDE
    sulfur = named("a", "SG") & named("b", "SG") & F.col("distance").between(low, high)
    kind = F.when(sulfur, "disulfide").when(along, "backbone").when(inside, "ligand").when(across, "cross")
    out = pairs.select("*", F.explode(F.array(kind)).alias("bond")).filter(F.col("bond").isNotNull())  # a row each; as a plain column it would be worked out for all candidates inside the join
    return out.select(F.col("a_structure_id").alias("structure_id"), "bond", *(F.col(f"{s}_{c}").alias(f"{c}_{i}") for i, s in ((1, "a"), (2, "b")) for c in ("chain_id", "residue_pos", "atom")), "distance")


def disulfides(atoms: DataFrame) -> DataFrame:
    """The disulfide bonds of ``bonded``. Only the sulfur atoms of cysteines can have one, so no others are looked at."""
    return bonded(atoms.filter((F.col("atom") == "SG") & F.col("residue").isin(*CYSTEINES))).filter("bond = 'disulfide'")


def tokens(atoms: DataFrame, members: Column | None = None) -> DataFrame:
    """One token a standard residue, one a heavy atom otherwise, numbered by chain, residue and atom.

    Atoms are exchanged once, by structure, and sorted once: groups, numbers and what is made of the tokens of a structure keep both.
    ``members``, worked out after the exchange, is collected from a token's atoms and sorted, so that atoms needn't look for their token.
    """
    standard = chem.is_standard_residue(F.col("residue"))
    kind = chem.chain_type(F.col("residue"))
    is_centre = ((F.col("atom") == "CA") & F.col("residue").isin(*chem.AMINO_ACIDS, chem.UNKNOWN_AMINO_ACID)) | ((F.col("atom") == "C1'") & F.col("residue").isin(*chem.RNA, *chem.DNA))
    heavy = without_hydrogens(atoms)
    if members is None:
        heavy = heavy.select(*RESIDUE, "seq_id", "residue", "atom", "atom_pos", "x", "y", "z")
    heavy = heavy.repartition("structure_id")
    heavy = heavy.withColumns({"__unit": F.when(standard, -1).otherwise(F.col("atom_pos")), "__centre": F.coalesce(is_centre, F.lit(False)), **({} if members is None else {"__member": members})})
    at = F.max(F.struct("__centre", F.when(~F.col("__centre"), -F.col("atom_pos")).alias("first"), "x", "y", "z"))  # the centre, else the first atom
    one = heavy.groupBy(*RESIDUE, "__unit", "seq_id", "residue").agg(F.count("*").alias("n_atoms"), at.alias("centre"), F.min("atom").alias("atom"), *([] if members is None else [F.sort_array(F.collect_list("__member")).alias("members")]))
    number = F.row_number().over(Window.partitionBy("structure_id").orderBy("chain_id", "residue_pos", "__unit")) - 1
    token_kind = F.when(standard, kind).when(kind == "ION", "ION").otherwise("LIGAND")
    return one.select(*RESIDUE, "seq_id", "residue", number.alias("token"), token_kind.alias("kind"), chem.restype_index(F.col("residue")).alias("restype"), "n_atoms", "centre.x", "centre.y", "centre.z", F.when(~standard, F.col("atom")).alias("atom"), *([] if members is None else ["members"]))


def bond_tokens(bonds: DataFrame, toks: DataFrame) -> DataFrame:
    """Token pairs of bonds, both ways.

    Only the bonds' pairs of residues, each once, look for their tokens: their token pairs are then different ones, and nothing is left to sort out.
    """
    key = lambda i: toks.select("structure_id", F.col("chain_id").alias(f"chain_id_{i}"), F.col("residue_pos").alias(f"residue_pos_{i}"), F.col("token").alias(f"token_{i}"))
    one, two = (F.struct(F.col(f"chain_id_{i}").alias("c"), F.col(f"residue_pos_{i}").alias("r")) for i in (1, 2))
    ends = bonds.select("structure_id", F.least(one, two).alias("p"), F.greatest(one, two).alias("q"))
    residues = ends.select("structure_id", *(F.col(f"{e}.{c}").alias(f"{name}_{i}") for i, e in ((1, "p"), (2, "q")) for c, name in (("c", "chain_id"), ("r", "residue_pos")))).distinct()
    pairs = residues.join(key(1).hint("merge"), ["structure_id", "chain_id_1", "residue_pos_1"]).join(key(2).hint("merge"), ["structure_id", "chain_id_2", "residue_pos_2"]).filter("token_1 <> token_2")
    there = F.struct("token_1", "token_2")
    back = F.struct(F.col("token_2").alias("token_1"), F.col("token_1").alias("token_2"))
    inside = (F.col("chain_id_1") == F.col("chain_id_2")) & (F.col("residue_pos_1") == F.col("residue_pos_2"))  # has both ways
    return pairs.select("structure_id", F.explode(F.when(inside, F.array(there)).otherwise(F.array(there, back))).alias("__e")).select("structure_id", "__e.*")


def token_pairs(toks: DataFrame, most: int = 32) -> DataFrame:
    """Relative position, chain mask and distogram bin of all token pairs of a structure; meant for cropped tokens."""
    a, b = (toks.select(*(F.col(c).alias(f"{s}_{c}") for c in ("structure_id", "chain_id", "seq_id", "token", "x", "y", "z"))) for s in "ab")
    pairs = a.join(b, F.col("a_structure_id") == F.col("b_structure_id"))
    same = F.col("a_chain_id") == F.col("b_chain_id")
    return pairs.select(F.col("a_structure_id").alias("structure_id"), F.col("a_token").alias("i"), F.col("b_token").alias("j"), chem.relative_position(F.col("a_seq_id"), F.col("b_seq_id"), same, most).alias("relative"), same.cast("int").alias("same_chain"), F.when(F.col("a_token") != F.col("b_token"), chem.distance_bin(spatial.distance())).alias("bin"))


def validation(res: DataFrame, most_missing: float = 0.2) -> DataFrame:
    """Chains with their share of residues without all backbone atoms, the NaN coordinates, and whether they are valid."""
    required = F.when(F.col("kind") == "PROTEIN", F.array(*map(F.lit, BACKBONE["PROTEIN"]))).otherwise(F.array(*map(F.lit, (*BACKBONE["RNA"], "O4'"))))
    lacks = (F.size(F.array_except(required, F.map_keys("atoms"))) > 0).cast("int")
    nan = F.size(F.filter(F.map_values("atoms"), lambda a: F.isnan(a["x"]) | F.isnan(a["y"]) | F.isnan(a["z"])))
    polymer = res.filter(F.col("kind").isin("PROTEIN", "RNA", "DNA"))
    out = polymer.groupBy(*CHAIN).agg(F.avg(lacks).alias("missing"), F.sum(nan).alias("nan_atoms"))
    return out.withColumns({"warning": F.col("missing") > most_missing, "valid": F.col("nan_atoms") == 0})


def expanded(atoms: DataFrame, operators: DataFrame, assembly: str = "1", most: int = 100) -> DataFrame:
    """Chains under their assembly's operators; a structure without operators, or with more than ``most``, stays as it is."""
    ops = operators.filter(F.col("assembly") == assembly).drop("assembly").withColumnRenamed("chain_id", "label_chain_id")
    use = ops.groupBy("structure_id").agg(F.countDistinct("op").alias("n")).filter(F.col("n") <= most).select("structure_id")
    chosen = ops.join(use, "structure_id", "left_semi")
    pairs = atoms.join(chosen, ["structure_id", "label_chain_id"])
    moved = {c: F.col(f"r{i}1") * F.col("x") + F.col(f"r{i}2") * F.col("y") + F.col(f"r{i}3") * F.col("z") + F.col(f"t{i}") for i, c in enumerate("xyz", 1)}
    first = F.min("op").over(Window.partitionBy("structure_id", "chain_id"))
    named = pairs.withColumns(moved).withColumn("chain_id", F.when(F.col("op") == first, F.col("chain_id")).otherwise(F.concat_ws("_", "chain_id", "op")))
    return named.select(*atoms.columns).unionByName(atoms.join(use, "structure_id", "left_anti"))


def glycosidic(atoms: DataFrame, glycans: DataFrame, most: float = GLYCOSIDIC) -> DataFrame:
    """Bonds of glycan atoms to protein atoms, and between glycans next to each other in a chain. ``glycans`` has the codes (``code``)."""
    codes = F.broadcast(glycans.select(F.col("code").alias("residue"), F.lit(True).alias("glycan")).distinct())  # some of the component codes
    protein = F.col("kind") == KINDS.index("PROTEIN")
    marked = atoms.select(*RESIDUE, "residue", "atom", _kind().alias("kind"), *spatial.XYZ).join(codes, "residue", "left").drop("residue").withColumn("glycan", F.coalesce("glycan", F.lit(False)))
    near = spatial.within(marked.filter(protein | F.col("glycan")), marked.filter("glycan"), most, ("structure_id",), width=cell_width(most))  # glycans are fewer, so these are copied
    beside = F.col("a_glycan") & (F.col("a_chain_id") == F.col("b_chain_id")) & (F.col("a_residue_pos") == F.col("b_residue_pos") + 1)
    out = near.select("*", F.explode(F.when((F.col("a_kind") == KINDS.index("PROTEIN")) | beside, F.array(F.lit(1)))).alias("__bond"))
    return out.select(F.col("a_structure_id").alias("structure_id"), F.lit("glycosidic").alias("bond"), *(F.col(f"{s}_{c}").alias(f"{c}_{i}") for i, s in ((1, "b"), (2, "a")) for c in ("chain_id", "residue_pos", "atom")), "distance")


def pocket(atoms: DataFrame, distance: float = 10.0) -> DataFrame:
    """Protein backbone atoms within ``distance`` of a ligand atom."""
    a = _keyed(without_hydrogens(atoms)).withColumn("kind", chem.chain_type(F.col("residue")))
    backbone = a.filter((F.col("kind") == "PROTEIN") & F.col("atom").isin(*BACKBONE["PROTEIN"], "O"))
    near = spatial.within(backbone, a.filter("kind = 'LIGAND'"), distance, ("structure_id",), width=cell_width(distance))
    keys = [*RESIDUE, "atom"]
    return backbone.join(near.select(*(F.col(f"a_{c}").alias(c) for c in keys)).distinct(), keys, "left_semi")


def without_leaving_atoms(atoms: DataFrame, bonds: DataFrame, known: DataFrame) -> DataFrame:
    """For both residues of each bond, atoms go that their component marks as leaving (``code, atom, leaving``)."""
    ends = bonds.select("structure_id", F.col("chain_1").alias("chain_id"), F.col("seq_1").alias("seq_id")).union(bonds.select("structure_id", "chain_2", "seq_2")).distinct()
    leaving = known.filter("leaving").select(F.col("code").alias("residue"), "atom").distinct()
    gone = atoms.join(ends, ["structure_id", "chain_id", "seq_id"], "left_semi").join(leaving, ["residue", "atom"], "left_semi").select(*RESIDUE, "atom")
    return atoms.join(gone, [*RESIDUE, "atom"], "left_anti")


def let(value, f):
    """``f`` of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def frames(res: DataFrame) -> DataFrame:
    """Each polymer residue's frame from its three backbone atoms: origin and unit vectors; null where they are missing or on a line."""
    a, o, b = (F.coalesce(*(F.when(F.col("kind") == k, F.try_element_at("atoms", F.lit(v[i]))) for k, v in BACKBONE.items())) for i in range(3))
    minus = lambda p, q: F.array(*(p[c] - q[c] for c in "xyz"))
    dot = lambda p, q: p[0] * q[0] + p[1] * q[1] + p[2] * q[2]
    unit = lambda v: let(F.sqrt(dot(v, v)), lambda n: F.when(n >= 1e-6, F.transform(v, lambda x: x / n)))
    cross = lambda p, q: F.array(p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0])
    beside = lambda v, ex: let(dot(v, ex), lambda t: F.array(*(v[i] - t * ex[i] for i in range(3))))
    polymer = res.filter(F.col("kind").isin(*BACKBONE)).select(*RESIDUE, o.alias("o"), minus(a, o).alias("v"), let(minus(b, o), unit).alias("ex"))
    two = polymer.withColumn("ey", F.when(F.col("ex").isNotNull(), let(beside(F.col("v"), F.col("ex")), unit)))
    there = F.col("ey").isNotNull()
    return two.select(*RESIDUE, F.col("o.x").alias("x"), F.col("o.y").alias("y"), F.col("o.z").alias("z"), F.when(there, F.col("ex")).alias("ex"), "ey", F.when(there, cross(F.col("ex"), F.col("ey"))).alias("ez"))


# Accessors of a residue: columns over its ``kind``, ``residue`` and ``atoms`` (by name)

NUCLEIC = ("RNA", "DNA")
REPRESENTATIVE = {"RNA": ("C1'", "C3'", "C4'"), "DNA": ("C1'", "C3'", "C4'")}


def named(*names: str):
    return F.array(*map(F.lit, names))


def atom(name: str):
    """Null where the residue lacks it."""
    return F.try_element_at("atoms", F.lit(name))


def first_atom():
    """The one that comes first in the file."""
    return F.array_min(F.transform(F.map_values("atoms"), lambda a: F.struct(a["atom_pos"].alias("atom_pos"), a.alias("atom"))))["atom"]


def centre_atom():
    """The alpha carbon, C1' of a nucleotide, else the first atom."""
    return F.coalesce(F.when(F.col("kind") == "PROTEIN", atom("CA")).when(F.col("kind").isin(*NUCLEIC), atom("C1'")), first_atom())


def frame_names():
    return F.when(F.col("kind") == "PROTEIN", named(*BACKBONE["PROTEIN"])).when(F.col("kind").isin(*NUCLEIC), named(*BACKBONE["RNA"]))


def backbone_atoms():
    """The frame's atoms by name; none for other kinds."""
    return F.map_filter("atoms", lambda k, _: F.coalesce(F.array_contains(frame_names(), k), F.lit(False)))


def has_frame():
    """Whether all of the frame's atoms are there; other kinds need none."""
    return F.coalesce(F.size(F.array_except(frame_names(), F.map_keys("atoms"))) == 0, F.lit(True))


def is_complete():
    """Backbone by name (nucleotides by C1', C3', C4'), or three atoms for other kinds."""
    names = F.when(F.col("kind") == "PROTEIN", named(*BACKBONE["PROTEIN"])).when(F.col("kind").isin(*NUCLEIC), named(*REPRESENTATIVE["RNA"]))
    return F.coalesce(F.size(F.array_intersect(names, F.map_keys("atoms"))) == 3, F.size("atoms") >= 3)


def beta_atom():
    """CB, or CA of glycine."""
    return F.when(F.col("residue") == "GLY", atom("CA")).otherwise(atom("CB"))


def pseudo_beta():
    return F.coalesce(beta_atom(), atom("CA"))


def heavy_atoms():
    return F.map_filter("atoms", lambda _, a: is_heavy(a["element"]))


def representatives(atoms: DataFrame) -> DataFrame:
    """``pae``, ``plddt`` and ``distogram``: whether an atom stands for its token in these."""
    kind = chem.token_kind(F.col("residue"))
    first = F.row_number().over(Window.partitionBy(*RESIDUE).orderBy("atom_pos")) == 1
    centre = F.when(kind == "PROTEIN", F.col("atom") == "CA").when(kind.isin(*NUCLEIC), F.col("atom") == "C1'").otherwise(first)
    beta = (kind == "PROTEIN") & ((F.col("atom") == "CB") | ((F.col("residue") == "GLY") & (F.col("atom") == "CA")))
    return atoms.withColumns({"pae": centre.cast("int"), "plddt": is_heavy(F.col("element")).cast("int"), "distogram": beta.cast("int")})


def permutations(res: DataFrame, twofold: dict[str, tuple[str, ...]]) -> DataFrame:
    """``permutations`` of a residue's atoms (places in order): as they are, and with each pair of ``twofold`` names swapped."""
    ordered = F.transform(F.array_sort(F.transform(F.map_entries("atoms"), lambda e: F.struct(e["value"]["atom_pos"], e["key"]))), lambda x: x["key"])
    pairs = F.coalesce(*(F.when(F.col("residue") == code, F.array(*(named(*names[k : k + 2]) for k in range(0, len(names), 2)))) for code, names in twofold.items()), F.array().cast("array<array<string>>"))

    def all_of(names):
        same = F.sequence(F.lit(0), F.size(names) - 1)
        place = lambda n: F.array_position(names, n).cast("int") - 1
        exchanged = lambda i, j: F.transform(same, lambda x: F.when(x == i, j).when(x == j, i).otherwise(x))
        there = F.filter(pairs, lambda p: F.array_contains(names, p[0]) & F.array_contains(names, p[1]))
        return F.concat(F.array(same), F.transform(there, lambda p: exchanged(place(p[0]), place(p[1]))))

    return res.withColumn("permutations", let(ordered, all_of))


def renamed_ligand_atoms(atoms: DataFrame) -> DataFrame:
    """Atoms of what is no standard residue are named by element and running number; ``old_atom`` keeps their name."""
    number = F.row_number().over(Window.partitionBy(*RESIDUE, F.upper("element")).orderBy("atom_pos")).cast("string")
    other = ~chem.is_standard_residue(F.col("residue"))
    return atoms.withColumn("old_atom", F.col("atom")).withColumn("atom", F.when(other, F.concat(F.upper("element"), number)).otherwise(F.col("atom")))


# Chains and structures


def polymer_structures(ch: DataFrame) -> DataFrame:
    """Structures with ``polymer`` (some chain is protein, RNA or DNA), ``n_residues`` and ``n_chains``."""
    return ch.groupBy("structure_id").agg(F.bool_or(F.col("kind").isin(*BACKBONE)).alias("polymer"), F.sum("n_residues").alias("n_residues"), F.count("*").alias("n_chains"))


def structure_metrics(ch: DataFrame) -> DataFrame:
    """Chains of each kind and residues in all."""
    kinds = ("PROTEIN", "RNA", "DNA", "LIGAND")
    return ch.groupBy("structure_id").agg(*(F.count_if(F.col("kind") == k).alias(f"n_{k.lower()}") for k in kinds), F.sum("n_residues").alias("n_residues"))


def classified_chains(res: DataFrame, share: float = 0.8) -> DataFrame:
    """A chain's kind by shares: over ``share`` of one polymer, all ions, all waters, or ligands; else unknown."""
    part = lambda k: F.count_if(F.col("kind") == k) / F.count("*")
    kind = F.when(part("PROTEIN") > share, "PROTEIN").when(part("RNA") > share, "RNA").when(part("DNA") > share, "DNA").when(part("ION") == 1, "ION").when(part("WATER") == 1, "WATER").when(part("LIGAND") == 1, "LIGAND").otherwise("UNKNOWN")
    return res.groupBy(*CHAIN).agg(kind.alias("kind"))


def chain_sequences(res: DataFrame) -> DataFrame:
    """``id`` (structure and chain) and the sequence of polymer residues: amino acids by letter, nucleotides by the last letter of their code."""
    keyed = res.withColumn("__key", F.struct(*CHAIN))
    kinds = majority(keyed, "__key", "kind", "residue_pos").select("__key.*", F.col("kind").alias("chain_kind"))
    letter = F.when(F.col("chain_kind") == "PROTEIN", F.when(F.col("residue").isin(*chem.AMINO_ACIDS), chem.aa_letter(F.col("residue"))).otherwise("X")).otherwise(F.right("residue", F.lit(1)))
    own = res.join(kinds.filter(F.col("chain_kind").isin(*BACKBONE)), CHAIN).withColumn("letter", letter)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("residue_pos", "letter"))), lambda x: x["letter"]), "")
    return own.groupBy(*CHAIN).agg(text.alias("sequence")).select(F.concat_ws("_", *CHAIN).alias("id"), "sequence")


def touching_chains(atoms: DataFrame, distance: float = INTERFACE, near: DataFrame | None = None) -> DataFrame:
    """Chain pairs with heavy atoms nearer than ``distance``. ``near`` as in ``clashing_chains``."""
    found = _across(neighbours(atoms, distance) if near is None else near, distance, True).filter("a_heavy AND b_heavy")
    return found.select(F.col("a_structure_id").alias("structure_id"), F.col("a_chain_id").alias("chain_1"), F.col("b_chain_id").alias("chain_2")).distinct()


def with_interface(found: DataFrame, kinds: tuple[str, str] | None = None, least: int = 1) -> DataFrame:
    """Structures with an interface (of the two kinds, in any order) of at least ``least`` contacts."""
    wanted = found.filter(F.col("contacts") >= least)
    return (wanted if kinds is None else wanted.filter(F.col("type") == "-".join(sorted(k.lower() for k in kinds)))).select("structure_id").distinct()


def interface_chains(found: DataFrame) -> DataFrame:
    """A structure's interfaces, most contacts first."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("structure_id").orderBy(F.col("contacts").desc(), "chain_1", "chain_2")))


def without_listed(atoms: DataFrame, ions: bool = False) -> DataFrame:
    """Without waters, chains of excluded ligands and, if asked, ions; a structure of which nothing is left goes by itself."""
    kept = without_excluded_ligands(without_waters(atoms))
    return kept.filter(~(F.lit(ions) & (chem.chain_type(F.col("residue")) == "ION")))


# Tokens


def positions(toks: DataFrame) -> DataFrame:
    """``asym_id``: the chains' numbers by their first token; ``in_chain``: a token's place in its chain; ``first`` and ``last`` token of its residue; ``metal``."""
    chain, residue = Window.partitionBy(*CHAIN), Window.partitionBy(*RESIDUE)
    first = toks.withColumn("__first", F.min("token").over(chain))
    metal = (F.count("*").over(residue) == 1) & (F.col("n_atoms") == 1) & (F.count("*").over(chain) == 1)
    return first.withColumns({
        "asym_id": F.dense_rank().over(Window.partitionBy("structure_id").orderBy("__first")) - 1, "in_chain": F.row_number().over(chain.orderBy("token")) - 1,
        "first": F.min("token").over(residue), "last": F.max("token").over(residue), "metal": metal,
    }).drop("__first")


def token_atoms(atoms: DataFrame, toks: DataFrame) -> DataFrame:
    """Heavy atoms with their token and their place in it, numbered through the structure (``flat``)."""
    keys = toks.select(*RESIDUE, "token", F.col("atom").alias("__atom"))
    own = without_hydrogens(atoms).join(keys.hint("merge"), RESIDUE).filter(F.col("__atom").isNull() | (F.col("__atom") == F.col("atom"))).drop("__atom")
    return own.withColumns({"within": F.row_number().over(Window.partitionBy("structure_id", "token").orderBy("atom_pos")) - 1, "flat": F.row_number().over(Window.partitionBy("structure_id").orderBy("token", "atom_pos")) - 1})


def polymer_bonds(toks: DataFrame) -> DataFrame:
    """Token pairs next to each other: same chain, residue numbers one apart, both standard residues."""
    w = Window.partitionBy(*CHAIN).orderBy("token")
    standard = lambda c: c.isin(*chem.AMINO_ACIDS, *chem.RNA[:-1], *chem.DNA[:-1])
    beside = toks.withColumns({"token_2": F.lead("token").over(w), "__seq": F.lead("seq_id").over(w), "__residue": F.lead("residue").over(w)})
    return beside.filter((F.col("__seq") == F.col("seq_id") + 1) & standard(F.col("residue")) & standard(F.col("__residue"))).select("structure_id", F.col("token").alias("token_1"), "token_2")


def ligand_bonds(atoms: DataFrame, toks: DataFrame, most: float = 2.5) -> DataFrame:
    """Pairs of a polymer token and another whose nearest atoms are nearer than ``most``. Atoms that are near each other look for their tokens, not all atoms."""
    own = without_hydrogens(atoms).select(*RESIDUE, "atom", F.col("residue").isin(*chem.AMINO_ACIDS, *chem.RNA[:-1], *chem.DNA[:-1]).alias("polymer"), *spatial.XYZ)
    near = spatial.within(own.filter("polymer").drop("polymer"), own.filter("NOT polymer").drop("polymer"), most, ("structure_id",), strict=True, width=cell_width(most))
    ends = [F.col(f"{s}_{c}").alias(f"{c}_{i}") for i, s in ((1, "a"), (2, "b")) for c in ("chain_id", "residue_pos", "atom")]
    pairs = near.groupBy(F.col("a_structure_id").alias("structure_id"), *ends).agg(F.min("distance").alias("distance"))
    for i in (1, 2):
        keys = toks.select("structure_id", F.col("chain_id").alias(f"chain_id_{i}"), F.col("residue_pos").alias(f"residue_pos_{i}"), F.col("token").alias(f"token_{i}"), F.col("atom").alias("__atom"))
        pairs = pairs.join(keys.hint("merge"), ["structure_id", f"chain_id_{i}", f"residue_pos_{i}"]).filter(F.col("__atom").isNull() | (F.col("__atom") == F.col(f"atom_{i}"))).drop("__atom")
    return pairs.groupBy("structure_id", "token_1", "token_2").agg(F.min("distance").alias("distance"))


def between_kinds(pairs: DataFrame, toks: DataFrame) -> DataFrame:
    """Token pairs without those of two polymer tokens."""
    kind = lambda i: toks.select("structure_id", F.col("token").alias(f"token_{i}"), F.col("kind").isin(*BACKBONE).alias(f"polymer_{i}"))
    return pairs.join(kind(1), ["structure_id", "token_1"]).join(kind(2), ["structure_id", "token_2"]).filter("NOT (polymer_1 AND polymer_2)").select("structure_id", "token_1", "token_2")


def bond_features(atoms: DataFrame, toks: DataFrame, most: float = 2.5) -> DataFrame:
    """Token pairs with their ``kind``: 1 along a polymer, 2 polymer and ligand, 3 disulfide (the highest counts)."""
    sulfur = bond_tokens(disulfides(atoms), toks).filter("token_1 < token_2")
    parts = [polymer_bonds(toks).withColumn("kind", F.lit(1)), ligand_bonds(atoms, toks, most).select("structure_id", F.least("token_1", "token_2").alias("token_1"), F.greatest("token_1", "token_2").alias("token_2")).withColumn("kind", F.lit(2)), sulfur.withColumn("kind", F.lit(3))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("structure_id", "token_1", "token_2").agg(F.max("kind").alias("kind"))


def matching_tokens(template: DataFrame, query: DataFrame) -> DataFrame:
    """Template tokens with the first query token of the same residue number and chain."""
    first = query.groupBy("structure_id", "chain_id", "seq_id").agg(F.min("token").alias("query_token"))
    return template.join(first, ["structure_id", "chain_id", "seq_id"], "left")


def matched_atoms(mobile: DataFrame, target: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """Atoms of equal name, of a repeated target name the last (``atom_pos``); groups with fewer than ``least`` go."""
    last = target.groupBy(*keys, "atom").agg(F.max_by(F.struct("x", "y", "z"), "atom_pos").alias("t"))
    both = mobile.join(last, [*keys, "atom"]).select(*keys, "atom", "x", "y", "z", *(F.col(f"t.{c}").alias(f"t{c}") for c in "xyz"))
    return both.join(both.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") >= least).select(*keys), keys, "left_semi")


def chain_members(df: DataFrame, number: str) -> DataFrame:
    """Each chain's numbers in order (of tokens, or of atoms) and how many."""
    return df.groupBy(*CHAIN).agg(F.array_sort(F.collect_list(number)).alias("members"), F.count("*").alias("n"))


def assembly_statistics(before: DataFrame, after: DataFrame, operators: DataFrame) -> DataFrame:
    """Chains and atoms of each structure before and after its expansion, the factor, and its operators."""
    size = lambda t, name: t.groupBy("structure_id").agg(F.countDistinct("chain_id").alias(f"{name}_chains"), F.count("*").alias(f"{name}_atoms"))
    ops = operators.groupBy("structure_id").agg(F.countDistinct("op").alias("n_operators"))
    return size(before, "original").join(size(after, "expanded"), "structure_id").join(ops, "structure_id", "left").withColumn("factor", F.col("expanded_chains") / F.col("original_chains"))


def moved_bonds(bonds: DataFrame, operators: DataFrame, first: DataFrame) -> DataFrame:
    """Bonds (``chain_1, chain_2`` and the rest) under every operator that both chains have, with the chains' names in the expansion; ``first`` has each chain's first operator (``chain_id, op``)."""
    ops = operators.select("structure_id", F.col("chain_id").alias("__chain"), "op")
    both = bonds.join(ops.withColumnRenamed("__chain", "chain_1"), ["structure_id", "chain_1"]).join(ops.withColumnRenamed("__chain", "chain_2"), ["structure_id", "chain_2", "op"])
    for i in (1, 2):
        own = first.select("structure_id", F.col("chain_id").alias(f"chain_{i}"), F.col("op").alias("__first"))
        both = both.join(own, ["structure_id", f"chain_{i}"]).withColumn(f"chain_{i}", F.when(F.col("op") == F.col("__first"), F.col(f"chain_{i}")).otherwise(F.concat_ws("_", f"chain_{i}", "op"))).drop("__first")
    return both.drop("op")


def operator_issues(operators: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Operators that are no rotation: rows not orthogonal and of length 1, or a determinant other than 1."""
    r = lambda i, j: F.col(f"r{i}{j}")
    dot = lambda a, b: sum((r(a, k) * r(b, k) for k in (1, 2, 3)), F.lit(0.0))
    off = [F.abs(dot(a, b) - (1.0 if a == b else 0.0)) > tolerance for a in (1, 2, 3) for b in (1, 2, 3) if a <= b]
    det = r(1, 1) * (r(2, 2) * r(3, 3) - r(2, 3) * r(3, 2)) - r(1, 2) * (r(2, 1) * r(3, 3) - r(2, 3) * r(3, 1)) + r(1, 3) * (r(2, 1) * r(3, 2) - r(2, 2) * r(3, 1))
    skew = F.lit(False)
    for o in off:
        skew = skew | o
    return operators.withColumns({"orthogonal": ~skew, "determinant": det}).filter(skew | (F.abs(det - 1) > tolerance))


def distillation_entries(ch: DataFrame, model: str = "alphafold2") -> DataFrame:
    """An entry of the distillation set for each structure: chains, residues and kinds, without resolution, date or cluster."""
    kinds = F.array_sort(F.collect_list(F.struct("chain_id", "kind")))
    out = ch.groupBy("structure_id").agg(F.count("*").alias("n_chains"), F.sum("n_residues").alias("n_residues"), F.transform(kinds, lambda x: x["kind"]).alias("chain_types"))
    return out.withColumn("entry", F.concat(F.col("structure_id"), F.lit(f"_distill_{model}"))).withColumns({"weight": F.lit(1.0), "dataset": F.lit("distillation"), "resolution": F.lit(None).cast("double"), "cluster": F.lit(None).cast("string")})


def glycan_residues(res: DataFrame, glycans: DataFrame) -> DataFrame:
    """Residues with ``glycan``, whether their code is in the table of glycans (``code``)."""
    known = glycans.select(F.upper("code").alias("__code")).distinct()
    return res.join(known, F.upper("residue") == F.col("__code"), "left").withColumn("glycan", F.col("__code").isNotNull()).drop("__code")


def without_clashing(atoms: DataFrame, distance: float = CLASH, share: float = CLASH_SHARE) -> DataFrame:
    return atoms.join(clashing_chains(atoms, distance, share).select(*CHAIN), CHAIN, "left_anti")


def without_empty_chains(ch: DataFrame, atoms: DataFrame) -> DataFrame:
    """Chains that still have atoms."""
    return ch.join(atoms.select(*CHAIN).distinct(), CHAIN, "left_semi")


def interface_or_all(toks: DataFrame, near: DataFrame) -> DataFrame:
    """The interface's tokens, or all of a structure that has none."""
    return near.unionByName(toks.join(near.select("structure_id").distinct(), "structure_id", "left_anti"))


def masked_centres(toks: DataFrame) -> DataFrame:
    return spatial.weighted_centres(toks, CHAIN, "mask")
