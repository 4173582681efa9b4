"""Template hits: dates, obsolete entries, the best hits, and their features on the query's positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import top_per_key

# Hits that are kept, days before an example's own date, and the order of a residue's atoms.
MAX_TEMPLATES, DAYS_BEFORE = 4, 60
ATOM_ORDER = ("N", "CA", "C", "CB", "O", "CG", "CG1", "CG2", "OG", "OG1", "SG", "CD", "CD1", "CD2", "ND1", "ND2", "OD1", "OD2", "SD", "CE", "CE1", "CE2", "CE3", "NE", "NE1", "NE2", "OE1", "OE2", "CH2", "NH1", "NH2", "OH", "CZ", "CZ2", "CZ3", "NZ", "OXT")
MIN_COVERAGE, MAX_LENGTH_SHARE, MAX_IDENTITY = 0.1, 0.95, 0.95
# End of fixed values.


def dated_before(date: Column, cutoff: str | Column, unknown: bool) -> Column:
    """Whether a hit's date is the cut-off's or earlier; ``unknown`` says what a hit without a date does."""
    return F.coalesce(date <= (F.lit(cutoff) if isinstance(cutoff, str) else cutoff).cast("date"), F.lit(unknown))


def without_obsolete(hits: DataFrame, entry: str, obsolete: DataFrame) -> DataFrame:
    """``obsolete`` has upper-case ids (``pdb_id``)."""
    gone = obsolete.select(F.upper("pdb_id").alias("__gone")).distinct()
    return hits.join(gone, F.upper(entry) == F.col("__gone"), "left_anti")


def allowed_before(examples: DataFrame, hits: DataFrame, key: str, example: str, date: str, hit: str, days: int = DAYS_BEFORE) -> DataFrame:
    """``example`` and ``allowed``, its hits (``key``, ``hit`` and ``date``) at least ``days`` before it: a range in an equi-join."""
    own = examples.select(F.col(key).alias("__key"), F.col(example), F.col(date).alias("__day"))
    other = hits.select(F.col(key).alias("__other"), F.col(hit).alias("__hit"), F.col(date).alias("__before"))
    return own.join(other, (F.col("__key") == F.col("__other")) & (F.col("__before") <= F.date_sub("__day", days)), "left").groupBy(example).agg(F.count("__hit").alias("allowed"))


def too_alike(length_share: Column, identity: Column) -> Column:
    """A hit that is as good as the query itself."""
    return (length_share > MAX_LENGTH_SHARE) & (identity > MAX_IDENTITY)


def good_hits(hits: DataFrame, query: list[str], most: int | None = None) -> DataFrame:
    """Hits with ``coverage``, ``length_share``, ``identity`` and ``score`` that cover enough and are not the query; best scores first."""
    kept = hits.filter((F.col("coverage") >= MIN_COVERAGE) & ~too_alike(F.col("length_share"), F.col("identity")))
    return top_per_key(kept, query, [F.col("score").desc(), F.col("hit")], most or 1 << 30)


def best_hits(hits: DataFrame, query: list[str], cutoff: str, obsolete: DataFrame, most: int = MAX_TEMPLATES, unknown: bool = False) -> DataFrame:
    """Dates, obsolete entries, one hit a sequence and the ``most`` best of each query (``hit, pdb_id, sequence, score, date``)."""
    dated = without_obsolete(hits.filter(dated_before(F.col("date"), cutoff, unknown)), "pdb_id", obsolete)
    order = [F.col("score").desc(), F.col("hit")]
    one = dated.withColumn("__n", F.row_number().over(Window.partitionBy(*query, F.upper("sequence")).orderBy(*order))).filter("__n = 1").drop("__n")
    return top_per_key(one, query, order, most)


def with_dates(hits: DataFrame, dates: DataFrame) -> DataFrame:
    """Unknown dates filled in from ``dates`` (``pdb_id, date``)."""
    known = dates.select(F.lower("pdb_id").alias("__id"), F.col("date").alias("__date"))
    return hits.join(known, F.lower("pdb_id") == F.col("__id"), "left").withColumn("date", F.coalesce("date", "__date")).drop("__id", "__date")


def atom_layout(residues: DataFrame) -> DataFrame:
    """Residues (``atoms`` by name) with ``positions`` and ``mask`` in the fixed order of 37 atoms; 0 where there is none."""
    at = lambda n: F.try_element_at("atoms", F.lit(n))
    place = F.array(*(F.when(at(n).isNotNull(), F.array(at(n)["x"], at(n)["y"], at(n)["z"])).otherwise(F.array(*[F.lit(0.0)] * 3)) for n in ATOM_ORDER))
    return residues.withColumns({"positions": place, "mask": F.array(*(at(n).isNotNull().cast("int") for n in ATOM_ORDER))})


def atom_of(name: str) -> Column:
    """An atom's place in the layout, null where the mask has none."""
    i = ATOM_ORDER.index(name)
    return F.when(F.col("mask")[i] == 1, F.col("positions")[i])


def layout_features(laid: DataFrame) -> DataFrame:
    """``pseudo_beta`` (the alpha carbon of glycine, and where the beta carbon lacks), its mask, and whether the frame's three atoms are there."""
    beta = F.coalesce(F.when(F.col("residue") != "GLY", atom_of("CB")), atom_of("CA"))
    frame = atom_of("N").isNotNull() & atom_of("CA").isNotNull() & atom_of("C").isNotNull()
    return laid.withColumns({"pseudo_beta": beta, "pseudo_beta_mask": beta.isNotNull().cast("int"), "frame_mask": frame.cast("int")})


def on_query(template: DataFrame, mapping: DataFrame) -> DataFrame:
    """Template residues on the query's positions: ``mapping`` has ``query, hit, pos`` and ``template_pos`` (-1 for none)."""
    found = mapping.filter("template_pos >= 0").join(template.withColumnRenamed("residue_pos", "template_pos"), ["hit", "template_pos"])
    return found.drop("template_pos")


def slots(hits: DataFrame, query: list[str], most: int = MAX_TEMPLATES) -> DataFrame:
    """``slot`` 0 to ``most`` - 1 of each query, with its hit or null."""
    ranked = top_per_key(hits, query, [F.col("score").desc(), F.col("hit")], most).withColumn("slot", F.col("rank") - 1).drop("rank")
    every = hits.select(*query).distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    return every.join(ranked, [*query, "slot"], "left")


# Templates straight from their files

# Atoms of a residue's frame, its second one stands for it.
FRAME_ATOMS = {"PROTEIN": ("N", "CA", "C"), "NUCLEIC": ("C1'", "C3'", "C4'")}
# End of fixed values.


def aligned_positions(hits: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, pos, template_pos`` for every column in which both rows of a hit's alignment have a letter.

    ``query_aligned`` and ``template_aligned`` are gapped and equally long (what one has beyond the other is left out); ``query_start`` and ``template_start``
    say which residue (from 0) their first letters are.
    """
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    q, t = letters(F.col("query_aligned")), letters(F.col("template_aligned"))
    n = F.least(F.size(q), F.size(t))
    cells = hits.select(*keys, "query_start", "template_start", F.posexplode(F.arrays_zip(F.slice(q, F.lit(1), n).alias("q"), F.slice(t, F.lit(1), n).alias("t"))).alias("k", "c"))
    upto = Window.partitionBy(*keys).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    there = lambda s: (F.col(f"c.{s}") != "-").cast("int")
    placed = cells.withColumns({"pos": (F.sum(there("q")).over(upto) - 1 + F.col("query_start")).cast("int"), "template_pos": (F.sum(there("t")).over(upto) - 1 + F.col("template_start")).cast("int")})
    return placed.filter((F.col("c.q") != "-") & (F.col("c.t") != "-")).select(*keys, "pos", "template_pos")


def backbone_places(atoms: DataFrame) -> DataFrame:
    """Each residue's three frame atoms ``a, o, b`` as arrays (null where one lacks or has no place)."""
    from ..functions import chem

    kind = chem.chain_type(F.col("residue"))
    good = ~(F.isnan("x") | F.isnan("y") | F.isnan("z"))
    at = lambda i: F.min_by(F.when(good, F.array("x", "y", "z")), F.when((kind == "PROTEIN") & (F.col("atom") == FRAME_ATOMS["PROTEIN"][i]) | kind.isin("RNA", "DNA") & (F.col("atom") == FRAME_ATOMS["NUCLEIC"][i]), F.col("atom_pos")))
    return atoms.groupBy("structure_id", "chain_id", "residue_pos").agg(F.min("residue").alias("residue"), *(at(i).alias(n) for i, n in enumerate("aob")))


def with_frames(residues: DataFrame) -> DataFrame:
    """``frame``: unit vectors x (from ``o`` to ``b``), y (in the plane, away from ``a``) and z; null where the atoms are missing or on a line."""
    from .structures import let

    minus = lambda p, r: F.zip_with(p, r, lambda x, y: x - y)
    dot = lambda p, r: p[0] * r[0] + p[1] * r[1] + p[2] * r[2]
    unit = lambda v: let(F.sqrt(dot(v, v)), lambda n: F.when(n >= 1e-6, F.transform(v, lambda x: x / n)))
    cross = lambda p, r: F.array(p[1] * r[2] - p[2] * r[1], p[2] * r[0] - p[0] * r[2], p[0] * r[1] - p[1] * r[0])
    out = residues.withColumn("__x", let(minus(F.col("b"), F.col("o")), unit))
    beside = let(minus(F.col("o"), F.col("a")), lambda v: let(dot(v, F.col("__x")), lambda t: F.zip_with(v, F.col("__x"), lambda p, x: p - t * x)))
    out = out.withColumn("__y", let(beside, unit))
    return out.withColumn("frame", F.when(F.col("__y").isNotNull(), F.array("__x", "__y", cross(F.col("__x"), F.col("__y"))))).drop("__x", "__y")


def template_frames(atoms: DataFrame, hits: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each hit of a query, over the query's positions: ``mask`` (its residue has a place), ``frame`` and ``frame_mask``, and for all pairs of positions
    ``distogram`` (the distance's bin, -1 where one of them has no place), ``unit_vector`` (from the second to the first) and ``local_vector`` (from the first to
    the second, in the first one's frame), zeros where there is none.

    ``atoms`` is an atom table (``sources.mmcif.scan`` reads just its columns of the hits' files); ``hits`` has ``query, slot, hit, chain_id`` and the columns of
    ``aligned_positions``; ``lengths`` has ``query, n``. What lies beyond the query's end is dropped, and a hit without a file has masks of 0.
    """
    from ..functions import chem
    from .structures import let

    wanted = hits.select(F.col("hit").alias("structure_id"), "chain_id").distinct()
    placed = with_frames(backbone_places(atoms.join(wanted, ["structure_id", "chain_id"], "left_semi"))).withColumnsRenamed({"structure_id": "hit", "residue_pos": "template_pos"})
    mapping = aligned_positions(hits, ["query", "slot", "hit", "chain_id"])
    rows = mapping.join(placed.filter("o IS NOT NULL"), ["hit", "chain_id", "template_pos"]).groupBy("query", "slot").agg(F.array_sort(F.collect_list(F.struct("pos", "o", "frame"))).alias("__p"))
    every = hits.select("query", "slot", "hit").join(lengths.select("query", "n"), "query").join(rows, ["query", "slot"], "left")
    numbers = F.sequence(F.lit(0), F.col("n") - 1)
    listed = every.withColumn("__pos", F.transform(F.coalesce("__p", F.array().cast(rows.schema["__p"].dataType)), lambda p: p["pos"]))
    dense = listed.withColumn("__d", F.transform(numbers, lambda i: F.get("__p", F.array_position("__pos", i).cast("int") - 1)))
    zero = F.array(*[F.lit(0.0)] * 3)

    def pair(f, none):
        return F.transform("__d", lambda p: F.transform("__d", lambda r: F.when(p.isNotNull() & r.isNotNull(), f(p, r)).otherwise(none)))

    minus = lambda p, r: F.zip_with(p, r, lambda x, y: x - y)
    dot = lambda p, r: p[0] * r[0] + p[1] * r[1] + p[2] * r[2]
    far = lambda v: F.sqrt(dot(v, v))
    unit = lambda v: let(F.greatest(far(v), F.lit(1e-8)), lambda n: F.transform(v, lambda x: x / n))
    local = lambda p, r: F.when(p["frame"].isNotNull(), let(unit(minus(r["o"], p["o"])), lambda v: F.transform(p["frame"], lambda axis: dot(axis, v)))).otherwise(zero)
    return dense.select(
        "query", "slot", "hit", F.transform("__d", lambda p: p.isNotNull().cast("int")).alias("mask"), F.transform("__d", lambda p: p["frame"]).alias("frame"), F.transform("__d", lambda p: p["frame"].isNotNull().cast("int")).alias("frame_mask"),
        pair(lambda p, r: chem.fine_distance_bin(far(minus(p["o"], r["o"]))), F.lit(-1)).alias("distogram"), pair(lambda p, r: unit(minus(p["o"], r["o"])), zero).alias("unit_vector"), pair(local, zero).alias("local_vector"),
    )
