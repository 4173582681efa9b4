"""Crops of token tables (``structure_id, chain_id, residue_pos, token, x, y, z, n_atoms``)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import spatial
from .relational import uniform

WEIGHTS = {"contiguous": 0.2, "spatial": 0.4, "interface": 0.4}


def renumbered(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("token", F.row_number().over(Window.partitionBy("structure_id").orderBy("token")) - 1)


def first_tokens(tokens: DataFrame, most: int) -> DataFrame:
    return tokens.withColumn("__n", F.row_number().over(Window.partitionBy("structure_id").orderBy("token"))).filter(F.col("__n") <= most).drop("__n")


def within_atom_budget(tokens: DataFrame, most: int) -> DataFrame:
    w = Window.partitionBy("structure_id").orderBy("token").rowsBetween(Window.unboundedPreceding, 0)
    return tokens.withColumn("__sum", F.sum("n_atoms").over(w)).filter(F.col("__sum") <= most).drop("__sum")


def interface_tokens(tokens: DataFrame, distance: float = 15.0) -> DataFrame:
    """Tokens with a token of another chain nearer than ``distance``."""
    own = tokens.select("structure_id", "chain_id", "token", *spatial.XYZ)
    near = spatial.near_pairs(own, "token", distance, ("structure_id",), strict=True).filter("a_chain_id <> b_chain_id")
    return tokens.join(spatial.ends(near, "structure_id", "token").distinct(), ["structure_id", "token"], "left_semi")


def reference_tokens(candidates: DataFrame, seed: int) -> DataFrame:
    """One token of each structure, by hash."""
    u = uniform(seed, "structure_id", "token")
    best = candidates.groupBy("structure_id").agg(F.min(F.struct(u.alias("u"), "token", "x", "y", "z")).alias("b"))
    return best.select("structure_id", *(F.col(f"b.{c}").alias(f"ref_{c}") for c in ("token", "x", "y", "z")))


def spatial_crop(tokens: DataFrame, references: DataFrame, most: int) -> DataFrame:
    """The ``most`` tokens nearest to each structure's reference; residues that are cut go whole."""
    square = sum((F.col(c) - F.col(f"ref_{c}")) * (F.col(c) - F.col(f"ref_{c}")) for c in "xyz")
    ranked = tokens.join(references, "structure_id").withColumn("__d", F.sqrt(square) + F.col("token") * 1e-6)
    ranked = ranked.withColumn("__in", F.row_number().over(Window.partitionBy("structure_id").orderBy("__d", "token")) <= most)
    whole = F.bool_and("__in").over(Window.partitionBy("structure_id", "chain_id", "residue_pos"))
    return ranked.withColumn("__whole", whole).filter("__whole").select(*tokens.columns)


def contiguous_crop(tokens: DataFrame, most: int, seed: int) -> DataFrame:
    """Runs of tokens of the chains in random order until the budget is used; a structure is one group."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("token", kind="stable")
        rng = np.random.default_rng(int(pd.util.hash_array(np.array([f"{g['structure_id'].iloc[0]}|{seed}"], dtype=object))[0]))
        left, total, keep = most, len(g), []
        for c in rng.permutation(sorted(g["chain_id"].unique())):
            own = g[g["chain_id"] == c]
            total -= len(own)
            high, low = min(len(own), left), min(len(own), max(0, left - total))
            size = int(rng.integers(low, high + 1)) if high else 0
            if size:
                at = int(rng.integers(0, len(own) - size + 1))
                part = own.iloc[at : at + size]
                keep.append(part[part.groupby("residue_pos")["token"].transform("size") == part["residue_pos"].map(own.groupby("residue_pos").size())])
                left -= size
        return pd.concat(keep).sort_values("token") if keep else g.iloc[:0]

    return tokens.groupBy("structure_id").applyInPandas(run, tokens.schema)


def crop_method(seed: int, weights: dict[str, float] | None = None):
    """The method of a structure, drawn by hash."""
    weights = weights or WEIGHTS
    u, total, out = uniform(seed, "structure_id"), sum(weights.values()), F.lit(None).cast("string")
    edge = total
    for name in reversed(weights):
        out = F.when(u * total < edge, name).otherwise(out)
        edge -= weights[name]
    return out
