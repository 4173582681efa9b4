"""From files to model inputs of cropped structures: all structures of a folder in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import crop, inputs, relational
from ..operators import structures as S
from ..sources import structures as src
from ..sources.tables import checkpoint_folder


@dataclass
class Curated:
    verdicts: DataFrame
    atoms: DataFrame
    chains: DataFrame
    interfaces: DataFrame
    bonds: DataFrame
    tokens: DataFrame
    pairs: DataFrame
    inputs: DataFrame


def cleaned(atoms: DataFrame) -> DataFrame:
    for f in (S.without_waters, S.without_hydrogens, S.methionine, S.arginine_names, S.without_crystallization_aids):
        atoms = f(atoms)
    return atoms


def verdicts(structures: DataFrame, chains: DataFrame, config: Config) -> DataFrame:
    """Whether each structure passes, or the first rule it fails."""
    size = chains.groupBy("structure_id").agg(F.sum("n_residues").alias("n_residues"), F.bool_or(F.col("kind").isin("PROTEIN", "RNA", "DNA")).alias("polymer"))
    f = config.filtering
    rules = [
        ("unreadable", F.col("error").isNull()), ("date", relational.date_rule(F.col("release_date"), f.cutoff)), ("resolution", relational.resolution_rule(F.col("resolution"), F.col("method"), f.max_resolution)),
        ("composition", F.col("polymer")), ("size", F.col("n_residues") >= f.min_residues),
    ]
    joined = structures.select("structure_id", "method", "resolution", "release_date", "error").join(size, "structure_id", "left")
    return relational.first_failing(joined, rules).select("structure_id", "passed", "reason")


def own_sequences(chains: DataFrame) -> DataFrame:
    """Alignments of the chains' own sequences, for chains that nothing was searched for."""
    return chains.select(*S.CHAIN, F.lit(0).alias("row"), "sequence", F.array_repeat(F.lit(0), F.length("sequence")).alias("deletions"))


def curate(spark: SparkSession, path: str, config: Config | None = None, alignments: DataFrame | None = None, templates: DataFrame | None = None) -> Curated:
    """``alignments`` and ``templates`` are those of ``inputs.model_inputs``; without alignments a chain has its own sequence alone."""
    config = config or Config()
    parsed = src.read_structures(spark, path)
    atoms = cleaned(src.atoms(parsed))
    chains = S.chains(S.residues(atoms))
    verdict = verdicts(parsed, chains, config)
    good = atoms.join(verdict.filter("passed").select("structure_id"), "structure_id", "left_semi")
    checkpoint_folder(spark)
    good = S.without_broken_chains(S.without_excluded_ligands(good), config.filtering.max_ca_distance).checkpoint()  # files are parsed for the verdicts and once for all else
    clash = S.clashing_chains(good, config.filtering.clash_distance, config.filtering.clash_share).select(*S.CHAIN).checkpoint()
    good = good.join(clash, S.CHAIN, "left_anti")
    tokens = S.tokens(good)
    references = crop.reference_tokens(tokens, config.cropping.seed)
    kept = crop.within_atom_budget(crop.spatial_crop(tokens, references, config.cropping.max_tokens), config.cropping.max_atoms)
    cropped = crop.renumbered(kept)
    good_chains, bonds = S.chains(S.residues(good)), S.bonded(good)
    whole = inputs.model_inputs(good, own_sequences(good_chains) if alignments is None else alignments, templates, S.bond_tokens(bonds, tokens), config.alignments.max_rows, config.alignments.max_templates)
    return Curated(verdict, good, good_chains, S.interfaces(good), bonds, cropped, S.token_pairs(cropped), inputs.cropped_inputs(whole, kept))


def write(result: Curated, folder: str) -> None:
    """Each table as Parquet in the folder."""
    for name in ("verdicts", "atoms", "chains", "interfaces", "bonds", "tokens", "pairs", "inputs"):
        getattr(result, name).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def filter_counts(verdict: DataFrame) -> DataFrame:
    return verdict.groupBy(F.coalesce("reason", F.lit("passed")).alias("outcome")).agg(F.count("*").alias("n"))
