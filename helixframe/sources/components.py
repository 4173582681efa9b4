"""Chemical component files: atoms with ideal and model coordinates, bonds and SMILES, one row a component."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .star import parse_star, table
from .structures import number
from .tables import workers_find_package

SCHEMA = (
    "code string, name string, smiles string, atoms array<struct<atom:string, element:string, charge:int, leaving:boolean, ideal_x:double, ideal_y:double, ideal_z:double, model_x:double, model_y:double, model_z:double>>, "
    "bonds array<struct<atom_1:string, atom_2:string, kind:string>>"
)


def parse_component(text: str) -> dict:
    data = parse_star(text)
    atoms = [
        {"atom": r.get("atom_id", ""), "element": r.get("type_symbol", ""), "charge": number(r.get("charge", ""), int) or 0, "leaving": r.get("pdbx_leaving_atom_flag") == "Y"}
        | {f"ideal_{c}": number(r.get(f"pdbx_model_cartn_{c}_ideal", "")) for c in "xyz"} | {f"model_{c}": number(r.get(f"model_cartn_{c}", "")) for c in "xyz"}
        for r in table(data, "chem_comp_atom")
    ]
    bonds = [{"atom_1": r.get("atom_id_1", ""), "atom_2": r.get("atom_id_2", ""), "kind": r.get("value_order", "")} for r in table(data, "chem_comp_bond")]
    smiles = next((r.get("descriptor", "") for r in table(data, "pdbx_chem_comp_descriptor") if r.get("type", "").upper().startswith("SMILES")), None)
    first = lambda k: (data.get(k) or [""])[0]
    return {"code": first("_chem_comp.id"), "name": first("_chem_comp.name"), "smiles": smiles, "atoms": atoms, "bonds": bonds}


def read_components(spark: SparkSession, path: str) -> DataFrame:
    """A file may hold many components (``data_`` blocks), which are split between tasks."""
    workers_find_package(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start, block in zip(b["block"], b["value"], strict=True):
                head, found, rest = block.partition("data_") if start == 0 and block.lstrip().startswith("data_") else ("", True, block)
                if found and rest.strip() and (start or not block.startswith("#")):
                    yield pd.DataFrame({k: [v] for k, v in parse_component("data_" + rest).items()})

    rows = spark.read.option("lineSep", "\ndata_").text(path).select("value", F.col("_metadata.file_block_start").alias("block"))
    return rows.mapInPandas(run, SCHEMA)


def conformers(components: DataFrame) -> DataFrame:
    """Heavy atoms with ideal coordinates, or the model's where a component lacks one of them."""
    a = components.select("code", F.explode("atoms").alias("a")).select("code", "a.*").filter(F.upper("element") != "H")
    whole = F.bool_and(F.col("ideal_x").isNotNull() & F.col("ideal_y").isNotNull() & F.col("ideal_z").isNotNull())
    ideal = a.groupBy("code").agg(whole.alias("ideal"))
    picked = [F.when(F.col("ideal"), F.col(f"ideal_{c}")).otherwise(F.col(f"model_{c}")).alias(c) for c in "xyz"]
    return a.join(ideal, "code").select("code", "atom", "element", "charge", "leaving", *picked, F.when(F.col("ideal"), "ideal").otherwise("model").alias("origin"))


def reference_conformers(atoms: DataFrame, known: DataFrame) -> DataFrame:
    """For each residue's atoms the component's place, else the one observed (centred by residue)."""
    keys = ["structure_id", "chain_id", "residue_pos"]
    mean = atoms.groupBy(*keys).agg(*(F.avg(c).alias(f"m{c}") for c in "xyz"))
    k = known.select(F.col("code").alias("residue"), "atom", *(F.col(c).alias(f"k{c}") for c in "xyz"), "origin")
    out = atoms.join(mean, keys).join(k, ["residue", "atom"], "left")
    return out.select(*keys, "residue", "atom", *(F.coalesce(f"k{c}", F.col(c) - F.col(f"m{c}")).alias(f"ref_{c}") for c in "xyz"), F.coalesce("origin", F.lit("observed")).alias("origin"))
