"""mmCIF files as tables: a file is one row of Spark's ``binaryFile`` source and is parsed where it lies.

``read_structures`` gives a nested row for each file; ``atoms``, ``bonds`` and ``operators`` flatten it. Files that
can't be parsed have ``error`` set and empty arrays, so that a bad file stops nothing.
"""

from __future__ import annotations

import gzip
import itertools
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .star import parse_star, table
from .tables import workers_find_package

ATOM = "chain_id string, label_chain_id string, entity_id string, seq_id int, ins_code string, residue string, residue_pos int, atom string, atom_pos int, element string, x double, y double, z double, occupancy double, b_factor double, charge int, is_hetero boolean, alt_loc string, serial int"
BOND = "chain_1 string, seq_1 int, atom_1 string, chain_2 string, seq_2 int, atom_2 string, kind string"
OPERATOR = "assembly string, op string, chain_id string, r11 double, r12 double, r13 double, r21 double, r22 double, r23 double, r31 double, r32 double, r33 double, t1 double, t2 double, t3 double"
SCHEMA = f"structure_id string, path string, method string, resolution double, release_date string, atoms array<struct<{ATOM.replace(' ', ':').replace(',:', ', ')}>>, bonds array<struct<{BOND.replace(' ', ':').replace(',:', ', ')}>>, operators array<struct<{OPERATOR.replace(' ', ':').replace(',:', ', ')}>>, error string"


def number(value: str, kind=float):
    try:
        return kind(value)
    except (TypeError, ValueError):
        return None


ATOM_FIELDS = ("cartn_x", "cartn_y", "cartn_z", "auth_asym_id", "label_asym_id", "auth_seq_id", "label_seq_id", "pdbx_pdb_ins_code", "auth_atom_id", "label_atom_id", "auth_comp_id", "label_comp_id", "label_entity_id", "type_symbol", "occupancy", "b_iso_or_equiv", "pdbx_formal_charge", "group_pdb", "label_alt_id", "id")


def atom_rows(data: dict) -> list[dict]:
    """Author ids before label ids; of alternate places the one with strictly higher occupancy, else the first."""
    best: dict[tuple, dict] = {}
    residues: dict[tuple, int] = {}
    in_chain: dict[str, int] = {}
    columns = {k.partition(".")[2]: v for k, v in data.items() if k.startswith("_atom_site.")}
    n = max((len(v) for v in columns.values()), default=0)
    fields = ([*v, *[""] * (n - len(v))] for v in (columns.get(c, []) for c in ATOM_FIELDS))  # a list a field: a dict a row would take most of the time
    for x, y, z, chain, label_chain, auth_seq, label_seq, ins_code, name, label_name, residue, label_residue, entity, symbol, occupancy, b_factor, charge, group_pdb, alt, serial in zip(*fields, strict=True):
        at = number(x), number(y), number(z)
        chain = chain or label_chain
        if None in at or not chain:
            continue
        seq = number(auth_seq or label_seq, int) or 0
        name, residue = name or label_name, residue or label_residue
        group = (chain, seq, ins_code, residue)
        if group not in residues:
            residues[group] = in_chain.get(chain, 0)
            in_chain[chain] = residues[group] + 1
        weight = number(occupancy)
        row = {
            "chain_id": chain, "label_chain_id": label_chain, "entity_id": entity, "seq_id": seq, "ins_code": ins_code, "residue": residue, "residue_pos": residues[group],
            "atom": name, "element": symbol or name[:1], "x": at[0], "y": at[1], "z": at[2], "occupancy": 1.0 if weight is None else weight, "b_factor": number(b_factor) or 0.0,
            "charge": charge and number(charge, int) or 0, "is_hetero": group_pdb == "HETATM", "alt_loc": alt, "serial": number(serial, int) or 0,
        }
        old = best.get((*group, name))
        if old is None or row["occupancy"] > old["occupancy"]:
            best[(*group, name)] = row if old is None else {**row, "residue_pos": old["residue_pos"]}
    count: dict[tuple, int] = {}
    for r in best.values():
        k = (r["chain_id"], r["residue_pos"])
        r["atom_pos"] = count.get(k, 0)
        count[k] = r["atom_pos"] + 1
    return list(best.values())


def bond_rows(data: dict) -> list[dict]:
    out = []
    for r in table(data, "struct_conn"):
        kind = r.get("conn_type_id", "").lower()
        one, two = (number(r.get(f"ptnr{i}_auth_seq_id", ""), int) for i in (1, 2))
        if ("covale" in kind or "metalc" in kind) and one is not None and two is not None:
            out.append({"chain_1": r.get("ptnr1_auth_asym_id", ""), "seq_1": one, "atom_1": r.get("ptnr1_label_atom_id", ""), "chain_2": r.get("ptnr2_auth_asym_id", ""), "seq_2": two, "atom_2": r.get("ptnr2_label_atom_id", ""), "kind": kind})
    return out


def operator_ids(expression: str) -> list[str]:
    """``1,2``, ``(1-5)`` and products ``(1-3)(4-6)``; a product's ids are joined by ``_``."""
    groups = re.findall(r"\(([^)]*)\)", expression) or [expression]
    parts = []
    for g in groups:
        ids: list[str] = []
        for x in filter(None, (p.strip() for p in g.split(","))):
            m = re.fullmatch(r"(\d+)-(\d+)", x)
            ids += map(str, range(int(m[1]), int(m[2]) + 1)) if m else [x]
        parts.append(ids)
    return ["_".join(p) for p in itertools.product(*parts)]


def operator_ids_of(expression: Column) -> Column:
    """``operator_ids`` over a column, in Arrow batches."""
    return F.pandas_udf(lambda s: s.map(operator_ids), "array<string>")(expression)


def operator_rows(data: dict) -> list[dict]:
    """(assembly, operator, chain) with the operator's matrix; products of operators are composed."""
    import numpy as np

    known = {}
    for r in table(data, "pdbx_struct_oper_list"):
        m = np.eye(4)
        for i in (1, 2, 3):
            m[i - 1, :3] = [number(r.get(f"matrix[{i}][{j}]", "")) or 0.0 for j in (1, 2, 3)]
            m[i - 1, 3] = number(r.get(f"vector[{i}]", "")) or 0.0
        known[r.get("id", "")] = m
    out = []
    for r in table(data, "pdbx_struct_assembly_gen"):
        for op in operator_ids(r.get("oper_expression", "")):
            ids = op.split("_")
            if all(i in known for i in ids):
                m = np.linalg.multi_dot([known[i] for i in ids]) if len(ids) > 1 else known[ids[0]]
                values = {f"r{i + 1}{j + 1}": float(m[i, j]) for i in range(3) for j in range(3)} | {f"t{i + 1}": float(m[i, 3]) for i in range(3)}
                out += [{"assembly": r.get("assembly_id", ""), "op": op, "chain_id": c.strip(), **values} for c in r.get("asym_id_list", "").split(",") if c.strip()]
    return out


def first_of(data: dict, *keys: str) -> str:
    return next((v[0] for k in keys if (v := data.get(k)) and v[0]), "")


# Where dates and resolutions stand, the first that is there counts.
DATE_KEYS = ("_pdbx_database_status.recvd_initial_deposition_date", "_database_pdb_rev.date_original")
RESOLUTION_KEYS = ("_refine.ls_d_res_high", "_em_3d_reconstruction.resolution", "_reflns.d_resolution_high")
# End of fixed values.


def resolution_of(data: dict) -> float | None:
    return next((x for k in RESOLUTION_KEYS if (x := number(first_of(data, k))) is not None), None)


def parse_structure(path: str, content: bytes, tables: tuple[str, ...] = ("atoms", "bonds", "operators")) -> dict:
    """A file's row; of its tables only those asked for are made, the others are empty."""
    name = re.sub(r"\.(cif|mmcif)(\.gz)?$", "", path.rsplit("/", 1)[-1])
    try:
        data = parse_star((gzip.decompress(content) if path.endswith(".gz") else content).decode())
        return {
            "structure_id": name, "path": path, "method": first_of(data, "_exptl.method").upper(), "resolution": resolution_of(data), "release_date": first_of(data, *DATE_KEYS) or None,
            **{t: rows(data) if t in tables else [] for t, rows in (("atoms", atom_rows), ("bonds", bond_rows), ("operators", operator_rows))}, "error": None,
        }
    except Exception as e:  # noqa: BLE001  whatever is wrong with a file is the file's error
        return {"structure_id": name, "path": path, "method": "", "resolution": None, "release_date": None, "atoms": [], "bonds": [], "operators": [], "error": f"{type(e).__name__}: {e}"}


def parsed(files: DataFrame, *tables: str) -> DataFrame:
    """A nested row for each ``path`` and ``content`` (bytes). Where ``tables`` are named, the others are left empty; ``""`` names none."""
    workers_find_package(files.sparkSession)
    kind, asked = to_arrow_schema(StructType.fromDDL(SCHEMA)), tables or ("atoms", "bonds", "operators")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, c in zip(b.column("path"), b.column("content"), strict=True):
                yield pa.RecordBatch.from_pylist([parse_structure(p.as_py(), c.as_py(), asked)], kind)

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    return parsed(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").filter(F.col("path").rlike(r"\.(cif|mmcif)(\.gz)?$")))


def star_rows(files: DataFrame, category: str) -> DataFrame:
    """``path, pos, values``: the rows of a category in each ``path`` and ``content`` (bytes), columns by lower-case name."""
    workers_find_package(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, i, r) for p, c in zip(b["path"], b["content"], strict=True) for i, r in enumerate(table(parse_star(bytes(c).decode()), category))]
            yield pd.DataFrame(rows, columns=["path", "pos", "values"])

    return files.select("path", "content").mapInPandas(run, "path string, pos int, values map<string,string>")


def release_dates(files: DataFrame) -> DataFrame:
    """``pdb_id, date`` of each file, from its text alone: the last word of the first line with the key; null where it is no date."""
    lines = files.select("path", F.posexplode(F.split(F.decode("content", "UTF-8"), r"\r?\n")).alias("pos", "line")).filter(F.col("line").startswith("_pdbx_database_status.recvd_initial_deposition_date"))
    first = lines.groupBy("path").agg(F.min_by("line", "pos").alias("line"))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.(cif|mmcif)(\.gz)?$", "")
    found = files.select("path").join(first, "path", "left")
    return found.select(name.alias("pdb_id"), F.try_to_date(F.element_at(F.split("line", r"\s+"), -1), "yyyy-M-d").alias("date"))


def _flat(structures: DataFrame, column: str) -> DataFrame:
    return structures.select("structure_id", F.explode(column).alias("r")).select("structure_id", "r.*")


def atoms(structures: DataFrame) -> DataFrame:
    return _flat(structures, "atoms")


def bonds(structures: DataFrame) -> DataFrame:
    return _flat(structures, "bonds")


def operators(structures: DataFrame) -> DataFrame:
    return _flat(structures, "operators")
