"""Numerical kernels that are sequential or need linear algebra, and their grouped forms."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def superposition(mobile: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Rotation, translation and RMSD of the best rigid fit of ``mobile`` onto ``target`` (rows are points)."""
    a, b = mobile.mean(axis=0), target.mean(axis=0)
    u, _, vt = np.linalg.svd((mobile - a).T @ (target - b))
    flip = np.diag([1.0, 1.0, np.sign(np.linalg.det(vt.T @ u.T)) or 1.0])
    r = vt.T @ flip @ u.T
    t = b - r @ a
    return r, t, float(np.sqrt(((mobile @ r.T + t - target) ** 2).sum(axis=1).mean()))


def superposed(df: DataFrame, key: str, mobile: tuple[str, str, str], target: tuple[str, str, str]) -> DataFrame:
    """The RMSD of each group's fit; groups under three points have none. A group is one pair of structures or chains."""
    kind = dict(df.dtypes)[key]

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        rmsd = superposition(g[list(mobile)].to_numpy(float), g[list(target)].to_numpy(float))[2] if len(g) >= 3 else None
        return pd.DataFrame({key: [g[key].iloc[0]], "n": [len(g)], "rmsd": [rmsd]})

    return df.select(key, *mobile, *target).groupBy(key).applyInPandas(fit, f"`{key}` {kind}, n long, rmsd double")


def frame(a: np.ndarray, origin: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """Rows x, y, z of the frame at ``origin`` with x toward ``b`` and ``a`` in the x-y plane; None if they are on a line."""
    x, v = b - origin, a - origin
    if np.linalg.norm(x) < 1e-6:
        return None
    x = x / np.linalg.norm(x)
    y = v - (v @ x) * x
    if np.linalg.norm(y) < 1e-6:
        return None
    y = y / np.linalg.norm(y)
    return np.stack([x, y, np.cross(x, y)])


def aligned(query: str, other: str, gap_open: float = -10.0, gap_extend: float = -1.0, match: float = 4.0, mismatch: float = -1.0) -> tuple[str, str]:
    """A global alignment in which gaps inside cost ``gap_extend`` a place, and leading ones ``gap_open`` once besides."""
    n, m = len(query), len(other)
    score = np.zeros((n + 1, m + 1))
    score[1:, 0] = gap_open + gap_extend * np.arange(n)
    score[0, 1:] = gap_open + gap_extend * np.arange(m)
    letters = np.frombuffer(other.encode("utf-32-le"), np.uint32)
    along = gap_extend * np.arange(m + 1)
    for i in range(1, n + 1):  # a row at once: what comes from the left is a running maximum
        best = np.where(letters == ord(query[i - 1]), match, mismatch) + score[i - 1, :-1]
        row = np.concatenate((score[i, :1], np.maximum(best, score[i - 1, 1:] + gap_extend)))
        score[i] = np.maximum.accumulate(row - along) + along
    a, b, i, j = [], [], n, m
    while i or j:
        s = (match if query[i - 1] == other[j - 1] else mismatch) if i and j else 0
        if i and j and abs(score[i, j] - score[i - 1, j - 1] - s) < 1e-9:
            a.append(query[i := i - 1])
            b.append(other[j := j - 1])
        elif i and (not j or abs(score[i, j] - score[i - 1, j] - gap_extend) < 1e-9):
            a.append(query[i := i - 1])
            b.append("-")
        else:
            a.append("-")
            b.append(other[j := j - 1])
    return "".join(a[::-1]), "".join(b[::-1])


def greedy_distinct(rows: list[str], threshold: float = 0.9) -> list[int]:
    """Places of the rows kept in order: the first, and each whose identity to all kept ones but the first is under the threshold."""
    kept = [0] if rows else []
    codes = [np.frombuffer(r.encode("utf-32-le"), np.uint32) for r in rows]
    for i in range(1, len(rows)):
        if all(len(codes[i]) != len(codes[j]) or (codes[i] == codes[j]).mean() < threshold for j in kept[1:]):
            kept.append(i)
    return kept


def greedily_deduplicated(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``greedy_distinct`` for each alignment of ``msa, row, sequence``; an alignment is one task's group by nature."""
    kinds = dict(df.dtypes)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("row", kind="stable").reset_index(drop=True)
        return g.iloc[greedy_distinct(g["sequence"].tolist(), threshold)]

    return df.select("msa", "row", "sequence").groupBy("msa").applyInPandas(run, f"msa {kinds['msa']}, row {kinds['row']}, sequence string")


def symmetry_label(operators: int, angles: list[int]) -> str:
    """A guess from the number of operators and their rotation angles in whole degrees."""
    fixed = {1: "C1", 12: "T", 24: "O", 60: "I"}
    if operators in fixed:
        return fixed[operators]
    if operators > 1 and any(a == round(360 / operators) for a in angles):
        return f"C{operators}"
    return f"D{operators // 2}" if operators > 2 and operators % 2 == 0 else "unknown"


def symmetry_by_count(operators: Column) -> Column:
    """A guess from the number of operators alone."""
    known = {1: "identity", 2: "C2", 3: "C3", 4: "C4", 5: "C5", 6: "C6", 12: "T", 24: "O", 60: "I"}
    pairs = [F.lit(x) for kv in known.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), operators.cast("int")), F.lit("other"))


def rotation_angle(r: np.ndarray) -> float:
    return float(np.degrees(np.arccos(np.clip((np.trace(r) - 1) / 2, -1, 1))))


def rmsd(df: DataFrame, key: str, a: tuple[str, str, str], b: tuple[str, str, str]) -> DataFrame:
    squares = sum((F.col(x) - F.col(y)) * (F.col(x) - F.col(y)) for x, y in zip(a, b, strict=True))
    return df.groupBy(key).agg(F.sqrt(F.avg(squares)).alias("rmsd"))


def grown(contacts: dict[tuple[str, str], int], chains: list[str], most: int, seed: int) -> list[str]:
    """Up to ``most`` chains: one by chance, then always the one with most contacts to those chosen (of equals the first by name), or one by chance where none has any."""
    rng = np.random.default_rng(seed)
    left = sorted(chains)
    out: list[str] = []
    while left and len(out) < most:
        score = {c: sum(contacts.get((min(c, o), max(c, o)), 0) for o in out) for c in left}
        best = max(score.values())
        pick = left[int(rng.integers(len(left)))] if best == 0 else next(c for c in left if score[c] == best)
        out.append(pick)
        left.remove(pick)
    return out


def cropped_to_chains(chains: DataFrame, contacts: DataFrame, most: int = 20, seed: int = 0) -> DataFrame:
    """The chains kept of each structure (``structure_id, chain_id``; ``contacts`` has ``chain_1, chain_2, contacts``). A structure's chains are one group."""
    kind = dict(chains.dtypes)["structure_id"]
    edges = contacts.groupBy("structure_id").agg(F.collect_list(F.struct("chain_1", "chain_2", "contacts")).alias("edges"))
    both = chains.groupBy("structure_id").agg(F.collect_set("chain_id").alias("chains")).join(edges, "structure_id", "left")

    def run(batches):
        for b in batches:
            rows = []
            for s, own, near in zip(b["structure_id"], b["chains"], b["edges"], strict=True):
                known = {(min(e["chain_1"], e["chain_2"]), max(e["chain_1"], e["chain_2"])): e["contacts"] for e in (near if near is not None else ())}
                key = int(pd.util.hash_array(np.array([f"{s}|{seed}"], dtype=object))[0])
                rows += [(s, c, i) for i, c in enumerate(grown(known, list(own), most, key))]
            yield pd.DataFrame(rows, columns=["structure_id", "chain_id", "place"])

    return both.mapInPandas(run, f"structure_id {kind}, chain_id string, place int")


def composed(matrices: list[np.ndarray]) -> np.ndarray:
    """One 4 x 4 operator from several, the last applied first."""
    out = np.eye(4)
    for m in matrices:
        out = out @ m
    return out


def inverse(matrix: np.ndarray) -> np.ndarray:
    out = np.eye(4)
    out[:3, :3] = matrix[:3, :3].T
    out[:3, 3] = -matrix[:3, :3].T @ matrix[:3, 3]
    return out


def rotation_axis(r: np.ndarray) -> np.ndarray | None:
    """The unit axis of a rotation; None for the identity."""
    values, vectors = np.linalg.eig(r)
    if rotation_angle(r) < 1e-6:
        return None
    axis = np.real(vectors[:, np.argmin(abs(values - 1))])
    return axis / np.linalg.norm(axis) * (1 if axis[np.argmax(abs(axis))] > 0 else -1)


def icosahedral() -> list[np.ndarray]:
    """All sixty rotations of the icosahedron, as products of a five-fold and a two-fold turn."""
    phi = (1 + 5**0.5) / 2

    def turn(axis: np.ndarray, angle: float) -> np.ndarray:
        x, y, z = axis / np.linalg.norm(axis)
        k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
        return np.eye(3) + np.sin(angle) * k + (1 - np.cos(angle)) * k @ k

    makers = [turn(np.array([0, 1, phi]), 2 * np.pi / 5), np.diag([-1.0, -1.0, 1.0])]
    seen, todo = {}, [np.eye(3)]
    while todo:
        r = todo.pop()
        key = tuple(np.round(r, 6).ravel() + 0.0)
        if key not in seen:
            seen[key] = r
            todo += [m @ r for m in makers]
    return list(seen.values())


def mapped(query: str, template: str) -> list[int]:
    """For each letter of an aligned query the place of its template letter, or -1."""
    out, j = [], -1
    for a, b in zip(query, template, strict=True):
        j += b != "-"
        if a != "-":
            out.append(j if b != "-" else -1)
    return out
