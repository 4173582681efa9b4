"""Queries of rigid motions: superpositions of the fixture's chains, symmetry of made operator tables, augmented residues."""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import geometry, rigid
from ..operators import structures as S
from ..sources.tables import checkpoint_folder, read_table
from .base import Queries
from .curation import HASH_SQL
from .fixture import ATOMS, atoms

q = Queries()
QUERIES, ORACLES = q.queries, q.oracles
MOBILE, TARGET = ("ax", "ay", "az"), ("bx", "by", "bz")

# Superposition: chain AF of a structure onto that of the next one, atom by atom; hydrogens have no weight, others what their place in the residue says.
PAIRED = f"""WITH {ATOMS}, af AS (SELECT *, dense_rank() OVER (ORDER BY structure_id) AS idx FROM atoms WHERE chain_id = 'AF'),
pairs AS (SELECT a.structure_id, a.x AS ax, a.y AS ay, a.z AS az, b.x AS tx, b.y AS ty, b.z AS tz, CASE WHEN a.element = 'H' THEN 0 ELSE {{weight}} END::DOUBLE AS w FROM af a JOIN af b ON b.idx = a.idx + 1 AND (a.residue_pos, a.atom_pos) = (b.residue_pos, b.atom_pos))"""
_H = [f"h{i}{j}" for i in "xyz" for j in "xyz"]
FITTED = f"""{PAIRED}, means AS (SELECT structure_id, count(*) AS n, sum(w) AS weight, {', '.join(f'sum(w * {s}{k}) / sum(w) AS u{s}{k}' for s in 'at' for k in 'xyz')} FROM pairs WHERE w > 0 GROUP BY 1),
hh AS (SELECT structure_id, {', '.join(f'sum(w * (a{i} - ua{i}) * (t{j} - ut{j})) AS h{i}{j}' for i in 'xyz' for j in 'xyz')}, sum(w * ({' + '.join(f'({s}{k} - u{s}{k}) * ({s}{k} - u{s}{k})' for s in 'at' for k in 'xyz')})) AS squares FROM pairs JOIN means USING (structure_id) WHERE w > 0 GROUP BY 1),
ss AS (SELECT *, {', '.join(f"{' + '.join(f'h{k}{i} * h{k}{j}' for k in 'xyz')} AS s{i}{j}" for i, j in ('xx', 'yy', 'zz', 'xy', 'xz', 'yz'))}, hxx * (hyy * hzz - hyz * hzy) - hxy * (hyx * hzz - hyz * hzx) + hxz * (hyx * hzy - hyy * hzx) AS det FROM hh),
ee AS (SELECT *, (sxx + syy + szz) / 3 AS q FROM ss), f AS (SELECT *, sqrt(((sxx - q) * (sxx - q) + (syy - q) * (syy - q) + (szz - q) * (szz - q) + 2 * (sxy * sxy + sxz * sxz + syz * syz)) / 6) AS p FROM ee),
g AS (SELECT *, acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, ((sxx - q) * ((syy - q) * (szz - q) - syz * syz) - sxy * (sxy * (szz - q) - syz * sxz) + sxz * (sxy * syz - (syy - q) * sxz)) / (2 * p * p * p)))) / 3 AS phi FROM f),
lam AS (SELECT *, q + 2 * p * cos(phi) AS e1 FROM g),
fits AS (SELECT structure_id, n, weight, uaz, utx, hxx, hyz, hzy, sqrt(greatest(0, (squares - 2 * (sqrt(e1) + sqrt(greatest(0, 3 * q - e1 + 2 * det / sqrt(e1))))) / weight)) AS rmsd FROM lam JOIN means USING (structure_id))
SELECT structure_id, n, weight, round(uaz / sqrt(2), 6) AS mobile_z, round(utx / sqrt(2), 6) AS target_x, round(hxx / sqrt(2), 4) AS hxx, round(hyz / sqrt(2), 4) AS hyz, round(hzy / sqrt(2), 4) AS hzy, round(rmsd, 3) AS rmsd FROM fits"""


def paired(spark, d: str, weighted: bool) -> DataFrame:
    """An atom goes to its own structure as a mobile point and to the one before as a target, so that atoms are read once and both meet by one exchange by structure, which later groups keep."""
    own = atoms(spark, d).filter("chain_id = 'AF'")
    before = F.lag("structure_id").over(Window.orderBy("structure_id"))
    names = own.select("structure_id").distinct().withColumn("before", before)  # a row a structure
    weight = F.when(F.col("element") == "H", 0).otherwise(F.col("atom_pos") + 1 if weighted else 1).cast("double")
    to = F.explode(F.array(F.struct(F.col("structure_id").alias("to"), F.lit(True).alias("mobile")), F.struct(F.col("before").alias("to"), F.lit(False).alias("mobile"))))
    sides = own.select("structure_id", "residue_pos", "atom_pos", *"xyz", weight.alias("w")).join(names, "structure_id").select(to.alias("at"), "residue_pos", "atom_pos", *"xyz", "w")
    points = sides.filter("at.to IS NOT NULL").select(F.col("at.to").alias("structure_id"), "at.mobile", "residue_pos", "atom_pos", *"xyz", "w").repartition("structure_id")
    of = lambda c, mobile: F.max(F.when(F.col("mobile") == mobile, F.col(c)))  # noqa: E731  an atom's place is its own, so there is one of each
    met = points.groupBy("structure_id", "residue_pos", "atom_pos").agg(*(of(c, s == "a").alias(f"{s}{c}") for s in "ab" for c in "xyz"), of("w", True).alias("w"), of("w", False).alias("__target"))
    return met.filter("w IS NOT NULL AND __target IS NOT NULL").drop("__target")


def fits(spark, d: str, weighted: bool) -> DataFrame:
    out = rigid.superpositions(paired(spark, d, weighted), ["structure_id"], MOBILE, TARGET, "w")
    scaled = lambda c, places: F.round(c / math.sqrt(2), places)  # noqa: E731  so that no value is half way between two decimals
    h = lambda i: scaled(F.col("covariance")[i], 4)
    return out.select("structure_id", "n", "weight", scaled(F.col("mobile_centroid")[2], 6).alias("mobile_z"), scaled(F.col("target_centroid")[0], 6).alias("target_x"), h(0).alias("hxx"), h(5).alias("hyz"), h(7).alias("hzy"), F.round("rmsd", 3).alias("rmsd"))


for _name, _weighted in (("l13_superpositions", False), ("l16_weighted_superpositions", True)):
    q.put(_name, lambda spark, d, w=_weighted: fits(spark, d, w), FITTED.format(weight="a.atom_pos + 1" if _weighted else "1"))


@q(f"{PAIRED.format(weight='1')} SELECT structure_id, count(*) FILTER (w > 0) AS n, true AS orthogonal, true AS best FROM pairs GROUP BY 1")
def l14_rotations(spark, d: str) -> DataFrame:
    """Rotations are orthogonal with determinant 1, and the moved points are as far from their targets as the fit says (and not farther than they were about their centroids)."""
    p = paired(spark, d, False)
    r = lambda i, j: F.col("rotation")[3 * i + j]
    off = sum((F.abs(sum((r(i, k) * r(j, k) for k in range(3)), F.lit(0.0)) - float(i == j)) for i in range(3) for j in range(3)), F.lit(0.0))
    det = sum((r(0, i) * (r(1, (i + 1) % 3) * r(2, (i + 2) % 3) - r(1, (i + 2) % 3) * r(2, (i + 1) % 3)) for i in range(3)), F.lit(0.0))
    found = rigid.superpositions(p, ["structure_id"], MOBILE, TARGET, "w").withColumn("orthogonal", (off < 1e-9) & (F.abs(det - 1) < 1e-9))
    moved = rigid.fitted(p, found, ["structure_id"], MOBILE, ("n", "orthogonal", "rmsd")).filter("w > 0 AND n IS NOT NULL")  # fits come along, so that they are made once
    far = F.sqrt(F.avg(sum(((F.col(a) - F.col(b)) * (F.col(a) - F.col(b)) for a, b in zip(MOBILE, TARGET, strict=True)), F.lit(0.0))))
    out = moved.groupBy("structure_id").agg(F.max("n").alias("n"), F.bool_and("orthogonal").alias("orthogonal"), F.max("rmsd").alias("rmsd"), far.alias("far"))
    return out.select("structure_id", "n", "orthogonal", (F.abs(F.col("far") - F.col("rmsd")) < 1e-6).alias("best"))


# Symmetry: a supplier's group is told by its key, and its operators are turned about z by as many degrees as its key.
GROUPS = ("C1", "C2", "C3", "C5", "D2", "D3", "D5", "T", "O", "I")


def turn(axis: tuple[float, float, float], degrees: float) -> np.ndarray:
    x, y, z = np.array(axis) / np.linalg.norm(axis)
    k, a = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]]), math.radians(degrees)
    return np.eye(3) + math.sin(a) * k + (1 - math.cos(a)) * k @ k


@functools.cache
def elements() -> tuple[tuple, ...]:
    """All operators of each group: its place among ``GROUPS`` and the matrix by rows, rounded."""
    makers = {"C1": [], "T": [turn((0, 0, 1), 180), turn((1, 1, 1), 120)], "O": [turn((0, 0, 1), 90), turn((1, 1, 1), 120)]}
    makers |= {f"C{n}": [turn((0, 0, 1), 360 / n)] for n in (2, 3, 5)} | {f"D{n}": [turn((0, 0, 1), 360 / n), turn((1, 0, 0), 180)] for n in (2, 3, 5)}
    out = []
    for g, name in enumerate(GROUPS):
        if name == "I":
            found = geometry.icosahedral()
        else:
            seen, todo = {}, [np.eye(3)]
            while todo:
                m = todo.pop()
                key = tuple(np.round(m, 6).ravel() + 0.0)
                if key not in seen:
                    seen[key] = m
                    todo += [k @ m for k in makers[name]]
            found = list(seen.values())
        out += [(g, i, *np.round(m.ravel(), 9).tolist()) for i, m in enumerate(found)]
    return tuple(out)


def operators(spark, d: str) -> DataFrame:
    known = spark.createDataFrame(list(elements()), "g int, op int, " + ", ".join(f"m{i}{j} double" for i in (1, 2, 3) for j in (1, 2, 3)))
    own = read_table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % len(GROUPS)).cast("int").alias("g")).join(F.broadcast(known), "g")
    a = F.radians(F.col("s_suppkey").cast("double"))
    z = [[F.cos(a), -F.sin(a), F.lit(0.0)], [F.sin(a), F.cos(a), F.lit(0.0)], [F.lit(0.0), F.lit(0.0), F.lit(1.0)]]
    half = {f"h{i}{j}": sum((z[i - 1][k - 1] * F.col(f"m{k}{j}") for k in (1, 2, 3)), F.lit(0.0)) for i in (1, 2, 3) for j in (1, 2, 3)}
    own = own.withColumns(half)
    return own.select("s_suppkey", "op", *(sum((F.col(f"h{i}{k}") * z[j - 1][k - 1] for k in (1, 2, 3)), F.lit(0.0)).alias(f"r{i}{j}") for i in (1, 2, 3) for j in (1, 2, 3)))


_AXES = {"C1": (1, 0, 0, 0, 0, 0), "C2": (2, 1, 1, 0, 0, 0), "C3": (3, 1, 0, 1, 0, 0), "C5": (5, 1, 0, 0, 0, 1), "D2": (4, 3, 3, 0, 0, 0), "D3": (6, 4, 3, 1, 0, 0), "D5": (10, 6, 5, 0, 0, 1), "T": (12, 7, 3, 4, 0, 0), "O": (24, 13, 6, 4, 3, 0), "I": (60, 31, 15, 10, 0, 6)}


@q("SELECT s_suppkey, operators, axes, axes_2, axes_3, axes_4, axes_5, symmetry FROM supplier JOIN (VALUES " + ", ".join(f"({g}, {', '.join(f'{n}::BIGINT' for n in _AXES[name])}, '{name}')" for g, name in enumerate(GROUPS)) + f") v(g, operators, axes, axes_2, axes_3, axes_4, axes_5, symmetry) ON g = s_suppkey % {len(GROUPS)}")
def p38_symmetry_groups(spark, d: str) -> DataFrame:
    checkpoint_folder(spark)
    return rigid.symmetry_groups(operators(spark, d).checkpoint(), ["s_suppkey"])  # tables have plain columns; made ones would be planned for long


@q(f"SELECT s_suppkey, op, round(degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (m11 + m22 + m33 - 1) / 2)))), 3) AS angle FROM supplier JOIN (VALUES {', '.join(f'({g}, {op}, {m[0]}::DOUBLE, {m[4]}::DOUBLE, {m[8]}::DOUBLE)' for g, op, *m in elements())}) v(g, op, m11, m22, m33) ON g = s_suppkey % {len(GROUPS)}")
def l23_rotation_angles(spark, d: str) -> DataFrame:
    return rigid.rotation_facts(operators(spark, d)).select("s_suppkey", "op", F.round("angle", 3).alias("angle"))


# Augmentation: every residue by itself
KEYED = "structure_id || '|' || chain_id || '|' || residue_pos"
SEED = 5


def _normal(part: int) -> str:
    u, v = (HASH_SQL.format(KEYED, 2 * (SEED * 16 + part) + k) for k in (0, 1))
    return f"sqrt(-2 * ln(1 - {u})) * cos(2 * pi() * {v})"


_ROWS = (("1 - 2 * (y * y + z * z)", "2 * (x * y - w * z)", "2 * (x * z + w * y)"), ("2 * (x * y + w * z)", "1 - 2 * (x * x + z * z)", "2 * (y * z - w * x)"), ("2 * (x * z - w * y)", "2 * (y * z + w * x)", "1 - 2 * (x * x + y * y)"))


@q(f"""WITH {ATOMS}, mid AS (SELECT structure_id, chain_id, residue_pos, {', '.join(f'avg({k}) AS m{k}' for k in 'xyz')} FROM atoms GROUP BY 1, 2, 3),
nrm AS (SELECT *, {', '.join(f'{_normal(k)} AS n{k}' for k in range(7))} FROM mid), lng AS (SELECT *, sqrt(n0 * n0 + n1 * n1 + n2 * n2 + n3 * n3) AS len FROM nrm),
uni AS (SELECT *, {', '.join(f'n{i} / len AS {v}' for i, v in enumerate('wxyz'))} FROM lng), trn AS (SELECT structure_id, chain_id, residue_pos, mx, my, mz, n4, n5, n6, {', '.join(f'{e} AS t{i}{j}' for i, row in enumerate(_ROWS) for j, e in enumerate(row))} FROM uni)
SELECT structure_id, chain_id, residue_pos, atom_pos, {', '.join(f"round({' + '.join(f't{i}{j} * (x{j} - m{j_})' for j, j_ in enumerate('xyz'))} + 1.5 * n{4 + i}, 5) + 0.0 AS {c}" for i, c in enumerate('xyz'))} FROM (SELECT structure_id, chain_id, residue_pos, atom_pos, x AS x0, y AS x1, z AS x2 FROM atoms) JOIN trn USING (structure_id, chain_id, residue_pos)""")
def i11_augmented_residues(spark, d: str) -> DataFrame:
    out = rigid.augmented(atoms(spark, d).select(*S.RESIDUE, "atom_pos", "x", "y", "z"), S.RESIDUE, SEED, 1.5)
    return out.select(*S.RESIDUE, "atom_pos", *((F.round(c, 5) + 0.0).alias(c) for c in "xyz"))
