"""Every query of the engine's own operators, with the SQL that gives the same rows."""

from __future__ import annotations

from . import curation, features, files, inputs, jobs, kernels, msas, rigid, scalar, spatial, structures

MODULES = (scalar, spatial, curation, features, structures, inputs, rigid, msas, files, jobs, kernels)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict:
    return {k: q for m in MODULES for k, q in m.ORACLES.items()}
