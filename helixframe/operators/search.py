"""Searches by external programs: argument lists, and a table-valued operator that runs them where they are installed.

Where a program is missing, each query's alignment is the query alone, as after a search without hits.
"""

from __future__ import annotations

import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Search:
    """A database's limits: hits reported, rows kept, and the database size assumed by the statistics."""

    database: str
    reported: int | None = None
    rows: int | None = None
    z: int | None = None


# Limits of the searches.
SEARCHES = {
    "uniref90": Search("uniref90", 100_000, 10_000), "uniprot": Search("uniprot", 500_000, 50_000, 138_515_945), "reduced_bfd": Search("reduced_bfd", 50_000, 5_000),
    "mgnify": Search("mgnify", 50_000, 5_000), "rfam": Search("rfam", None, 10_000), "rnacentral": Search("rnacentral", None, 10_000), "nt": Search("nt", None, 10_000),
}
# End of fixed values.


# programs' arguments.


def jackhmmer(query: str, database: str, output: str, cpus: int = 4, reported: int | None = None, z: int | None = None) -> list[str]:
    extra = ([] if reported is None else ["--seq_limit", str(reported)]) + ([] if z is None else ["-Z", str(z)])
    return ["jackhmmer", "-N", "1", "-E", "0.0001", "--incE", "0.0001", "--F1", "0.0005", "--F2", "0.00005", "--F3", "0.0000005", "--cpu", str(cpus), "-A", output, *extra, query, database]


def hhblits(query: str, database: str, output: str, cpus: int = 4) -> list[str]:
    return ["hhblits", "-i", query, "-d", database, "-oa3m", output, "-n", "3", "-e", "0.001", "-cpu", str(cpus)]


def nhmmer(query: str, database: str, output: str, length: int, cpus: int = 4) -> list[str]:
    return ["nhmmer", "-E", "0.001", "--incE", "0.001", "--rna", "--watson", "--F3", "0.02" if length < 50 else "0.00005", "--cpu", str(cpus), "-A", output, query, database]


def hmmbuild(alignment: str, output: str, name: str = "query") -> list[str]:
    return ["hmmbuild", "--amino", "-n", name, output, alignment]


def hmmsearch(model: str, database: str, alignment: str, scores: str, cpus: int = 4) -> list[str]:
    return ["hmmsearch", "--noali", "--F1", "0.1", "--F2", "0.1", "--F3", "0.1", "-E", "100", "--incE", "100", "-Z", "10000", "--cpu", str(cpus), "-A", alignment, "--tblout", scores, model, database]


def hmmbuild_rna(query: str, output: str) -> list[str]:
    return ["hmmbuild", "--rna", output, query]


def hmmalign(model: str, sequences: str, output: str) -> list[str]:
    return ["hmmalign", "--rna", "--outformat", "Stockholm", "-o", output, model, sequences]


def mmseqs(fasta: str, output: str, scratch: str, identity: float = 0.4, coverage: float = 0.8, mode: int = 1) -> list[str]:
    return ["mmseqs", "easy-cluster", fasta, output, scratch, "--min-seq-id", str(identity), "-c", str(coverage), "--cov-mode", str(mode)]


# End of fixed values.


def named_search(name: str, folder: str = "databases") -> Callable[[str, str, int], list[str]]:
    """The command of a search by its database's name."""
    path = f"{folder}/{name}"
    if name in ("uniclust30", "bfd"):
        return lambda q, o, _: hhblits(q, path, o)
    if name in ("rfam", "rnacentral", "nt"):
        return lambda q, o, n: nhmmer(q, path, o, n)
    limits = SEARCHES[name]
    return lambda q, o, _: jackhmmer(q, path, o, reported=limits.reported, z=limits.z)


def searched(queries: DataFrame, command: Callable[[str, str, int], list[str]], timeout: int = 3600) -> DataFrame:
    """``id, found, output, error`` for rows ``id, sequence``; ``command`` takes the query's and the output's path and its length.

    The programs' files are the worker's own and gone when its row is made.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for id_, s in zip(b["id"], b["sequence"], strict=True):
                with tempfile.TemporaryDirectory() as d:
                    q, o = Path(d, "query.fasta"), Path(d, "output")
                    q.write_text(f">{id_}\n{s}\n")
                    args = command(str(q), str(o), len(s))
                    error = None
                    if shutil.which(args[0]) is None:
                        error = f"{args[0]} is not installed"
                    else:
                        try:
                            done = subprocess.run(args, capture_output=True, text=True, timeout=timeout)  # noqa: S603
                            error = done.stderr[-1000:] if done.returncode else None
                        except subprocess.TimeoutExpired:
                            error = f"{args[0]} took over {timeout} s"
                    good = error is None and o.exists()
                    rows.append((str(id_), good, o.read_text() if good else f">{id_}\n{s}\n", error))
            yield pd.DataFrame(rows, columns=["id", "found", "output", "error"])

    return queries.selectExpr("cast(id as string) id", "sequence").mapInPandas(run, "id string, found boolean, output string, error string")


def realigned(alignments: DataFrame, model: str | None = None, build: Callable[[str, str], list[str]] = hmmbuild_rna, align: Callable[[str, str, str], list[str]] = hmmalign, timeout: int = 3600) -> DataFrame:
    """``id, realigned, output, error`` for rows ``id, names, sequences`` (the query first): Stockholm text of the ungapped sequences aligned to a model of the query, or to ``model``.

    ``output`` is the given alignment as FASTA where it has one sequence, a program is missing or fails. A ``model`` that doesn't exist is an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if model is not None and not Path(model).exists():
            raise FileNotFoundError(model)
        for b in batches:
            rows = []
            for id_, names, sequences in zip(b["id"], b["names"], b["sequences"], strict=True):
                bare = [s.replace("-", "").replace(".", "") for s in sequences]
                error, output = None, "".join(f">{n}\n{s}\n" for n, s in zip(names, sequences, strict=True))
                good = False
                if len(sequences) > 1:
                    with tempfile.TemporaryDirectory() as d:
                        q, h, s, o = (str(Path(d, x)) for x in ("query.fasta", "query.hmm", "sequences.fasta", "aligned.sto"))
                        Path(q).write_text(f">query\n{bare[0]}\n")
                        Path(s).write_text("".join(f">{n}\n{x}\n" for n, x in zip(names, bare, strict=True)))
                        for args in ([] if model else [build(q, h)]) + [align(model or h, s, o)]:
                            if shutil.which(args[0]) is None:
                                error = f"{args[0]} is not installed"
                            else:
                                try:
                                    done = subprocess.run(args, capture_output=True, text=True, timeout=timeout)  # noqa: S603
                                    error = (done.stderr[-1000:] or f"{args[0]} failed") if done.returncode else None
                                except subprocess.TimeoutExpired:
                                    error = f"{args[0]} took over {timeout} s"
                            if error is not None:
                                break
                        good = error is None and Path(o).exists()
                        output = Path(o).read_text() if good else output
                rows.append((str(id_), good, output, error))
            yield pd.DataFrame(rows, columns=["id", "realigned", "output", "error"])

    return alignments.selectExpr("cast(id as string) id", "names", "sequences").mapInPandas(run, "id string, realigned boolean, output string, error string")
