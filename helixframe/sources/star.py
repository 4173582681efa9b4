"""STAR text (the syntax of mmCIF files) as columns.

Lines are split at white space, and Python's ``re`` takes what has quoted blanks, comments or text blocks; loops are cut into rows by their header's width, whether or not a
row is on one line, and an unfinished last row is dropped. The last value of a repeated key wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

TOKEN = re.compile(r"""^;(?P<block>.*?)^;|(?P<comment>\#[^\n]*)|'(?P<single>.*?)'(?=\s|$)|"(?P<double>.*?)"(?=\s|$)|(?P<plain>\S+)""", re.M | re.S | re.X)


def tokens(text: str) -> Iterator[tuple[str, bool]]:
    """Values with whether they were bare words (keys and keywords are; quoted text is not)."""
    for m in TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "block":
            yield m["block"].strip("\n"), False
        elif kind != "comment":
            yield m[kind], kind == "plain"


def clean(value: str) -> str:
    return "" if value in (".", "?") else value


UNKNOWN = {".": "", "?": ""}


def lines_of_tokens(text: str) -> list[list[tuple[str, bool]] | list[str]]:
    """The tokens of each line; a line that is a row of bare words at most, without keys and keywords, has its cleaned values alone. One list where a token may go over lines."""
    if text.startswith(";") or "\n;" in text:
        return [list(tokens(text))]
    out, known = [], UNKNOWN.get
    for line in text.split("\n"):
        quoted = "'" in line or '"' in line
        if "#" not in line and "_" not in line:
            values = line.split()
            if not quoted:
                out.append([known(v, v) for v in values])
                continue
            if all(v[0] not in "'\"" or (len(v) > 1 and v[-1] == v[0]) for v in values):
                out.append([v[1:-1] if v[0] in "'\"" else known(v, v) for v in values])
                continue
        found = list(tokens(line))
        if quoted and any(bare and v[0] in "'\"" for v, bare in found):
            return [list(tokens(text))]
        out.append(found)
    return out


def parse_star(text: str) -> dict[str, list[str]]:
    """Lower-case key -> its values (one for a plain pair)."""
    out: dict[str, list[str]] = {}
    header: list[str] = []
    row: list[str] = []
    rows: list[list[str]] = []
    looping, key = False, None

    def close() -> None:
        nonlocal header, row, rows, looping
        if len(set(header)) < len(header):  # a key twice takes both values, row by row
            for r in rows:
                for h, v in zip(header, r, strict=True):
                    out[h].append(v)
        elif rows:
            for h, values in zip(header, zip(*rows, strict=True), strict=True):
                out[h].extend(values)
        header, row, rows, looping = [], [], [], False

    for line in lines_of_tokens(text):
        if line and isinstance(line[0], str):
            if header and looping and not row and len(line) == len(header):
                rows.append(line)
                continue
            line = [(v, None) for v in line]
        for value, bare in line:
            low = value.lower() if bare else ""
            if low.startswith("data_") or low.startswith("save_"):
                close()
                key = None
            elif low == "loop_":
                close()
                looping, key = True, None
            elif low.startswith("_"):
                if looping and not row and not rows:
                    header.append(low)
                    out[low] = []
                else:
                    close()
                    key = low
            elif looping and header:
                row.append(clean(value) if bare else value)
                if len(row) == len(header):
                    rows.append(row)
                    row = []
            elif key:
                out[key] = [clean(value) if bare else value]
                key = None
    close()
    return out


def table(data: dict[str, list[str]], category: str) -> list[dict[str, str]]:
    """The rows of a category, from a loop or from single pairs."""
    columns = {k.partition(".")[2]: v for k, v in data.items() if k.startswith(f"_{category}.")}
    n = max((len(v) for v in columns.values()), default=0)
    return [{k: v[i] if i < len(v) else "" for k, v in columns.items()} for i in range(n)]
