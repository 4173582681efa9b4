"""mmCIF files as a data source that reads what is asked for: ``spark.read.format("mmcif").option("table", "structures").load(folder)``.

Tables: ``structures`` (one row a file), ``atoms``, ``bonds`` and ``operators``. A file is read line by line; categories that the table
and its columns don't need are passed over without being parsed, and reading ends when all that is needed is there. So what is
known of an entry (date, method, resolution, assemblies) costs its head, not its atoms. Files are dealt to tasks by their bytes.

A schema given by the reader's ``schema`` prunes columns; ``scan`` makes it from column names. Comparisons of ``structure_id`` with
constants prune files where ``spark.sql.python.filterPushdown.enabled`` is set (option ``pushdown``, which ``scan`` sets).

Files are opened by pyarrow's file systems (local, ``s3://``, ``gs://``, ``hdfs://``); for stores that only Spark knows, ``structures.read_structures``
reads whole files through Spark. Text that doesn't begin a loop or an item on a line of its own is parsed whole. Of an item or category that
is repeated, the first one counts here. A file that can't be parsed has ``error`` in ``structures`` and no rows in the other tables.
"""

from __future__ import annotations

import codecs
import gzip
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from .star import parse_star
from .storage import file_system, put_all
from .structures import ATOM, BOND, DATE_KEYS, OPERATOR, RESOLUTION_KEYS, atom_rows, bond_rows, first_of, number, operator_rows, resolution_of
from .tables import workers_find_package

TABLES = {
    "structures": "structure_id string, path string, method string, resolution double, release_date string, error string", "atoms": f"structure_id string, {ATOM}", "bonds": f"structure_id string, {BOND}", "operators": f"structure_id string, {OPERATOR}",
}
CATEGORIES = {"atoms": ("atom_site",), "bonds": ("struct_conn",), "operators": ("pdbx_struct_oper_list", "pdbx_struct_assembly_gen")}
ROWS = {"atoms": atom_rows, "bonds": bond_rows, "operators": operator_rows}
#: Bytes and number of the files of a task (a head costs as much in a small file), and rows of a batch.
PARTITION_BYTES, PARTITION_FILES, BATCH_ROWS = 32 << 20, 500, 10_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
NAME = re.compile(r"\.(cif|mmcif)(\.gz)?$")


#: What a line begins with that may be more than a row of a loop (as ``loop_``, ``data_``, ``save_``, items and text do), beside blanks and signs.
MARKS = frozenset("lLdDsS_;")


class Irregular(Exception):
    """The text isn't laid out in lines."""


class Needed:
    """What is still to be found: items by falling priority, and categories."""

    def __init__(self, table: str, columns: Iterable[str]):
        columns = set(columns)
        self.items: list[list[str]] = []
        if table == "structures":
            self.items = [list(keys) for column, keys in (("method", ("_exptl.method",)), ("resolution", RESOLUTION_KEYS), ("release_date", DATE_KEYS)) if column in columns]
        self.open = set(CATEGORIES.get(table, ()))
        self.categories = self.open | {k[1:].split(".")[0] for keys in self.items for k in keys}

    def close(self, category: str, text: list[str]) -> None:
        """A category has ended. A usable item of highest priority settles the lower ones."""
        self.open.discard(category)
        for key, values in parse_star("".join(text)).items() if self.items else ():
            usable = number(values[0]) is not None if key in RESOLUTION_KEYS else values[0] or key not in DATE_KEYS
            self.items = [keys for keys in self.items if not (usable and key == keys[0])]

    def done(self) -> bool:
        return not self.items and not self.open


def wanted_lines(lines: Iterable[str], needed: Needed) -> Iterator[str]:
    """The lines of the categories needed, up to the one that ends the last of them."""
    block = in_loop = headed = waiting = keep = False  # in a text block; in a loop; its header has ended; an item's value is due; the lines are needed
    category, text = "", []
    for line in lines:
        if headed and not (block or waiting) and "0" <= line[0] <= "z" and line[0] not in MARKS:  # a row of a loop
            if keep:
                if needed.items:
                    text.append(line)
                yield line
            continue
        if block:
            block = not line.startswith(";")
        elif line.startswith(";"):
            block, waiting, headed = True, False, headed or in_loop
        else:
            low = line.lstrip().lower()
            if not low or low.startswith("#"):
                continue
            words = low.split(None, 1)
            header = low.startswith("_") and in_loop and not headed
            if not header and low.startswith(("loop_", "_", "data_", "save_")):
                new = words[0][1:].split(".")[0] if low.startswith("_") else ""
                if waiting or (not new and len(words) > 1):
                    raise Irregular
                if keep and (in_loop or new != category):
                    needed.close(category, text)
                    if needed.done():
                        return
                    text = []
                category, in_loop, headed, keep, waiting = new, low.startswith("loop_"), False, new in needed.categories, bool(new) and len(words) == 1
            elif header:
                if len(words) > 1:
                    raise Irregular
                if not category:
                    category = words[0][1:].split(".")[0]
                    keep = category in needed.categories
                    if keep:
                        text.append("loop_\n")
                        yield "loop_\n"
            else:
                waiting, headed = False, headed or in_loop
        if keep:
            if needed.items:
                text.append(line)
            yield line


def lines_of(chunks: Iterable[bytes]) -> Iterator[str]:
    """Text lines of bytes in pieces; lines end as Python's universal newlines do."""
    decoder, rest = codecs.getincrementaldecoder("utf-8")(), ""
    for chunk in chunks:
        rest += decoder.decode(chunk)
        *whole, rest = rest.replace("\r\n", "\n").split("\n")
        for line in whole:
            yield line + "\n"
    rest += decoder.decode(b"", True)
    if rest:
        yield rest


def parsed_items(open_lines, needed_of) -> dict:
    """The items and categories needed of a text; ``open_lines`` opens it, ``needed_of`` says what is needed."""
    try:
        return parse_star("".join(wanted_lines(open_lines(), needed_of())))
    except Irregular:
        return parse_star("".join(open_lines()))


def file_rows(table: str, columns: list[str], path: str, open_lines) -> list[dict]:
    name = NAME.sub("", path.rsplit("/", 1)[-1])
    empty = {"structure_id": name, "path": path, "method": "", "resolution": None, "release_date": None, "error": None}
    if table == "structures" and not {"method", "resolution", "release_date", "error"} & set(columns):
        return [empty]
    if table == "structures" and "error" in columns:
        columns = [*columns, "method", "resolution", "release_date"]
    try:
        data = parsed_items(open_lines, lambda: Needed(table, columns))
        if table == "structures":
            return [empty | {"method": first_of(data, "_exptl.method").upper(), "resolution": resolution_of(data), "release_date": first_of(data, *DATE_KEYS) or None}]
        return [{"structure_id": name, **r} for r in ROWS[table](data)]
    except Exception as e:  # noqa: BLE001  whatever is wrong with a file is the file's error
        return [empty | {"error": f"{type(e).__name__}: {e}"}] if table == "structures" else []


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class MmcifReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        options = {k.lower(): v for k, v in options.items()}
        self.path, self.table, self.columns = options["path"], options.get("table", "structures"), [f.name for f in schema.fields]
        self.schema, self.most = schema, int(options.get("partitionbytes", PARTITION_BYTES))
        self.names: set[str] | None = None

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        system, root = file_system(self.path)
        prefix = self.path[: len(self.path) - len(root)] if self.path.endswith(root) else ""
        info = system.get_file_info(root)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size or 0) for f in found if f.is_file and NAME.search(f.path) and (self.names is None or NAME.sub("", f.base_name) in self.names))
        out: list[list[str]] = [[]]
        size = 0
        for path, n in files:
            if out[-1] and (size + n > self.most or len(out[-1]) == PARTITION_FILES):
                out.append([])
                size = 0
            out[-1].append(prefix + path)
            size += n
        return [Files(p) for p in out]

    def read(self, partition: Files):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kind, rows = to_arrow_schema(self.schema), []
        batch = lambda: pa.RecordBatch.from_pylist(rows, kind)
        for path in partition.paths:
            rows += file_rows(self.table, self.columns, path, lambda p=path: lines_of(self.chunks(p)))
            if len(rows) >= BATCH_ROWS:
                yield batch()
                rows = []
        if rows:
            yield batch()

    @staticmethod
    def chunks(path: str) -> Iterator[bytes]:
        system, at = file_system(path)
        with system.open_input_stream(at, compression=None) as raw:
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
            while chunk := stream.read(1 << 16):
                yield chunk


class PushdownReader(MmcifReader):
    """Spark asks for filters only where pushdown is on, and has no readers that take them elsewhere."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Names of structures choose files; the rows are filtered by Spark besides."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("structure_id",):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.names = names if self.names is None else self.names & names
            yield f


class MmcifSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mmcif"

    def schema(self) -> str:
        table = self.options.get("table", "structures")
        if table not in TABLES:
            raise ValueError(f"no table {table!r} in mmCIF files")
        return TABLES[table]

    def reader(self, schema: StructType) -> MmcifReader:
        return (PushdownReader if self.options.get("pushdown") == "true" else MmcifReader)(dict(self.options), schema)


def scan(spark: SparkSession, path: str, table: str = "structures", columns: Iterable[str] | None = None, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The columns of a table of all files below ``path`` (or of the one file)."""
    workers_find_package(spark)
    spark.dataSource.register(MmcifSource)
    whole = StructType.fromDDL(TABLES[table])
    schema = whole if columns is None else StructType([whole[c] for c in columns])
    return spark.read.format("mmcif").schema(schema).option("table", table).option("partitionBytes", partition_bytes).option("pushdown", spark.conf.get(PUSHDOWN)).load(path)


def write_files(files: DataFrame, folder: str) -> None:
    """Each ``content`` as the file of its ``path``'s name in the folder."""
    put_all(files.select(F.element_at(F.split("path", "/"), -1).alias("key"), "content"), folder)
