"""Objects by key in any file system that Spark can reach: local folders, HDFS, S3, Google and Azure stores by their schemes.

For small things beside tables (settings, manifests, single arrays); tables are read and written by Spark itself.
"""

from __future__ import annotations

import io
import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import workers_find_package

#: Names of stores and the schemes that Spark knows them by.
SCHEMES = {"local": "file", "hdfs": "hdfs", "s3": "s3a", "gcs": "gs", "azure": "abfss", "view": "viewfs"}


def uri(store: str, bucket: str, key: Column) -> Column:
    """The path by which Spark knows an object; local ones have no bucket."""
    return F.concat(F.lit(f"{SCHEMES[store]}://{'' if store == 'local' else bucket}/"), key)


def file_system(path: str):
    """pyarrow's file system of a path and the path in it."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", path):
        path = path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def put_all(objects: DataFrame, root: str) -> None:
    """Each ``content`` (bytes) as the object ``key`` below ``root``, put by the tasks that have it; a task that runs again puts the same again. Spark's ``binaryFile`` source reads them."""

    def run(rows) -> None:
        for r in rows:
            system, at = file_system(f"{root.rstrip('/')}/{r.key}")
            system.create_dir(at.rsplit("/", 1)[0])
            with system.open_output_stream(f"{at}.part", compression=None) as out:
                out.write(bytes(r.content))
            system.move(f"{at}.part", at)

    workers_find_package(objects.sparkSession)
    objects.select("key", "content").foreachPartition(run)


class Storage:
    """Objects under a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway, self._conf = spark.sparkContext._jvm, spark.sparkContext._gateway, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, key: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}" if key else self.root)

    def put(self, key: str, content: bytes) -> None:
        """Replaces what was there in one rename; written beside it first, so that a reader sees the old content or the new one."""
        target, beside = self._path(key), self._path(f"{key}.tmp-")
        out = self._fs.create(beside, True)
        out.write(bytearray(content))
        out.close()
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else self._fs.getUri(), self._conf).rename(beside, target, options)

    def get(self, key: str) -> bytes:
        if not self.exists(key):
            raise KeyError(key)
        stream = self._fs.open(self._path(key))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def exists(self, key: str) -> bool:
        return self._fs.exists(self._path(key))

    def delete(self, key: str) -> bool:
        """Whether it was there."""
        return self._fs.delete(self._path(key), False)

    def list(self, prefix: str = "") -> list[str]:
        """All keys that begin with ``prefix``, in order."""
        if not self._fs.exists(self._path("")):
            return []
        files, out = self._fs.listFiles(self._path(""), True), []
        base = self._fs.makeQualified(self._path("")).toString() + "/"
        while files.hasNext():
            out.append(files.next().getPath().toString().removeprefix(base))
        return sorted(k for k in out if k.startswith(prefix))

    def put_json(self, key: str, value) -> None:
        self.put(key, json.dumps(value).encode())

    def get_json(self, key: str):
        return json.loads(self.get(key))

    def put_arrays(self, key: str, **arrays: np.ndarray) -> None:
        out = io.BytesIO()
        np.savez(out, **arrays)
        self.put(key, out.getvalue())

    def get_arrays(self, key: str) -> dict[str, np.ndarray]:
        with np.load(io.BytesIO(self.get(key)), allow_pickle=False) as found:
            return {k: found[k] for k in found.files}


def create_storage(spark: SparkSession, uri: str) -> Storage:
    """For a path or a uri with a scheme that ``SCHEMES`` has (by either name)."""
    scheme, found, rest = uri.partition("://")
    if not found:
        return Storage(spark, uri)
    known = SCHEMES.get(scheme, scheme)
    if known not in SCHEMES.values():
        raise ValueError(f"not a store: {uri!r}")
    return Storage(spark, f"{known}://{rest}")
