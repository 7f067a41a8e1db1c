"""Listing of folders and first bytes of files, in tasks.

Spark's own file sources list all files on the driver. Here each round lists the folders that the round before found, in
parallel, and the names stay in stored tables. Only file systems that pyarrow opens by address can be listed so.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hold

#: Spark's name of a scheme and pyarrow's
SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs"}
ENTRIES = 10_000


def _scheme(address: str) -> str:
    found = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):", address)
    return found.group(1).lower() if found else "file"


def can_list(address: str) -> bool:
    return _scheme(address) in SCHEMES


def opened(address: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path in it, what precedes the path in Spark's addresses of files)."""
    scheme = _scheme(address)
    rest = address.split(":", 1)[1] if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", address) else address
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    system, path = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")
    authority = f"{scheme}:{rest}"
    return system, path, authority[: len(authority) - len(path.rstrip("/"))] if authority.rstrip("/").endswith(path.rstrip("/")) else f"{scheme}://"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, path, before = opened(folder)
            entries = [e for e in system.get_file_info(fs.FileSelector(path)) if not e.base_name.startswith(("_", "."))]
            for at in range(0, len(entries), ENTRIES):
                part = entries[at : at + ENTRIES]
                names = [before + e.path for e in part]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([e.type == fs.FileType.Directory for e in part])], ["path", "is_folder"])


def list_files(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """(path) of all files below a folder whose name matches; names that begin with ``_`` or ``.`` are hidden, as for Spark."""
    level = spark.range(1).select(F.lit(directory).alias("path"))
    found = None
    while True:
        entries = hold(level.mapInArrow(_listed, "path string, is_folder boolean"))
        files = entries.where(~F.col("is_folder")).select("path")
        found = files if found is None else found.unionByName(files)
        # folders are dealt to tasks by name, as many as a round found
        level = entries.where("is_folder").select("path").repartition("path")
        if level.isEmpty():
            break
    if glob == "*":
        return found
    return found.where(F.regexp_extract("path", r"[^/]+$", 0).rlike(fnmatch.translate(glob).replace(r"\Z", "$").replace(r"\z", "$")))


def first_bytes(paths: DataFrame, path: str, size: int) -> DataFrame:
    """``paths`` with ``head``: the first ``size`` bytes of each file."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in paths.schema)}, head binary"
    names = paths.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                system, place, _ = opened(one.column(names.index(path))[0].as_py())
                with system.open_input_stream(place) as stream:
                    head = stream.read(size)
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([head], pa.binary())], [*names, "head"])

    return paths.mapInArrow(run, schema)
