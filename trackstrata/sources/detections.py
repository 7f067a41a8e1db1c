"""Detection files and stored tables. Schemas are always given, never inferred: two files inferred
apart may disagree on the type of a key column, which breaks the joins on it."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import strip
from ..model import DETECTION_DDL, DETECTIONS_GLOB, PLAIN_DETECTION_DDL
from ..session import broadcast_if_small
from .listing import can_list, first_bytes

SOURCE_FILE = "_source_file"
HEADER_BYTES = 1 << 20


def _struct(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _csv(spark: SparkSession, schema: StructType, glob: str):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )


def _lines(spark: SparkSession, directory: str, glob: str) -> DataFrame:
    """(value, source_file, _start): the lines that are not blank."""
    lines = spark.read.text(directory, recursiveFileLookup=True, pathGlobFilter=glob)
    found = lines.select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_start"))
    return found.where(F.trim("value") != "")


def _headers(spark: SparkSession, directory: str, glob: str, lines: DataFrame, required: list[str]) -> DataFrame:
    """(source_file, _header): the first line of each file that names all required columns, among its first ``HEADER_BYTES``
    bytes where tasks can open the files, else in its first block."""
    if not can_list(directory):
        return _scanned_headers(lines, required)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(directory)
    named = files.select("path", F.col("_metadata.file_path").alias("source_file"))
    heads = first_bytes(named, "path", HEADER_BYTES)
    text = F.regexp_replace(F.make_valid_utf8(F.col("head").cast("string")), "^\ufeff", "")
    found = F.split(text, r"\r\n|\n|\r")
    # a line cut off by the limit is no header
    found = F.when(F.length("head") < HEADER_BYTES, found).otherwise(F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0))))
    names = lambda line: F.transform(F.split(line, ","), lambda x: strip(F.replace(x, F.lit('"'), F.lit(""))))
    headers = F.filter(found, lambda line: F.forall(F.array(*[F.lit(c) for c in required]), lambda c: F.array_contains(names(line), c)))
    return heads.select("source_file", F.try_element_at(headers, F.lit(1)).alias("_header")).where("_header is not null")


def _scanned_headers(lines: DataFrame, required: list[str]) -> DataFrame:
    """The same from a scan of the lines. Row numbers grow along a block, so a later data row that holds the names is never
    taken. Other lines do not reach the grouping."""
    names = F.transform(F.split("value", ","), lambda x: strip(F.replace(x, F.lit('"'), F.lit(""))))
    numbered = lines.where("_start = 0").withColumn("_at", F.monotonically_increasing_id())
    for column in required:
        numbered = numbered.where(F.contains("value", F.lit(column)) & F.array_contains(names, column))
    return numbered.groupBy("source_file").agg(F.min_by("value", "_at").alias("_header"))


def _names(header: str) -> list[str]:
    names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")]))]
    twice = {n for n in names if names.count(n) > 1}
    if twice or "" in names:
        raise ValueError(f"header with empty or repeated names: {header}")
    return names


def _by_name(spark: SparkSession, directory: str, glob: str, wanted: StructType | None, required: list[str]) -> DataFrame:
    lines = _lines(spark, directory, glob)
    headers = broadcast_if_small(_headers(spark, directory, glob, lines, required))
    texts = sorted(r["_header"] for r in headers.select("_header").distinct().collect())
    if not texts:
        raise ValueError(f"no file with a header of {required} matches {glob!r} below {directory}")
    layouts = [_names(t) for t in texts]
    types = {f.name: f.dataType.simpleString() for f in wanted or _struct(f"{DETECTION_DDL}, {_only_plain()}")}
    missing = F.raise_error(F.concat(F.lit("no header line in "), F.col("source_file")))
    rows = lines.join(headers, "source_file", "left").withColumn("_header", F.coalesce("_header", missing)).where("value != _header")
    parsed = {}
    for i, (text, names) in enumerate(zip(texts, layouts)):
        ddl = ", ".join(f"`{n.replace('`', '``')}` {types.get(n, 'string')}" for n in names)
        parsed[f"_row{i}"] = F.when(F.col("_header") == text, F.from_csv("value", ddl))
    rows = rows.withColumns(parsed)
    found = list(dict.fromkeys(n for names in layouts for n in names))
    order = [*types, *[n for n in found if n not in types]] if wanted else found
    columns = []
    for name in order:
        cells = [F.col(f"_row{i}").getField(name) for i, names in enumerate(layouts) if name in names]
        columns.append((F.coalesce(*cells) if cells else F.lit(None).cast(types[name])).alias(name))
    return rows.select(*columns, F.col("source_file").alias(SOURCE_FILE))


def _only_plain() -> str:
    return ", ".join(c for c in PLAIN_DETECTION_DDL.split(", ") if c not in DETECTION_DDL.split(", "))


def read_detections(
    spark: SparkSession,
    directory: str,
    glob: str = DETECTIONS_GLOB,
    schema: str | StructType | None = DETECTION_DDL,
    by_name: bool = False,
    key: str = "cam_ID",
    with_source: bool = False,
) -> DataFrame:
    """All detection CSVs below ``directory`` as one scan.

    Columns are read by position and a file whose header disagrees with the schema fails loudly.
    ``by_name`` accepts any header that names ``key`` and ``timestamp`` (found in the first bytes of each file; only the
    distinct header lines reach the driver). Every line is then parsed by its own file's header, one line a row. Columns
    that the schema does not know are kept as text, those a file lacks are null there; without a schema the
    columns are the ones found. A file without such a header ends the job.
    """
    if by_name:
        table = _by_name(spark, directory, glob, None if schema is None else _struct(schema), [key, "timestamp"])
        return table.withColumnRenamed(SOURCE_FILE, "source_file") if with_source else table.drop(SOURCE_FILE)
    wanted = _struct(DETECTION_DDL if schema is None else schema)
    source = [F.col("_metadata.file_path").alias("source_file")] if with_source else []
    return _csv(spark, wanted, glob).csv(directory).select(*wanted.fieldNames(), *source)


def read_table(
    spark: SparkSession, path: str, schema: str | StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A stored table; CSV and JSON need a schema."""
    if fmt == "parquet" or fmt == "orc":
        reader = spark.read.schema(_struct(schema)) if schema is not None else spark.read
        return reader.format(fmt).load(path)
    if schema is None:
        raise ValueError(f"a {fmt} table needs a schema")
    reader = spark.read.schema(_struct(schema))
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path)
