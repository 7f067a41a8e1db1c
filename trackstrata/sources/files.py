"""File listings, checklists and table names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import basename
from .checks import require_columns
from .listing import can_list, list_files

_STRATUM = r"^strata(\d+)"


def index_paths(paths: DataFrame, path: str = "path") -> DataFrame:
    """(file_name, file_path): lower-cased base name to path; the greatest path wins a shared name."""
    named = paths.select(basename(path).alias("file_name"), F.col(path).alias("file_path"))
    return named.where(F.col("file_name") != "").groupBy("file_name").agg(F.max("file_path").alias("file_path"))


def file_index(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """Index of the files below a folder, listed in tasks; no contents are read. Where tasks cannot list (see ``listing``), Spark's
    driver does. For a stored table of paths use :func:`index_paths`."""
    if can_list(directory):
        return index_paths(list_files(spark, directory, glob))
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(directory)
        .select("path")
    )
    return index_paths(listing)


def read_checklist(spark: SparkSession, path: str, column: str = "species") -> DataFrame:
    """The distinct non-null names of a checklist CSV."""
    table = require_columns(spark.read.option("header", True).csv(path), [column], "checklist")
    return table.select(F.col(column).cast("string")).dropna().distinct()


def stratum_number(name: str) -> int | None:
    """1 to 8 from a table name such as ``strata3_hym_...``, else None."""
    found = re.match(_STRATUM, name.replace("\\", "/").rsplit("/", 1)[-1])
    number = int(found.group(1)) if found else 0
    return number if 1 <= number <= 8 else None


def with_stratum_number(df: DataFrame, name: str, alias: str = "stratum_number") -> DataFrame:
    """The same as a column, from a column of table or file names."""
    digits = F.regexp_extract(basename(name, lower=False), _STRATUM, 1).try_cast("int")
    return df.withColumn(alias, F.when(digits.between(1, 8), digits))
