"""What the corpus operators share: stored intermediate tables and Arrow text columns as bytes."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackstrata.session import hold

BLOCK_BYTES = 4 << 20


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, written as Parquet to the shared folder, and read from there: lost executors
    cost a re-read only, and later steps still prune columns."""
    return hold(df)


def crc_fold(key: Column | str, folds: int) -> Column:
    """``crc32`` of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32((F.col(key) if isinstance(key, str) else key).cast("string").cast("binary")) % folds


def crc_of(text: str) -> int:
    return zlib.crc32(text.encode())


def as_text(column: str) -> Column:
    """The column as string with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def passed(df: DataFrame, added: str) -> T.StructType:
    """The schema of ``df`` followed by the columns of the DDL ``added``, which replace columns of the same name."""
    extra = T.StructType.fromDDL(added)
    names = {f.name.lower() for f in extra}
    return T.StructType([*[f for f in df.schema if f.name.lower() not in names], *extra])


def packed(df: DataFrame, outputs: list[str], keep: list[str] | None = None) -> Column:
    """The caller's columns ``keep`` (all by default) as one struct, without those named like an output, so that they meet no
    internal name on the way. Unpack with ``unpacked``."""
    taken = {o.lower() for o in outputs}
    names = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    return F.struct(*[F.col(_quoted(c)) for c in names]) if names else F.struct(F.lit(None).cast("boolean").alias("_none"))


def unpacked(df: DataFrame, struct: str) -> list[Column]:
    """The columns that ``packed`` put into ``struct``."""
    return [F.col(struct).getField(f.name).alias(f.name) for f in df.schema[struct].dataType if f.name != "_none"]


OWN = "columns_of_the_caller"


def shielded(df: DataFrame, needs: list[str], outputs: list[str], keep: list[str] | None, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The caller's columns ``keep`` and the ``outputs`` of ``operator``, which gets the columns it ``needs`` and, in the one column
    ``OWN``, the caller's: whatever these are called, they meet no name of the operator's."""
    done = operator(df.select(*[F.col(_quoted(c)).alias(c) for c in dict.fromkeys(needs)], packed(df, outputs, keep).alias(OWN)))
    return done.select(*unpacked(done, OWN), *outputs)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def utf8(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its row offsets, without copying; null rows are empty."""
    values = batch.column(batch.schema.get_field_index(column))
    if values.null_count:
        values = values.fill_null("")
    wide = pa.types.is_large_string(values.type)
    _, offsets, data = values.buffers()
    if offsets is None or len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes together (a longer row comes alone)."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(rows, max(start + 1, end))
        yield start, end
        start = end


def let(value: str, name: str, body: str) -> str:
    """SQL text of ``body`` with ``name`` standing for ``value``, computed once. A plain column would be computed again
    wherever the optimizer moves a filter on the result below the projection."""
    return f"transform(array({value}), {name} -> {body})[0]"


def broadcast_under(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A stored table of a few numbers a row, hinted for broadcast if it has at most ``rows`` rows; otherwise joins shuffle it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
