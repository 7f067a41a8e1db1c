"""Exact-size, seeded, without-replacement sampling.

The rows of a sample are the ``n`` smallest priorities (a keyed hash, see ``sample_priority``) of each
stratum: the same rows after any repartitioning, nested for growing ``n``, and found with a partial
limit in every task before the shuffle. ``keys`` must identify a row.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sample_priority
from ..model import SEED, TRACK_KEYS
from ..session import broadcast_if_small, hold

_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
_DIGITS = 4
#: how much of the group limit the wanted rows of a sub-stratum are expected to take
_FILL = 0.6
#: rows of a stratum that one task may rank
_FEW_KEPT = 2_000_000


def group_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(_LIMIT_CONF, "1000"))


def _cells(ranked: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Rows per (stratum, cell of equal leading hex digits) and how many rows come before the cell; at
    most 16**digits rows per stratum, so the running count never holds a stratum's rows."""
    counts = ranked.groupBy(*strata, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*strata).orderBy("_cell") if strata else Window.orderBy("_cell")
    before = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return counts.select(*strata, "_cell", F.coalesce(before, F.lit(0)).alias("_before"))


def _ranked(df: DataFrame, seed: int, salt: str, keys: Sequence[str], digits: int) -> DataFrame:
    ranked = df.withColumn("_priority", sample_priority(seed, salt, keys))
    return ranked.withColumn("_cell", F.conv(F.substring("_priority", 1, digits), 16, 10).cast("int"))


def _large_sample(
    df: DataFrame, strata: Sequence[str], n: int, seed: int, keys: Sequence[str], salt: str, digits: int = _DIGITS
) -> DataFrame:
    """The same rows for an ``n`` above the group-limit threshold, with one pass over ``df``.

    Strata are dealt into so many sub-strata, by a hash that does not follow the order, that each is expected to hold a
    fraction of the threshold of the ``n`` rows sought. The group limit then works on them, and what is left,
    about ``n`` rows a stratum, is held. A sub-stratum that was cut although the sample reaches beyond its last row
    would lose rows: that is checked, and the cells of the whole table are taken then."""
    limit = group_limit(df)
    share = math.ceil(n / (limit * _FILL))
    hashed = df.withColumn("_priority", sample_priority(seed, salt, keys))
    # numbers are sorted faster than texts; two strata of one number would only be cut too early, which is seen below
    group = F.xxhash64(*strata, F.pmod(F.xxhash64("_priority", F.lit("deal")), F.lit(share)))
    hashed = hashed.withColumn("_group", group)
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_priority", *keys))
    kept = hold(hashed.withColumn("_place", place).where(F.col("_place") <= limit).drop("_group"))
    if share * limit <= _FEW_KEPT:
        rank = F.row_number().over(Window.partitionBy(*strata).orderBy("_priority", *keys))
        sample = kept.withColumn("_rank", rank).where(F.col("_rank") <= n)
    else:
        sample = hold(_by_cells(kept, kept.columns, strata, n, seed, keys, salt, digits))
    # rows after the last one of a sub-stratum can be missing only if that one is in the sample
    if sample.where(F.col("_place") == limit).isEmpty():
        return sample.select(*df.columns)
    return _by_cells(df, df.columns, strata, n, seed, keys, salt, digits)


def _by_cells(
    df: DataFrame, columns: Sequence[str], strata: Sequence[str], n: int, seed: int, keys: Sequence[str], salt: str, digits: int
) -> DataFrame:
    """Only the cells that can hold one of the ``n`` smallest priorities are kept, and rows are ranked within their cell and
    shifted by the rows before it, so no task sees a whole stratum."""
    ranked = _ranked(df, seed, salt, keys, digits)
    cells = _cells(ranked, strata).where(F.col("_before") < F.lit(n))
    cells = broadcast_if_small(
        cells.select(*[F.col(s).alias(f"_of_{s}") for s in strata], F.col("_cell").alias("_at"), "_before")
    )
    same = [F.col("_cell") == F.col("_at"), *[F.col(s).eqNullSafe(F.col(f"_of_{s}")) for s in strata]]
    within = F.row_number().over(Window.partitionBy(*strata, "_cell").orderBy("_priority", *keys))
    kept = ranked.join(cells, same).withColumn("_place", within + F.col("_before")).where(F.col("_place") <= n)
    return kept.select(*columns)


def stratified_sample(
    df: DataFrame,
    strata: Sequence[str],
    n: int,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    salt: str = "",
) -> DataFrame:
    """``min(n, size)`` rows of every stratum.

    Up to Spark's group-limit threshold each task ships at most ``n`` rows per stratum. Above it Spark
    would send whole strata to single tasks, so larger samples are cut by sub-strata and by cells of priorities.
    """
    if n <= 0:
        return df.limit(0)
    if not strata:
        return sample_n(df, n, seed, keys, salt)
    if n > group_limit(df):
        return _large_sample(df, strata, n, seed, keys, salt)
    ranked = df.withColumn("_priority", sample_priority(seed, salt, keys))
    place = F.row_number().over(Window.partitionBy(*strata).orderBy("_priority", *keys))
    return ranked.withColumn("_place", place).where(F.col("_place") <= n).drop("_place", "_priority")


def sample_n(
    df: DataFrame, n: int, seed: int = SEED, keys: Sequence[str] = TRACK_KEYS, salt: str = ""
) -> DataFrame:
    """``min(n, size)`` rows of the whole table: a top-k per task, then of those; a large ``n`` is cut by
    cells of priorities instead of being gathered in one task."""
    if n > group_limit(df):
        return _large_sample(df, [], n, seed, keys, salt)
    ranked = df.withColumn("_priority", sample_priority(seed, salt, keys))
    return ranked.orderBy("_priority", *keys).limit(max(n, 0)).drop("_priority")


def top_values(df: DataFrame, column: str, n: int = 25, count: str = "count") -> DataFrame:
    """The ``n`` most frequent non-null values, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count))
    return counts.orderBy(F.desc(count), F.asc(column)).limit(n)


def chunk(
    df: DataFrame,
    size: int = 100,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    salt: str = "chunk",
    part: str = "part",
    position: str | None = None,
    digits: int = _DIGITS,
) -> DataFrame:
    """Shuffle the rows and number them into parts of exactly ``size`` (the last may be smaller).

    A global rank without a one-task sort: rows are ranked within cells of equal leading hex digits,
    and the running count of at most 16**digits cells (a fixed bound, so broadcast) is added. The rows are computed and
    shuffled once, for the counts and for the ranks.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    ranked = _ranked(df, seed, salt, keys, digits).repartition("_cell")
    within = F.row_number().over(Window.partitionBy("_cell").orderBy("_priority", *keys))
    # a metric over all columns keeps them in the counted branch, so its exchange is that of the ranked rows and runs once
    counted = ranked.observe(f"chunk-{uuid.uuid4().hex}", F.max(F.xxhash64(*ranked.columns)).alias("checksum"))
    # every cell is there; a left join adds no filter to the ranked branch alone
    placed = ranked.join(F.broadcast(_cells(counted, [])), "_cell", "left")
    numbered = placed.withColumn("_place", within + F.col("_before"))
    numbered = numbered.withColumn(part, F.floor((F.col("_place") - 1) / F.lit(size)) + 1)
    if position:
        numbered = numbered.withColumn(position, F.col("_place"))
    return numbered.drop("_priority", "_cell", "_before", "_place")
