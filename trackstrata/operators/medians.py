"""Exact group medians and the split of rows around them.

A median is taken over (group, value, count) rows: the counts combine on the map side, so a group
holding a large share of all rows costs only its distinct values. Their number is bounded before a task orders them:
by the caller's word (probabilities rounded to two decimals have at most 101), or by an approximate count per group,
taken in one pass that shuffles no values. Groups with more than ``most`` values are narrowed to a bracket of their median first,
by :func:`group_median_refined`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import median_half
from ..session import BROADCAST_ROWS, broadcast_if_small, hold


MOST_VALUES = 65_536
_COUNT_ERROR = 0.05


def _middle(low: Column, high: Column) -> Column:
    return (low + high) * F.lit(0.5)


def _from_counts(counts: DataFrame, groups: Sequence[str], alias: str) -> DataFrame:
    """``counts`` has groups, _v, _n, and _before/_total: rows of the group below the kept values and
    rows of the group in all."""
    running = F.sum("_n").over(
        Window.partitionBy(*groups).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counts.withColumn("_upto", running + F.col("_before"))
    lower, upper = F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1")
    return (
        ranked.groupBy(*groups)
        .agg(
            F.min(F.when(F.col("_upto") >= lower, F.col("_v"))).alias("_low"),
            F.min(F.when(F.col("_upto") >= upper, F.col("_v"))).alias("_high"),
        )
        .select(*groups, _middle(F.col("_low"), F.col("_high")).alias(alias))
    )


def group_median(
    df: DataFrame,
    groups: Sequence[str],
    column: str,
    alias: str = "median",
    values: int | None = None,
    most: int = MOST_VALUES,
) -> DataFrame:
    """Exact median per group (mean of the two middle values for even counts); nulls are ignored.

    ``values`` states a proven bound on a group's distinct values. Without one they are counted approximately, and if a group
    may have more than ``most``, no task gets them all (see :func:`group_median_refined`)."""
    if values is None:
        value = F.col(column).cast("double")
        each = df.where(value.isNotNull()).groupBy(*groups).agg(F.approx_count_distinct(value, _COUNT_ERROR).alias("_n"))
        # five standard errors above the estimate
        values = int((each.agg(F.max("_n")).first()[0] or 0) * (1 + 5 * _COUNT_ERROR))
    if values > most:
        return group_median_refined(df, groups, column, alias, most=most)
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*groups, F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sized = counts.withColumns(
        {"_total": F.sum("_n").over(Window.partitionBy(*groups)), "_before": F.lit(0).cast("bigint")}
    )
    return _from_counts(sized, groups, alias)


def group_median_refined(
    df: DataFrame, groups: Sequence[str], column: str, alias: str = "median", cells: int = 64, most: int = MOST_VALUES
) -> DataFrame:
    """The same result for columns with unbounded distinct values, however they are spread: no task meets more than
    ``most`` (2 or more) distinct values of a group. Approximate quantiles close to the middle give each group two values
    that bracket its median; rows outside are only counted. While a group has more than ``most`` values in its bracket,
    its quantiles cut it into ``cells`` cells, and the ones that hold the middle ranks stay. Null group values are
    skipped."""
    value = F.col(column).cast("double")
    rows = df.where(value.isNotNull()).dropna(subset=list(groups)).select(*groups, value.alias("_v"))
    edges = rows.groupBy(*groups).agg(F.percentile_approx("_v", [0.4995, 0.5005], 10_000).alias("_e"))
    placed = rows.join(broadcast_if_small(edges), list(groups))
    below, above = F.col("_v") < F.col("_e")[0], F.col("_v") > F.col("_e")[1]
    counted = hold(
        placed.groupBy(*groups, F.when(~below & ~above, F.col("_v")).alias("_v"), below.alias("_below")).agg(
            F.count(F.lit(1)).alias("_n")
        )
    )
    sizes = counted.groupBy(*groups).agg(
        F.sum("_n").alias("_total"), F.sum(F.when(F.col("_below"), F.col("_n")).otherwise(F.lit(0))).alias("_before")
    )
    inside = counted.where(F.col("_v").isNotNull()).drop("_below")
    counts = hold(inside.join(broadcast_if_small(sizes), list(groups)))
    while not counts.groupBy(*groups).count().where(F.col("count") > most).isEmpty():
        counts = hold(_narrowed(counts, groups, cells))
    return _from_counts(counts, groups, alias)


def _narrowed(counts: DataFrame, groups: Sequence[str], cells: int) -> DataFrame:
    """``counts`` without the cells of each group that cannot hold its middle ranks."""
    splits = [i / cells for i in range(1, cells)]
    cut = counts.groupBy(*groups).agg(F.percentile_approx("_v", splits, 10_000).alias("_s"))
    cell = F.size(F.filter("_s", lambda split: split < F.col("_v")))
    placed = counts.join(broadcast_if_small(cut), list(groups)).withColumn("_cell", cell).drop("_s")
    histogram = placed.groupBy(*groups, "_cell", "_before", "_total").agg(F.sum("_n").alias("_n"))
    running = F.sum("_n").over(
        Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = histogram.withColumn("_upto", running + F.col("_before"))
    start = F.col("_upto") - F.col("_n")
    middle = (F.col("_upto") >= F.expr("(_total + 1) div 2")) & (start < F.expr("_total div 2 + 1"))
    target = ranked.where(middle).groupBy(*groups).agg(
        F.min("_cell").alias("_from"), F.max("_cell").alias("_to"), F.min(start).alias("_before")
    )
    kept = placed.drop("_before").join(broadcast_if_small(target), list(groups))
    return kept.where(F.col("_cell").between(F.col("_from"), F.col("_to"))).drop("_cell", "_from", "_to")


def median_split(
    df: DataFrame,
    groups: Sequence[str],
    column: str,
    median: str = "median",
    label: str = "prob_cat",
    max_groups: int | None = None,
    values: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add the group's median and a low/high label; rows without a group are dropped.

    ``values`` states a proven bound on the distinct values of a group, which are counted otherwise (see :func:`group_median`).

    ``max_groups`` states a proven bound on the number of groups (a fixed domain, a top-N list): their
    medians are broadcast lazily. Otherwise they are held and counted, and broadcast only if few.
    """
    present = df.dropna(subset=list(groups))
    medians = group_median(present, groups, column, median, values)
    if max_groups is not None and max_groups <= broadcast_rows:
        medians = F.broadcast(medians)
    else:
        medians = broadcast_if_small(medians, broadcast_rows)
    return present.join(medians, list(groups), "left").withColumn(label, median_half(column, median))
