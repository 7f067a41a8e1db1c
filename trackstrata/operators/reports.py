"""Distribution reports: the numbers behind the usual plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clip, cut_labels, finite
from ..model import POLLINATOR_ORDERS

# fixed values: upper edge and label of the duration bins, in display order
DURATION_BINS = ((10, ">0-10"), (100, ">10-100"), (500, ">100-500"))
DURATION_ORDER = ("0", ">0-10", ">10-100", ">100-500", ">500")


def count_by(df: DataFrame, columns: Sequence[str], alias: str = "count") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(alias))


def duration_report(
    df: DataFrame, duration: str = "duration_s", category: str = "order_category", keep: str = "pollinator"
) -> DataFrame:
    """Rows of one category per duration bin, with the bin's place in the display order."""
    label = cut_labels(duration, DURATION_BINS, above=">500", zero="0")
    counts = count_by(df.where(F.col(category) == keep).withColumn("duration_bin", label), ["duration_bin"])
    place = F.array_position(F.array(*[F.lit(x) for x in DURATION_ORDER]), F.col("duration_bin"))
    return counts.withColumn("bin_ord", place.cast("int"))


def composition(
    df: DataFrame,
    column: str = "bioclip_order",
    named: Sequence[str] = POLLINATOR_ORDERS,
    other: str = "Other Orders",
) -> DataFrame:
    """Counts of the named values (zero when absent), all remaining rows as one total."""
    label = F.when(F.col(column).isin(list(named)), F.col(column)).otherwise(F.lit(other))
    counted = [F.count_if(label == F.lit(v)).alias(f"_{i}") for i, v in enumerate([*named, other])]
    row = df.agg(*counted)
    pairs = [
        F.struct(F.lit(v).alias("category"), F.col(f"_{i}").alias("count"), F.lit(i + 1).alias("category_ord"))
        for i, v in enumerate([*named, other])
    ]
    return row.select(F.explode(F.array(*pairs)).alias("_row")).select("_row.*")


def histogram_by(
    df: DataFrame,
    group: str = "bioclip_order",
    column: str = "top1_prob_weighted",
    values: Sequence[str] = POLLINATOR_ORDERS,
    bins: int = 20,
    low: float = 0.0,
    high: float = 1.0,
) -> DataFrame:
    """Equal-width histogram per group over the group's observed range, last bin closed.

    Values are clipped to ``[low, high]`` and counted once per (group, value); range and bins both come
    from those counts, so the table is scanned a single time (the second use is a reused exchange). One
    distinct value gets a range of width one. The groups are a given list, so the ranges are broadcast.
    """
    rows = df.where(F.col(group).isin(list(values))).select(group, clip(finite(column), low, high).alias("_v"))
    counts = rows.where(F.col("_v").isNotNull()).groupBy(group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # the row total keeps the counts from being optimised away into a second scan
    bounds = counts.groupBy(group).agg(
        F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.sum("_n").alias("_rows")
    ).where(F.col("_rows") > 0)
    same = F.col("_min") == F.col("_max")
    bounds = bounds.select(
        group,
        F.when(same, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
        F.when(same, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"),
    )
    span = F.col("_hi") - F.col("_lo")
    estimate = F.least(F.floor((F.col("_v") - F.col("_lo")) / span * F.lit(bins)), F.lit(bins - 1).cast("bigint"))

    def edge(place: Column) -> Column:
        return place * (span / F.lit(float(bins))) + F.col("_lo")

    # the estimate can be one off next to an edge: the edges themselves decide
    place = F.when(F.col("_v") < edge(F.col("_at")), F.col("_at") - 1).when(
        (F.col("_v") >= edge(F.col("_at") + 1)) & (F.col("_at") < F.lit(bins - 1)), F.col("_at") + 1
    )
    placed = counts.join(F.broadcast(bounds), group).withColumn("_at", estimate)
    binned = placed.withColumn("bin", F.coalesce(place, F.col("_at")).cast("int"))
    return (
        binned.groupBy(group, "bin", "_lo", "_hi")
        .agg(F.sum("_n").alias("count"))
        .select(
            group, "bin", edge(F.col("bin")).alias("bin_from"), edge(F.col("bin") + 1).alias("bin_to"), "count"
        )
    )
