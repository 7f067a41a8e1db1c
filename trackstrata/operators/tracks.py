"""Detections to tracks.

The only pass over the detections is :func:`vote_cells`: it groups by the track and by every
categorical value a later step needs (class, taxonomy, plant), with long, double and timestamp
buffers only. Spark therefore keeps its hash aggregate with map-side combine, a track holding a large
share of all rows is reduced before the shuffle, and everything after works on a few rows per track.
"First" values mean earliest timestamp, then smallest value: rows have no file order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    exact_mean,
    finite,
    mean_from_parts,
    membership_label,
    present,
    round_half_up,
    sum_parts,
    vote_weight,
    wall_clock,
    whole_seconds,
)
from ..model import CLASS, CLASS_PROB, PLANT, POLLINATOR_ORDERS, RANKS, SCORE, TIMESTAMP_FORMAT, TRACK_KEYS

_FAR = float("inf")


def normalize_classes(
    df: DataFrame,
    ranks: Sequence[str] = RANKS,
    score: str = SCORE,
    name: str = CLASS,
    prob: str = CLASS_PROB,
) -> DataFrame:
    """Give the table a class and a probability column, whichever classifier format it has."""
    if name in df.columns and prob in df.columns:
        return df
    if score not in df.columns:
        raise ValueError(f"no class columns: need {name!r} and {prob!r}, or {score!r} with taxonomic ranks")
    present = [r for r in ranks if r in df.columns]
    if not present:
        raise ValueError(f"{score!r} is there but none of the ranks {list(ranks)}")
    return df.withColumns({name: F.coalesce(*present), prob: F.col(score)})


def ts_or_null(column: str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text as ``timestamp_ntz``, null where it does not parse; the fraction is optional."""
    return wall_clock(column, fmt)


def parse_ts(df: DataFrame, column: str = "timestamp", fmt: str = TIMESTAMP_FORMAT, strict: bool = False) -> DataFrame:
    """Text timestamps to ``timestamp_ntz``. Lenient: rows that do not parse are dropped; strict:
    they raise. A column that already is a timestamp is left alone."""
    if df.schema[column].dataType.typeName().startswith("timestamp"):
        return df
    if strict:
        return df.withColumn(column, F.to_timestamp_ntz(F.col(column), F.lit(fmt)))
    return df.withColumn(column, ts_or_null(column, fmt)).where(F.col(column).isNotNull())


def bbox_metrics(
    df: DataFrame,
    width: float = 1.0,
    height: float = 1.0,
    box: Sequence[str] = ("x_min", "x_max", "y_min", "y_max"),
) -> DataFrame:
    """Box sides in frame units, and the longer and shorter of the two."""
    x0, x1, y0, y1 = (F.col(c) for c in box)
    side_x = round_half_up((x1 - x0) * F.lit(float(width)), 4)
    side_y = round_half_up((y1 - y0) * F.lit(float(height)), 4)
    return df.withColumns(
        {
            "bbox_size_x": side_x,
            "bbox_size_y": side_y,
            "bbox_length": F.greatest(side_x, side_y),
            "bbox_width": F.least(side_x, side_y),
        }
    )


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def track_stats(
    detections: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    ts: str = "timestamp",
    confidence: str = "confidence",
) -> DataFrame:
    """Images, time span, mean confidence and mean box sides per track."""
    return (
        keyed(detections, keys)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("track_ID_imgs"),
            F.min(ts).alias("start_time"),
            F.max(ts).alias("end_time"),
            round_half_up(exact_mean(confidence), 2).alias("det_conf_mean"),
            round_half_up(exact_mean("bbox_length"), 3).alias("bbox_length_mean"),
            round_half_up(exact_mean("bbox_width"), 3).alias("bbox_width_mean"),
        )
        .withColumn("duration_s", whole_seconds("start_time", "end_time"))
    )


def _part_names(tag: str) -> list[str]:
    return [f"_{tag}_{part}" for part in ("whole", "high", "low")]


def _measure(tag: str, column: str) -> list[Column]:
    sums = [F.expr(f"sum({part}) as {name}") for part, name in zip(sum_parts(column), _part_names(tag))]
    return [*sums, F.expr(f"count({present(column)}) as _{tag}_n")]


def _merge(tag: str) -> list[Column]:
    return [F.expr(f"sum({name}) as {name}") for name in [*_part_names(tag), f"_{tag}_n"]]


def _mean(tag: str) -> Column:
    return mean_from_parts(_part_names(tag), f"_{tag}_n")


def vote_cells(
    detections: DataFrame,
    keys: Sequence[str],
    name: str,
    prob: str,
    ts: str,
    carried: Sequence[str],
    measures: dict[str, str],
    step: Sequence[str] = (),
) -> DataFrame:
    """Mergeable partial results per (track, class, carried values), clustered by track. With ``step``, the column that
    tells which step removed a row, removed rows are kept as cells of their own."""
    columns = [*step, *keys, name, *carried]
    sums = [c for tag, column in {"prob": prob, **measures}.items() for c in _measure(tag, column)]
    return (
        (detections if step else keyed(detections, keys))
        .groupBy(*columns)
        .agg(
            F.count(F.lit(1)).alias("_images"),
            F.min(ts).alias("_first"),
            F.max(ts).alias("_last"),
            *sums,
        )
        .repartition(*keys)
    )


def _carried(df: DataFrame, ranks: Sequence[str], plant: str, name: str) -> tuple[list[str], list[str]]:
    present = [r for r in ranks if r in df.columns and r != name]
    return present, [plant] if plant in df.columns else []


def _earliest(values: Sequence[str], when: str) -> Column:
    """Values of the earliest row; among equally early ones the smallest, nulls first."""
    return F.min_by(F.struct(*values), F.struct(when, *values))


def _merged(
    cells: DataFrame,
    keys: Sequence[str],
    name: str,
    ranks: list[str],
    plant: list[str],
    tags: Sequence[str],
    step: Sequence[str] = (),
) -> DataFrame:
    """One row per (track, class), still mergeable."""
    carried = [_earliest(ranks, "_first").alias("_ranks")] if ranks else []
    plants = [F.min(F.struct("_first", *plant)).alias("_plant")] if plant else []
    return cells.groupBy(*step, *keys, name).agg(
        F.sum("_images").alias("top1_imgs"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        *[c for tag in tags for c in _merge(tag)],
        *carried,
        *plants,
    )


def _carried_by(parts: DataFrame) -> tuple[list[str], list[str]]:
    """The taxonomy and plant columns that parts hold."""
    ranks = parts.schema["_ranks"].dataType.fieldNames() if "_ranks" in parts.columns else []
    plant = parts.schema["_plant"].dataType.fieldNames()[1:] if "_plant" in parts.columns else []
    return ranks, plant


def _votes(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The parts with the track's image count and first plant alongside."""
    ranks, plant = _carried_by(parts)
    track = Window.partitionBy(*keys)
    added = {
        "track_ID_imgs": F.sum("top1_imgs").over(track),
        "top1_prob_mean": round_half_up(_mean("prob"), 2),
        **{rank: F.col("_ranks").getField(rank) for rank in ranks},
    }
    if plant:
        added[plant[0]] = F.min("_plant").over(track).getField(plant[0])
    votes = parts.withColumns(added)
    return votes.withColumn("top1_prob_weighted", vote_weight("top1_prob_mean", "top1_imgs", "track_ID_imgs"))


def order_category(order: str, orders: Sequence[str], columns: Sequence[str]) -> Column:
    if order not in columns:
        return F.lit("non-pollinator")
    return membership_label(order, orders, "pollinator", "non-pollinator")


def track_votes(
    detections: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    name: str = CLASS,
    prob: str = CLASS_PROB,
    ts: str = "timestamp",
    plant: str = PLANT,
    ranks: Sequence[str] = RANKS,
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """One row per (track, class): images, mean and weighted probability, first plant of the track,
    first taxonomy of the class in the track."""
    taxonomy, plants = _carried(detections, ranks, plant, name)
    cells = vote_cells(detections, keys, name, prob, ts, [*taxonomy, *plants], {})
    return votes_from_parts(_merged(cells, keys, name, taxonomy, plants, ["prob"]), keys, name, order, orders)


def votes_from_parts(
    parts: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    name: str = CLASS,
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """:func:`track_votes` from :func:`track_parts`."""
    taxonomy, plants = _carried_by(parts)
    return _votes(parts, keys, name).select(
        *keys,
        "track_ID_imgs",
        "top1_imgs",
        name,
        "top1_prob_mean",
        "top1_prob_weighted",
        *plants,
        *taxonomy,
        order_category(order, orders, taxonomy).alias("order_category"),
    )


def track_top1(
    detections: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    name: str = CLASS,
    prob: str = CLASS_PROB,
    ts: str = "timestamp",
    confidence: str = "confidence",
    plant: str = PLANT,
    ranks: Sequence[str] = RANKS,
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """One row per track: the class with the highest weighted probability (then the highest mean,
    then the smallest name; a missing probability never wins over a present one) and the track's
    statistics. Two shuffles, both of pre-aggregated rows."""
    parts = track_parts(detections, keys, name, prob, ts, confidence, plant, ranks)
    return tracks_from_parts(parts, keys, name, order, orders)


def track_parts(
    detections: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    name: str = CLASS,
    prob: str = CLASS_PROB,
    ts: str = "timestamp",
    confidence: str = "confidence",
    plant: str = PLANT,
    ranks: Sequence[str] = RANKS,
    step: str | None = None,
) -> DataFrame:
    """What votes and tracks need of each (track, class): store it, and both come from it without a second pass over
    the detections. With ``step``, rows that it names are counted per step, without a track."""
    taxonomy, plants = _carried(detections, ranks, plant, name)
    measures = {"conf": confidence, "length": "bbox_length", "width": "bbox_width"}
    steps = [] if step is None else [step]
    if step is not None:
        grouped = [*keys, name, *taxonomy, *plants]
        detections = detections.withColumns({c: F.when(F.col(step).isNull(), F.col(c)) for c in grouped})
    cells = vote_cells(detections, keys, name, prob, ts, [*taxonomy, *plants], measures, steps)
    return _merged(cells, keys, name, taxonomy, plants, ["prob", *measures], steps)


def tracks_from_parts(
    parts: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    name: str = CLASS,
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """:func:`track_top1` from :func:`track_parts`."""
    taxonomy, plants = _carried_by(parts)
    measures = ("conf", "length", "width")
    votes = _votes(parts, keys, name)
    kept = ["track_ID_imgs", "top1_imgs", name, "top1_prob_mean", "top1_prob_weighted", *plants, *taxonomy]
    rank = F.struct(
        F.coalesce(-F.col("top1_prob_weighted"), F.lit(_FAR)).alias("a"),
        F.coalesce(-F.col("top1_prob_mean"), F.lit(_FAR)).alias("b"),
        F.col(name).alias("c"),
    )
    tracks = votes.groupBy(*keys).agg(
        F.min_by(F.struct(*kept), rank).alias("_best"),
        F.min("_first").alias("start_time"),
        F.max("_last").alias("end_time"),
        *[c for tag in measures for c in _merge(tag)],
    )
    return tracks.select(
        *keys,
        "_best.*",
        "start_time",
        "end_time",
        whole_seconds("start_time", "end_time").alias("duration_s"),
        round_half_up(_mean("conf"), 2).alias("det_conf_mean"),
        round_half_up(_mean("length"), 3).alias("bbox_length_mean"),
        round_half_up(_mean("width"), 3).alias("bbox_width_mean"),
        order_category(order, orders, taxonomy).alias("order_category")
        if order not in taxonomy
        else membership_label(F.col("_best").getField(order), orders, "pollinator", "non-pollinator").alias(
            "order_category"
        ),
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` of the first row per key in ``order``; ties go to the smallest values."""
    first = F.min_by(F.struct(*columns), F.struct(*order, *[F.col(c).alias(f"_{c}") for c in columns]))
    return keyed(df, keys).groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")


def best_per_key(
    df: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    score: str = SCORE,
    columns: Sequence[str] = ("crop_path",),
    tie: Sequence[str] = ("crop_path",),
    default: float = -1.0,
) -> DataFrame:
    """``columns`` of the highest-scored row per key (missing score counts as ``default``), ties to
    the smallest ``tie`` values. Without a score column: the first row by ``tie``."""
    order = [F.asc_nulls_first(t) for t in tie]
    if score in df.columns:
        order.insert(0, F.desc(F.coalesce(finite(score), F.lit(default))))
    # one row per key leaves each task (window group limit), so a hot key is a few rows when it is shuffled
    order += [F.asc_nulls_first(c) for c in columns if c not in tie]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    needed = list(dict.fromkeys([*keys, *columns, *tie, *([score] if score in df.columns else [])]))
    return keyed(df, keys).select(*needed).withColumn("_place", place).where(F.col("_place") == 1).select(*keys, *columns)
