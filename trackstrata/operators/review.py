"""Review tables: images for sampled rows, human labels joined back, and accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import basename, empty_to_null, normal_name
from ..functions.text import strip
from ..model import CORRECTNESS_LABELS, CROP_STATES, POLLINATOR_LABELS, REVIEW_LEVELS, SCORE, TRACK_KEYS
from ..session import BROADCAST_ROWS, has_at_most, hold
from .tracks import best_per_key


def attach_best(
    sample: DataFrame,
    detections: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    columns: Sequence[str] = ("crop_path",),
    score: str = SCORE,
    tie: Sequence[str] = ("crop_path",),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left-join the sample with ``columns`` of the best-scored detection of each track.

    The sample is held, its distinct keys are counted, and when few they are broadcast to filter the
    detections before anything is shuffled; otherwise the filter is a shuffled semi-join.
    """
    sample = hold(sample)
    wanted = sample.select(*keys).dropna().distinct()
    if has_at_most(wanted, broadcast_rows):
        wanted = F.broadcast(wanted)
    needed = list(dict.fromkeys([*keys, *columns, *tie, *([score] if score in detections.columns else [])]))
    hits = detections.select(*needed).join(wanted, list(keys), "left_semi")
    return sample.join(best_per_key(hits, keys, score, columns, tie), list(keys), "left")


def resolve_files(
    df: DataFrame, index: DataFrame, path: str = "crop_path", alias: str = "file_path"
) -> DataFrame:
    """Look up each path's lower-cased base name in a file index; null if the file is not there."""
    named = df.withColumn("_name", basename(path))
    listed = index.select(F.col("file_name").alias("_name"), F.col("file_path").alias(alias))
    return named.join(listed, "_name", "left").drop("_name")


def missing_files(df: DataFrame, index: DataFrame, path: str = "crop_path") -> DataFrame:
    """Rows whose file is not in the index."""
    listed = index.select(F.col("file_name").alias("_name"))
    return df.withColumn("_name", basename(path)).join(listed, "_name", "left_anti").drop("_name")


def label_column(stratum: int, level: str | None = None) -> str:
    """``val1``/``val2``, or ``val{n}_{level}`` for strata 3 to 8."""
    if stratum in (1, 2):
        if level is not None:
            raise ValueError("strata 1 and 2 are judged as pollinator or not: no level")
        return f"val{stratum}"
    if not 3 <= stratum <= 8:
        raise ValueError("the stratum must be 1 to 8")
    if level is None or level.lower() not in REVIEW_LEVELS:
        raise ValueError(f"strata 3 to 8 need a level of {REVIEW_LEVELS}")
    return f"val{stratum}_{level.lower()}"


def label_domain(stratum: int) -> tuple[str, ...]:
    return POLLINATOR_LABELS if stratum in (1, 2) else CORRECTNESS_LABELS


def _one_per_key(labels: DataFrame, keys: Sequence[str], given: Sequence[Column]) -> DataFrame:
    """The given columns of each key's only row. A second row would double the sampled one, so it ends the job."""
    rows = labels.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(*given)).alias("_given")
    )
    names = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    only = F.when(F.col("_rows") == 1, F.col("_given")).otherwise(
        F.raise_error(F.concat(F.lit("several labels for one key: "), names))
    )
    return rows.select(*keys, only.alias("_given")).select(*keys, "_given.*")


def attach_labels(
    sample: DataFrame,
    labels: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    label: str = "label",
    column: str = "val1",
    comment: str | None = "comment",
) -> DataFrame:
    """All sample columns plus the label (under its review name) and the trimmed comment; rows without
    a label stay, with null. Two labels of one key end the job."""
    given = [F.col(label).alias(column)]
    if comment is not None:
        given.append((strip(comment) if comment in labels.columns else F.lit(None).cast("string")).alias("comment"))
    return sample.join(_one_per_key(labels, keys, given), list(keys), "left")


def check_domain(df: DataFrame, label: str, domain: Sequence[str]) -> DataFrame:
    """Rejects: rows whose label is present but not allowed."""
    return df.where(F.col(label).isNotNull() & ~F.col(label).isin(list(domain)))


def predicted_value(df: DataFrame, stratum: int, level: str | None = None, prefix: str = "bioclip_") -> Column:
    """What the reviewer judges: species for strata 1 and 2, else the chosen rank; ``N/A`` if missing."""
    label_column(stratum, level)
    rank = prefix + ("species" if stratum in (1, 2) else level.lower())
    if rank not in df.columns:
        return F.lit("N/A")
    return F.coalesce(F.col(rank).cast("string"), F.lit("N/A"))


def attach_expert_labels(
    sample: DataFrame,
    labels: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    crop: str = "valid_crop",
    free: str = "expert_id_free",
    listed: str = "expert_id_checklist",
) -> DataFrame:
    """Expert columns: crops are valid unless said otherwise, empty identifications are missing. Two
    rows of one key end the job."""
    columns = [
        F.col(crop).alias("_crop"),
        empty_to_null(free).alias("expert_id_free"),
        empty_to_null(listed).alias("expert_id_checklist"),
    ]
    given = _one_per_key(labels, keys, columns)
    joined = sample.join(given, list(keys), "left")
    return joined.withColumn("valid_crop", F.coalesce("_crop", F.lit(CROP_STATES[0]))).drop("_crop")


def missing_identification(df: DataFrame) -> DataFrame:
    """Rows marked valid without any identification."""
    return df.where(
        (F.col("valid_crop") == CROP_STATES[0])
        & F.col("expert_id_free").isNull()
        & F.col("expert_id_checklist").isNull()
    )


def checklist_match(
    df: DataFrame, checklist: DataFrame, column: str, name: str = "species", listed: bool = True
) -> DataFrame:
    """Rows whose name is (``listed``) or is not on the checklist, compared as normalised names. Spark
    broadcasts the list when its measured size allows. A missing name is not listed."""
    names = checklist.select(normal_name(name).alias("_name")).distinct()
    keyed = df.withColumn("_name", normal_name(column))
    return keyed.join(names, "_name", "left_semi" if listed else "left_anti").drop("_name")


def checklist_search(checklist: DataFrame, text: str, name: str = "species") -> DataFrame:
    """Names that contain the text, ignoring case; an empty text gives all."""
    names = checklist.select(name).where(F.col(name).isNotNull()).distinct()
    return names.where(F.lower(name).contains(text.lower())) if text else names


def validation_metrics(
    reviewed: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    correct: str = "correct",
    incorrect: str = "incorrect",
    unclear: str = "unclear",
) -> DataFrame:
    """Review counts, accuracy and error rate, overall or per group. Unclear rows count as reviewed
    but not towards accuracy; both rates are null where nothing was decided."""
    value = F.col(label)
    counts = reviewed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(value.isin(correct, incorrect, unclear)).alias("n_reviewed"),
        F.count_if(value == correct).alias("n_correct"),
        F.count_if(value == incorrect).alias("n_incorrect"),
        F.count_if(value == unclear).alias("n_unclear"),
    )
    decided = F.col("n_correct") + F.col("n_incorrect")
    accuracy = F.when(decided > 0, F.col("n_correct") / decided)
    return counts.withColumns({"accuracy": accuracy, "error_rate": F.lit(1.0) - accuracy})
