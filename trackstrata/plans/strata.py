"""The sample families as presets over ``stratified_sample``.

Each takes a track table and returns the sampled rows with their stratum labels. A family is one plan:
all its strata are drawn in a single window, never in a loop over values. Store the track table first
(``write_table``) when several families are drawn from it; the families only read it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cut_labels, decile_bin, membership_label, name_slug, prob_class, sample_priority
from ..model import HOVERFLY_FAMILY, ORDER_SHORT, POLLINATOR_ORDERS, PROB, SEED, TRACK_KEYS
from ..operators import attach_best, chunk, median_split, sample_n, stratified_sample, top_values, with_thresholds
from ..operators.sampling import group_limit
from ..session import hold

# fixed values: upper edge and label of the duration classes
DURATION_CLASSES = ((500, "multiple_crop"),)
ROUNDED_VALUES = 101


def label_tracks(
    tracks: DataFrame,
    prob: str = PROB,
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """Pollinator class and probability class, carried by every family."""
    return tracks.withColumns(
        {
            "strata1": membership_label(order, orders, "pollinator", "non_pollinator"),
            "prob_strata1": prob_class(prob),
        }
    )


def _pollinators(tracks: DataFrame, prob: str, order: str, orders: Sequence[str]) -> DataFrame:
    return label_tracks(tracks, prob, order, orders).where(F.col(order).isin(list(orders)))


def strata1(
    tracks: DataFrame,
    n: int = 500,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """Pollinator or not, by probability class: ``n // 2`` rows of each."""
    labelled = label_tracks(tracks, prob, order, orders)
    return stratified_sample(labelled, ["strata1", "prob_strata1"], n // 2, seed, keys, "strata1")


def strata2(
    tracks: DataFrame,
    n: int = 500,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    duration: str = "duration_s",
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """Pollinators by duration class and probability class: ``n // 2`` rows of each."""
    label = cut_labels(duration, DURATION_CLASSES, above="long_crop", other="unknown", zero="single_crop")
    classed = _pollinators(tracks, prob, order, orders).withColumn("strata2", label)
    known = classed.where(F.col("strata2") != "unknown")
    return stratified_sample(known, ["strata2", "prob_strata1"], n // 2, seed, keys, "strata2")


def strata3(
    tracks: DataFrame,
    n: int = 100,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
    exact_edges: bool = False,
) -> DataFrame:
    """Each order by probability decile: ``n`` rows of each; the bin past the last edge is not drawn."""
    binned = _pollinators(tracks, prob, order, orders).withColumn("prob_bin", decile_bin(prob, exact_edges))
    inside = binned.where(F.col("prob_bin") != "1.0-1.0")
    return stratified_sample(inside, [order, "prob_bin"], n, seed, keys, "strata3")


def _by_median(
    tracks: DataFrame,
    number: int,
    groups: Sequence[str],
    n: int,
    seed: int,
    keys: Sequence[str],
    prob: str,
    duration: str,
    order: str,
    orders: Sequence[str],
    max_groups: int | None = None,
) -> DataFrame:
    active = _pollinators(tracks, prob, order, orders).where(F.col(duration) > 0)
    active = active.withColumn("prob_bin", decile_bin(prob))
    half = f"s{number}_prob_cat"
    # the library rounds its own probabilities to two decimals
    values = ROUNDED_VALUES if prob == PROB else None
    split = median_split(active, groups, prob, f"s{number}_median", half, max_groups, values)
    return stratified_sample(split, [*groups, half], n, seed, keys, f"strata{number}")


def strata4(
    tracks: DataFrame,
    n: int = 100,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    duration: str = "duration_s",
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
    group: str = "plant_species",
) -> DataFrame:
    """Active pollinators per plant, below and from the plant's median: ``n // 2`` rows of each."""
    return _by_median(tracks, 4, [group], n // 2, seed, keys, prob, duration, order, orders)


def strata5(
    tracks: DataFrame,
    n: int = 10,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    duration: str = "duration_s",
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
    group: str = "bioclip_genus",
) -> DataFrame:
    """Active pollinators per order and genus, below and from the median: ``n`` rows of each."""
    return _by_median(tracks, 5, [order, group], n, seed, keys, prob, duration, order, orders)


def strata6(
    tracks: DataFrame,
    n: int = 10,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    duration: str = "duration_s",
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
    group: str = "bioclip_family",
) -> DataFrame:
    """Active pollinators per order and family, below and from the median: ``n`` rows of each."""
    return _by_median(tracks, 6, [order, group], n, seed, keys, prob, duration, order, orders)


def strata7(
    tracks: DataFrame,
    n: int = 500,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    duration: str = "duration_s",
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
) -> DataFrame:
    """Active pollinators per order, below and from the order's median: ``n`` rows of each. The orders
    are a given list, so their medians are few by definition."""
    return _by_median(tracks, 7, [order], n, seed, keys, prob, duration, order, orders, len(orders))


def strata8(
    tracks: DataFrame,
    n: int = 100,
    top_n: int = 25,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    duration: str = "duration_s",
    order: str = "bioclip_order",
    orders: Sequence[str] = POLLINATOR_ORDERS,
    species: str = "bioclip_species",
) -> DataFrame:
    """The ``top_n`` most frequent species of active pollinators, below and from the species' median:
    ``n`` rows of each. At most ``top_n`` names and medians are broadcast."""
    active = tracks.where(F.col(order).isin(list(orders)) & (F.col(duration) > 0))
    top = F.broadcast(top_values(active, species, top_n).select(species))
    common = tracks.join(top, species, "left_semi")
    sampled = _by_median(common, 8, [species], n, seed, keys, prob, duration, order, orders, top_n)
    return sampled.withColumn("slug", name_slug(species))


def sample_all(
    tracks: DataFrame,
    n: int = 100,
    threshold: float = 0.5,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    confidence: str = "det_conf_mean",
) -> DataFrame:
    """``n`` rows of all tracks above a mean detection confidence."""
    return sample_n(tracks.where(F.col(confidence) > F.lit(threshold)), n, seed, keys, "sample_all")


def strata_thresholds(
    tracks: DataFrame,
    thresholds: Sequence[float] = (0.5,),
    n: int = 100,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    family: str = "bioclip_family",
    name: str = HOVERFLY_FAMILY,
) -> DataFrame:
    """One family's rows above each probability threshold: ``n`` per threshold; a row can be in several."""
    passed = with_thresholds(tracks.where(F.col(family) == name), prob, thresholds)
    return stratified_sample(passed, ["threshold"], n, seed, keys, "strata_thresholds")


def strata_genus(
    tracks: DataFrame,
    n: int = 50,
    threshold: float = 0.5,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    family: str = "bioclip_family",
    name: str = HOVERFLY_FAMILY,
    genus: str = "bioclip_genus",
    chunk_size: int | None = None,
) -> DataFrame:
    """One family's rows above a threshold: ``n`` per genus; with ``chunk_size`` shuffled into parts."""
    rows = tracks.where((F.col(family) == name) & F.col(genus).isNotNull() & (F.col(prob) > F.lit(threshold)))
    sampled = stratified_sample(rows, [genus], n, seed, keys, "strata_genus").withColumn(
        "sampled_genus", F.col(genus)
    )
    return chunk(sampled, chunk_size, seed, keys) if chunk_size else sampled


def expert_samples(
    tracks: DataFrame,
    detections: DataFrame,
    n_all: int = 100,
    min_confidence: float = 0.5,
    thresholds: Sequence[float] = (0.5,),
    n_threshold: int = 100,
    n_genus: int = 50,
    genus_threshold: float = 0.5,
    chunk_size: int = 100,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    prob: str = PROB,
    confidence: str = "det_conf_mean",
    family: str = "bioclip_family",
    name: str = HOVERFLY_FAMILY,
    genus: str = "bioclip_genus",
    columns: Sequence[str] = ("crop_path",),
) -> DataFrame:
    """The rows of :func:`sample_all`, :func:`strata_thresholds` and :func:`strata_genus` (in parts of ``chunk_size``) as
    one table: ``sample``, ``threshold``, ``sampled_genus``, ``part``, the track, and ``columns`` of its best detection. The
    tracks are read once: a row is listed under every stratum it belongs to, all strata are drawn by one window, and
    one join with the detections serves all. The drawn rows are held, so parts and join do not draw again."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def member(condition: Column, sample: str, n: int, threshold: Column = number, of: Column = text) -> Column:
        parts = F.struct(F.lit(sample).alias("sample"), threshold.alias("threshold"), of.alias("sampled_genus"), F.lit(n).alias("_n"))
        return F.when(condition, parts)

    inside = F.col(family) == name
    members = [member(F.col(confidence) > F.lit(min_confidence), "sample_all", n_all)]
    members += [member(inside & (F.col(prob) > F.lit(t)), "strata_thresholds", n_threshold, F.lit(float(t))) for t in dict.fromkeys(thresholds)]
    in_genus = inside & F.col(genus).isNotNull() & (F.col(prob) > F.lit(genus_threshold))
    members.append(member(in_genus, "strata_genus", n_genus, of=F.col(genus)))
    listed = tracks.withColumn("_member", F.explode(F.array_compact(F.array(*members)))).select(*tracks.columns, "_member.*")
    strata, largest = ["sample", "threshold", "sampled_genus"], max(n_all, n_threshold, n_genus)
    if largest <= group_limit(tracks):
        order = [sample_priority(seed, F.col("sample"), keys), *keys]
        place = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
        drawn = listed.withColumn("_place", place).where(F.col("_place") <= largest).where(F.col("_place") <= F.col("_n")).drop("_place")
    else:
        sizes = {"sample_all": n_all, "strata_thresholds": n_threshold, "strata_genus": n_genus}
        each = [stratified_sample(listed.where(F.col("sample") == s), strata, n, seed, keys, s) for s, n in sizes.items()]
        drawn = reduce(DataFrame.unionByName, each)
    drawn = hold(drawn.drop("_n"))
    parts = chunk(drawn.where(F.col("sample") == "strata_genus"), chunk_size, seed, keys)
    others = drawn.where(F.col("sample") != "strata_genus").withColumn("part", F.lit(None).cast("bigint"))
    return attach_best(parts.unionByName(others), detections, keys, columns)


FAMILIES: dict[str, Callable[..., DataFrame]] = {
    "strata1": strata1,
    "strata2": strata2,
    "strata3": strata3,
    "strata4": strata4,
    "strata5": strata5,
    "strata6": strata6,
    "strata7": strata7,
    "strata8": strata8,
}


def _stratum(family: str, order: str, species: str) -> Column:
    """The part of a family a row is stored under: its order, its species (two may share a slug), or the whole family."""
    if family in ("strata3", "strata5", "strata6", "strata7"):
        names = F.create_map(*[F.lit(x) for pair in ORDER_SHORT.items() for x in pair])
        return F.coalesce(names[F.col(order)], F.lower(F.col(order)))
    return F.col(species) if family == "strata8" else F.lit("all")


def sample_families(
    tracks: DataFrame,
    sizes: dict[str, int] | None = None,
    seed: int = SEED,
    keys: Sequence[str] = TRACK_KEYS,
    order: str = "bioclip_order",
    species: str = "bioclip_species",
) -> DataFrame:
    """All families as one table with ``family`` and ``stratum`` columns, ready for ``attach_best`` and
    ``write_strata``. ``sizes`` overrides the rows per group of a family."""
    parts = []
    for family, draw in FAMILIES.items():
        size = {"n": sizes[family]} if sizes and family in sizes else {}
        drawn = draw(tracks, seed=seed, keys=keys, **size)
        parts.append(drawn.withColumns({"family": F.lit(family), "stratum": _stratum(family, order, species)}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
