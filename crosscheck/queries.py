"""One Spark query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from trackstrata import functions as fn
from trackstrata import operators as op
from trackstrata import plans, sinks, sources
from trackstrata.model import CAMERA_PATHS, TRACK_KEYS
from trackstrata.plans.strata import label_tracks
from trackstrata.session import hold
from trackstrata.sources import index_paths, parse_configs, with_stratum_number

from . import stored
from .fixtures import WIDE_ORDERS, detections, reviewed, sessions, table, wide_tracks

KEYS = list(TRACK_KEYS)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def prepared(spark: SparkSession, sf_dir: str, **slots) -> DataFrame:
    return plans.prepare_detections(detections(spark, sf_dir), **slots)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.track_top1(prepared(spark, sf_dir))


def stored_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track table as the sampling jobs meet it: computed once and read again."""
    return hold(tracks(spark, sf_dir))


# --- tracks ---------------------------------------------------------------------------------------


@query
def track_stats(spark, sf_dir):
    return op.track_stats(prepared(spark, sf_dir))


@query
def track_votes(spark, sf_dir):
    return op.track_votes(prepared(spark, sf_dir))


@query
def track_top1(spark, sf_dir):
    return tracks(spark, sf_dir)


@query
def track_top1_filtered(spark, sf_dir):
    rows = prepared(spark, sf_dir, min_conf="0.4", max_conf="<0.95")
    return plans.aggregate_tracks(rows, min_duration=">0", max_duration="<=80000", min_prob=">=0.1", max_prob="0.9")


@query
def track_top1_plain(spark, sf_dir):
    """The classifier format without taxonomy: one class and one probability per detection."""
    named = [F.col("bioclip_order").alias("top1"), F.col("bioclip_score").alias("top1_prob")]
    boxes = ["x_min", "x_max", "y_min", "y_max"]
    rows = detections(spark, sf_dir).select(*KEYS, "timestamp", "confidence", *boxes, *named)
    return op.track_top1(plans.prepare_detections(rows))


@query
def top1_coalesce(spark, sf_dir):
    return op.normalize_classes(detections(spark, sf_dir)).select("crop_path", "top1", "top1_prob")


@query
def bbox_metrics(spark, sf_dir):
    boxes = op.bbox_metrics(detections(spark, sf_dir), 12.5, 8.0)
    return boxes.select("crop_path", "bbox_size_x", "bbox_size_y", "bbox_length", "bbox_width")


@query
def threshold_ops(spark, sf_dir):
    specs = (">0.5", ">=0.5", "<0.5", "<= 0.5", "'==0.7'", "!=0.7")
    rows = detections(spark, sf_dir)
    counts = rows.agg(*[F.count_if(fn.threshold("confidence", s)).alias(str(i)) for i, s in enumerate(specs)])
    pairs = F.array(*[F.struct(F.lit(s).alias("spec"), F.col(str(i)).alias("n")) for i, s in enumerate(specs)])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


_SLOTS = dict(min_conf="0.4", max_conf="<0.95", min_duration=">0", max_duration="<=80000", min_prob=">=0.1", max_prob="0.9")


def _once(spark, sf_dir):
    return plans.process_once(detections(spark, sf_dir), stored.scratch(spark, "parts"), **_SLOTS)


@query
def process_once_votes(spark, sf_dir):
    return _once(spark, sf_dir)[0]


@query
def process_once_tracks(spark, sf_dir):
    return _once(spark, sf_dir)[1]


@query
def process_once_removed(spark, sf_dir):
    return _once(spark, sf_dir)[2]


@query
def sorted_tracks(spark, sf_dir):
    """The track table written in order of its key, and each row's place by file and row."""
    path = sinks.write_table(tracks(spark, sf_dir), stored.scratch(spark, "sorted"), order_by=KEYS)
    at = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    rows = spark.read.parquet(path).select(*KEYS, *at)
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.join(F.broadcast(files.select("file", F.coalesce(before, F.lit(0)).alias("before"))), "file")
    return placed.select(*KEYS, (F.col("before") + F.col("row") + 1).alias("position"))


@query
def removal_counts(spark, sf_dir):
    return plans.track_steps(
        op.normalize_classes(detections(spark, sf_dir)),
        min_conf="0.4", max_conf="<0.95", min_duration=">0", max_duration="<=80000", min_prob=">=0.1", max_prob="0.9",
    )


@query
def parsed_timestamps(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    return op.parse_ts(table(spark, sf_dir, "events").select("event_id", text.alias("timestamp")))


@query
def strict_timestamps(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return op.parse_ts(table(spark, sf_dir, "events").select("event_id", text.alias("timestamp")), strict=True)


@query
def first_plant_per_track(spark, sf_dir):
    return op.first_per_key(detections(spark, sf_dir), KEYS, ["timestamp"], ["plant_species"])


@query
def taxonomy_per_vote(spark, sf_dir):
    ranks = ["bioclip_species", "bioclip_genus", "bioclip_family", "bioclip_order"]
    rows = op.normalize_classes(detections(spark, sf_dir))
    return op.first_per_key(rows, [*KEYS, "top1"], ["timestamp"], ranks)


@query
def best_detection_per_track(spark, sf_dir):
    return op.best_per_key(detections(spark, sf_dir), columns=["crop_path", "bioclip_score", "confidence"])


# --- sessions -------------------------------------------------------------------------------------


@query
def session_intervals(spark, sf_dir):
    return op.session_intervals(sessions(spark, sf_dir), columns=["setting"], tie=["filename"]).withColumnRenamed(
        "end", "next_start"
    )


def _joined(spark, sf_dir, **how):
    facts = detections(spark, sf_dir, plant=False).select("crop_path", "cam_ID", "timestamp")
    return op.session_join(facts, sessions(spark, sf_dir), columns=["setting"], tie=["filename"], **how)


@query
def session_join(spark, sf_dir):
    return _joined(spark, sf_dir)


@query
def session_join_sliced(spark, sf_dir):
    return _joined(spark, sf_dir, strategy="sliced")


@query
def session_join_union(spark, sf_dir):
    return _joined(spark, sf_dir, strategy="union")


@query
def session_join_salted(spark, sf_dir):
    return _joined(spark, sf_dir, strategy="union", salts=4)


@query
def session_join_shuffled(spark, sf_dir):
    return _joined(spark, sf_dir, strategy="sliced", broadcast_rows=0)


@query
def session_join_broadcast(spark, sf_dir):
    return _joined(spark, sf_dir, strategy="interval")


@query
def merged_tracks(spark, sf_dir):
    joined = op.session_join(
        detections(spark, sf_dir, plant=False),
        sessions(spark, sf_dir).withColumnRenamed("setting", "plant_species"),
        tie=["filename"],
    )
    return op.track_top1(plans.prepare_detections(joined))


# --- files ----------------------------------------------------------------------------------------


@query
def detection_files(spark, sf_dir):
    """CSV files found below a folder, read as one table with the file of each row."""
    rows = sources.read_detections(spark, stored.detection_files(spark, sf_dir), with_source=True)
    return rows.withColumn("source_file", F.regexp_extract("source_file", r"kind=([^/]*)/\d+_metadata_merged_crops_classified\.csv$", 1))


@query
def detection_files_by_name(spark, sf_dir):
    """Files whose headers differ in order and columns."""
    return sources.read_detections(spark, stored.detection_files(spark, sf_dir, mixed=True), by_name=True)


@query
def config_files(spark, sf_dir):
    """Config documents found by name, merged to one stored table."""
    found = sources.read_configs(spark, stored.config_files(spark, sf_dir))
    path = sinks.write_table(found.select(*sources.merged_config_columns()), stored.scratch(spark, "configs"))
    return sources.read_table(spark, path)


@query
def merged_files(spark, sf_dir):
    """Config and detection files to the stored table of detections with plants."""
    merged = plans.merge_detections(spark, stored.config_files(spark, sf_dir), stored.detection_files(spark, sf_dir, broken=True))
    return sources.read_table(spark, sinks.write_table(merged, stored.scratch(spark, "merged")))


@query
def merge_counts(spark, sf_dir):
    """What an observation counts while the merged table is written."""
    seen = Observation()
    merged = plans.merge_detections(spark, stored.config_files(spark, sf_dir), stored.detection_files(spark, sf_dir, broken=True), observation=seen)
    sinks.write_table(merged, stored.scratch(spark, "merged"))
    return spark.createDataFrame(sorted(seen.get.items()), "step string, n bigint")


@query
def stored_strata(spark, sf_dir):
    """One folder per family and stratum, species under their full names."""
    rows = hold(detections(spark, sf_dir))
    drawn = plans.sample_families(hold(op.track_top1(plans.prepare_detections(rows))), _SIZES)
    path = sinks.write_strata(op.attach_best(drawn, rows).select("family", "stratum", *KEYS, "crop_path"), stored.scratch(spark, "strata"))
    return sources.read_table(spark, path).select("family", "stratum", *KEYS, "crop_path")


@query
def stored_parts(spark, sf_dir):
    """Expert samples in one folder per sample and part."""
    drawn = _expert_samples(spark, sf_dir).select("sample", "part", "threshold", *KEYS, "crop_path")
    path = sinks.write_strata(drawn, stored.scratch(spark, "expert"), by=["sample", "part"], fmt="parquet")
    return sources.read_table(spark, path).select("sample", F.col("part").cast("bigint").alias("part"), "threshold", *KEYS, "crop_path")


@query
def run_manifest(spark, sf_dir):
    """Parameters and row totals of a run, stored in its folder."""
    path, run = stored.scratch(spark, "run"), sinks.new_run_id("checked")
    passing, seen = sinks.observed(op.filter_range(tracks(spark, sf_dir), "top1_prob_weighted", ">=0.1"))
    sinks.write_table(passing, path, run_id=run)
    written = sinks.write_manifest(spark, {"min_prob": ">=0.1", "rows": seen.get["rows"]}, path, run_id=run)
    found = sources.read_table(spark, written, "run_id string, written_at string, parameters string", "json")
    dated = F.to_timestamp_ntz("written_at", F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
    return found.select(F.col("run_id").rlike(r"^checked_\d{4}-\d\d-\d\d_\d\d-\d\d-\d\d$").alias("named"), dated.alias("dated"), "parameters")


@query
def reviewed_file(spark, sf_dir):
    """The reviewed table as a CSV file and back."""
    rows = attach_labels(spark, sf_dir)
    path = sinks.write_table(rows, stored.scratch(spark, "validated"), fmt="csv")
    return sources.read_table(spark, path, rows.schema, "csv")


@query
def identified_file(spark, sf_dir):
    """The table of expert identifications as a CSV file and back."""
    rows = _expert(spark, sf_dir)
    path = sinks.write_table(rows, stored.scratch(spark, "identified"), fmt="csv")
    return sources.read_table(spark, path, rows.schema, "csv")


@query
def checklist_file(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.when(F.col("p_size") > 5, F.upper("p_name")).alias("species"), "p_size")
    return sources.read_checklist(spark, sinks.write_table(names, stored.scratch(spark, "checklist"), fmt="csv"))


# --- reports --------------------------------------------------------------------------------------


@query
def order_category(spark, sf_dir):
    return op.count_by(tracks(spark, sf_dir), ["order_category", "bioclip_order"])


@query
def duration_bins(spark, sf_dir):
    return op.duration_report(tracks(spark, sf_dir))


@query
def duration_classes(spark, sf_dir):
    label = fn.cut_labels("duration_s", [(500, "multiple_crop")], "long_crop", "unknown", "single_crop")
    return op.count_by(tracks(spark, sf_dir).withColumn("strata2", label), ["strata2"])


@query
def prob_deciles(spark, sf_dir):
    rows = wide_tracks(spark, sf_dir)
    rows = rows.withColumns(
        {"prob_bin": fn.decile_bin("top1_prob_weighted"), "exact_bin": fn.decile_bin("top1_prob_weighted", True)}
    )
    return op.count_by(rows, ["prob_bin", "exact_bin"])


@query
def stratum_labels(spark, sf_dir):
    return op.count_by(label_tracks(tracks(spark, sf_dir)), ["strata1", "prob_strata1"])


@query
def composition(spark, sf_dir):
    return op.composition(tracks(spark, sf_dir))


@query
def composition_wide(spark, sf_dir):
    return op.composition(wide_tracks(spark, sf_dir), named=[*WIDE_ORDERS, "ABSENT"])


@query
def hist_probability(spark, sf_dir):
    return op.histogram_by(wide_tracks(spark, sf_dir), values=WIDE_ORDERS)


@query
def hist_confidence(spark, sf_dir):
    return op.histogram_by(wide_tracks(spark, sf_dir), column="det_conf_mean", values=WIDE_ORDERS)


@query
def clipped_values(spark, sf_dir):
    clipped = fn.clip(F.col("value") / 100, 0.2, 0.8)
    return table(spark, sf_dir, "events").select("event_id", clipped.alias("clipped"))


@query
def group_median(spark, sf_dir):
    return op.group_median(wide_tracks(spark, sf_dir), ["bioclip_order", "bioclip_genus"], "top1_prob_weighted")


@query
def group_median_refined(spark, sf_dir):
    return op.group_median_refined(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice")


def _price(spark, sf_dir):
    """Prices, a few of them huge: very many values, unevenly spread."""
    huge = F.when(F.col("l_orderkey") % 1000 == 0, F.col("l_extendedprice") * 1e9).otherwise(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", huge.alias("price"))


@query
def median_money(spark, sf_dir):
    return op.group_median(_price(spark, sf_dir), ["l_returnflag"], "price", most=1000)


@query
def median_split_money(spark, sf_dir):
    return op.median_split(_price(spark, sf_dir), ["l_returnflag"], "price")


@query
def median_split_by_group(spark, sf_dir):
    split = op.median_split(wide_tracks(spark, sf_dir), ["bioclip_genus"], "top1_prob_weighted")
    return split.select(*KEYS, "bioclip_genus", "top1_prob_weighted", "median", "prob_cat")


@query
def top_species(spark, sf_dir):
    return op.top_values(wide_tracks(spark, sf_dir), "bioclip_species", 25)


@query
def species_slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fn.name_slug("p_name").alias("slug"))


# --- samples --------------------------------------------------------------------------------------

_SIZES = {"strata1": 500, "strata2": 500, "strata3": 20, "strata4": 100, "strata5": 4, "strata6": 6, "strata7": 200, "strata8": 10}


def _family(name: str) -> Query:
    def run(spark, sf_dir):
        return plans.FAMILIES[name](stored_tracks(spark, sf_dir), n=_SIZES[name])

    run.__name__ = name
    return run


for _name in _SIZES:
    query(_family(_name))


@query
def strata3_wide(spark, sf_dir):
    return plans.strata3(wide_tracks(spark, sf_dir), orders=WIDE_ORDERS)


@query
def strata5_wide(spark, sf_dir):
    return plans.strata5(wide_tracks(spark, sf_dir), orders=WIDE_ORDERS)


@query
def strata7_wide(spark, sf_dir):
    return plans.strata7(wide_tracks(spark, sf_dir), orders=WIDE_ORDERS)


@query
def strata8_wide(spark, sf_dir):
    return plans.strata8(wide_tracks(spark, sf_dir), orders=WIDE_ORDERS)


@query
def sample_all(spark, sf_dir):
    return plans.sample_all(tracks(spark, sf_dir))


@query
def sample_all_wide(spark, sf_dir):
    return plans.sample_all(wide_tracks(spark, sf_dir), n=500)


@query
def sample_large(spark, sf_dir):
    return op.stratified_sample(wide_tracks(spark, sf_dir), ["bioclip_order"], 2500, salt="large")


@query
def sample_n_large(spark, sf_dir):
    return op.sample_n(wide_tracks(spark, sf_dir), 20_000, salt="large")


@query
def strata_thresholds(spark, sf_dir):
    return plans.strata_thresholds(tracks(spark, sf_dir), [0.2, 0.5, 0.55], 30)


@query
def strata_genus(spark, sf_dir):
    return plans.strata_genus(tracks(spark, sf_dir), n=5)


@query
def sample_chunks(spark, sf_dir):
    return plans.strata_genus(stored_tracks(spark, sf_dir), n=5, chunk_size=10)


def _expert_samples(spark, sf_dir):
    sizes = dict(n_all=60, min_confidence=0.4, thresholds=[0.2, 0.5, 0.55], n_threshold=30, n_genus=5, chunk_size=10)
    return plans.expert_samples(tracks(spark, sf_dir), detections(spark, sf_dir), **sizes)


@query
def expert_samples(spark, sf_dir):
    return _expert_samples(spark, sf_dir).select("sample", "threshold", "sampled_genus", "part", *KEYS, "top1_prob_weighted", "crop_path")


@query
def chunk_wide(spark, sf_dir):
    return op.chunk(wide_tracks(spark, sf_dir).select(*KEYS), 100, position="position")


@query
def sample_families(spark, sf_dir):
    rows = hold(detections(spark, sf_dir))
    stored = hold(op.track_top1(plans.prepare_detections(rows)))
    drawn = plans.sample_families(stored, _SIZES)
    return op.attach_best(drawn, rows).select("family", "stratum", *KEYS, "crop_path")


# --- review ---------------------------------------------------------------------------------------


@query
def attach_crop_path(spark, sf_dir):
    drawn = plans.strata1(tracks(spark, sf_dir))
    return op.attach_best(drawn, detections(spark, sf_dir)).select(*KEYS, "strata1", "prob_strata1", "crop_path")


def _files(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.upper("url").alias("crop_path")), index_paths(
        pages.where(F.col("url").startswith("https")), "url"
    )


@query
def file_index(spark, sf_dir):
    return index_paths(table(spark, sf_dir, "pages"), "url")


@query
def resolve_files(spark, sf_dir):
    return op.resolve_files(*_files(spark, sf_dir))


@query
def missing_files(spark, sf_dir):
    return op.missing_files(*_files(spark, sf_dir))


@query
def stratum_number(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    named = part.select("p_partkey", F.concat(F.lit("out/strata"), "p_size", F.lit("_"), "p_type", F.lit(".csv")).alias("name"))
    return with_stratum_number(named, "name")


@query
def json_first(spark, sf_dir):
    nested = F.concat(F.lit('{"a": {"b": '), F.when(F.col("event_type") == "view", "0").otherwise(F.col("user_id").cast("string")), F.lit('}, "old": '), "props", F.lit("}"))
    found = fn.json_first(nested, ["a.b", "missing", "old.k"], "unknown")
    return table(spark, sf_dir, "events").select("event_id", found.alias("found"))


@query
def json_fields(spark, sf_dir):
    fields = fn.json_fields("props", {"k": "k", "nothing": "a.b"})
    return table(spark, sf_dir, "events").select("event_id", *fields)


def _configs(spark, sf_dir):
    """Config documents written from events: camera under one of two paths, setting, one number."""
    text = F.format_string(
        '{"network": {"hotspot": {"ssid": "%s"}}, "device": {"id": %d}, "deployment": {"setting": "%s", "location": {"latitude": %d}}}',
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.concat(F.lit("cam"), "user_id")),
        F.col("event_id"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.concat(F.lit(" "), "event_type", F.lit(" "))),
        F.col("user_id"),
    )
    documents = table(spark, sf_dir, "events").select(
        text.alias("value"),
        F.concat("event_id", F.lit(".json")).alias("filename"),
        F.date_format("ts", "yyyy-MM-dd_HH-mm-ss").alias("date_time"),
        F.lit("events").alias("source"),
    )
    return parse_configs(documents, CAMERA_PATHS)


@query
def parsed_configs(spark, sf_dir):
    return _configs(spark, sf_dir).select(
        "filename", "start", "cam_ID", "deployment_setting", "location_latitude", "parse_ok",
        F.concat_ws(",", "missing").alias("missing"),
    )


@query
def config_quality(spark, sf_dir):
    found = sources.config_quality(_configs(spark, sf_dir))
    return found.select("filename", "parse_ok", F.concat_ws(",", "missing").alias("missing"))


@query
def attach_labels(spark, sf_dir):
    given = reviewed(spark, sf_dir).where("label is not null")
    given = given.select("doc_id", "label", F.concat(F.lit(" seen in "), "source", F.lit(" ")).alias("comment"))
    sample = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return op.attach_labels(sample, given, ["doc_id"], column=op.label_column(3, "species"))


@query
def label_domain_check(spark, sf_dir):
    upper = F.when(F.col("lang") == "de", F.upper("label")).otherwise(F.col("label"))  # labels that are not allowed
    return op.check_domain(reviewed(spark, sf_dir).withColumn("label", upper), "label", op.label_domain(3))


@query
def predicted_value(spark, sf_dir):
    rows = detections(spark, sf_dir)
    return rows.select(
        "crop_path",
        op.predicted_value(rows, 1).alias("judged_species"),
        op.predicted_value(rows, 5, "genus").alias("judged_genus"),
        op.predicted_value(rows, 7, "order").alias("judged_order"),
    )


def _expert(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, F.lit("dismissed")).alias("valid_crop"),
        F.when(F.col("quality") == 1, F.lit(" Apis sp. ")).otherwise(F.lit("  ")).alias("expert_id_free"),
        F.lit("").alias("expert_id_checklist"),
    )
    sample = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return op.attach_expert_labels(sample, labels, ["doc_id"])


@query
def expert_defaults(spark, sf_dir):
    return _expert(spark, sf_dir)


@query
def missing_identification(spark, sf_dir):
    return op.missing_identification(_expert(spark, sf_dir))


def _names(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    listed = parts.where("p_type = 'ECONOMY' and p_size < 10").select(F.upper("p_name").alias("species"))
    return parts.select("p_partkey", "p_name"), listed


@query
def checklist_match(spark, sf_dir):
    names, listed = _names(spark, sf_dir)
    return op.checklist_match(names, listed, "p_name")


@query
def checklist_unmatched(spark, sf_dir):
    names, listed = _names(spark, sf_dir)
    return op.checklist_match(names, listed, "p_name", listed=False)


@query
def checklist_search(spark, sf_dir):
    return op.checklist_search(table(spark, sf_dir, "part").select(F.col("p_name").alias("species")), "RED")


@query
def validation_metrics(spark, sf_dir):
    return op.validation_metrics(reviewed(spark, sf_dir))


@query
def validation_metrics_by_group(spark, sf_dir):
    return op.validation_metrics(reviewed(spark, sf_dir), ["lang", "source"])
