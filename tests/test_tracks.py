from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trackstrata import operators as op
from trackstrata import plans

DDL = (
    "cam_ID string, rec_ID string, track_ID string, timestamp timestamp_ntz, confidence double, x_min double, "
    "x_max double, y_min double, y_max double, plant_species string, bioclip_species string, "
    "bioclip_genus string, bioclip_family string, bioclip_order string, bioclip_score double, crop_path string"
)
T0 = datetime(2024, 5, 1, 12)


def det(track, seconds, species=None, genus=None, family=None, order="Diptera", score=0.5, conf=0.5, plant="p", crop=None, cam="c"):
    crop = crop or f"{track}-{seconds}.jpg"
    return (cam, "r", track, T0 + timedelta(seconds=seconds), conf, 0.1, 0.3, 0.1, 0.2, plant, species, genus, family, order, score, crop)


def top1(spark, rows, **slots):
    df = spark.createDataFrame(rows, DDL)
    return {r.track_ID: r for r in plans.aggregate_tracks(plans.prepare_detections(df), **slots).collect()}


def test_one_image_and_subsecond_tracks_last_zero_seconds(spark):
    got = top1(spark, [det("a", 0, "X x"), det("b", 0, "X x"), det("b", 0.95, "X x"), det("c", 0, "X x"), det("c", 1.0, "X x")])
    assert [got[t].duration_s for t in "abc"] == [0, 0, 1]


def test_vote_weights_and_double_rounding(spark):
    rows = [det("a", i, "X x", score=s) for i, s in enumerate([0.25, 0.26])] + [det("a", 2, "Y y", score=0.9)]
    got = top1(spark, rows)["a"]
    # mean 0.255 -> 0.26 (half up), 0.26 * 2/3 = 0.1733 -> 0.17; the single vote weighs 0.9 / 3 = 0.3
    assert (got.top1, got.top1_prob_weighted, got.track_ID_imgs, got.top1_imgs) == ("Y y", 0.3, 3, 1)


def test_ties_go_to_the_higher_mean_then_the_smaller_name(spark):
    rows = [det("a", 0, "B b", score=0.8), det("a", 1, "A a", score=0.8)]
    assert top1(spark, rows)["a"].top1 == "A a"
    rows = [det("a", i, "B b", score=0.4) for i in range(2)] + [det("a", i, "A a", score=0.8) for i in range(2, 3)] + [det("a", 9, "C c", score=0.0)]
    got = top1(spark, rows)["a"]  # both weigh 0.2
    assert (got.top1, got.top1_prob_weighted) == ("A a", 0.2)


def test_missing_scores_never_win(spark):
    rows = [det("a", 0, "A a", score=None), det("a", 1, "B b", score=0.01)]
    assert top1(spark, rows)["a"].top1 == "B b"
    got = top1(spark, [det("a", 0, "A a", score=None)])["a"]
    assert got.top1 == "A a" and got.top1_prob_weighted is None


def test_unresolved_ranks_fall_through(spark):
    rows = [det("a", 0, None, "G", "F"), det("b", 0, None, None, "F"), det("c", 0, None, None, None, "O"), det("d", 0, order=None)]
    got = top1(spark, rows)
    assert [got[t].top1 for t in "abcd"] == ["G", "F", "O", None]
    assert got["d"].order_category == "non-pollinator" and got["a"].order_category == "pollinator"


def test_first_plant_and_taxonomy_are_the_earliest(spark):
    rows = [
        det("a", 5, "X x", "Late", plant="late"),
        det("a", 1, "X x", "Early", plant=None),
        det("a", 9, "X x", "Later", plant="later"),
    ]
    got = top1(spark, rows)["a"]
    assert (got.bioclip_genus, got.plant_species) == ("Early", None)


def test_null_keys_are_left_out(spark):
    rows = [det("a", 0, "X x"), det("b", 0, "X x", cam=None)]
    assert set(top1(spark, rows)) == {"a"}


def test_filters_and_counts(spark):
    rows = [det("a", i, "X x", conf=0.9, score=0.9) for i in (0, 20)] + [det("b", 0, "X x", conf=0.2), det("c", 0, "Y y", conf=0.9, score=0.1), det("c", 30, "Y y", conf=0.9, score=0.1)]
    slots = dict(min_duration=">1", min_prob="0.5")
    df = spark.createDataFrame(rows, DDL)
    votes, tracks = plans.process_detections(df, min_conf=">=0.5", **slots)
    assert [r.track_ID for r in tracks.collect()] == ["a"]
    assert {r.track_ID for r in votes.collect()} == {"a", "c"}
    steps = {r.step: r.removed for r in plans.track_steps(op.normalize_classes(df), min_conf=">=0.5", **slots).collect()}
    assert steps["detections_removed"] == 1 and steps["tracks_removed"] == 0 and steps["classifications_removed"] == 1


def test_plain_format_needs_no_taxonomy(spark):
    df = spark.createDataFrame(
        [("c", "r", "t", "2024-05-01T12:00:00", 0.5, 0.1, 0.2, 0.1, 0.3, "bee", 0.7)],
        "cam_ID string, rec_ID string, track_ID string, timestamp string, confidence double, x_min double, x_max double, y_min double, y_max double, top1 string, top1_prob double",
    )
    row = plans.aggregate_tracks(plans.prepare_detections(df)).first()
    assert row.top1 == "bee" and row.order_category == "non-pollinator" and row.bbox_length_mean == 0.2


def test_class_format_is_checked(spark):
    with pytest.raises(ValueError):
        op.normalize_classes(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(ValueError):
        op.normalize_classes(spark.createDataFrame([(0.1,)], "bioclip_score double"))


def test_timestamps(spark):
    texts = ["2024-05-01T12:00:00", "2024-05-01T12:00:00.5", "2024-05-01T12:00:00.123456", "garbage", "", None, "2024-13-01T00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    got = sorted(r[0].microsecond for r in op.parse_ts(df).collect())
    assert got == [0, 123456, 500000]
    with pytest.raises(Exception):
        op.parse_ts(df, strict=True).collect()
    assert op.parse_ts(df.limit(3), strict=True).count() == 3


def test_best_per_key(spark):
    rows = [det("a", 0, score=None, crop="n.jpg"), det("a", 1, score=0.4, crop="z.jpg"), det("a", 2, score=0.4, crop="y.jpg"), det("b", 0, score=None, crop="only.jpg")]
    df = spark.createDataFrame(rows, DDL)
    assert {r.track_ID: r.crop_path for r in op.best_per_key(df).collect()} == {"a": "y.jpg", "b": "only.jpg"}
    bare = df.drop("bioclip_score")
    assert {r.track_ID: r.crop_path for r in op.best_per_key(bare).collect()} == {"a": "n.jpg", "b": "only.jpg"}


def test_a_hot_track_is_reduced_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.lit("c").alias("cam_ID"), F.lit("r").alias("rec_ID"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("track_ID"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"), F.lit(0.5).alias("confidence"),
        F.lit(0.0).alias("x_min"), F.lit(0.1).alias("x_max"), F.lit(0.0).alias("y_min"), F.lit(0.2).alias("y_max"),
        F.lit("bee").alias("top1"), (F.col("id") % 10 / 10).alias("top1_prob"),
    )
    tracks = plans.aggregate_tracks(plans.prepare_detections(df))
    hot = tracks.where("track_ID = 'hot'").first()
    assert hot.track_ID_imgs == 10_000 and hot.duration_s == 29_997 and tracks.count() == 20_001
    plan = tracks._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange hashpartitioning")
    assert "HashAggregate" in plan[first_exchange:] and "partial_sum" in plan[first_exchange:]


def test_one_pass_gives_votes_tracks_and_counts(spark, rows, tmp_path):
    data = [det("a", i, "X x", conf=0.9, score=0.9) for i in (0, 20)] + [det("a", 3, "Y y", conf=0.9, score=0.8)]
    data += [det("b", 0, "X x", conf=0.2), det("c", 0, "Y y", conf=0.9, score=0.1), det("c", 30, "Y y", conf=None), det("d", 0, "X x", cam=None)]
    data += [det("e", 0, "X x", score=0.1), det("e", 5, "X x", score=0.1)]
    text = F.when((F.col("track_ID") == "a") & (F.col("bioclip_species") == "Y y"), F.lit("never")).otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    spark.createDataFrame(data, DDL).withColumn("timestamp", text).write.parquet(f"{tmp_path}/detections")
    df = op.normalize_classes(spark.read.parquet(f"{tmp_path}/detections"))
    slots = dict(min_conf=">=0.5", min_duration=">1", min_prob="0.2")
    votes, tracks, steps = plans.process_once(df, f"{tmp_path}/parts", **slots)
    expected_votes, expected_tracks = plans.process_detections(df, **slots)
    for got, expected in [(votes, expected_votes), (tracks, expected_tracks), (steps, plans.track_steps(df, **slots))]:
        assert got.columns == expected.columns and rows(got) == rows(expected)
        assert got.inputFiles() and all("/parts/" in f for f in got.inputFiles())
    assert {r.step: r.removed for r in steps.collect()} == {
        "invalid_timestamps": 1, "detections_removed": 2, "detections_without_track": 1, "tracks_removed": 1, "classifications_removed": 1,
    }
    classed = plans.tracks.track_parts(plans.prepare_detections(df).withColumn("_step", F.lit(None).cast("string")), step="_step")
    assert classed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_one_pass_over_an_empty_table(spark, tmp_path):
    votes, tracks, steps = plans.process_once(spark.createDataFrame([], DDL), f"{tmp_path}/parts")
    assert votes.count() == 0 and tracks.count() == 0 and {r.removed for r in steps.collect()} == {0}


def test_times_are_read_as_written_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.createDataFrame([("2024-03-31T02:30:00.5",), ("2024-10-27T02:30:00",), ("x",)], "timestamp string")
        expected = [datetime(2024, 3, 31, 2, 30, 0, 500000), datetime(2024, 10, 27, 2, 30)]
        assert [r[0] for r in op.parse_ts(df).collect()] == expected
        assert [r[0] for r in op.parse_ts(df.where("timestamp <> 'x'"), strict=True).collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_infinite_values_count_as_missing(spark):
    inf = float("inf")
    rows = [det("a", 0, "X x", score=0.5, conf=inf), det("a", 1, "X x", score=inf, conf=0.4), det("a", 2, "X x", score=-inf, conf=float("nan"))]
    got = top1(spark, rows)["a"]
    assert (got.det_conf_mean, got.top1_prob_mean) == (0.4, 0.5)
    assert op.best_per_key(spark.createDataFrame(rows, DDL)).first().crop_path == "a-0.jpg"
