import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackstrata import operators as op
from trackstrata import plans

KEYS = ["id"]


@pytest.fixture(scope="module")
def people(spark):
    """5000 rows, a third of them in stratum h, one stratum of 3 rows."""
    stratum = (
        F.when(F.col("id") < 3, F.lit("tiny")).when(F.col("id") % 3 == 0, F.lit("h")).otherwise((F.col("id") % 5).cast("string"))
    )
    return spark.range(5000).select("id", stratum.alias("s"), (F.col("id") % 101 / 100).alias("p")).cache()


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("n", [0, 1, 7, 400, 1200])
def test_sizes_are_exact(people, n):
    drawn = op.stratified_sample(people, ["s"], n, keys=KEYS)
    sizes = {r.s: r["count"] for r in people.groupBy("s").count().collect()}
    got = {r.s: r["count"] for r in drawn.groupBy("s").count().collect()}
    assert got == ({} if n == 0 else {s: min(n, size) for s, size in sizes.items()})
    assert len(set(ids(drawn))) == drawn.count()


def test_same_rows_after_repartitioning(people):
    drawn = ids(op.stratified_sample(people, ["s"], 20, keys=KEYS))
    for parts in (1, 3, 13):
        assert ids(op.stratified_sample(people.repartition(parts, F.rand(parts)), ["s"], 20, keys=KEYS)) == drawn
    assert ids(op.stratified_sample(people, ["s"], 20, seed=5, keys=KEYS)) != drawn
    assert ids(op.stratified_sample(people, ["s"], 20, keys=KEYS, salt="other")) != drawn


def test_cut_path_gives_the_same_rows(spark, people):
    plain = ids(op.stratified_sample(people, ["s"], 300, keys=KEYS))
    whole = ids(op.sample_n(people, 400, keys=KEYS))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "100")
    try:
        assert ids(op.stratified_sample(people, ["s"], 300, keys=KEYS)) == plain
        null = people.withColumn("s", F.when(F.col("s") != "h", F.col("s")))
        assert op.stratified_sample(null, ["s"], 300, keys=KEYS).where("s is null").count() == 300
        assert ids(op.sample_n(people, 400, keys=KEYS)) == whole
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(small=st.integers(1, 40), more=st.integers(1, 40), seed=st.integers(0, 10**6))
def test_samples_are_nested(people, small, more, seed):
    first = set(ids(op.stratified_sample(people, ["s"], small, seed, KEYS)))
    second = set(ids(op.stratified_sample(people, ["s"], small + more, seed, KEYS)))
    assert first < second


def test_sample_n(people):
    drawn = ids(op.sample_n(people, 50, keys=KEYS))
    assert len(drawn) == 50 and drawn == ids(op.sample_n(people.repartition(9), 50, keys=KEYS))
    assert set(drawn) < set(ids(op.sample_n(people, 51, keys=KEYS)))
    assert op.sample_n(people, 10**6, keys=KEYS).count() == 5000


def test_every_row_is_as_likely(people):
    counts = {}
    for seed in range(20):
        for r in op.sample_n(people, 500, seed, KEYS).select((F.col("id") < 2500).alias("low")).collect():
            counts[r.low] = counts.get(r.low, 0) + 1
    assert 0.45 < counts[True] / 10_000 < 0.55


def test_limit_comes_before_the_shuffle(people):
    plan = op.stratified_sample(people, ["s"], 20, keys=KEYS)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]
    plan = op.sample_n(people, 20, keys=KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan


def test_chunks(people):
    parts = op.chunk(people, 100, keys=KEYS, position="place")
    sizes = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sizes == {p: 100 for p in range(1, 51)}
    rows = parts.orderBy("place").collect()
    assert [r.place for r in rows] == list(range(1, 5001)) and [r.id for r in rows] != list(range(5000))
    assert {r.id: r.part for r in op.chunk(people.repartition(7), 100, keys=KEYS, digits=1).collect()} == {r.id: r.part for r in rows}
    last = op.chunk(people.where("id < 250"), 100, keys=KEYS).groupBy("part").count()
    assert sorted((r.part, r["count"]) for r in last.collect()) == [(1, 100), (2, 100), (3, 50)]


def test_chunk_has_no_single_task_sort_of_the_rows(people):
    plan = op.chunk(people, 100, keys=KEYS)._jdf.queryExecution().executedPlan().toString()
    single = plan.index("SinglePartition")
    assert "HashAggregate" in plan[single : single + 400]


def test_top_values_skip_null_and_break_ties_by_value(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "b", "a", "a", "c", None, None, None]], "x string")
    assert [tuple(r) for r in op.top_values(df, "x", 2).collect()] == [("a", 2), ("b", 2)]


TRACK = (
    "track_ID string, bioclip_order string, bioclip_genus string, bioclip_family string, bioclip_species string, "
    "plant_species string, duration_s bigint, top1_prob_weighted double, det_conf_mean double"
)


def track_table(spark, rows):
    return spark.createDataFrame(rows, TRACK)


def one(i, order="Diptera", genus="G", family="Syrphidae", species="G s", plant="p", duration=5, prob=None, conf=0.9):
    return (f"t{i:04d}", order, genus, family, species, plant, duration, i % 100 / 100 if prob is None else prob, conf)


def test_families(spark):
    key = ["track_ID"]
    tracks = track_table(
        spark,
        [one(i) for i in range(200)]
        + [one(i, genus=None, plant=None, species=None) for i in range(200, 220)]
        + [one(i, order="Araneae") for i in range(220, 240)]
        + [one(i, duration=0) for i in range(240, 250)]
        + [one(i, duration=None) for i in range(250, 255)]
        + [one(i, prob=1.0) for i in range(255, 260)],
    )
    first = plans.strata1(tracks, 11, keys=key)
    assert {(r.strata1, r.prob_strata1): r["count"] for r in first.groupBy("strata1", "prob_strata1").count().collect()} == {
        ("pollinator", "low_prob"): 5, ("pollinator", "high_prob"): 5, ("non_pollinator", "low_prob"): 5,
    }
    second = plans.strata2(tracks, 6, keys=key)
    assert set(r.strata2 for r in second.select("strata2").distinct().collect()) == {"single_crop", "multiple_crop"}
    third = plans.strata3(tracks, 3, keys=key)
    assert third.where("prob_bin = '1.0-1.0'").count() == 0 and third.groupBy("prob_bin").count().where("count <> 3").count() == 0
    fourth = plans.strata4(tracks, 11, keys=key)
    assert fourth.where("plant_species is null").count() == 0 and fourth.count() == 10
    fifth = plans.strata5(tracks, 11, keys=key)
    assert fifth.where("bioclip_genus is null").count() == 0 and fifth.count() == 22
    seventh = plans.strata7(tracks, 7, keys=key)
    assert seventh.count() == 14 and seventh.where("duration_s = 0").count() == 0
    eighth = plans.strata8(tracks, 4, 1, keys=key)
    assert eighth.count() == 8 and {r.slug for r in eighth.collect()} == {"g_s"}


def test_empty_families_keep_their_columns(spark):
    tracks = track_table(spark, [one(1, order="Araneae")])
    for name, draw in plans.FAMILIES.items():
        if name != "strata1":
            empty = draw(tracks, keys=["track_ID"])
            assert empty.count() == 0 and "strata1" in empty.columns


def test_species_sharing_a_slug_stay_apart(spark):
    tracks = track_table(spark, [one(i, species="Genus species") for i in range(10)] + [one(i, species="Genesis spectra") for i in range(10, 20)])
    drawn = plans.strata8(tracks, 2, keys=["track_ID"])
    assert {r.slug for r in drawn.collect()} == {"gen_spe"}
    assert {r["count"] for r in drawn.groupBy("bioclip_species").count().collect()} == {4}


def test_expert_samples(spark):
    key = ["track_ID"]
    tracks = track_table(
        spark,
        [one(i, genus=f"G{i % 3}") for i in range(300)] + [one(i, family="Other", conf=0.1) for i in range(300, 400)],
    )
    assert plans.sample_all(tracks, 30, keys=key).where("det_conf_mean <= 0.5").count() == 0
    both = plans.strata_thresholds(tracks, [0.5, 0.9], 10, keys=key)
    assert {r.threshold: r["count"] for r in both.groupBy("threshold").count().collect()} == {0.5: 10, 0.9: 10}
    assert both.where("top1_prob_weighted <= threshold or bioclip_family <> 'Syrphidae'").count() == 0
    genera = plans.strata_genus(tracks, 40, keys=key, chunk_size=50)
    assert {r["count"] for r in genera.groupBy("sampled_genus").count().collect()} == {40}
    assert sorted(r["count"] for r in genera.groupBy("part").count().collect()) == [20, 50, 50]


def test_median_split_is_a_partition(spark, people):
    for how in (dict(), dict(max_groups=10), dict(broadcast_rows=0)):
        split = op.median_split(people, ["s"], "p", **how)
        assert split.count() == 5000
        assert split.where("(prob_cat = 'low_prob') <> (p < median)").count() == 0


def test_medians(spark):
    rows = [("odd", 3.0), ("odd", 1.0), ("odd", 2.0), ("even", 1.0), ("even", 2.0), ("one", 7.0), ("null", None), ("some", None), ("some", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    expected = {"odd": 2.0, "even": 1.5, "one": 7.0, "some": 4.0}
    assert {r.g: r.median for r in op.group_median(df, ["g"], "x").collect()} == expected
    assert {r.g: r.median for r in op.group_median_refined(df, ["g"], "x", cells=4).collect()} == expected
    split = op.median_split(df, ["g"], "x")
    assert [r.prob_cat for r in split.where("g = 'null'").collect()] == ["high_prob"]


def test_refined_median_on_many_values_and_a_hot_group(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 4).cast("string")).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7).alias("x"),
    )
    exact = {r.g: r.m for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    for cells in (1, 64, 4096):
        got = {r.g: r.median for r in op.group_median_refined(df, ["g"], "x", cells=cells).collect()}
        assert got == pytest.approx(exact, rel=1e-15)


def test_refined_median_narrows_whatever_the_spread(spark):
    far = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 0, "ties").otherwise("few").alias("g"),
        F.when(F.col("id") < 5, F.lit(1e12)).when((F.col("id") % 3 == 0) & (F.col("id") % 2 == 1), F.lit(2.5)).otherwise(F.col("id") / 3).alias("x"),
    ).where("g <> 'few' or id < 40")
    exact = {r.g: r.m for r in far.groupBy("g").agg(F.median("x").alias("m")).collect()}
    for most, cells in ((2, 4), (3, 64), (65_536, 64)):
        got = {r.g: r.median for r in op.group_median_refined(far, ["g"], "x", cells=cells, most=most).collect()}
        assert got == pytest.approx(exact, rel=1e-15)


def test_narrowing_keeps_the_middle_and_few_values(spark):
    from trackstrata.operators.medians import _from_counts, _narrowed

    counts = spark.range(5_001).select(
        F.lit("a").alias("g"), F.exp(F.col("id") / 100).alias("_v"), (F.col("id") % 3 + 1).alias("_n"), F.lit(10_002).cast("bigint").alias("_total"), F.lit(0).cast("bigint").alias("_before")
    )
    kept = _narrowed(counts, ["g"], 64)
    assert 1 <= kept.count() <= 160
    assert _from_counts(kept.select(counts.columns), ["g"], "m").first().m == _from_counts(counts, ["g"], "m").first().m


def test_medians_bound_the_values_of_a_task(spark):
    df = spark.range(3_000).select((F.col("id") % 3).alias("g"), F.exp(F.pmod(F.xxhash64("id"), F.lit(5_000)) / 300).alias("x"))
    exact = {r.g: r.m for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    for most in (50, 65_536):
        medians = op.group_median(df, ["g"], "x", most=most)
        assert {r.g: r.median for r in medians.collect()} == pytest.approx(exact, rel=1e-15)
    assert op.group_median(df.where("false"), ["g"], "x").count() == 0


def test_chunks_compute_their_rows_once(spark, people, tmp_path):
    people.write.parquet(f"{tmp_path}/people")
    parts = op.chunk(spark.read.parquet(f"{tmp_path}/people"), 100, keys=["id"], position="position")
    assert sorted(r.position for r in parts.collect()) == list(range(1, people.count() + 1))
    final = parts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_large_samples_read_their_table_once(spark, people, tmp_path, monkeypatch):
    from trackstrata.operators import sampling

    people.write.parquet(f"{tmp_path}/people")
    stored = spark.read.parquet(f"{tmp_path}/people")
    expected = {s: sorted(r.id for r in sampling._by_cells(stored, stored.columns, [], n, 123, ["id"], "x", 4).collect()) for s, n in (("a", 1500),)}
    sample = op.sample_n(stored, 1500, keys=["id"], salt="x")
    assert sorted(r.id for r in sample.collect()) == expected["a"]
    assert not any("/people" in f for f in sample.inputFiles())
    # sub-strata that are too few lose rows, which is seen: the whole table is taken
    monkeypatch.setattr(sampling, "_FILL", 50)
    again = op.sample_n(stored, 1500, keys=["id"], salt="x")
    assert sorted(r.id for r in again.collect()) == expected["a"]
    assert any("/people" in f for f in again.inputFiles())


def test_best_row_is_cut_before_the_shuffle(spark, people):
    plan = op.best_per_key(people, ["s"], "p", ["id"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "SortAggregate" not in plan


def test_expert_samples_are_those_of_the_three_plans(spark):
    key = ["track_ID"]
    tracks = track_table(spark, [one(i, genus=f"G{i % 3}") for i in range(300)] + [one(i, family="Other", conf=0.6) for i in range(300, 400)])
    crops = tracks.select("track_ID", F.lit(0.5).alias("bioclip_score"), F.concat(F.lit("c"), "track_ID").alias("crop_path"))
    sizes = dict(n_all=30, thresholds=[0.5, 0.9], n_threshold=10, n_genus=40, chunk_size=50, keys=key)
    for limit in ("1000", "5"):
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
        try:
            drawn = plans.expert_samples(tracks, crops, **sizes).collect()
        finally:
            spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
        assert all(r.crop_path == f"c{r.track_ID}" for r in drawn)
        got = {s: sorted((r.threshold, r.sampled_genus, r.part, r.track_ID) for r in drawn if r["sample"] == s) for s in ("sample_all", "strata_thresholds", "strata_genus")}
        assert got["sample_all"] == sorted((None, None, None, r.track_ID) for r in plans.sample_all(tracks, 30, keys=key).collect())
        assert got["strata_thresholds"] == sorted((r.threshold, None, None, r.track_ID) for r in plans.strata_thresholds(tracks, [0.5, 0.9], 10, keys=key).collect())
        assert got["strata_genus"] == sorted((None, r.sampled_genus, r.part, r.track_ID) for r in plans.strata_genus(tracks, 40, keys=key, chunk_size=50).collect())
