from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trackstrata import operators as op

T0 = datetime(2024, 5, 1)
STRATEGIES = [
    dict(),
    dict(strategy="sliced"),
    dict(strategy="sliced", slice_seconds=600),
    dict(strategy="sliced", broadcast_rows=0),
    dict(strategy="union"),
    dict(strategy="union", salts=3, slice_seconds=3600),
    dict(strategy="interval"),
    dict(strategy="interval", broadcast_rows=0),
]


def at(hours):
    return T0 + timedelta(hours=hours)


def frames(spark):
    sessions = [
        ("a", at(1), "x", "1.json"),
        ("a", at(5), None, "2.json"),
        ("a", at(80), "z", "3.json"),
        ("b", at(2), "first", "10.json"),
        ("b", at(2), "second", "11.json"),
        (None, at(0), "never", "12.json"),
    ]
    facts = [
        (1, "a", at(0.5)),
        (2, "a", at(1)),
        (3, "a", at(4.999)),
        (4, "a", at(5)),
        (5, "a", at(79)),
        (6, "a", at(80)),
        (7, "a", at(5000)),
        (8, "b", at(2)),
        (9, "unknown", at(3)),
        (10, None, at(3)),
        (11, "a", None),
        (12, "b", at(50)),
    ]
    return (
        spark.createDataFrame(facts, "id int, cam_ID string, timestamp timestamp_ntz"),
        spark.createDataFrame(sessions, "cam_ID string, start timestamp_ntz, setting string, filename string"),
    )


EXPECTED = {1: None, 2: "x", 3: "x", 4: None, 5: None, 6: "z", 7: "z", 8: "first", 9: None, 10: None, 11: None, 12: "first"}


@pytest.mark.parametrize("how", STRATEGIES, ids=str)
def test_session_join(spark, how):
    facts, sessions = frames(spark)
    joined = op.session_join(facts, sessions, columns=["setting"], tie=["filename"], **how)
    assert {r.id: r.setting for r in joined.collect()} == EXPECTED
    assert joined.columns == [*facts.columns, "setting"]


@pytest.mark.parametrize("how", STRATEGIES, ids=str)
def test_strategies_agree_on_a_hot_key(spark, how):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 7))
    time = F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(400_000)) + 1_700_000_000).cast("timestamp_ntz")
    facts = spark.range(6000).select("id", key.alias("cam_ID"), time.alias("timestamp"))
    sessions = spark.range(300).select(
        key.alias("cam_ID"), time.alias("start"), F.col("id").cast("string").alias("setting")
    )
    joined = op.session_join(facts, sessions, columns=["setting"], tie=["setting"], **how)
    starts = {}
    for row in sessions.collect():
        starts.setdefault(row.cam_ID, []).append((row.start, row.setting))
    for row in joined.collect():
        past = [s for s in starts.get(row.cam_ID, []) if s[0] <= row.timestamp]
        latest = max((s[0] for s in past), default=None)
        names = [s[1] for s in past if s[0] == latest]
        assert row.setting == (min(names) if names else None)
    assert joined.count() == 6000


def test_no_session_at_all(spark):
    facts, sessions = frames(spark)
    for how in STRATEGIES:
        joined = op.session_join(facts, sessions.limit(0), columns=["setting"], tie=["filename"], **how)
        assert joined.count() == 12 and joined.where("setting is not null").count() == 0


def test_intervals(spark):
    _, sessions = frames(spark)
    rows = {(r.cam_ID, r.start): r.end for r in op.session_intervals(sessions, columns=["setting"], tie=["filename"]).collect()}
    assert rows == {("a", at(1)): at(5), ("a", at(5)): at(80), ("a", at(80)): None, ("b", at(2)): None}


def test_facts_are_not_shuffled_when_intervals_are_few(spark):
    facts, sessions = frames(spark)
    joined = op.session_join(facts, sessions, columns=["setting"], tie=["filename"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_bad_arguments(spark):
    facts, sessions = frames(spark)
    with pytest.raises(ValueError):
        op.session_join(facts, sessions, columns=["setting"], strategy="guess")
    with pytest.raises(ValueError):
        op.session_join(facts.withColumn("setting", F.lit(1)), sessions, columns=["setting"])


@pytest.mark.parametrize("how", [dict(), dict(strategy="sliced"), dict(strategy="sliced", broadcast_rows=0), dict(strategy="interval"), dict(strategy="union", salts=2)], ids=str)
def test_the_facts_are_read_once(spark, how, tmp_path):
    """Nothing reads them while the join is built, and the join has one scan of them."""
    facts, sessions = frames(spark)
    facts.write.parquet(f"{tmp_path}/facts")
    stored = spark.read.parquet(f"{tmp_path}/facts")
    unread = stored.withColumn("id", F.when(F.raise_error(F.lit("read")).isNull(), F.col("id")))
    op.session_join(unread, sessions, columns=["setting"], tie=["filename"], **how)
    joined = op.session_join(stored, sessions, columns=["setting"], tie=["filename"], **how)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    scans = plan.count("Relation [id#")
    # the union strategy adds the facts that cannot be placed from a second branch of the same plan
    assert scans == (2 if how.get("strategy") == "union" else 1)


def test_slices_follow_the_sessions(spark):
    """One long session beside many short ones: the listed rows stay within their bound and every fact finds its session."""
    from trackstrata.operators.sessions import _listed, _measure

    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    later = lambda seconds: F.timestamp_seconds(seconds + 1_704_067_200).cast("timestamp_ntz")
    short = spark.range(2000).select(F.lit("busy").alias("cam_ID"), later(F.col("id") * 7).alias("start"), F.col("id").cast("string").alias("setting"))
    long = spark.range(1).select(F.lit("calm").alias("cam_ID"), (t0 - F.expr("interval 4000 days")).alias("start"), F.lit("old").alias("setting"))
    sessions = short.unionByName(long)
    facts = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "busy").otherwise("calm").alias("cam_ID"), later(F.col("id") * 5 - 50).alias("timestamp"))
    for how in (dict(strategy="sliced"), dict(strategy="union"), dict(strategy="sliced", slice_seconds=3600)):
        found = {r.id: r.setting for r in op.session_join(facts, sessions, columns=["setting"], **how).collect()}
        expected = {i: "old" if i % 2 else str(min((i * 5 - 50) // 7, 1999)) if i >= 10 else None for i in range(3000)}
        assert found == expected
    intervals = op.session_intervals(sessions, columns=["setting"]).select("cam_ID", F.col("start").alias("_from"), F.struct("setting").alias("_values"), F.col("end").alias("_to"))
    measured = _measure(intervals, "cam_ID")
    for seconds in (measured.slice_seconds(), 60, 86_400):
        assert _listed(intervals, seconds, measured.latest // seconds + 1).count() <= measured.listed(seconds)
    assert measured.listed(measured.slice_seconds()) <= 3 * 2001 + 4
