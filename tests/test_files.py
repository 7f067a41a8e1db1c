import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trackstrata import plans, sinks
from trackstrata.model import EXPERT_COLUMNS, REVIEW_COLUMNS, TRACK_DDL
from trackstrata.operators import checklist_match
from trackstrata.sources import (
    config_quality,
    file_index,
    read_checklist,
    read_configs,
    read_detections,
    read_table,
    rejected_configs,
)

HEADER = "cam_ID,rec_ID,track_ID,timestamp,confidence,x_min,y_min,x_max,y_max,bioclip_species,bioclip_genus,bioclip_family,bioclip_order,bioclip_class,bioclip_score,crop_path"
NAME = "2024-05-01_metadata_merged_crops_classified.csv"


def row(cam="001", track="1", ts="2024-05-01T10:00:00.5", species="Apis mellifera", score="0.9", crop="a.jpg"):
    return f"{cam},r,{track},{ts},0.8,0.1,0.1,0.3,0.2,{species},Apis,Apidae,Hymenoptera,Insecta,{score},{crop}"


def put(root, path, text):
    full = os.path.join(str(root), path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def configs(tmp_path):
    def doc(name, body):
        put(tmp_path, name, body if isinstance(body, str) else json.dumps(body))

    doc("2024-05-01_10-00-00_config_unit_flower.json", {"network": {"hotspot": {"ssid": " 001 "}}, "deployment": {"setting": " Salvia ", "location": {"latitude": 48.5, "accuracy": "x"}}, "camera": {"focus": {"lens_position": {"manual": 3, "range": {"min": 1, "max": 9.5}}}}})
    doc("deep/er/2024-05-01_11-00-00_config_unit_platform.json", {"device": {"id": 0}, "cam_id": "001", "deployment": {"setting": "NA"}})
    doc("2024-05-01_12-00-00_config_unit_flower.json", {"ssid": "001", "deployment": None})
    doc("2024-05-02_12-00-00_config_unit_flower.json", '{"network": {"hotspot": {"ssid": "001"}}, "deploy')
    doc("2024-13-01_12-00-00_config_unit_flower.json", {"ssid": "001"})
    doc("2024-05-01_12-00-00_config_unit_table.json", {"ssid": "001"})
    doc("2024-05-01_12-00-00_config.json", {"ssid": "001"})
    return str(tmp_path)


def test_configs(spark, configs):
    got = {r.date_time: r for r in read_configs(spark, configs).collect()}
    assert sorted(got) == ["2024-05-01_10-00-00", "2024-05-01_11-00-00", "2024-05-01_12-00-00", "2024-05-02_12-00-00"]
    first = got["2024-05-01_10-00-00"]
    assert (first.cam_ID, first.deployment_setting, first.location_latitude, first.location_accuracy) == ("001", "Salvia", 48.5, None)
    assert (first.lens_position_manual, first.lens_position_min, first.lens_position_max) == (3.0, 1.0, 9.5)
    assert got["2024-05-01_11-00-00"].cam_ID == "001" and got["2024-05-01_11-00-00"].deployment_setting == "NA"
    assert got["2024-05-01_12-00-00"].deployment_setting == "unknown"
    broken = got["2024-05-02_12-00-00"]
    assert (broken.cam_ID, broken.location_latitude, broken.parse_ok) == ("unknown", None, False)
    assert [r.date_time for r in rejected_configs(spark, configs).collect()] == ["2024-13-01_12-00-00"]
    quality = {r.filename[:19]: (r.parse_ok, r.missing) for r in config_quality(read_configs(spark, configs)).collect()}
    assert quality == {"2024-05-01_12-00-00": (True, ["deployment_setting"]), "2024-05-02_12-00-00": (False, ["JSON parsing failed"])}


def test_detections_by_position(spark, tmp_path):
    put(tmp_path, f"a/{NAME}", "\n".join([HEADER, row(), row(track="2")]))  # no final newline
    put(tmp_path, f"b/c/{NAME}", "\n".join([HEADER, row(cam="002", species="")]) + "\n")
    put(tmp_path, f"d/{NAME}", HEADER + "\n")
    put(tmp_path, "d/other.csv", "x\n1\n")
    df = read_detections(spark, str(tmp_path), with_source=True)
    rows = df.collect()
    assert sorted((r.cam_ID, r.track_ID, r.bioclip_species) for r in rows) == [("001", "1", "Apis mellifera"), ("001", "2", "Apis mellifera"), ("002", "1", None)]
    assert {r.source_file.rsplit("/", 2)[-2] for r in rows} == {"a", "c"}


def test_other_headers_fail_loudly_or_are_read_by_name(spark, tmp_path):
    names = HEADER.split(",")
    cells = row(cam="007").split(",")
    put(tmp_path, f"a/{NAME}", "\n".join([HEADER, row()]) + "\n")
    put(tmp_path, f"b dir/{NAME}", ",".join(reversed(names)) + "\n" + ",".join(reversed(cells)) + "\n")
    short = [i for i, n in enumerate(names) if n != "bioclip_class"]
    put(tmp_path, f"c/{NAME}", ",".join(names[i] for i in short) + ",extra\n" + ",".join(cells[i] for i in short) + ",1\n")
    with pytest.raises(Exception):
        read_detections(spark, str(tmp_path)).collect()
    df = read_detections(spark, str(tmp_path), by_name=True)
    assert df.columns == [*names, "extra"]
    assert sorted(r.extra for r in df.where("extra is not null").collect()) == ["1"]
    got = {(r.cam_ID, r.confidence, r.bioclip_class, r.crop_path) for r in df.collect()}
    assert got == {("001", 0.8, "Insecta", "a.jpg"), ("007", 0.8, "Insecta", "a.jpg"), ("007", 0.8, None, "a.jpg")}
    assert df.count() == 3


def test_merge_then_tracks(spark, tmp_path, configs):
    lines = [HEADER, row(ts="2024-05-01T09:59:59"), row(track="2", ts="2024-05-01T10:00:00"), row(track="3", ts="2024-05-01T11:30:00.25"), row(track="4", ts="bad"), row(cam="zzz", track="5")]
    put(tmp_path, f"processed/{NAME}", "\n".join(lines) + "\n")
    for strategy in ("sliced", "union", "interval"):
        merged = plans.merge_detections(spark, configs, str(tmp_path / "processed"), strategy=strategy)
        assert {r.track_ID: r.plant_species for r in merged.collect()} == {"1": None, "2": "Salvia", "3": "NA", "4": None, "5": None}
    votes, tracks = plans.process_detections(merged)
    assert {r.track_ID for r in tracks.collect()} == {"1", "2", "3", "5"}
    assert set(REVIEW_COLUMNS) - set(tracks.columns) == {"crop_path"} and set(EXPERT_COLUMNS) - set(tracks.columns) == {"crop_path"}

    target = sinks.write_table(tracks, str(tmp_path / "tracks"), run_id="run_1")
    again = read_table(spark, target, TRACK_DDL)
    assert again.columns == tracks.columns and again.count() == 4
    with pytest.raises(Exception):
        sinks.write_table(tracks, str(tmp_path / "tracks"), run_id="run_1")
    csv = sinks.write_table(tracks, str(tmp_path / "csv"), fmt="csv")
    assert read_table(spark, csv, TRACK_DDL, "csv").where("duration_s = 0").count() == 4
    with pytest.raises(ValueError):
        read_table(spark, csv, fmt="csv")


PLAIN = "cam_ID,rec_ID,track_ID,timestamp,confidence,x_min,y_min,x_max,y_max,top1,top1_prob,crop_path"


def test_plain_format_merges_to_classes(spark, tmp_path, configs):
    lines = [PLAIN, "001,r,1,2024-05-01T10:00:00,0.8,0.1,0.1,0.3,0.2,bee,0.9,a.jpg"]
    put(tmp_path, f"plain/{NAME}", "\n".join(lines) + "\n")
    from trackstrata.model import PLAIN_DETECTION_DDL

    for options in ({"by_name": True}, {"schema": PLAIN_DETECTION_DDL}):
        merged = plans.merge_detections(spark, configs, str(tmp_path / "plain"), **options)
        assert merged.columns == [*PLAIN.split(","), "plant_species"]
        _, tracks = plans.process_detections(merged)
        assert [(r.top1, r.plant_species) for r in tracks.collect()] == [("bee", "Salvia")]
    put(tmp_path, f"neither/{NAME}", "cam_ID,timestamp,confidence\n001,2024-05-01T10:00:00,0.8\n")
    with pytest.raises(ValueError, match="top1"):
        plans.merge_detections(spark, configs, str(tmp_path / "neither"), by_name=True)


def test_rows_that_look_like_headers_are_data(spark, tmp_path):
    put(tmp_path, f"a/{NAME}", "\n".join([HEADER, row(cam="cam_ID", ts="timestamp"), '002,r,1,t,0.8,0.1,0.1,0.3,0.2,"A, b",Apis,Apidae,Hymenoptera,Insecta,0.9,c.jpg']) + "\n")
    put(tmp_path, f"b/{NAME}", PLAIN + ",note\n003,r,1,t,0.8,0.1,0.1,0.3,0.2,fly,0.7,d.jpg,x\n")
    df = read_detections(spark, str(tmp_path), by_name=True, schema=None, with_source=True)
    assert df.columns == [*HEADER.split(","), "top1", "top1_prob", "note", "source_file"]
    got = {(r.cam_ID, r.bioclip_species, r.bioclip_score, r.top1, r.top1_prob, r.note) for r in df.collect()}
    assert got == {("cam_ID", "Apis mellifera", 0.9, None, None, None), ("002", "A, b", 0.9, None, None, None), ("003", None, None, "fly", 0.7, "x")}
    put(tmp_path, f"c/{NAME}", "1,2,3\n")
    with pytest.raises(Exception, match="no header line"):
        read_detections(spark, str(tmp_path), by_name=True).collect()


def test_merge_needs_both_inputs(spark, tmp_path, configs):
    put(tmp_path, f"none/{NAME}", HEADER + "\n")
    put(tmp_path, f"some/{NAME}", HEADER + "\n" + row() + "\n")
    with pytest.raises(ValueError, match="detections"):
        plans.merge_detections(spark, configs, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="configs"):
        plans.merge_detections(spark, str(tmp_path / "some"), str(tmp_path / "some"))


def test_strata_folders_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("strata3", "hym", 1), ("strata3", "dip", 2), ("strata8", "api_mel", 3)], "family string, stratum string, x int")
    out = sinks.write_strata(df, str(tmp_path / "strata"))
    assert sorted(os.listdir(f"{out}/family=strata3")) == ["stratum=dip", "stratum=hym"]
    assert spark.read.parquet(out).where("family = 'strata3' and stratum = 'hym'").first().x == 1
    levels = spark.createDataFrame([(0.55, 1), (0.6, 2)], "threshold double, x int")
    out = sinks.write_strata(levels, str(tmp_path / "levels"), ["threshold"], "csv")
    assert {d for d in os.listdir(out) if d.startswith("threshold")} == {"threshold=0.55", "threshold=0.6"}
    where = sinks.write_manifest(spark, {"min_conf": ">=0.5", "n": 3}, str(tmp_path / "run"), "run_2")
    saved = spark.read.json(where).first()
    assert saved.run_id == "run_2" and json.loads(saved.parameters) == {"min_conf": ">=0.5", "n": 3}


def test_observed_rows(spark):
    df, seen = sinks.observed(spark.range(42), "step")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 42


def test_checklist_file(spark, tmp_path):
    put(tmp_path, "list.csv", "species\nSyrphidae\nEristalis\nEristalis tenax\nEristalis tenax\n\n")
    listed = read_checklist(spark, str(tmp_path / "list.csv"))
    assert listed.count() == 3
    names = spark.createDataFrame([("eristalis tenax",), ("x",)], "name string")
    assert checklist_match(names, listed, "name").count() == 1
    put(tmp_path, "bad.csv", "name\nx\n")
    with pytest.raises(ValueError):
        read_checklist(spark, str(tmp_path / "bad.csv"))


def test_file_index_lists_in_tasks(spark, tmp_path, monkeypatch):
    from trackstrata.sources import files, listing

    for name in ("One.JPG", "A/two.jpg", "A/b c/Drei é.jpg", "A/b c/d/one.jpg", "B/_hidden.jpg", "B/.also", "_no/x.jpg", "B/e.txt"):
        put(tmp_path, f"img/{name}", "x" * 10)
    os.makedirs(f"{tmp_path}/img/empty/folder")
    root = str(tmp_path / "img")
    index = {r.file_name: r.file_path for r in file_index(spark, root, "*.[jJ][pP][gG]").collect()}
    monkeypatch.setattr(files, "can_list", lambda _: False)
    assert index == {r.file_name: r.file_path for r in file_index(spark, root, "*.[jJ][pP][gG]").collect()}
    assert sorted(index) == ["drei é.jpg", "one.jpg", "two.jpg"] and index["one.jpg"] == f"file:{root}/One.JPG"
    listed = listing.list_files(spark, f"file://{root}")
    assert listed.count() == 5 and "MapInArrow" not in listed._jdf.queryExecution().executedPlan().toString()
    assert listing.can_list("s3a://b/x") and not listing.can_list("viewfs://store/x")


def test_headers_come_from_the_first_bytes(spark, tmp_path, monkeypatch):
    from trackstrata.sources import detections

    other = ",".join([*reversed(HEADER.split(",")), "note"])
    cells = ",".join([*reversed(row(cam="007", track="9").split(",")), "n"])
    put(tmp_path, f"a/{NAME}", "\ufeff" + "\r\n".join(["", HEADER, row(), HEADER]) + "\r\n")
    put(tmp_path, f"b dir/é/{NAME}", other + "\n" + "\n".join([cells] * 2000))
    put(tmp_path, f"c/{NAME}", "")
    got = read_detections(spark, str(tmp_path), by_name=True)
    assert got.count() == 2001 and got.where("note = 'n' and cam_ID = '007' and bioclip_score = 0.9").count() == 2000
    heads = detections.first_bytes(spark.createDataFrame([(f"file:{tmp_path}/b dir/é/{NAME}",)], "path string"), "path", 64).first().head
    assert bytes(heads) == other.encode()[:64]
    monkeypatch.setattr(detections, "HEADER_BYTES", len(other) + 5)  # the header line is whole, the next one is not
    assert read_detections(spark, str(tmp_path), by_name=True).count() == 2001
    monkeypatch.setattr(detections, "HEADER_BYTES", len(other) - 5)
    with pytest.raises(ValueError, match="no file with a header"):
        read_detections(spark, str(tmp_path), by_name=True).count()
    monkeypatch.setattr(detections, "can_list", lambda _: False)
    assert read_detections(spark, str(tmp_path), by_name=True).count() == 2001


def test_merge_counts_strict_and_device(spark, tmp_path):
    config = json.dumps({"ssid": "001", "deployment": {"setting": "Salvia"}})
    put(tmp_path, "raw/2024-05-01_09-00-00_config_unit_flower.json", config)
    put(tmp_path, "raw/2024-05-01_09-30-00_config_other_flower.json", config.replace("Salvia", "Aster"))
    lines = [row(), row(ts="not a time"), row(cam=""), row(ts=""), row(cam="002")]
    put(tmp_path, f"processed/{NAME}", "\n".join([HEADER, *lines]) + "\n")
    folders = (f"{tmp_path}/raw", f"{tmp_path}/processed")
    seen = Observation()
    merged = plans.merge_detections(spark, *folders, observation=seen)
    assert sum(1 for _ in merged.toLocalIterator()) == 5
    expected = {
        "rows": merged.count(),
        "unparsed_timestamps": merged.where("timestamp = 'not a time'").count(),
        "without_camera": merged.where("cam_ID is null").count(),
        "without_plant": merged.where("plant_species is null").count(),
    }
    assert seen.get == expected == {"rows": 5, "unparsed_timestamps": 1, "without_camera": 1, "without_plant": 4}
    assert {r.plant_species for r in merged.collect()} == {"Aster", None}
    assert {r.plant_species for r in plans.merge_detections(spark, *folders, device="unit").collect()} == {"Salvia", None}
    with pytest.raises(Exception, match="does not parse: not a time"):
        plans.merge_detections(spark, *folders, strict=True).collect()


def test_sorted_sink(spark, tmp_path):
    rows = spark.range(5000).select(F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id"), F.lit(40))).alias("a"), F.pmod(F.hash("id"), F.lit(9)).alias("b"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = sinks.write_table(rows.repartition(6), str(tmp_path / "sorted"), order_by=["a", "b", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    found = [tuple(r) for f in files for r in spark.read.parquet(f"{path}/{f}").collect()]
    assert len(files) > 1 and found == sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0] is not None, r))


def test_held_tables_prune_columns_and_are_deleted(spark, tmp_path):
    from trackstrata import session

    with session.holding(spark) as folder:
        held = session.hold(spark.range(5).selectExpr("id", "cast(id as string) as name"))
        plan = held.select("name").where("name > '2'")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<name:string>" in plan and "PushedFilters: [IsNotNull(name), GreaterThan(name,2)]" in plan
        assert held.where("id > 2").count() == 2 and all(folder in f for f in held.inputFiles())
    path, files = session._files(spark, folder)
    assert not files.exists(path)


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    from trackstrata.session import broadcast_if_small

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    rows = spark.range(100).selectExpr("id", "sha2(string(id), 512) as text")
    assert hinted(broadcast_if_small(rows)) and not hinted(broadcast_if_small(rows, rows=99)) and not hinted(broadcast_if_small(rows, size=10_000))


def test_settings_of_the_session_win(spark):
    from trackstrata.session import get_spark

    before = spark.sparkContext.getConf().get("spark.sql.session.timeZone")
    assert get_spark(**{"spark.sql.test.setting": "x"}).conf.get("spark.sql.session.timeZone") == before
    assert spark.conf.get("spark.sql.test.setting") == "x"
