import numpy as np
import pytest
from pyspark.sql import functions as F

from trackstrata import operators as op
from trackstrata.sources import index_paths, require_columns, require_rows, stratum_number, with_stratum_number


def test_duration_report_in_display_order(spark):
    data = [(d, "pollinator") for d in [0, 0, 1, 10, 11, 100, 101, 500, 501]] + [(5, "non-pollinator")]
    df = spark.createDataFrame(data, "duration_s bigint, order_category string")
    got = [(r.duration_bin, r["count"]) for r in op.duration_report(df).orderBy("bin_ord").collect()]
    assert got == [("0", 2), (">0-10", 2), (">10-100", 2), (">100-500", 2), (">500", 1)]


def test_composition_fills_zeros(spark):
    df = spark.createDataFrame([("Diptera",), ("Araneae",), ("Odonata",), (None,)], "bioclip_order string")
    got = {r.category: r["count"] for r in op.composition(df).collect()}
    assert got == {"Hymenoptera": 0, "Diptera": 1, "Lepidoptera": 0, "Coleoptera": 0, "Other Orders": 3}


def test_histogram_matches_numpy(spark):
    xs = [0.01 * i for i in range(0, 101, 3)] + [1.0, 0.33, 0.33]
    data = [("Diptera", x) for x in xs] + [("Lepidoptera", 0.4)] * 3 + [("Coleoptera", None), ("Araneae", 0.2), ("Hymenoptera", 1.5)]
    df = spark.createDataFrame(data, "bioclip_order string, top1_prob_weighted double")
    got = op.histogram_by(df).collect()
    flies = {r.bin: r["count"] for r in got if r.bioclip_order == "Diptera"}
    counts, edges = np.histogram(xs, bins=20)
    assert sum(flies.values()) == len(xs)
    assert [flies.get(i, 0) for i in range(20)] == list(counts)
    same = [r for r in got if r.bioclip_order == "Lepidoptera"]
    assert len(same) == 1 and same[0].bin == 10 and same[0]["count"] == 3
    assert {r.bioclip_order for r in got} == {"Diptera", "Lepidoptera", "Hymenoptera"}


def test_histogram_scans_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    hist = op.histogram_by(df, "l_returnflag", "l_discount", ("A", "N", "R"))
    hist.collect()
    assert "ReusedExchange" in hist._jdf.queryExecution().executedPlan().toString()


def test_removal_counts_chain(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (None, 1)], "a int, b int")
    got = {r.step: r.removed for r in op.removal_counts(df, [("a", F.col("a") == 1), ("b", F.col("b") == 1)]).collect()}
    assert got == {"a": 2, "b": 1}


def test_attach_best_filters_first(spark):
    det = spark.createDataFrame(
        [("c", "r", "1", 0.2, "a"), ("c", "r", "1", 0.9, "b"), ("c", "r", "2", 0.5, "c")],
        "cam_ID string, rec_ID string, track_ID string, bioclip_score double, crop_path string",
    )
    sample = spark.createDataFrame([("c", "r", "1", 7), ("c", "r", "9", 8), (None, "r", "1", 9)], "cam_ID string, rec_ID string, track_ID string, x int")
    for limit in (100, 0):
        got = op.attach_best(sample, det, broadcast_rows=limit)
        assert {r.x: r.crop_path for r in got.collect()} == {7: "b", 8: None, 9: None}
    plan = op.attach_best(sample, det)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_files(spark):
    index = index_paths(spark.createDataFrame([("x/A.jpg",), ("y/a.JPG",), ("y/b.jpg",), ("z/",)], "path string"))
    assert {r.file_name: r.file_path for r in index.collect()} == {"a.jpg": "y/a.JPG", "b.jpg": "y/b.jpg"}
    sample = spark.createDataFrame([(1, "crops/G/A.JPG"), (2, "crops\\G\\B.jpg"), (3, "none.jpg"), (4, None)], "i int, crop_path string")
    assert {r.i: r.file_path for r in op.resolve_files(sample, index).collect()} == {1: "y/a.JPG", 2: "y/b.jpg", 3: None, 4: None}
    assert sorted(r.i for r in op.missing_files(sample, index).collect()) == [3, 4]


def test_label_columns():
    assert op.label_column(1) == "val1" and op.label_column(5, "Genus") == "val5_genus"
    for bad in [(0,), (9, "genus"), (3,), (3, "class"), (2, "species")]:
        with pytest.raises(ValueError):
            op.label_column(*bad)
    assert op.label_domain(2)[0] == "pollinator" and op.label_domain(7)[0] == "correct"


def test_labels_join_by_key(spark):
    sample = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, x string")
    labels = spark.createDataFrame([(2, "correct", " ok "), (3, "maybe", "")], "k int, label string, comment string")
    done = op.attach_labels(sample, labels, ["k"], column="val3_genus")
    assert {r.k: (r.x, r.val3_genus, r.comment) for r in done.collect()} == {1: ("a", None, None), 2: ("b", "correct", "ok"), 3: ("c", "maybe", "")}
    assert [r.k for r in op.check_domain(done, "val3_genus", op.label_domain(3)).collect()] == [3]


def test_expert_labels(spark):
    sample = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    labels = spark.createDataFrame(
        [(1, None, " Apis ", ""), (2, "dismissed", "", None), (3, "valid", "  ", "")],
        "k int, valid_crop string, expert_id_free string, expert_id_checklist string",
    )
    done = op.attach_expert_labels(sample, labels, ["k"])
    assert {r.k: (r.valid_crop, r.expert_id_free, r.expert_id_checklist) for r in done.collect()} == {
        1: ("valid", "Apis", None), 2: ("dismissed", None, None), 3: ("valid", None, None), 4: ("valid", None, None),
    }
    assert sorted(r.k for r in op.missing_identification(done).collect()) == [3, 4]


def test_checklist(spark):
    listed = spark.createDataFrame([("Eristalis tenax",), ("Syrphus",), ("Syrphus",)], "species string")
    names = spark.createDataFrame([(1, " eristalis  TENAX"), (2, "Apis mellifera"), (3, None)], "i int, name string")
    assert [r.i for r in op.checklist_match(names, listed, "name").collect()] == [1]
    assert sorted(r.i for r in op.checklist_match(names, listed, "name", listed=False).collect()) == [2, 3]
    assert [r.species for r in op.checklist_search(listed, "SYR").collect()] == ["Syrphus"]
    assert op.checklist_search(listed, "").count() == 2 and op.checklist_search(listed, "q").count() == 0


def test_metrics(spark):
    rows = [("a", "correct")] * 3 + [("a", "incorrect"), ("a", "unclear"), ("a", None), ("b", "unclear"), ("c", "odd")]
    df = spark.createDataFrame(rows, "g string, label string")
    got = {r.g: r for r in op.validation_metrics(df, ["g"]).collect()}
    assert (got["a"].n_rows, got["a"].n_reviewed, got["a"].accuracy, got["a"].error_rate) == (6, 5, 0.75, 0.25)
    assert got["b"].accuracy is None and got["b"].error_rate is None and got["c"].n_reviewed == 0
    assert op.validation_metrics(df).first().n_reviewed == 6


def test_predicted_value(spark):
    df = spark.createDataFrame([("S", None)], "bioclip_species string, bioclip_genus string")
    got = df.select(op.predicted_value(df, 1), op.predicted_value(df, 4, "genus"), op.predicted_value(df, 4, "family")).first()
    assert tuple(got) == ("S", "N/A", "N/A")


def test_input_checks(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="b, c"):
        require_columns(df, ["a", "b", "c"])
    assert require_rows(require_columns(df, ["a"])).count() == 1
    with pytest.raises(ValueError):
        require_rows(df.limit(0))


def test_stratum_numbers(spark):
    names = {"strata3_hym_2024.csv": 3, "out/strata8_x/strata8_api_mel.csv": 8, "strata9.csv": None, "strata12_a": None, "sample_all.csv": None, "x_strata1": None}
    assert {n: stratum_number(n) for n in names} == names
    df = with_stratum_number(spark.createDataFrame([(n,) for n in names], "name string"), "name")
    assert {r.name: r.stratum_number for r in df.collect()} == names


def test_two_labels_of_one_key_end_the_job(spark):
    sample = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    labels = spark.createDataFrame([(1, "correct", "\tseen\n"), (None, "a", "b"), (None, "c", "d")], "k int, label string, comment string")
    assert {(r.k, r.val1, r.comment) for r in op.attach_labels(sample, labels, ["k"]).collect()} == {(1, "correct", "seen"), (2, None, None), (None, None, None)}
    twice = labels.union(spark.createDataFrame([(1, "incorrect", "")], labels.schema))
    with pytest.raises(Exception, match="several labels for one key: 1"):
        op.attach_labels(sample, twice, ["k"]).collect()
    expert = spark.createDataFrame([(1, "valid", "\n", "x"), (1, "valid", "y", "x")], "k int, valid_crop string, expert_id_free string, expert_id_checklist string")
    with pytest.raises(Exception, match="several labels"):
        op.attach_expert_labels(sample, expert, ["k"]).collect()
    assert op.attach_expert_labels(sample, expert.limit(1), ["k"]).where("k = 1").first().expert_id_free is None
