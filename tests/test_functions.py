import math

import pytest
from pyspark.sql import functions as F

from trackstrata import functions as fn


def values(spark, xs, kind="double"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression.alias("y")).collect()]


def test_rounding_is_half_up_on_the_stated_formula(spark):
    xs = [0.125, 0.285, 0.505, 1.005, 0.0, None]
    expected = [math.floor(x * 100 + 0.5) / 100 if x is not None else None for x in xs]
    assert column(values(spark, xs), fn.round_half_up("x", 2)) == expected


def test_mean_is_exact_and_independent_of_order(spark):
    xs = [0.1, 0.2, 0.3, 1e6 + 0.7, None, float("nan"), 0.05]
    present = [x for x in xs if x is not None and not math.isnan(x)]
    for parts in (1, 2, 5):
        got = values(spark, xs).repartition(parts).agg(fn.exact_mean("x"), fn.exact_sum("x")).first()
        assert got[0] == pytest.approx(sum(present) / len(present), abs=1e-10)
        assert got[1] == pytest.approx(sum(present), abs=1e-9)
    means = {
        values(spark, xs * 7).orderBy(F.rand(s)).agg(fn.exact_mean("x")).first()[0] for s in range(4)
    }
    assert len(means) == 1


def test_decimal_ties_stay_ties(spark):
    got = values(spark, [0.57, 1.0]).agg(fn.exact_sum("x"), fn.round_half_up(fn.exact_mean("x"), 2)).first()
    assert tuple(got) == (1.57, 0.79)
    big = values(spark, [123456.57, 0.01, -7.25]).agg(fn.exact_sum("x")).first()[0]
    assert big == 123449.33


def test_mean_of_nothing_is_null(spark):
    assert values(spark, [None, None]).agg(fn.exact_mean("x")).first()[0] is None


def test_mean_of_negative_numbers(spark):
    assert values(spark, [-0.25, -1.5, 0.5]).agg(fn.exact_mean("x")).first()[0] == pytest.approx(-1.25 / 3)


def test_clip_keeps_null(spark):
    assert column(values(spark, [-1.0, 0.5, 2.0, None]), fn.clip("x", 0.0, 1.0)) == [0.0, 0.5, 1.0, None]


def test_deciles_with_binary_and_exact_edges(spark):
    xs = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, None]
    binary = column(values(spark, xs), fn.decile_bin("x"))
    assert binary[3] == "0.2-0.3" and binary[6] == "0.5-0.6" and binary[7] == "0.6-0.7"
    assert binary[0] == "0.0-0.1" and binary[9] == "0.9-1.0"
    assert binary[10:] == ["1.0-1.0", "1.0-1.0"]
    exact = column(values(spark, xs), fn.decile_bin("x", exact_edges=True))
    assert exact[:10] == fn.decile_labels() and exact[10] == "0.9-1.0" and exact[11] == "1.0-1.0"


def test_cut_labels(spark):
    label = fn.cut_labels("x", [(500, "multiple_crop")], "long_crop", "unknown", "single_crop")
    got = column(values(spark, [0.0, 0.5, 500.0, 501.0, -1.0, None]), label)
    assert got == ["single_crop", "multiple_crop", "multiple_crop", "long_crop", "unknown", "unknown"]


def test_null_labels(spark):
    df = values(spark, ["a", "b", None], "string")
    assert column(df, fn.membership_label("x", ["a"], "in", "out")) == ["in", "out", "out"]
    df = values(spark, [0.5, 0.51, None])
    assert column(df, fn.prob_class("x")) == ["low_prob", "high_prob", "high_prob"]
    assert column(df, fn.median_half("x", F.lit(0.51))) == ["low_prob", "high_prob", "high_prob"]


@pytest.mark.parametrize(
    "spec, kept",
    [(">0.5", [0.6]), (">= 0.5", [0.5, 0.6]), ('"<0.5"', [0.4]), ("'<=0.5'", [0.4, 0.5]), ("==0.5", [0.5]), ("!=0.5", [0.4, 0.6])],
)
def test_thresholds(spark, spec, kept):
    df = values(spark, [0.4, 0.5, 0.6, None])
    assert [r.x for r in df.where(fn.threshold("x", spec)).orderBy("x").collect()] == kept


@pytest.mark.parametrize("spec", ["", "0.5", ">-1", "=>1", "> 1e3", "=0.5", ">.5", "x"])
def test_bad_thresholds_raise(spec):
    with pytest.raises(ValueError):
        fn.threshold("x", spec)


def test_bare_numbers_in_range_slots(spark):
    df = values(spark, [0.3, 0.5, 0.9, None])
    assert [r.x for r in df.where(fn.in_range("x", 0.5, "0.9")).orderBy("x").collect()] == [0.5, 0.9]
    assert df.where(fn.in_range("x")).count() == 4


def test_names(spark):
    df = values(spark, ["Apis mellifera", "Apis", "  Bombus   terrestris audax", "Eo x"], "string")
    assert column(df, fn.name_slug("x")) == ["api_mel", "api", "bom_ter", "eo_x"]
    df = values(spark, ["a/b/C.JPG", "a\\b\\D.jpg", "e.png", "dir/"], "string")
    assert column(df, fn.basename("x")) == ["c.jpg", "d.jpg", "e.png", ""]
    df = values(spark, ["  a ", "   ", "", None], "string")
    assert column(df, fn.empty_to_null("x")) == ["a", None, None, None]


def test_json_truthiness(spark):
    docs = [
        '{"device": {"id": 0}, "ssid": " net "}',
        '{"device": {"id": "0"}, "ssid": "net"}',
        '{"device": {"id": false}, "ssid": ""}',
        '{"device": null, "ssid": [], "camera": {"id": 12}}',
        '{"device": {"id": "x"',
        "[1, 2]",
        None,
    ]
    first = fn.json_first("x", ["device.id", "ssid", "camera.id"], "unknown")
    got = column(values(spark, docs, "string"), first)
    assert got == ["net", "0", "unknown", "12", "unknown", "unknown", "unknown"]


def test_whole_seconds_truncates(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-03-31 01:59:59.1' a, timestamp_ntz'2024-03-31 03:00:00' b, 0 i"
    )
    assert column(df, fn.whole_seconds("a", "b")) == [3600]
    assert column(df, fn.whole_seconds("a", F.col("a") + F.expr("interval 0.95 seconds"))) == [0]


def test_strip_removes_tabs_and_line_breaks(spark):
    from trackstrata.functions.jsonfields import json_truthy
    from trackstrata.functions.text import empty_to_null, normal_name

    rows = spark.createDataFrame([("\tApis  mellifera\n", '{"k": "\\t cam1 \\n"}'), ("\n", '{"k": 0}')], "name string, j string")
    got = rows.select(normal_name("name"), empty_to_null("name"), json_truthy("j", "k")).collect()
    assert [tuple(r) for r in got] == [("apis mellifera", "Apis  mellifera", "cam1"), ("", None, None)]
