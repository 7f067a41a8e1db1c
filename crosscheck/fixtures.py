"""Views that give the driver's tables the shape of detections, sessions, tracks and review tables.

Each view is a list of SQL expressions that reads the same in Spark and in DuckDB, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackstrata.sources import read_table

K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

DETECTIONS = {
    "cam_ID": "concat('cam', cast(user_id % 10 as string))",
    "rec_ID": "cast(cast(ts as date) as string)",
    "track_ID": "user_id",
    "timestamp": "ts",
    "confidence": "cast(30 + event_id % 71 as double) / 100",
    "x_min": "cast(event_id % 40 as double) / 100",
    "x_max": "cast(event_id % 40 as double) / 100 + cast(1 + event_id % 17 as double) / 50",
    "y_min": "cast(event_id % 30 as double) / 100",
    "y_max": "cast(event_id % 30 as double) / 100 + cast(1 + event_id % 13 as double) / 50",
    "bioclip_species": f"case when {K} % 10 = 0 then null else concat('Gen', cast({K} % 30 as string), ' sp', cast({K} % 7 as string)) end",
    "bioclip_genus": f"case when {K} % 50 = 0 then null else concat('Gen', cast({K} % 30 as string)) end",
    "bioclip_family": f"case when event_type = 'view' and {K} % 3 = 0 then 'Syrphidae' else concat('Fam', cast({K} % 12 as string)) end",
    "bioclip_order": "case event_type when 'click' then 'Hymenoptera' when 'view' then 'Diptera' when 'purchase' then 'Lepidoptera' when 'signup' then 'Coleoptera' else 'Araneae' end",
    "bioclip_score": "least(value / 100, cast(1 as double))",
    "crop_path": "concat('crops/', event_type, '/', cast(event_id as string), '.JPG')",
}

PLANT = {"plant_species": f"case when {K} % 11 = 0 then null else concat('plant', cast({K} % 7 as string)) end"}

SESSIONS = {
    "cam_ID": "concat('cam', cast(user_id % 10 as string))",
    "start": "ts",
    "setting": f"concat('plant', cast({K} % 7 as string))",
    "filename": "concat(cast(event_id as string), '.json')",
}

# one line item is one track; the key of four columns and the date identifies it
WIDE = {
    "cam_ID": "concat('cam', cast(l_suppkey % 10 as string))",
    "rec_ID": "cast(cast(l_shipdate as date) as string)",
    "track_ID": "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), cast(l_suppkey as string))",
    "top1_prob_weighted": "floor(l_discount * 1000 + 0.5) / 100",
    "det_conf_mean": "floor(l_tax * 1000 + 0.5) / 100",
    "duration_s": "cast(l_quantity as bigint)",
    "bioclip_species": "p_name",
    "bioclip_genus": "p_brand",
    "bioclip_order": "p_type",
}
WIDE_ORDERS = ("ECONOMY", "MEDIUM", "PROMO", "SMALL")

REVIEWED = {
    "doc_id": "doc_id",
    "lang": "lang",
    "source": "source",
    "label": "case when quality is null then null when toxic = 1 then 'unclear' when quality = 1 then 'correct' else 'incorrect' end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} as {name}" for name, text in columns.items()])


def detections(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    return _view(table(spark, sf_dir, "events"), {**DETECTIONS, **(PLANT if plant else {})})


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(table(spark, sf_dir, "events").where("event_type = 'signup'"), SESSIONS)


def wide_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return _view(items.join(parts, items.l_partkey == parts.p_partkey), WIDE)


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _view(documents.join(labels, "doc_id", "left"), REVIEWED)


def _sql(columns: dict[str, str], source: str) -> str:
    return "select " + ", ".join(f"{text} as {name}" for name, text in columns.items()) + f" from {source}"


DETECTIONS_SQL = _sql({**DETECTIONS, **PLANT}, "events")
SESSIONS_SQL = _sql(SESSIONS, "events where event_type = 'signup'")
WIDE_SQL = _sql(WIDE, "lineitem join part on l_partkey = p_partkey")
REVIEWED_SQL = _sql(
    {k: ("documents.doc_id" if k == "doc_id" else v) for k, v in REVIEWED.items()},
    "documents left join labels on documents.doc_id = labels.doc_id",
)
