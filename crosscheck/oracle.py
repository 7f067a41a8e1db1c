"""The SQL twin of every query, for DuckDB."""

from __future__ import annotations

from trackstrata.model import CONFIG_NUMBERS

from .fixtures import DETECTIONS_SQL, REVIEWED_SQL, SESSIONS_SQL, WIDE_ORDERS, WIDE_SQL
from .stored import STARTS

K = "cam_ID, rec_ID, track_ID"
POLL = "('Hymenoptera', 'Diptera', 'Lepidoptera', 'Coleoptera')"
WIDE_POLL = "(" + ", ".join(f"'{o}'" for o in WIDE_ORDERS) + ")"
RANKS = "bioclip_species, bioclip_genus, bioclip_family, bioclip_order"
SEED = 123


def _round(x: str, digits: int) -> str:
    scale = 10**digits
    return f"floor(({x}) * {scale}::double + 0.5::double) / {scale}::double"


def _mean(x: str) -> str:
    return f"(cast(sum(cast({x} as decimal(28,12))) as double) / count({x}))"


def _md5(salt: str, keys: str = K) -> str:
    return f"md5(concat_ws('|', '{SEED}', '{salt}', {keys}))"


def _with(*ctes: tuple[str, str]) -> str:
    return "with " + ", ".join(f"{name} as ({body})" for name, body in ctes) + " "


def _boxes(width: str = "1.0::double", height: str = "1.0::double") -> str:
    x, y = _round(f"(x_max - x_min) * {width}", 4), _round(f"(y_max - y_min) * {height}", 4)
    return (
        f"select *, coalesce(bioclip_species, bioclip_genus, bioclip_family, bioclip_order) as top1, "
        f"bioclip_score as top1_prob, {x} as bbox_size_x, {y} as bbox_size_y, "
        f"greatest({x}, {y}) as bbox_length, least({x}, {y}) as bbox_width from det"
    )


def _tracks(det: str = DETECTIONS_SQL, where: str = "true") -> list[tuple[str, str]]:
    tax_order = ", ".join(f"{r} nulls first" for r in RANKS.split(", "))
    return [
        ("det", det),
        ("boxed", _boxes() + f" where {where}"),
        (
            "stats",
            f"select {K}, count(*) as track_ID_imgs, min(timestamp) as start_time, max(timestamp) as end_time, "
            f"datesub('second', min(timestamp), max(timestamp)) as duration_s, "
            f"{_round(_mean('confidence'), 2)} as det_conf_mean, "
            f"{_round(_mean('bbox_length'), 3)} as bbox_length_mean, "
            f"{_round(_mean('bbox_width'), 3)} as bbox_width_mean from boxed group by {K}",
        ),
        (
            "counted",
            f"select {K}, top1, count(*) as top1_imgs, {_round(_mean('top1_prob'), 2)} as top1_prob_mean "
            f"from boxed group by {K}, top1",
        ),
        (
            "plants",
            f"select {K}, plant_species from boxed qualify row_number() over "
            f"(partition by {K} order by timestamp, plant_species nulls first) = 1",
        ),
        (
            "taxa",
            f"select {K}, top1, {RANKS} from boxed qualify row_number() over "
            f"(partition by {K}, top1 order by timestamp, {tax_order}) = 1",
        ),
        (
            "votes",
            f"select {K}, track_ID_imgs, top1_imgs, top1, top1_prob_mean, "
            f"{_round('top1_prob_mean * (top1_imgs::double / track_ID_imgs::double)', 2)} as top1_prob_weighted, "
            f"plant_species, {RANKS}, case when bioclip_order in {POLL} then 'pollinator' else 'non-pollinator' end "
            f"as order_category from counted join stats using ({K}) join plants using ({K}) join taxa using ({K}, top1)",
        ),
        (
            "tracks",
            f"select v.*, s.start_time, s.end_time, s.duration_s, s.det_conf_mean, s.bbox_length_mean, "
            f"s.bbox_width_mean from (select * from votes qualify row_number() over (partition by {K} order by "
            f"top1_prob_weighted desc nulls last, top1_prob_mean desc nulls last, top1 nulls first) = 1) v "
            f"join stats s using ({K})",
        ),
    ]


DET = _with(("det", DETECTIONS_SQL))
BOXED = _with(("det", DETECTIONS_SQL), ("boxed", _boxes()))
TRACKS = _tracks()
WIDE = ("tracks", WIDE_SQL)

ORACLE: dict[str, str] = {
    "track_stats": _with(*TRACKS) + "select * from stats",
    "track_votes": _with(*TRACKS) + "select * from votes",
    "track_top1": _with(*TRACKS) + "select * from tracks",
    "track_top1_filtered": _with(*_tracks(where="confidence >= 0.4::double and confidence < 0.95::double"))
    + "select * from tracks where duration_s > 0 and duration_s <= 80000 "
    "and top1_prob_weighted >= 0.1::double and top1_prob_weighted <= 0.9::double",
    "track_top1_plain": _with(("det", DETECTIONS_SQL), ("boxed", _boxes()))
    + f", n as (select {K}, bioclip_order as top1, count(*) as top1_imgs, {_round(_mean('top1_prob'), 2)} as top1_prob_mean "
    f"from boxed group by {K}, bioclip_order), s as (select {K}, count(*) as track_ID_imgs, min(timestamp) as start_time, "
    "max(timestamp) as end_time, datesub('second', min(timestamp), max(timestamp)) as duration_s, "
    f"{_round(_mean('confidence'), 2)} as det_conf_mean, {_round(_mean('bbox_length'), 3)} as bbox_length_mean, "
    f"{_round(_mean('bbox_width'), 3)} as bbox_width_mean from boxed group by {K}), "
    f"w as (select *, {_round('top1_prob_mean * (top1_imgs::double / track_ID_imgs::double)', 2)} as top1_prob_weighted, "
    f"'non-pollinator' as order_category from n join s using ({K})) select * from w qualify row_number() over "
    f"(partition by {K} order by top1_prob_weighted desc, top1_prob_mean desc, top1) = 1",
    "top1_coalesce": BOXED + "select crop_path, top1, top1_prob from boxed",
    "bbox_metrics": _with(("det", DETECTIONS_SQL), ("boxed", _boxes("12.5::double", "8.0::double")))
    + "select crop_path, bbox_size_x, bbox_size_y, bbox_length, bbox_width from boxed",
    "threshold_ops": DET
    + " union all ".join(
        f"select '{spec}' as spec, count(*) as n from det where confidence {test}::double"
        for spec, test in [
            (">0.5", "> 0.5"), (">=0.5", ">= 0.5"), ("<0.5", "< 0.5"), ("<= 0.5", "<= 0.5"), ("''==0.7''", "= 0.7"), ("!=0.7", "<> 0.7"),
        ]
    ),
    "removal_counts": _with(*_tracks(where="confidence >= 0.4::double and confidence < 0.95::double"))
    + "select 'invalid_timestamps' as step, count(*) as removed from det where timestamp is null "
    "union all select 'detections_removed', count(*) from det where not (confidence >= 0.4::double and confidence < 0.95::double) "
    "union all select 'detections_without_track', count(*) from det where cam_ID is null or rec_ID is null or track_ID is null "
    "union all select 'tracks_removed', count(*) from tracks where not (duration_s > 0 and duration_s <= 80000) "
    "union all select 'classifications_removed', count(*) from tracks where duration_s > 0 and duration_s <= 80000 "
    "and not (top1_prob_weighted >= 0.1::double and top1_prob_weighted <= 0.9::double)",
    "parsed_timestamps": "select event_id, ts as timestamp from events where event_type <> 'error'",
    "first_plant_per_track": _with(*TRACKS) + "select * from plants",
    "taxonomy_per_vote": _with(*TRACKS) + "select * from taxa",
    "best_detection_per_track": DET
    + f"select {K}, crop_path, bioclip_score, confidence from det qualify row_number() over "
    f"(partition by {K} order by coalesce(bioclip_score, -1) desc, crop_path) = 1",
}

# --- sessions -------------------------------------------------------------------------------------

_UNIQUE = (
    "unique_sessions",
    "select cam_ID, start, setting from sessions qualify row_number() over "
    "(partition by cam_ID, start order by filename, setting) = 1",
)
_SESSIONS = [("det", DETECTIONS_SQL), ("sessions", SESSIONS_SQL), _UNIQUE]
_ASOF = _with(*_SESSIONS) + (
    "select det.crop_path, det.cam_ID, det.timestamp, s.setting from det asof left join unique_sessions s "
    "on det.cam_ID = s.cam_ID and det.timestamp >= s.start"
)
_PLANTED = (
    "select d.* exclude (plant_species), s.setting as plant_species from raw d asof left join unique_sessions s "
    "on d.cam_ID = s.cam_ID and d.timestamp >= s.start"
)
ORACLE |= {
    "session_intervals": _with(*_SESSIONS)
    + "select cam_ID, start, setting, lead(start) over (partition by cam_ID order by start) as next_start from unique_sessions",
    "session_join": _ASOF,
    "session_join_sliced": _ASOF,
    "session_join_union": _ASOF,
    "session_join_salted": _ASOF,
    "session_join_shuffled": _ASOF,
    "session_join_broadcast": _ASOF,
    "merged_tracks": _with(("raw", DETECTIONS_SQL), ("sessions", SESSIONS_SQL), _UNIQUE, *_tracks(_PLANTED))
    + "select * from tracks",
}

# --- reports --------------------------------------------------------------------------------------

_CLASS = (
    "case when duration_s = 0 then 'single_crop' when duration_s > 0 and duration_s <= 500 then 'multiple_crop' "
    "when duration_s > 500 then 'long_crop' else 'unknown' end"
)


def _decile(x: str, edge: str, last: str = "<") -> str:
    tests = " ".join(
        f"when {x} {last if i == 10 else '<'} {edge.format(i=i)} then '{(i - 1) / 10:.1f}-{i / 10:.1f}'"
        for i in range(1, 11)
    )
    return f"case {tests} else '1.0-1.0' end"


_DECILE = _decile("top1_prob_weighted", "{i} * 0.1::double")
_EXACT = _decile("top1_prob_weighted", "{i}::double / 10::double", "<=")


def _histogram(column: str) -> str:
    return (
        f"with tracks as ({WIDE_SQL}), v as (select bioclip_order, least(greatest({column}, 0::double), 1::double) as x "
        f"from tracks where bioclip_order in {WIDE_POLL} and {column} is not null), "
        "b as (select bioclip_order, case when min(x) = max(x) then min(x) - 0.5::double else min(x) end as lo, "
        "case when min(x) = max(x) then max(x) + 0.5::double else max(x) end as hi from v group by bioclip_order), "
        "p as (select bioclip_order, cast(least(len(list_filter(range(1, 21), lambda i: x >= i * ((hi - lo) / 20) + lo)), 19) "
        "as integer) as bin, lo, hi from v join b using (bioclip_order)) "
        "select bioclip_order, bin, bin * ((hi - lo) / 20) + lo as bin_from, (bin + 1) * ((hi - lo) / 20) + lo as bin_to, "
        "count(*) as count from p group by bioclip_order, bin, lo, hi"
    )


ORACLE |= {
    "order_category": _with(*TRACKS) + "select order_category, bioclip_order, count(*) as count from tracks group by all",
    "duration_bins": _with(*TRACKS)
    + ", d as (select case when duration_s = 0 then 1 when duration_s <= 10 then 2 when duration_s <= 100 then 3 "
    "when duration_s <= 500 then 4 else 5 end as bin_ord from tracks where order_category = 'pollinator') "
    "select case bin_ord when 1 then '0' when 2 then '>0-10' when 3 then '>10-100' when 4 then '>100-500' else '>500' end "
    "as duration_bin, cast(count(*) as bigint) as count, cast(bin_ord as integer) as bin_ord from d group by bin_ord",
    "duration_classes": _with(*TRACKS) + f"select {_CLASS} as strata2, count(*) as count from tracks group by 1",
    "prob_deciles": _with(WIDE) + f"select {_DECILE} as prob_bin, {_EXACT} as exact_bin, count(*) as count from tracks group by 1, 2",
    "stratum_labels": _with(*TRACKS)
    + f"select case when bioclip_order in {POLL} then 'pollinator' else 'non_pollinator' end as strata1, "
    "case when top1_prob_weighted <= 0.5 then 'low_prob' else 'high_prob' end as prob_strata1, count(*) as count "
    "from tracks group by 1, 2",
    "composition": _with(*TRACKS)
    + ", domain(category, category_ord) as (values ('Hymenoptera', 1), ('Diptera', 2), ('Lepidoptera', 3), ('Coleoptera', 4), ('Other Orders', 5)), "
    f"n as (select case when bioclip_order in {POLL} then bioclip_order else 'Other Orders' end as category, count(*) as c from tracks group by 1) "
    "select category, category_ord, coalesce(c, 0) as count from domain left join n using (category)",
    "composition_wide": _with(WIDE)
    + ", domain(category, category_ord) as (values ('ECONOMY', 1), ('MEDIUM', 2), ('PROMO', 3), ('SMALL', 4), ('ABSENT', 5), ('Other Orders', 6)), "
    f"n as (select case when bioclip_order in {WIDE_POLL} then bioclip_order else 'Other Orders' end as category, count(*) as c from tracks group by 1) "
    "select category, category_ord, coalesce(c, 0) as count from domain left join n using (category)",
    "hist_probability": _histogram("top1_prob_weighted"),
    "hist_confidence": _histogram("det_conf_mean"),
    "clipped_values": "select event_id, greatest(0.2::double, least(0.8::double, value / 100)) as clipped from events",
    "group_median": _with(WIDE)
    + "select bioclip_order, bioclip_genus, median(top1_prob_weighted) as median from tracks group by 1, 2",
    "group_median_refined": "select l_returnflag, median(l_extendedprice) as median from lineitem group by 1",
    "median_split_by_group": _with(WIDE, ("m", "select bioclip_genus, median(top1_prob_weighted) as median from tracks group by 1"))
    + f"select {K}, bioclip_genus, top1_prob_weighted, median, "
    "case when top1_prob_weighted < median then 'low_prob' else 'high_prob' end as prob_cat from tracks join m using (bioclip_genus)",
    "top_species": _with(WIDE)
    + "select bioclip_species, count(*) as count from tracks where bioclip_species is not null group by 1 "
    "order by count(*) desc, bioclip_species limit 25",
    "species_slug": "select p_partkey, lower(concat(substr(split_part(p_name, ' ', 1), 1, 3), '_', substr(split_part(p_name, ' ', 2), 1, 3))) as slug from part",
}

# --- samples --------------------------------------------------------------------------------------


def _labelled(orders: str) -> str:
    return (
        f"select *, case when bioclip_order in {orders} then 'pollinator' else 'non_pollinator' end as strata1, "
        "case when top1_prob_weighted <= 0.5 then 'low_prob' else 'high_prob' end as prob_strata1 from tracks"
    )


def _draw(source: str, strata: str, n: int, salt: str, keys: str = K) -> str:
    return (
        f"select * from {source} qualify row_number() over (partition by {strata} order by {_md5(salt, keys)}) <= {n}"
    )


_SLUG = "lower(concat(substr(split_part(bioclip_species, ' ', 1), 1, 3), '_', substr(split_part(bioclip_species, ' ', 2), 1, 3))) as slug"


def _family(number: int, n: int, orders: str = POLL) -> list[tuple[str, str]]:
    """CTEs of one sample family; the last is the sample itself."""
    name = f"strata{number}"
    base = (f"{name}_in", _labelled(orders))
    if number == 1:
        return [base, (name, _draw(base[0], "strata1, prob_strata1", n // 2, name))]
    only = f"{name}_in where bioclip_order in {orders}"
    if number == 2:
        classed = (f"{name}_c", f"select * from (select *, {_CLASS} as strata2 from {only}) where strata2 <> 'unknown'")
        return [base, classed, (name, _draw(classed[0], "strata2, prob_strata1", n // 2, name))]
    if number == 3:
        binned = (f"{name}_b", f"select * from (select *, {_DECILE} as prob_bin from {only}) where prob_bin <> '1.0-1.0'")
        return [base, binned, (name, _draw(binned[0], "bioclip_order, prob_bin", n, name))]
    group = {
        4: "plant_species",
        5: "bioclip_order, bioclip_genus",
        6: "bioclip_order, bioclip_family",
        7: "bioclip_order",
        8: "bioclip_species",
    }[number]
    present = " and ".join(f"{g} is not null" for g in group.split(", "))
    extra = ""
    if number == 8:
        present += (
            f" and bioclip_species in (select bioclip_species from {only} and duration_s > 0 "
            "and bioclip_species is not null group by 1 order by count(*) desc, 1 limit 25)"
        )
        extra = f", {_SLUG}"
    active = (f"{name}_a", f"select *, {_DECILE} as prob_bin from {only} and duration_s > 0 and {present}")
    medians = (f"{name}_m", f"select {group}, median(top1_prob_weighted) as s{number}_median from {active[0]} group by {group}")
    split = (
        f"{name}_s",
        f"select *, case when top1_prob_weighted < s{number}_median then 'low_prob' else 'high_prob' end as s{number}_prob_cat"
        f"{extra} from {active[0]} join {medians[0]} using ({group})",
    )
    size = n // 2 if number == 4 else n
    return [base, active, medians, split, (name, _draw(split[0], f"{group}, s{number}_prob_cat", size, name))]


_SIZES = {1: 500, 2: 500, 3: 20, 4: 100, 5: 4, 6: 6, 7: 200, 8: 10}
for _number, _n in _SIZES.items():
    ORACLE[f"strata{_number}"] = _with(*TRACKS, *_family(_number, _n)) + f"select * from strata{_number}"
for _number, _n in {3: 100, 5: 10, 7: 500, 8: 100}.items():
    ORACLE[f"strata{_number}_wide"] = _with(WIDE, *_family(_number, _n, WIDE_POLL)) + f"select * from strata{_number}"

_BEST = (
    "best",
    f"select {K}, crop_path from det qualify row_number() over "
    f"(partition by {K} order by coalesce(bioclip_score, -1) desc, crop_path) = 1",
)
_SHORT = "case bioclip_order when 'Hymenoptera' then 'hym' when 'Lepidoptera' then 'lep' when 'Coleoptera' then 'col' when 'Diptera' then 'dip' end"
_STORED = {1: "'all'", 2: "'all'", 3: _SHORT, 4: "'all'", 5: _SHORT, 6: _SHORT, 7: _SHORT, 8: "bioclip_species"}
_GENUS = (
    "genus",
    "select *, bioclip_genus as sampled_genus from tracks where bioclip_family = 'Syrphidae' and bioclip_genus is not null "
    f"and top1_prob_weighted > 0.5 qualify row_number() over (partition by bioclip_genus order by {_md5('strata_genus')}) <= 5",
)
ORACLE |= {
    "sample_all": _with(*TRACKS) + f"select * from tracks where det_conf_mean > 0.5 order by {_md5('sample_all')} limit 100",
    "sample_all_wide": _with(WIDE) + f"select * from tracks where det_conf_mean > 0.5 order by {_md5('sample_all')} limit 500",
    "sample_large": _with(WIDE) + _draw("tracks", "bioclip_order", 2500, "large"),
    "sample_n_large": _with(WIDE) + f"select * from tracks order by {_md5('large')} limit 20000",
    "strata_thresholds": _with(*TRACKS, ("t", "select unnest([0.2::double, 0.5::double, 0.55::double]) as threshold"), ("p", "select tracks.*, threshold from tracks join t on top1_prob_weighted > threshold where bioclip_family = 'Syrphidae'"))
    + _draw("p", "threshold", 30, "strata_thresholds"),
    "strata_genus": _with(*TRACKS, _GENUS) + "select * from genus",
    "sample_chunks": _with(*TRACKS, _GENUS)
    + f"select *, cast((row_number() over (order by {_md5('chunk')}) - 1) // 10 + 1 as bigint) as part from genus",
    "chunk_wide": _with(WIDE, ("r", f"select {K}, row_number() over (order by {_md5('chunk')}) as position from tracks"))
    + f"select {K}, position, cast((position - 1) // 100 + 1 as bigint) as part from r",
    "sample_families": _with(*TRACKS, _BEST, *[c for number, n in _SIZES.items() for c in _family(number, n)])
    + " union all ".join(
        f"select 'strata{number}' as family, {stored} as stratum, {K}, crop_path from strata{number} left join best using ({K})"
        for number, stored in _STORED.items()
    ),
    "attach_crop_path": _with(*TRACKS, _BEST, *_family(1, 500))
    + f"select {K}, strata1, prob_strata1, crop_path from strata1 left join best using ({K})",
}

# --- review ---------------------------------------------------------------------------------------

_NAME = "lower(regexp_extract({0}, '[^/\\\\]+$'))"
_INDEX = (
    "select {name} as file_name, max(url) as file_path from pages where {name} <> '' {only} group by 1"
)
_HTTPS = _INDEX.format(name=_NAME.format("url"), only="and starts_with(url, 'https')")
_EXPERT = (
    "select d.doc_id, d.lang, case when l.toxic = 1 then 'dismissed' else 'valid' end as valid_crop, "
    "case when l.quality = 1 then 'Apis sp.' end as expert_id_free, cast(null as varchar) as expert_id_checklist "
    "from documents d left join labels l using (doc_id)"
)
_CONFIGS = (
    "select concat(event_id, '.json') as filename, date_trunc('second', ts) as start, "
    "case when event_type <> 'view' then concat('cam', user_id) when event_id = 0 then 'unknown' else cast(event_id as varchar) end as cam_ID, "
    "case when event_type = 'error' then 'unknown' else event_type end as deployment_setting, "
    "cast(user_id as double) as location_latitude, true as parse_ok, "
    "concat_ws(',', case when event_type = 'view' and event_id = 0 then 'cam_ID' end, case when event_type = 'error' then 'deployment_setting' end) as missing from events"
)
_LISTED = "(select p_name from part where p_type = 'ECONOMY' and p_size < 10)"
_METRICS = (
    "count(*) as n_rows, count(label) as n_reviewed, count(*) filter (label = 'correct') as n_correct, "
    "count(*) filter (label = 'incorrect') as n_incorrect, count(*) filter (label = 'unclear') as n_unclear, "
    "count(*) filter (label = 'correct')::double / nullif(count(*) filter (label in ('correct', 'incorrect')), 0) as accuracy, "
    "1.0::double - count(*) filter (label = 'correct')::double / nullif(count(*) filter (label in ('correct', 'incorrect')), 0) as error_rate"
)
ORACLE |= {
    "file_index": _INDEX.format(name=_NAME.format("url"), only=""),
    "resolve_files": f"with i as ({_HTTPS}) select page_id, upper(url) as crop_path, file_path from pages left join i on {_NAME.format('pages.url')} = file_name",
    "missing_files": f"with i as ({_HTTPS}) select page_id, upper(url) as crop_path from pages where {_NAME.format('url')} not in (select file_name from i)",
    "stratum_number": "select p_partkey, concat('out/strata', p_size, '_', p_type, '.csv') as name, case when p_size between 1 and 8 then p_size end as stratum_number from part",
    "json_first": "select event_id, case when event_type <> 'view' and user_id <> 0 then cast(user_id as varchar) when (props::json ->> '$.k') = '0' then 'unknown' else props::json ->> '$.k' end as found from events",
    "json_fields": "select event_id, cast(props::json ->> '$.k' as double) as k, cast(null as double) as nothing from events",
    "parsed_configs": _CONFIGS,
    "config_quality": f"select filename, parse_ok, missing from ({_CONFIGS}) where missing <> ''",
    "attach_labels": f"with r as ({REVIEWED_SQL}) select d.doc_id, d.lang, d.n_chars, r.label as val3_species, "
    "case when r.label is not null then concat('seen in ', d.source) end as comment from documents d join r using (doc_id)",
    "label_domain_check": f"with r as ({REVIEWED_SQL}), s as (select * replace (case when lang = 'de' then upper(label) else label end as label) from r) "
    "select * from s where label is not null and label not in ('correct', 'incorrect', 'unclear')",
    "predicted_value": DET + "select crop_path, coalesce(bioclip_species, 'N/A') as judged_species, coalesce(bioclip_genus, 'N/A') as judged_genus, coalesce(bioclip_order, 'N/A') as judged_order from det",
    "expert_defaults": _EXPERT,
    "missing_identification": f"select * from ({_EXPERT}) where valid_crop = 'valid' and expert_id_free is null and expert_id_checklist is null",
    "checklist_match": f"select p_partkey, p_name from part where p_name in {_LISTED}",
    "checklist_unmatched": f"select p_partkey, p_name from part where p_name not in {_LISTED}",
    "checklist_search": "select distinct p_name as species from part where p_name ilike '%red%'",
    "validation_metrics": f"with r as ({REVIEWED_SQL}) select {_METRICS} from r",
    "validation_metrics_by_group": f"with r as ({REVIEWED_SQL}) select lang, source, {_METRICS} from r group by lang, source",
}

# --- files ----------------------------------------------------------------------------------------

_RANKS_OF = "bioclip_species, bioclip_genus, bioclip_family, bioclip_order, 'Insecta' as bioclip_class"
_TEXT = (
    "select cam_ID, rec_ID, cast(track_ID as varchar) as track_ID, {time} as timestamp, confidence, x_min, y_min, x_max, y_max, "
    f"{_RANKS_OF}, bioclip_score, crop_path{{more}} from det"
)
_TIME = "strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')"
_BROKEN = f"case when contains(crop_path, '/error/') then 'not a time' else {_TIME} end"
_KIND = "split_part(crop_path, '/', 2)"
_STARTS = ("starts", STARTS)
_MERGED = _with(("det", DETECTIONS_SQL), _STARTS, ("parsed", "select *, case when not contains(crop_path, '/error/') then timestamp end as at from det"), ("merged", _TEXT.format(time=_BROKEN, more=", s.setting as plant_species").replace("cam_ID, rec_ID", "det.cam_ID, rec_ID").replace("from det", "from parsed det asof left join starts s on det.cam_ID = s.cam_ID and det.at >= s.start")))
ORACLE |= {
    "process_once_votes": _with(*_tracks(where="confidence >= 0.4::double and confidence < 0.95::double")) + "select * from votes",
    "process_once_tracks": ORACLE["track_top1_filtered"],
    "process_once_removed": ORACLE["removal_counts"],
    "sorted_tracks": _with(*TRACKS) + f"select {K}, row_number() over (order by cam_ID, rec_ID, track_ID) as position from tracks",
    "strict_timestamps": "select event_id, ts as timestamp from events",
    "median_money": "select l_returnflag, median(case when l_orderkey % 1000 = 0 then l_extendedprice * 1e9::double else l_extendedprice end) as median from lineitem group by 1",
    "median_split_money": "with p as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, case when l_orderkey % 1000 = 0 then l_extendedprice * 1e9::double else l_extendedprice end as price from lineitem), "
    "m as (select l_returnflag, median(price) as median from p group by 1) "
    "select p.*, median, case when price < median then 'low_prob' else 'high_prob' end as prob_cat from p join m using (l_returnflag)",
    "detection_files": DET + _TEXT.format(time=_TIME, more=f", {_KIND} as source_file"),
    "detection_files_by_name": DET + _TEXT.format(time=_TIME, more=f", case when {_KIND} = 'view' then concat('n ', crop_path) end as note"),
    "config_files": _with(_STARTS)
    + "select concat(strftime(start, '%Y-%m-%d_%H-%M-%S'), '_config_', cam_ID, case when dayofyear(start) % 2 = 0 then '_flower' else '_platform' end, '.json') as filename, "
    "strftime(start, '%Y-%m-%d_%H-%M-%S') as date_time, cam_ID, setting as deployment_setting, cast(dayofyear(start) as double) as location_latitude, "
    + ", ".join(f"cast(null as double) as {n}" for n in CONFIG_NUMBERS if n != "location_latitude")
    + " from starts",
    "merged_files": _MERGED + "select * from merged",
    "merge_counts": _MERGED + "select 'rows' as step, count(*) as n from merged union all select 'unparsed_timestamps', count(*) from merged where timestamp = 'not a time' "
    "union all select 'without_camera', count(*) from merged where cam_ID is null union all select 'without_plant', count(*) from merged where plant_species is null",
    "stored_strata": ORACLE["sample_families"],
    "run_manifest": _with(*TRACKS) + "select true as named, true as dated, concat('{\"min_prob\": \">=0.1\", \"rows\": ', count(*), '}') as parameters from tracks where top1_prob_weighted >= 0.1::double",
    "reviewed_file": ORACLE["attach_labels"],
    "identified_file": ORACLE["expert_defaults"],
    "checklist_file": "select distinct upper(p_name) as species from part where p_size > 5",
}
_PICKED = (
    "picked",
    f"select 'sample_all' as sample, cast(null as double) as threshold, cast(null as varchar) as sampled_genus, cast(null as bigint) as part, {K}, top1_prob_weighted "
    f"from (select * from tracks where det_conf_mean > 0.4::double order by {_md5('sample_all')} limit 60) "
    f"union all select 'strata_thresholds', threshold, null, null, {K}, top1_prob_weighted from ({_draw('p', 'threshold', 30, 'strata_thresholds')}) "
    f"union all select 'strata_genus', null, sampled_genus, cast((row_number() over (order by {_md5('chunk')}) - 1) // 10 + 1 as bigint), {K}, top1_prob_weighted from genus",
)
_PASSED = [
    ("t", "select unnest([0.2::double, 0.5::double, 0.55::double]) as threshold"),
    ("p", "select tracks.*, threshold from tracks join t on top1_prob_weighted > threshold where bioclip_family = 'Syrphidae'"),
]
ORACLE |= {
    "expert_samples": _with(*TRACKS, _BEST, _GENUS, *_PASSED, _PICKED)
    + f"select sample, threshold, sampled_genus, part, {K}, top1_prob_weighted, crop_path from picked left join best using ({K})",
    "stored_parts": _with(*TRACKS, _BEST, _GENUS, *_PASSED, _PICKED) + f"select sample, part, threshold, {K}, crop_path from picked left join best using ({K})",
}
