"""The SQL twin of the licence scan, for DuckDB."""

from __future__ import annotations

from . import licenses


def _values() -> str:
    rows = []
    for licence, listed in licenses.all_templates().items():
        for form, body in enumerate(listed):
            least = max(licenses.THRESHOLD, licenses.WHOLE_THRESHOLD) if len(body.split()) >= licenses.WHOLE_WORDS else licenses.THRESHOLD
            rows.append(f"('{licence}', {form}, '{body.replace(chr(39), chr(39) * 2)}', {least}::double)")
    return ",\n".join(rows)


_FILE = licenses.LICENCE_FILE
_TERMS = r"unnest(list_filter(regexp_split_to_array(lower(body), '[^\p{L}\p{N}]+'), lambda x: x <> ''))"
_MARKED = f"array_to_string(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{licenses.NOTICE}')), chr(10))"
_IDF = "(ln((total + 1) / (coalesce(df, 0) + 1)::double) + 1)"


def licenses_twin() -> str:
    return rf"""
with d as (
  select row_number() over () as r, doc_id, text, coalesce(text, '') as t, lang, source from documents
), named as (
  select *, concat_ws('/', source, lang,
    case when 2 * length(case when regexp_matches(regexp_extract(source, '[^/]*$'), '{_FILE}') then t else {_MARKED} end) > length(text)
         then 'LICENSE.' || doc_id else doc_id || '.txt' end) as path from d
), rooted as (
  select *, regexp_extract(path, '[^/]*$') as base, case when regexp_matches(path, '^[.]{{0,2}}/') then path else './' || path end as whole from named
), files as (
  select *, case when regexp_matches(base, '{_FILE}') then t else {_MARKED} end as body, regexp_extract(whole, '^(.*)/[^/]*$', 1) as dir from rooted
), notices as (
  select body, count(*) as files from files where body <> '' group by body
), total as (select coalesce(sum(files), 0) as total from notices),
terms as (
  select body, files, term, count(*) as tf from (select body, files, {_TERMS} as term from notices) group by body, files, term
), df as (select term, sum(files) as df from terms group by term),
known(license, form, body, least) as (values {_values()}),
wanted as (
  select license, form, least, term, ttf * {_IDF} as tw
  from (select license, form, least, term, count(*) as ttf from (select license, form, least, {_TERMS} as term from known) group by all) left join df using (term), total
), normed as (select license, form, sqrt(sum(tw * tw)) as tnorm from wanted group by license, form),
weighed as (select body, term, tf * {_IDF} as w from terms join df using (term), total),
norms as (select body, sqrt(sum(w * w)) as norm from weighed group by body),
scores as (
  select body, license, least, round(sum(w * tw) / any_value(norm) / any_value(tnorm), 6) as own_score
  from weighed join wanted using (term) join normed using (license, form) join norms using (body) group by body, license, form, least
), tagged as (
  select body, regexp_replace(lower(regexp_extract(body, '(?i)SPDX-License-Identifier:[ \t(]*([A-Za-z0-9.+-]+)', 1)), '(-only|-or-later)?[+]?$', '') as tag from notices
), tags as (
  select body, license from tagged left join (select distinct license from known) k on lower(license) = tag where tag <> ''
), best as (
  select body, arg_min(license, row(-own_score, license)) as own_license, max(own_score) as own_score from (
    select body, license, own_score from scores where own_score >= least and body not in (select body from tags)
    union all select body, license, 1.0::double from tags where license is not null) group by body
), scored as (select * from files left join best using (body)),
in_dir as (
  select dir as above, arg_min(path, row(-own_score, path, own_license)) as p, arg_min(own_license, row(-own_score, path, own_license)) as l
  from scored where own_license is not null and regexp_matches(base, '{_FILE}') group by dir
), up as (
  select dir, u as distance, array_to_string(parts[1 : len(parts) - u], '/') as above
  from (select dir, parts, unnest(range(len(parts))) as u from (select distinct dir, string_split(dir, '/') as parts from files where path is not null))
), nearest as (
  select dir, min(distance) as distance, arg_min(p, distance) as p, arg_min(l, distance) as l from up join in_dir using (above) group by dir
)
select doc_id, path, own_license, own_score, coalesce(own_license, l) as license, case when own_license is null then p end as inherited_from,
       cast(case when own_license is null then distance end as integer) as distance
from scored left join nearest using (dir)
"""
