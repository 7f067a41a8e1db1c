"""The SQL twin of the quality rules, for DuckDB: counts by grouping instead of within the row, distances by joins."""

from __future__ import annotations

from . import quality_rules as rules

_SYMBOLS = r"[^!#*$%&|<>@=~^_+/{}\[\]\\]+"
#: class, and what to delete from a text to keep it
_CLASSES = [("lower", "[^a-z]+"), ("upper", "[^A-Z]+"), ("digit", "[^0-9]+"), ("stop", r"[^.,;:?\x27\x22()-]+"), ("symbol", _SYMBOLS), ("letter", r"[\x00-\x7F]+")]
_COUNTS = ", ".join(f"length(regexp_replace(t, '{drop}', '', 'g')) as c{i}" for i, (_, drop) in enumerate(_CLASSES))
_ALL = [f"c{i}" for i in range(len(_CLASSES))] + ["blank", "other"]


def _divergence(p: str, q: str) -> str:
    part = "case when {0} > 0 then {0} * log2(2 * {0} / ({0} + {1})) else 0 end"
    return f"({part.format(p, q)} + {part.format(q, p)})"


_CHARS = " + ".join(_divergence(f"(x.{c} / greatest(x.size, 1)::double)", f"(f.{c} / f.size::double)") for c in _ALL)

QUALITY = rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, lang from documents
), words as (
  select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
         list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}]+'), lambda x: x <> '') as pw,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d
), windows as (
  select r, i, ws[i : i + {rules.WINDOW_WORDS - 1}] as g from (select r, ws, unnest(range(1, len(ws) - {rules.WINDOW_WORDS - 2})) as i from words where len(ws) >= {rules.WINDOW_WORDS})
), repeated as (
  select r, count(distinct p) as n_repeat_words from (
    select r, unnest(range(i, i + {rules.WINDOW_WORDS})) as p from (select *, count(*) over (partition by r, g) as n from windows) where n > 1) group by r
), counted as (
  select r, doc_id, t, lang, pw, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, length(t) as size, {_COUNTS} from words
), x as (
  select *, size - word_chars as blank, word_chars - ({' + '.join(f'c{i}' for i in range(len(_CLASSES)))}) as other,
         len(pw) as n, coalesce(n_repeat_words, 0) as repeats from counted left join repeated using (r)
), spoken as (
  select lang, unnest(pw) as word from x where lang is not null
), totals as (
  select lang, count(*) as total from spoken group by lang
), common as (
  select lang, word, count(*) as k from spoken where length(word) <= {rules.COMMON_LENGTH} group by lang, word
  qualify row_number() over (partition by lang order by count(*) desc, word) <= {rules.COMMON_WORDS}
), f as (
  select lang, {', '.join(f'sum({c}) as {c}' for c in _ALL)}, sum(size) as size, any_value(total) as total
  from x join totals using (lang) group by lang having count(*) >= {rules.LEAST_DOCS} and any_value(total) >= {rules.LEAST_WORDS} and sum(size) > 0
), shares as (
  select lang, word, k / total::double as share from common join f using (lang)
), alone as (
  select lang, sqrt(greatest(0, ({_divergence('sum(0.0::double)', 'sum(share)').replace('sum(0.0::double)', '0.0::double')} + {_divergence('1.0::double', '(1 - sum(share))')}) / 2)) as alone from shares group by lang
), chars as (
  select r, min(sqrt(greatest(0, ({_CHARS}) / 2))) as dc from x, f group by r
), mine as (
  select r, word, count(*) as k from (select r, unnest(pw) as word from x) where word in (select word from shares) group by r, word
), met as (
  select x.r, s.lang, s.share, coalesce(m.k, 0) / greatest(x.n, 1)::double as p from x cross join shares s left join mine m on m.r = x.r and m.word = s.word
), parts as (
  select r, lang, sum({_divergence('p', 'share')}) as inside, 1 - sum(p) as p_rest, greatest(0, 1 - sum(share)) as q_rest from met group by r, lang
), worded as (
  select r, min(dw) as dw, min(dw / alone) as share from (
    select r, lang, sqrt(greatest(0, (inside + {_divergence('p_rest', 'q_rest')}) / 2)) as dw from parts) join alone using (lang) group by r
), judged as (
  select x.*, n_words < 20 or 100 * repeats > 30 * n_words as base_failed, dc, dw,
         (size >= {rules.MIN_CHARS} and coalesce(dc, 0) > {rules.MAX_CHAR_DISTANCE}) or
         (n >= {rules.MIN_WORDS} and coalesce(share, 0) > case when n >= {rules.SURE_WORDS} then {rules.MAX_WORD_SHARE} else {rules.MAX_SHORT_SHARE} end) as far
  from x left join chars using (r) left join worded using (r)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
       repeats::bigint as n_repeat_words, base_failed, not base_failed and not far as kept,
       floor(dc * 1e6::double + 0.5::double) / 1e6::double as char_distance, floor(dw * 1e6::double + 0.5::double) / 1e6::double as word_distance
from judged
"""
