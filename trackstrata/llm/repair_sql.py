"""The SQL twin of the conversation repair, for DuckDB: the same costs by one pass over the rows, least audits by comparing them."""

from __future__ import annotations

#: fixed value: the reflected polynomial of CRC-32
POLYNOMIAL = 0xEDB88320


def _step(key: str, cost: str, letter: str) -> str:
    """A nine-digit cost followed by the audit so far, after one more edit. Least by text is least by cost, then by audit."""
    return f"lpad(cast(cast(left({key}, 9) as integer) + {cost} as varchar), 9, '0') || substr({key}, 10) || '{letter}'"


def _into(state: int, sources: str, initial: str) -> str:
    stay = _step(f"s{state}", "2", "D")
    moves = [f"case when initial = '{initial}' then {_step(f's{s}', 'extra', 'K')} else {_step(f's{s}', 'extra + 1', 'R')} end" for s in sources]
    return f"case when lost then {stay} else least({', '.join([stay, *moves])}) end as s{state}"


# Inserting a row is never cheaper than deleting a neighbour at these costs, so the pass has no insertions.
REPAIR = rf"""
with recursive bits as (
  select list(t order by i) as t from (
    select i, list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::bigint[], lambda c, k: case when c & 1 = 1 then xor(c >> 1, {POLYNOMIAL}::bigint) else c >> 1 end, i::bigint) as t from range(256) x(i))
), thrown as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 20 as dice
  from conversations, bits
), damaged as (
  select conv_id, turn, case when dice = 4 then 'user' else role end as role,
         case dice when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case dice when 0 then 0 when 3 then 2 else 1 end)) as copy
  from thrown
), ordered as (
  select *, left(role, 1) as initial, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as cut,
         row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i
  from damaged
), marked as (
  select *, not blank and row_number() over (partition by conv_id, role, text order by i) > 1 as again,
         lag(initial) over (partition by conv_id order by i) as before
  from ordered
), rows as (
  select *, blank or again as lost, case when cut then 5 else 0 end as extra from marked
), counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (again) as duplicate,
         count(*) filter (cut and not lost) as truncated, count(*) filter (before || initial not in ('su', 'ua', 'au')) as illegal, max(i) as n
  from rows group by conv_id
), pass as (
  select conv_id, 0::bigint as i, '000000000' as s0, null::varchar as s1, null::varchar as s2, null::varchar as s3 from counts
  union all
  select r.conv_id, r.i, {_step("s0", "2", "D")} as s0,
         case when lost or initial <> 's' then {_step("s1", "2", "D")} else least({_step("s1", "2", "D")}, {_step("s0", "extra", "K")}) end as s1,
         {_into(2, "013", "u")}, {_into(3, "2", "a")}
  from pass p join rows r on p.conv_id is not distinct from r.conv_id and r.i = p.i + 1
), best as (
  select c.*, cast(left(least(s0, s3), 9) as bigint) as cost, substr(least(s0, s3), 10) as audit
  from counts c join pass p on c.conv_id is not distinct from p.conv_id and c.n = p.i
), edited as (
  select r.conv_id, r.i, r.role, r.text, substr(audit, r.i, 1) as edit, initial from rows r join best b on r.conv_id is not distinct from b.conv_id
), answered as (
  select *, count(*) filter (not (edit = 'K' and initial = 's')) over (partition by conv_id order by i) as place from edited where edit <> 'D'
), lines as (
  select conv_id, string_agg(case when edit = 'K' then role when place % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by i) as body
  from answered group by conv_id
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
       coalesce(audit, '') as audit, sha256(coalesce(body, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join best b on o.conv_id is not distinct from b.conv_id
left join lines l on o.conv_id is not distinct from l.conv_id
"""
