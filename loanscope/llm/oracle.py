"""Check SQL of the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as squeezed
  from documents
), k as (
  select squeezed, arg_min(doc_id, (-points, doc_id)) as keep_id, count(*) as group_size from d group by squeezed
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(squeezed) as text_sha256
from d join k using (squeezed)
"""


SECRETS = r"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents
), patterns as (
  select unnest([0, 1, 2, 3]) as kind, unnest(['assign', 'access', 'hex', 'bare']) as name, unnest([6, 20, 24, 16]) as least,
    unnest(['(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)',
      'AKIA[A-Z0-9]+', '[0-9a-f]+', '[A-Za-z0-9+/_=-]{16,}']) as p
), f as (
  select r, doc_id, source, kind, least, string_split_regex(t, p) as gaps, regexp_extract_all(t, p) as found,
    case when kind = 0 then regexp_extract_all(t, p, 2) else regexp_extract_all(t, p) end as vals
  from d, patterns where regexp_matches(t, p)
), n as (
  select *, unnest(range(1, len(found) + 1)) as i from f
), spans as (
  select r, doc_id, source, kind, vals[i] as v, length(found[i]) as size,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as s
  from n where length(vals[i]) >= least
), base as (
  select *, s + size as e from spans where kind < 3
), bare as (
  select *, s + size as e from spans x where kind = 3 and regexp_matches(v, '[A-Za-z]') and regexp_matches(v, '[0-9]')
    and not exists (select 1 from base b where b.r = x.r and x.s < b.e and b.s < x.s + x.size)
), every as (
  select * from base union all select * from bare
), owned as (
  select v, count(distinct coalesce(source, chr(1))) <= 2 and count(distinct coalesce(doc_id::varchar, '')) <= 10 as live from every group by v
), judged as (
  select every.*, live, name || ':' || cast(s as bigint) || ':' || cast(e as bigint) as listed
  from every join owned using (v) join patterns using (kind) where kind < 3 or live
), parts as (
  select r, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access,
    count(*) filter (where kind = 2) as n_hex, count(*) filter (where kind = 3) as n_bare,
    count(*) filter (where live) as n_live, count(*) filter (where not live) as n_copied,
    string_agg(listed, ',' order by s, kind) filter (where kind < 3) as base,
    string_agg(listed, ',' order by s, kind) as spans, string_agg(listed, ',' order by s, kind) filter (where live) as live_spans
  from judged group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_bare, 0) as n_bare,
  coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied, coalesce(live_spans, '') as live_spans
from d left join parts using (r)
"""


# crc32 of `crc_of.data` (a blob): bytes folded over the table of 256 remainders.
CRC32 = r"""
remainders as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as rem
), hex_of as (
  select data, lower(hex(data)) as h from crc_of
), crcs as (
  select data, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i:
    16 * (instr('0123456789abcdef', h[2 * i + 1]) - 1) + instr('0123456789abcdef', h[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, rem[(xor(c, b) & 255) + 1])), 4294967295) as crc
  from hex_of, remainders
)
"""


RESAMPLING = r"""
with d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), b as (
  select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), dw as (
  select r, word, count(*) as n from (select r, unnest(words) as word from d) group by all
), bw as (
  select word, count(*) as n from (select unnest(words) as word from b) group by all
), crc_of as (
  select encode(word) as data from (select word from dw union select word from bw)
), """ + CRC32 + r""", hashed as (
  select decode(data) as word, crc % 10000 as bucket from crcs
), s as (
  select bucket, sum(n)::double as s from dw join hashed using (word) group by bucket
), t as (
  select bucket, sum(n)::double as t from bw join hashed using (word) group by bucket
), gains as (
  select bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((select coalesce(sum(s), 0) from s) + 10000)
    / ((coalesce(s, 0) + 1) * ((select coalesce(sum(t), 0) from t) + 10000))))::bigint as gain
  from s full join t using (bucket)
), weights as (
  select r, floor(sum(n * gain)::double / sum(n))::bigint as weight from dw join hashed using (word) join gains using (bucket) group by r
), scored as (
  select r, doc_id, len(words)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::varchar, '')), 8))::bigint + 0.5::double)
      / 4294967296::double)))::bigint as score
  from d left join weights using (r)
), ranked as (
  select r, row_number() over (order by score desc, doc_id nulls last, n_features, weight) as rank from scored where n_features >= 20
)
select doc_id, n_features, weight, score,
  case when rank <= (select count(*) from ranked) * 10 // 100 then rank end as rank
from scored left join ranked using (r)
"""


CONVERSATIONS = r"""
with recursive crc_of as (
  select distinct encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')) as data from conversations
), """ + CRC32 + r""", fates as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, crc % 20 as fate
  from conversations join crcs on encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')) = data
), damaged as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(case when fate = 3 then [1, 2] else [1] end) from fates where fate <> 0)
), ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from damaged
), seen as (
  select *, row_number() over (partition by conv_id, role, text order by n) > 1 as repeat,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') as bare
  from ordered
), faults as (
  select conv_id, turn, n, role, text, left(role, 1) as initial, bare = '' as blank, bare <> '' and repeat as duplicate,
    bare <> '' and not repeat and right(bare, 1) not in ('.', '!', '?') as truncated,
    lag(left(role, 1)) over (partition by conv_id order by n) as previous
  from seen
), states as (
  select unnest([0, 1, 2, 3, 0, 1, 3, 2, 0, 1]) as state, unnest([0, 1, 2, 3, 2, 2, 2, 3, 3, 3]) as there,
    unnest(['', '', '', '', 'I', 'I', 'I', 'I', 'II', 'II']) as inserted,
    unnest(['', '', '', '', 'user:|', 'user:|', 'user:|', 'assistant:|', 'user:|assistant:|', 'user:|assistant:|']) as said
), edits as (
  select state, inserted, replace(said, '|', chr(10)) as said, edit, initial,
    case edit when 'D' then there when 'K' then if(initial = 's', 1, if(initial = 'u', 2, 3)) else if(there = 2, 3, 2) end as after,
    if(there = 2, 'assistant', 'user') as wanted, 2 * length(inserted) + case edit when 'D' then 3 when 'K' then 0 else 2 end as cost
  from states, (values ('D', null), ('R', null), ('K', 's'), ('K', 'u'), ('K', 'a')) as e(edit, initial)
  where initial is null or (initial = 's' and there = 0) or (initial = 'u' and there in (0, 1, 3)) or (initial = 'a' and there = 2)
), paths as (
  select conv_id, 0::bigint as n, 0 as state, 0::bigint as cost, '' as audit, '' as said from (select distinct conv_id from damaged)
  union all
  select conv_id, n, after, cost, audit, said from (
    select f.conv_id, f.n, e.after, p.cost + e.cost + (f.truncated and e.edit <> 'D')::bigint as cost, p.audit || e.inserted || e.edit as audit,
      p.said || e.said || case e.edit when 'D' then '' when 'K' then f.role || ':' || f.text || chr(10) else e.wanted || ':' || f.text || chr(10) end as said,
      row_number() over (partition by f.conv_id, e.after order by p.cost + e.cost + (f.truncated and e.edit <> 'D')::bigint, p.audit || e.inserted || e.edit) as place
    from paths p join faults f on f.conv_id is not distinct from p.conv_id and f.n = p.n + 1
      join edits e on e.state = p.state and (e.edit = 'D' or not (f.blank or f.duplicate)) and (e.initial is null or e.initial = f.initial)
  ) where place = 1
), ends as (
  select p.conv_id, p.cost + 2 * length(inserted) as cost, p.audit || inserted as audit, p.said || replace(s.said, '|', chr(10)) as said,
    row_number() over (partition by p.conv_id order by p.cost + 2 * length(inserted), p.audit || inserted) as place
  from paths p join (select conv_id, max(n) as n from faults group by conv_id) l on l.conv_id is not distinct from p.conv_id and l.n = p.n
    join states s on s.state = p.state and s.there in (0, 3)
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank,
    count(*) filter (where duplicate) as duplicate, count(*) filter (where truncated) as truncated,
    count(*) filter (where n > 1 and previous || initial not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id
)
select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  sha256(coalesce(left(said, greatest(length(said) - 1, 0)), '')) as repaired_sha256
from (select distinct conv_id from conversations) i
  left join counted c on c.conv_id is not distinct from i.conv_id
  left join (select * from ends where place = 1) e on e.conv_id is not distinct from i.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP, "op10_secrets": SECRETS, "op11_resampling": RESAMPLING,
        "op12_conversations": CONVERSATIONS,
    }
