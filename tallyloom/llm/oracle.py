"""SQL for the opN queries that DuckDB can express. The others are tested against brute force."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP2 = f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
    (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 12))::bigint >> 3) as rank from documents),
s as (select source, sum(size)::bigint as n, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from d group by source),
o as (select *, row_number() over (order by n / w, source) as k, sum(3 * n) over (order by n / w, source) as caps, sum(w) over (order by n / w, source) as used,
    sum(n) over () as total, sum(w) over () as mass from s),
lv as (select min(k) as k from (select k, case when mass > used - w then (total - (caps - 3 * n)) * w / (mass - (used - w)) <= 3 * n end as fits from o) where fits),
left_over as (select (any_value(total) - coalesce(sum(3 * n) filter (where o.k < lv.k), 0))::double as left_mass, (any_value(mass) - coalesce(sum(w) filter (where o.k < lv.k), 0))::double as free from o, lv),
t as (select source, n, case when o.k < lv.k then (3 * n)::double else left_mass * w / free end as target from o, lv, left_over),
p as (select *, case when n > 0 then least(3, floor(target / n))::bigint else 0 end as whole from t),
b as (select d.*, p.n, p.target, p.whole, p.target - p.whole * p.n as budget from d join p on d.source is not distinct from p.source),
c0 as (select *, sum(size) over (partition by source order by rank range unbounded preceding) as run from b),
t0 as (select *, rank < coalesce(min(rank) filter (where run > budget) over (partition by source), 1::bigint << 46) as in0 from c0),
l0 as (select *, budget - coalesce(sum(size) filter (where in0) over (partition by source), 0) as left0 from t0),
c1 as (select *, not in0 and size <= left0 as free1, sum(case when not in0 and size <= left0 then size else 0 end) over (partition by source order by rank range unbounded preceding) as run1 from l0),
t1 as (select *, free1 and rank < coalesce(min(rank) filter (where free1 and run1 > left0) over (partition by source), 1::bigint << 46) as in1 from c1),
l1 as (select *, left0 - coalesce(sum(size) filter (where in1) over (partition by source), 0) as left1 from t1),
c2 as (select *, not in0 and not in1 and size <= left1 as free2, sum(case when not in0 and not in1 and size <= left1 then size else 0 end) over (partition by source order by rank range unbounded preceding) as run2 from l1),
t2 as (select *, free2 and rank < coalesce(min(rank) filter (where free2 and run2 > left1) over (partition by source), 1::bigint << 46) as in2 from c2)
select doc_id, size, n as source_size, round(target, 3) as target, ((whole + ((in0 or in1 or in2) and whole < 3)::int) * size)::bigint as taken from t2
"""

OP4 = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{WORD}') as ws from d),
win as (select doc_id, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) > 2),
g as (select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as k from win),
rep as (select doc_id, count(distinct i + j) as n_repeat_words from g, range(3) r(j) where k > 1 group by doc_id),
l as (select doc_id, unnest(string_split(t, chr(10))) as line from d),
lines as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from l where regexp_matches(line, '{WORD}') group by doc_id),
m as (select doc_id, len(ws)::bigint as n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(n_lines, 0) as n_lines, length(regexp_replace(t, '[\\x00-@\\[-`{{-\\x7F]', '', 'g')) as n_alpha, length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper
  from w left join rep using (doc_id) left join lines using (doc_id)),
f as (select *, ((n_words < 50)::int + (100 * n_repeat_words > 50 * n_words)::int * 2 + (n_symbols / greatest(n_words, 1) > 0.2::double)::int * 4 + (n_dup_lines / greatest(n_lines, 1) > 0.5::double)::int * 8
    + (word_chars / greatest(n_words, 1) < 2 or word_chars / greatest(n_words, 1) > 20)::int * 16 + (n_upper / greatest(n_alpha, 1) > 0.6::double)::int * 32 + (n_alpha / greatest(word_chars, 1) < 0.5::double)::int * 64
    + (n_words > 1000000)::int * 128)::bigint as failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed, failed & 127 = 0 as kept, failed from f
"""

OP9 = f"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as ws from documents),
x as (select doc_id, unnest(range(1, len(ws) - 3)) as i, ws from d where len(ws) >= 5),
sh as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s from x union all select doc_id, array_to_string(ws, ' ') from d where len(ws) between 1 and 4),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from common join n x on a = x.doc_id join n y on b = y.doc_id where 100 * k >= 75 * (x.n + y.n - k)),
reach as (select doc_id as node, doc_id as seen from d union select node, b from reach join e on seen = a)
select d.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(seen) as component_id from d join reach on node = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
"""

ORACLE = {"op2_mixing": OP2, "op4_quality_rules": OP4, "op9_jaccard": OP9}
