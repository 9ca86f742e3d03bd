"""SQL for DuckDB that registered queries must equal: brute force over whole tables, fit for small ones."""
from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs that share a shingle, then what is reachable.
MINHASH = f"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
u as (select doc_id, len(s) as n, unnest(s) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k, any_value(a.n) as n, any_value(b.n) as m from u as a join u as b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from p where 100 * k >= 85 * (n + m - k)),
r(node, reached) as (select doc_id, doc_id from s union select r.node, l.b from r join l on l.a = r.reached),
c as (select node as doc_id, min(reached) as component_id from r group by 1)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept from s join c using (doc_id)"""

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FIVE = " || ".join(
    f"substr('{_B32}', 1 + ((cast('0x' || substr(x, {5 * g + 1}, 5) as bigint) >> {s}) & 31)::integer, 1)" for g in range(8) for s in (15, 10, 5, 0))

WARC = f"""
with d as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as x from pages),
l as (select *, max(page_id) over (partition by x) as leader from d)
select page_id, cast(n as bigint) as payload_bytes, {_FIVE} as payload_digest, case when page_id = leader then 'response' else 'revisit' end as record_type,
  case when page_id <> leader then leader end as refers_to from l"""

#: The CRC-32 of a doc_id as text: each byte comes in, then eight steps (-1) of the division.
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(d) + 1), lambda i: [ascii(substr(d, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, v: case when v >= 0 then xor(c, v) when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end), 4294967295)"""

#: What the language model's query counts: folds, tokens, and the base score.
HMM_BASE = f"""
with d as (select doc_id, cast(doc_id as varchar) as d, list_append(list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''), '') as w from documents),
f as (select doc_id, {_CRC} % 5 = 1 as held_out, w from d),
t as (select doc_id, held_out, unnest(w) as word from f),
c as (select word, count(*) as c from t where not held_out group by 1),
n as (select sum(c) as n, count(*) as v from c)
select doc_id, held_out, count(*) as n_tokens, count(c) as n_known, cast(any_value(n) as bigint) as train_tokens,
  round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 4) as base_score
from t left join c using (word), n group by 1, 2"""

#: Every string of 100 bytes with its first place; the bytes of a text are pairs of hexadecimal digits.
REPEATS = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, p, md5(substr(h, 2 * p + 1, 200)) as s from (select doc_id, h, unnest(range(0, len(h) // 2 - 99)) as p from d where len(h) >= 200)),
r as (select doc_id, p from (select doc_id, p, row_number() over (partition by s order by doc_id, p) as k from w) where k > 1),
g as (select doc_id, p, sum(case when p <= before then 0 else 1 end) over (partition by doc_id order by p) as g
  from (select doc_id, p, coalesce(lag(p) over (partition by doc_id order by p) + 100, -1) as before from r)),
a as (select doc_id, min(p) as a, max(p) + 100 as b from g group by doc_id, g),
k as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as begin from a),
e as (select doc_id, string_agg(substr(h, 2 * begin + 1, 2 * (a - begin)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as kept, sum(b - a) as gone, count(*) as n from k join d using (doc_id) group by doc_id)
select d.doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(gone, 0) as bigint) as n_removed, coalesce(n, 0) as n_spans, sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join e using (doc_id)"""
