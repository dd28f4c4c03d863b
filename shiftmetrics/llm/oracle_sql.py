"""DuckDB SQL of the text queries that joins can express over whole tables.

Each is written from the query's contract, not from its operator: windows and
shingles are joined as text, groups are reached link by link, words meet by
what is left when a code point is deleted.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({_lower(f'coalesce({text}, {chr(39) * 2})')}, '{pattern}')"


#: Windows of documents, of each length that an item's windows have, joined on the window's text.
DECONTAMINATION = rf"""
with docs as (
  select row_number() over () as r, doc_id, {_words('text', r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} as w from documents),
items as (
  select coalesce(item_id::varchar, '') as item_id, {_words('text', r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')} as w from benchmark),
windows as (
  select distinct item_id, n, array_to_string(w[k:k + n - 1], ' ') as said from (
    select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as k from items where len(w) > 0)),
lengths as (select distinct n from windows),
placed as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from docs where len(w) > 0),
ahead as (
  select r, pos, [word, {', '.join(f'lead(word, {i}) over o' for i in range(1, 10))}] as ws from placed
  window o as (partition by r order by pos)),
found as (
  select r, pos, n, item_id from (
    select r, pos, n, array_to_string(ws[1:n], ' ') as said from ahead, lengths where ws[n] is not null)
  join windows using (n, said)),
hit as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(pos, pos + n)) as p from found) group by r),
named as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct r, item_id from found) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (r) left join named using (r)
"""

#: Sets that share one of their rarest quarter of shingles are compared whole; the links are followed to the end.
NGRAM_JOIN = rf"""
with recursive docs as (
  select row_number() over () as r, doc_id, {_words('text', r'[^\x20\x09-\x0D]+')} as w from documents),
shingles as (
  select distinct r, array_to_string(w[k:k + 4], ' ') as s
  from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as k from docs where len(w) > 0)),
sizes as (select r, count(*) as n from shingles group by r),
held as (select s, count(*) as df from shingles group by s),
ranked as (
  select r, s, n, row_number() over (partition by r order by df, s) as place from shingles join held using (s) join sizes using (r)),
rare as (select r, s, n from ranked where place <= n - (3 * n + 3) // 4 + 1),
candidates as (
  select distinct a.r as a, b.r as b, a.n as n, b.n as m from rare a join rare b on a.s = b.s and a.r < b.r
  where 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)),
shared as (
  select c.a, c.b, n, m, count(*) as common
  from candidates c join shingles x on x.r = c.a join shingles y on y.r = c.b and y.s = x.s group by c.a, c.b, n, m),
links as (
  select a, b from shared where 100 * common >= 75 * (n + m - common)
  union all select b, a from shared where 100 * common >= 75 * (n + m - common)),
reached(a, b) as (
  select r, r from docs
  union select p.a, l.b from reached p join links l on l.a = p.b),
least as (select p.a as r, min(d.doc_id) as component_id from reached p join docs d on d.r = p.b group by p.a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id from docs join least using (r) left join sizes using (r)
"""

#: CRC-32, bit by bit (lowest bit of each byte first), of a text's UTF-8 bytes.
_CRC32 = r"""xor(4294967295, list_reduce(
    list_transform(range(0, 4 * length(h)), lambda j: ((('0x' || substr(h, 2 * (j // 8) + 1, 2))::bigint >> (j % 8)) & 1)::bigint),
    lambda c, x: xor(c >> 1, 3988292384 * (xor(c, x) & 1)), 4294967295::bigint))"""

#: Words meet by position and rest: equal rests after a deletion at one place, or a rest that is a word.
SPELLING = rf"""
with recursive runs as (
  select d, run, count(*) as times from (
    select coalesce(doc_id::varchar, '') as d, unnest(regexp_extract_all({_lower('text')}, '[a-zÀ-ÿ]+')) as run from documents)
  group by d, run),
summed as (select run, times, {_CRC32} as h from (select run, times, hex(encode(d || ':' || run)) as h from runs)),
noisy as (
  select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
         times from summed),
words as (select word, sum(times)::bigint as n from noisy where length(word) >= 7 group by word having sum(times) >= 2),
cut as (
  select word, k, substr(word, 1, k - 1) || substr(word, k + 1) as rest
  from (select word, unnest(range(1, length(word) + 1))::int as k from words)),
near as (
  select a.word as word, b.word as other from cut a join cut b on a.rest = b.rest and a.k = b.k and a.word <> b.word
  union select c.word, w.word from cut c join words w on w.word = c.rest
  union select w.word, c.word from cut c join words w on w.word = c.rest),
best as (
  select near.word as word, count(*) as n_near, max(o.n) as most, arg_min(near.other, (-o.n, near.other)) as form
  from near join words o on o.word = near.other group by near.word),
known as (
  select word, n, coalesce(n_near, 0)::bigint as n_near, case when most >= 10 * n then form end as form,
         case when most >= 10 * n then most end as form_n
  from words left join best using (word)),
steps(word, place, k) as (
  select word, word, 0 from known
  union all select s.word, f.form, k + 1 from steps s join known f on f.word = s.place where f.form is not null)
select word, form, root, n, n_near, form_n::bigint as form_n
from known join (select word, arg_max(place, k) as root from steps group by word) using (word)
"""
