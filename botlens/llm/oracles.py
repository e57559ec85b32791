"""SQL twins (DuckDB) of the corpus queries that SQL can express."""

from __future__ import annotations

from collections import Counter

from botlens.llm import hard_negatives, lexical, licenses, warc

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_SIZES = Counter(k for k, *_ in licenses.template_pairs())
_PAIRS = ", ".join(
    f"({k}, '{label}', {c}, {_SIZES[k]}, {licenses.needed(_SIZES[k])}, '{a}', '{b}')" for k, label, c, a, b in licenses.template_pairs()
)

LICENSES = rf"""
with d as (select row_number() over () as id, doc_id, {_TERMS} as w, {_LOWER} as low from documents),
tokens as (select id, unnest(w) as t, generate_subscripts(w, 1) - 1 as i from d),
following as (select id, i, t as a, lead(t, 1) over g as b, lead(t, 2) over g as c from tokens window g as (partition by id order by i)),
places as (
  select id, i, case when a = 'cc' and b = 'by' then 'cc-by' when a = 'general' and b = 'public' and c = 'license' then 'gpl'
    when a = 'all' and b = 'rights' and c = 'reserved' then 'reserved' end as label from following
),
base as (
  select id, count(*) as n, min(i) as f, max(i) as l, list_distinct(list(label)) as labels from places where label is not null group by id
),
pairs(k, label, c, size, need, a, b) as (values {_PAIRS}),
hits as (select id, i, k, label, p.c, size, need, p.a, p.b from following f join pairs p on f.a = p.a and f.b = p.b),
windows as (
  select id, k, label, size, need, a, b, i // c as win from hits
  union all select id, k, label, size, need, a, b, i // c - 1 from hits where i >= c and i % c < c - 1
),
held as (select id, k, label, size, need, count(distinct a || ' ' || b) as n from windows group by id, k, label, size, need, win),
more as (
  select id, list_distinct(list(label)) as labels, max(n / size) as share from held where n >= need group by id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_base, cast(f as bigint) as first_word, cast(l as bigint) as last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ','), '') as labels,
  case when n > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from d left join base using (id) left join more using (id)
"""

CONTAMINATION = rf"""
with d as (select row_number() over () as id, doc_id, {_TERMS} as w from documents),
items as (select item_id, {_TERMS} as w from benchmark),
windows as (
  select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as win
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from (select item_id, w, least(len(w), 10) as n from items where len(w) > 0))
),
lengths as (select distinct n from windows),
spots as (
  select id, i, n, array_to_string(w[i : i + n - 1], ' ') as win
  from (select id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n)
),
hits as (select id, i, s.n, item_id from spots s join windows using (win)),
covered as (select id, count(distinct p) as n_hit from (select id, unnest(range(i, i + n)) as p from hits) group by id),
named as (
  select id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from hits group by id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (id) left join named using (id)
"""

QUALITY = r"""
with d as (
  select row_number() over () as id, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
spots as (
  select id, i, array_to_string(w[i : i + 7], ' ') as win from (select id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) > 8)
),
twice as (select id, win from spots group by id, win having count(*) > 1),
repeated as (
  select id, count(distinct p) as n from (select id, unnest(range(i, i + 8)) as p from spots join twice using (id, win)) group by id
),
m as (
  select d.*, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
    coalesce(n, 0) as n_repeat_words,
    len(list_filter(w, lambda x: length(x) > 1 and x = upper(x) and x <> lower(x))) as shouted,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as same
  from d left join repeated using (id)
),
b as (
  select *, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and 100 * n_symbols <= 10 * n_words and 100 * n_dup_lines <= 50 * len(lines)
    and word_chars between 2 * n_words and 20 * n_words and 100 * shouted <= 50 * n_words and 100 * same <= 20 * n_words as kept
from b
"""

NEAR_DUPLICATES = rf"""
with recursive d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from d
),
entries as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
  select a.doc_id as x, b.doc_id as y from entries a join entries b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach(doc_id, r) as (
  select doc_id, doc_id from sets union select reach.doc_id, links.y from reach join links on reach.r = links.x
),
found as (select doc_id, min(r) as component_id from reach group by doc_id)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept from sets join found using (doc_id)
"""

ORACLES = {
    "op2_licenses": LICENSES,
    "op3_decontamination": CONTAMINATION,
    "op4_warc": warc.ORACLE,
    "op7_quality_rules": QUALITY,
    "op10_near_dedup": NEAR_DUPLICATES,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_lexical_search": lexical.ORACLE,
}
