"""The same results in SQL over the test tables, for DuckDB, where SQL can express them."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce({text}, ''), '[ \t-\r]+'), lambda w: w <> '')"

ORACLE: dict[str, str] = {}

ORACLE["op4_url_filter"] = r"""
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(rule_host, rule_path, rule_verdict) as (values
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
  select page_id, rule_host || rule_path as rule, rule_verdict as verdict,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc) as n
  from parts join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parts left join (select * from fits where n = 1) using (page_id)
"""

ORACLE["op9_mixing"] = (
    r"""
with sized as (
  select doc_id, source, cast(len("""
    + WORDS.format(text="text")
    + r""") as bigint) as size,
    cast('0x' || substr(md5('0:' || coalesce(cast(doc_id as varchar), 'null')), 1, 15) as bigint)
      as mixing_key
  from documents),
by_source as (
  select source, cast(sum(size) as bigint) as source_size,
    case (row_number() over (order by source nulls last) - 1) % 3
      when 0 then 1.0::double when 1 then 2.0::double else 3.0::double end as weight
  from sized group by source),
limits as (
  select *, cast(3 * source_size as double) as cap,
    cast(sum(source_size) over () as double) as total from by_source),
filled as (
  select *,
    (total - coalesce(sum(cap) over (order by cap / weight, source nulls last
        rows between unbounded preceding and 1 preceding), 0))
      / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source nulls last
        rows between unbounded preceding and 1 preceding), 0)) as rate,
    row_number() over (order by cap / weight, source nulls last) as place
  from limits),
stop as (select rate as final_rate from filled where rate * weight <= cap order by place limit 1),
targets as (
  select source, source_size,
    least(cap, coalesce((select final_rate from stop), 'infinity'::double) * weight) as target
  from filled),
runs as (
  select doc_id, size, source_size, target,
    coalesce(sum(size) over (partition by s.source order by mixing_key, doc_id, size
      rows between unbounded preceding and 1 preceding), 0) as before,
    case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  cast(case when size = 0 then 0
    else size * (epochs + case when before + size / 2.0 <= target - epochs * source_size
                               then 1 else 0 end) end as bigint) as taken
from runs
"""
)

ORACLE["op7_quality_rules"] = (
    r"""
with texts as (
  select doc_id, coalesce(text, '') as text, """
    + WORDS.format(text="text")
    + r""" as words from documents),
tokens as (
  select doc_id, unnest(words) as w, generate_subscripts(words, 1) as p from texts),
grams as (
  select * from (
    select doc_id, p, w || ' ' || lead(w, 1) over (partition by doc_id order by p)
      || ' ' || lead(w, 2) over (partition by doc_id order by p) as gram from tokens)
  where gram is not null),
repeats as (
  select doc_id, p from (
    select doc_id, p, count(*) over (partition by doc_id, gram) as n from grams) where n > 1),
covered as (
  select doc_id, cast(count(distinct spot) as bigint) as n_repeat_words
  from (select doc_id, unnest([p, p + 1, p + 2]) as spot from repeats) group by doc_id),
lines as (
  select doc_id, text, words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) as spoken
  from texts),
measures as (
  select doc_id, text, words, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[ \t-\r]', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(spoken) - len(list_distinct(spoken)) as bigint) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from lines left join covered using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    word_chars < 2 * n_words or word_chars > 16 * n_words
    or 10 * n_symbols > n_words
    or 10 * n_dup_lines > 3 * (1 + length(text) - length(replace(text, chr(10), '')))
    or 10 * (length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g'))) > 3 * word_chars
    or 5 * (length(text) - length(replace(text, '!', ''))) > n_words
    or 10 * (length(text) - length(regexp_replace(text, '[0-9]+', '', 'g'))) > 2 * word_chars
    as rejected
  from measures)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not rejected as kept
from judged
"""
)

# Chunks are compared by their text alone; two lines hash in the same way.
ORACLE["op5_line_dedup"] = r"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 as i
  from documents where text is not null),
hashed as (
  select *, cast('0x' || substr(md5(line), 1, 7) as bigint) as h,
    count(*) over (partition by doc_id) as n from lines),
ends as (
  select *, i > 0 and (i = n - 1 or
    ((lag(h) over w * 1000003) % 2147483647 + h) % 2147483647 % 8 <> 0) as ending
  from hashed window w as (partition by doc_id order by i)),
starts as (
  select *, min(case when ending then i end) over (partition by doc_id order by i
    rows between 1 following and unbounded following) as e from ends),
chunks as (
  select s.doc_id, s.i as first, s.e as last, list_aggregate(
    string_split(d.text, chr(10))[s.i + 1 : s.e + 1], 'string_agg', chr(10)) as passage
  from starts s join documents d using (doc_id) where s.e is not null),
placed as (
  select doc_id, first, last,
    row_number() over (partition by passage order by doc_id, first) > 1 as again,
    count(*) over (partition by passage) > 1 as repeated
  from chunks),
marked as (
  select l.doc_id, l.i, any_value(l.line) as line,
    coalesce(bool_or(p.again), false) and not coalesce(bool_or(p.repeated and not p.again), false) as gone
  from lines l left join placed p
    on p.doc_id = l.doc_id and l.i between p.first and p.last and p.repeated
  group by l.doc_id, l.i),
kept as (
  select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
    string_agg(line, chr(10) order by i) filter (not gone) as kept_text
  from marked group by doc_id)
select doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
  sha256(coalesce(kept_text, '')) as kept_sha256
from documents left join kept using (doc_id)
"""

ORACLE["op13_filter_audit"] = (
    r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, """
    + WORDS.format(text="text")
    + r""" as words from documents),
failed as (
  select part, doc_id,
    [len(words) < 200,
     100 * len(list_distinct(words)) < 50 * len(words),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
     regexp_matches(text, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) over (partition by text), false)] as fails
  from texts),
marked as (
  select part, fails,
    coalesce(doc_id in (select doc_id from labels where quality = 1), false) as good,
    coalesce(doc_id in (select doc_id from labels where toxic = 1), false) as toxic
  from failed),
alike as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from marked group by part, fails),
places as (select unnest([1, 2, 3, 4, 5]) as p),
orders as (
  select [a.p, b.p, c.p, d.p, e.p] as o
  from places a, places b, places c, places d, places e
  where len(list_distinct([a.p, b.p, c.p, d.p, e.p])) = 5),
steps as (
  select list_aggregate(list_transform(o, lambda k: substr('ABCDE', k, 1)), 'string_agg', '')
      as filter_order, p as step, o[p] as own, o[1 : p - 1] as before
  from orders, places),
counted as (
  select part, filter_order, step, own,
    sum(case when not out_before and not fails[own] then n else 0 end)::bigint as kept,
    sum(case when not out_before and fails[own] then n else 0 end)::bigint as removed,
    sum(case when out_before and fails[own] then n else 0 end)::bigint as redundant,
    sum(case when fails[own] and len(list_filter(fails, lambda f: f)) = 1 then n else 0 end)::bigint
      as unique_fails,
    sum(case when not out_before and fails[own] then good else 0 end)::bigint as good_lost,
    sum(case when not out_before and fails[own] then toxic else 0 end)::bigint as toxic_lost
  from (
    select *, len(list_filter(before, lambda k: fails[k])) > 0 as out_before
    from alike, steps)
  group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost,
  toxic_lost, (sum(removed) over (partition by part, own))::bigint as shapley
from counted
"""
)

# CRC-32, bit by bit: DuckDB has no function for it. Prefixes are compared by all their text.
ORACLE["op12_prefix_trie"] = (
    r"""
with said as (
  select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as body,
    cast(len("""
    + WORDS.format(text="text")
    + r""") as bigint) as words
  from conversations where conv_id is not null),
placed as (
  select c, length(role) || ':' || role || body as turn_text, words,
    row_number() over (partition by c order by turn nulls first, role, body) as p from said),
heads as (
  select c, count(*) as size, c - c % 20 as base,
    xor(list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
        lambda x, _: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end)::bigint)),
      4294967295::bigint) % 4 as h
  from placed group by c),
rebuilt as (
  select h.c, p.p, p.turn_text, p.words, 0 as part
  from heads h join placed p on p.c = h.base and p.p <= h.h
  union all
  select h.c, p.p, p.turn_text, p.words, 1 from heads h join placed p on p.c = h.c and p.p > h.h),
sequence as (
  select c, words, turn_text, row_number() over (partition by c order by part, p) as d from rebuilt),
prefixes as (
  select c, d, words,
    md5(string_agg(length(turn_text) || ':' || turn_text, '') over (partition by c order by d)) as k
  from sequence
  union all select c, 0, 0, '' from heads),
keyed as (
  select *, lag(k) over (partition by c order by d) as up, max(d) over (partition by c) as size
  from prefixes),
nodes as (
  select k, d, any_value(up) as up, min(c) as conv_id, count(*) as n, any_value(words) as words,
    string_agg(c::varchar, ',' order by c) filter (d = size) as ending
  from keyed group by k, d),
children as (select up, count(*) as n from nodes where up is not null group by up),
below as (
  select distinct a.k as top, a.d as top_d, b.k, b.d
  from keyed a join keyed b on a.c = b.c and b.d >= a.d),
subtrees as (
  select top, top_d, count(*) filter (x.n is null) as n_leaves,
    sum((n.n - 1) * n.words)::bigint as saved_tokens
  from below b join nodes n on b.k = n.k and b.d = n.d left join children x on x.up = n.k
  group by top, top_d)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n as n_convs,
  coalesce(x.n, 0) as n_children, s.n_leaves, s.saved_tokens,
  sha256(coalesce(n.ending, '')) as ends_sha256
from nodes n join subtrees s on s.top = n.k and s.top_d = n.d
left join nodes p on p.k = n.up left join children x on x.up = n.k
"""
)
