"""Check SQL for the queries that SQL can express; written apart from the operators, as direct joins and windows.

The others rest on hashes, compression, random rotations, token files or samples that SQL doesn't have; the tests compare
them with plain versions.
"""

from __future__ import annotations

from millwright.llm.urls import RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 13) as l, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as gram
  from (select *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
lengths as (select distinct l from windows),
spots as (
  select r, i, l, array_to_string(w[i:i + l - 1], ' ') as gram
  from (select r, w, l, unnest(range(1, len(w) - l + 2)) as i from d, lengths where len(w) >= l)),
hits as (select s.r, s.i, s.l, item_id from spots s join windows v on s.gram = v.gram and s.l = v.l),
hit_words as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + l)) as p from hits) group by r),
named as (
  select r, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct r, cast(item_id as varchar) as name from hits where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit_words using (r) left join named using (r)"""

REPEATS = """
with d as (
  select row_number() over () as r, doc_id, encode(coalesce(text, '')) as t, strlen(coalesce(text, '')) as n
  from documents),
starts as (
  select r, i, md5(t[i:i + 399]) as g from (select r, t, unnest(range(1, n - 398)) as i from d where n >= 400)),
again as (select g from starts group by g having count(*) > 1),
marked as (select r, i from starts where g in (select g from again)),
numbered as (
  select r, i, sum(opens) over (partition by r order by i) as run
  from (select r, i, case when i - 400 <= lag(i) over (partition by r order by i) then 0 else 1 end as opens
        from marked)),
runs as (select r, min(i) as first, max(i) + 399 as last from numbered group by r, run),
cut as (
  select r, first, last, coalesce(lag(last) over (partition by r order by first), 0) as before from runs),
kept as (
  select r, count(*) as n_spans, sum(last - first + 1) as n_removed,
    string_agg(case when before + 1 < first then hex(t[before + 1:first - 1]) else '' end, '' order by first)
      || case when max(last) < max(n) then hex(max(t)[max(last) + 1:max(n)]) else '' end as rest
  from cut join d using (r) group by r)
select doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(rest, hex(t)))) as kept_sha256,
  n - cast(coalesce(n_removed, 0) as bigint) as n_kept
from d left join kept using (r)"""


def _fits(h: str, p: str) -> str:
    return f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"


def _longest() -> list[tuple[str, str, str]]:
    return sorted(RULES, key=lambda rule: -len(rule[1] + rule[2]))


_RULE = "case " + " ".join(f"when {_fits(h, p)} then '{h}{p}'" for _, h, p in _longest()) + " end"
_OWN = "case " + " ".join(f"when {_fits(h, p)} then '{v}'" for v, h, p in _longest()) + " end"

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _address(url: str) -> str:
    return (
        f"{_LOWER.format(f'regexp_extract({url}, $p${_PARTS}$p$, 1)')} as host,"
        f" regexp_extract({url}, $p${_PARTS}$p$, 2) as path,"
        rf" list_filter(string_split(regexp_extract({url}, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),"
        " lambda x: x <> '' and not starts_with(x, 'utm_')) as words"
    )


_NODE = """case when contains(url, '://') then regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/$', '')
    || case when len(words) > 0 then '?' || array_to_string(words, '&') else '' end end"""

_TARGETS = r"""
  select url, origin, scheme, regexp_extract(regexp_extract(html,
    '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) as x from p
  union all
  select url, origin, scheme, regexp_extract(regexp_extract(html,
    '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) from p"""

URLS = rf"""
with recursive p as (
  select url, html, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) as origin,
    regexp_extract(url, '(?s)^(.*?:)//', 1) as scheme from pages where contains(url, '://')),
targets as ({_TARGETS}),
links as (
  select url, case when starts_with(x, '//') then scheme || x when starts_with(x, '/') then origin || x
    when contains(x, '://') then x end as target from targets),
addresses as (
  select *, {_NODE} as node, {_OWN} as own from (
    select url, {_address('url')} from (
      select url from p union select target from links where target is not null))),
edges as (
  select distinct a.node as a, b.node as b from links l
  join addresses a on a.url = l.url join addresses b on b.url = l.target where a.node <> b.node),
both_ways as (select a, b from edges union select b, a from edges),
reached as (
  select distinct node, node as other from addresses
  union
  select r.node, e.b from reached r join both_ways e on e.a = r.other),
told as (
  select r.node, bool_or(own = 'allow') as allowed, bool_or(own = 'block') as blocked
  from reached r join addresses o on o.node = r.other group by r.node),
judged as (
  select page_id, coalesce(host, '') as host, coalesce(path, '') as path, {_NODE} as node
  from (select page_id, url, {_address('url')} from pages))
select page_id, host, path, {_RULE} as rule,
  coalesce({_OWN}, case when allowed then 'allow' when blocked then 'block' end, 'allow') as verdict
from judged left join told using (node)"""


RANKING = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
b as (select row_number() over () as q, item_id, {_WORDS} as w from benchmark),
asked as (select q, unnest(w) as term from b),
total as (select count(*) as docs, cast(sum(len(w)) as bigint) as terms from d where len(w) > 0),
found as (
  select r, term, count(*) as tf from (select r, unnest(w) as term from d)
  where term in (select term from asked) group by r, term),
weights as (
  select term, cast(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) as bigint) as weight
  from found, total group by term),
parts as (
  select r, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(w) * docs) // terms))) as part
  from found join weights using (term) join d using (r), total),
scores as (
  select q, r, cast(sum(part) as bigint) as score from asked join parts using (term) group by q, r),
ranked as (
  select q, doc_id, score, row_number() over (partition by q order by score desc, doc_id) as n
  from scores join d using (r) where score > 0)
select item_id, cast(n as integer) as rank, doc_id, score from ranked join b using (q) where n <= 20"""


def oracle() -> dict[str, str]:
    return {"op3_decontaminate": DECONTAMINATE, "op4_repeats": REPEATS, "op5_urls": URLS, "op12_ranking": RANKING}
