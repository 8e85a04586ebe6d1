"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

from snapdelta.llm.common import LOWER, UPPER
from snapdelta.llm.quality_rules import STOP_WORDS
from snapdelta.llm.url_filters import BASE, CANONICAL, HREF, REFRESH, UNSEEN, VALUE

WORDS = r"list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t, {WORDS.format(text="text")} as w from documents
), g as (
  select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win
  from (select rid, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)
), r as (
  select rid, i from (select rid, i, count(*) over (partition by rid, win) as n from g) where n > 1
), c as (
  select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from r) group by rid
), l as (
  select rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls,
    list_filter(w, lambda x: list_contains([{", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))}], lower(x))) as st from d
), m as (
  select d.doc_id, len(d.w)::bigint as n_words, coalesce(list_sum(list_transform(d.w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    length(regexp_replace(t, '[^!?]', '', 'g'))::bigint as n_marks, len(l.st) as n_stop, len(l.ls) as n_lines,
    (len(l.ls) - len(list_distinct(l.ls)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
  from d join l using (rid) left join c using (rid)
), b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars between 2 * n_words and 14 * n_words and n_symbols / n_words <= 0.3
  and n_marks / n_words <= 0.5 and n_stop / n_words >= 0.02 and n_dup_lines / n_lines <= 0.5 as kept
from b
"""



def _parts(url: str) -> str:
    """Host and path of a url, as a struct."""
    pattern = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
    host = f"translate(coalesce(regexp_extract({url}, {pattern}, 1), ''), '{UPPER}', '{LOWER}')"
    return f"struct_pack(host := {host}, path := coalesce(regexp_extract({url}, {pattern}, 2), ''))"


def _rule(host: str, path: str) -> str:
    """The fitting rule, longest first."""
    fits = lambda h, p: f"({host} = '{h}' or ends_with({host}, '.{h}')) and starts_with({path}, '{p}')"
    rules = (("example.net", "/en/"), ("example.com", "/de/"), ("org", "/fr/"), ("net", "/"))
    return "case " + " ".join(f"when {fits(h, p)} then '{h}{p}'" for h, p in rules) + " end"


_VERDICT = "case {rule} when 'example.net/en/' then 'allow' when 'org/fr/' then 'allow' when 'example.com/de/' then 'block' when 'net/' then 'block' end"


def _resolved(target: str, near: str) -> str:
    """A link's target beside the struct of host and path that it stands in; null for other schemes without ``//``."""
    own = f"'http://' || {near}.host"
    folder = f"coalesce(nullif(regexp_extract({near}.path, '(?s)^.*/'), ''), '/')"
    return f"""case when {target} = '' then null when regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*://') or starts_with({target}, '://') then {target}
      when regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*:') then null when starts_with({target}, '//') then 'http:' || {target}
      when starts_with({target}, '/') then {own} || {target} when regexp_matches({target}, '^[?#]') then {own} || {near}.path || {target}
      else {own} || {folder} || {target} end"""


def _node(parts: str) -> str:
    """Host and path of a page, without the path's segments ``.`` and ``..``."""
    step = "case when x[1] = '..' then so_far[1:greatest(len(so_far) - 1, 0)] when x[1] = '.' then so_far else list_concat(so_far, x) end"
    left = f"list_reduce(list_prepend([]::varchar[], list_transform(string_split({parts}.path, '/')[2:], lambda x: [x])), lambda so_far, x: {step})"
    end = f"case when regexp_matches({parts}.path, '/\\.\\.?$') and len({left}) > 0 then '/' else '' end"
    path = f"case when {parts}.path = '' then '/' when regexp_matches({parts}.path, '/\\.\\.?(/|$)') then '/' || array_to_string({left}, '/') || {end} else {parts}.path end"
    return f"case when {parts}.host <> '' then {parts}.host || {path} end"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _targets(tag: str, attribute: str) -> str:
    return f"list_transform(regexp_extract_all(m, {_text(tag)}), lambda x: regexp_extract(x, {_text('(?i)' + attribute + VALUE)}, 1))"


#: Every refresh and canonical link of a page is an edge, as in the query; the patterns are the same, the closure is its own.
OP3 = rf"""
with recursive t as (
  select row_number() over () as rid, page_id, {_parts("coalesce(url, '')")} as p, coalesce(regexp_replace(html, {_text(UNSEEN)}, ' ', 'g'), '') as m from pages
), v as (
  select *, regexp_extract(regexp_extract(m, {_text(BASE)}), {_text('(?i)' + HREF + VALUE)}, 1) as base from t
), near as (select *, {_resolved("base", "p")} as full_base from v),
u as (
  select rid, case when full_base is null then p else {_parts("full_base")} end as p,
    unnest(list_concat({_targets(REFRESH, r"\burl")}, {_targets(CANONICAL, HREF)})) as raw from near
), k as (select rid, p, replace(raw, '&amp;', '&') as target from u),
q as (select rid, {_resolved("target", "p")} as full_target from k),
y as (select rid, {_parts("full_target")} as p from q where full_target is not null),
n as (select rid, page_id, p.host as host, p.path as path, {_rule("p.host", "p.path")} as rule, {_node("p")} as node from t),
d as (select n.node as a, {_node("y.p")} as b from n join y using (rid)),
e as (select a, b from d where a is not null and b is not null union select b, a from d where a is not null and b is not null),
r(a, b) as (select a, a from e union select r.a, e.b from r join e on r.b = e.a),
g as (
  select a, bool_or({_VERDICT.format(rule="rule")} = 'allow') as allows, bool_or({_VERDICT.format(rule="rule")} = 'block') as blocks
  from (select a, {_rule("split_part(b, '/', 1)", "substr(b, strpos(b, '/'))")} as rule from r) group by a
)
select page_id, host, path, rule,
  coalesce({_VERDICT.format(rule="rule")}, case when blocks and not coalesce(allows, false) then 'block' else 'allow' end) as verdict
from n left join g on node = a
"""

OP9 = rf"""
with recursive d as (
  select row_number() over () as rid, doc_id, {WORDS.format(text=f"translate(text, '{UPPER}', '{LOWER}')")} as w from documents
), s as (
  select distinct rid, case when len(w) >= 3 then w[i:i + 2] else w end as sh
  from (select rid, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from d where len(w) > 0)
), n as (select rid, count(*) as n from s group by rid),
o as (select a.rid as a, b.rid as b, count(*) as c from s a join s b on a.sh = b.sh and a.rid <> b.rid group by 1, 2),
l as (select a, b from o join n x on x.rid = a join n y on y.rid = b where 100 * c >= 90 * (x.n + y.n - c)),
r(a, b) as (select rid, rid from d union select r.a, l.b from r join l on r.b = l.a),
m as (select r.a as rid, min(doc_id) as component_id from r join d on d.rid = r.b group by r.a)
select doc_id, coalesce(n.n, 0) as n_shingles, component_id from d left join n using (rid) join m using (rid)
"""

ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(upper=UPPER, lower=LOWER)
OP10 = rf"""
with d as (select row_number() over () as rid, doc_id, {ITEM_WORDS} as w from documents),
b as (select item_id, {ITEM_WORDS} as w from benchmark),
i as (
  select distinct item_id::varchar as item, size, w[j:j + size - 1] as win from (
    select item_id, w, least(10, len(w)) as size, unnest(range(1, len(w) - least(10, len(w)) + 2)) as j from b where len(w) > 0)
), p as (
  select rid, size, j, w[j:j + size - 1] as win from (
    select rid, w, size, unnest(range(1, len(w) - size + 2)) as j
    from d join (select distinct size from i) on len(w) >= size)
), h as (select rid, j, p.size, item from p join i on p.size = i.size and p.win = i.win),
c as (select rid, count(distinct k) as n_hit from (select rid, unnest(range(j, j + size)) as k from h) group by rid),
t as (
  select rid, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct rid, item from h where item is not null) group by rid
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (rid) left join t using (rid)
"""

FINITE = "len(list_filter(embedding::double[], lambda x: x is null or not isfinite(x))) = 0"
#: Exact links; the query may miss a few of those just above the threshold, of which the given tables have none.
OP11 = f"""
with recursive e as (select row_number() over () as rid, vec_id, embedding from embeddings),
ok as (select rid, vec_id, embedding::double[] as v from e where embedding is not null and {FINITE} and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as materialized (
  select a.rid as a, b.rid as b from ok a join ok b on a.rid <> b.rid
  where case when len(a.v) = len(b.v) then list_cosine_similarity(a.v, b.v) else -1 end >= 0.95
), r as (select rid as a, rid as b from e union select r.a, l.b from r join l on l.a = r.b),
c as (select a, min(vec_id) as component_id from r join e on e.rid = r.b group by a),
n as (select a, count(*) as n from l group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, component_id is not distinct from vec_id as kept
from e join c on c.a = e.rid left join n on n.a = e.rid
"""


def _codes() -> str:
    """Lloyd's rounds written out: every part with every entry, the least (distance, index)."""
    far = "list_sum(list_transform(range(1, len(p.part) + 1), lambda j: (p.part[j] - b.entry[j]) * (p.part[j] - b.entry[j])))::bigint"
    sql = f"""
with k as (
  select row_number() over () as rid, vec_id, label, list_transform(embedding::double[], lambda x: floor(256 * x)::bigint) as q
  from embeddings where embedding is not null and len(embedding) > 0 and {FINITE}
), o as (select *, row_number() over (order by vec_id nulls last, q) - 1 as e from k),
s as (select * from o where len(q) = (select len(q) from o where e = 0)),
p as materialized (select rid, i, q[i * (len(q) // 16) + 1:(i + 1) * (len(q) // 16)] as part from s, range(16) t(i)),
b0 as (select i, row_number() over (partition by i order by o.e) - 1 as e, p.part as entry from p join o using (rid) qualify e < 64)"""
    for n in range(3):
        sql += f""",
a{n} as materialized (
  select rid, i, min(d) as d, arg_min(e, (d, e)) as e from (select p.rid, p.i, b.e, {far} as d from p join b{n} b on p.i = b.i) group by rid, i)"""
        if n < 2:
            sql += f""",
b{n + 1} as materialized (
  select b.i, b.e, coalesce(m.entry, b.entry) as entry from b{n} b left join (
    select i, e, list(((s - ((s % n + n) % n)) // n)::bigint order by j) as entry
    from (select i, e, j, sum(part[j])::bigint as s, count(*) as n from a{n} join p using (rid, i), range(1, len(part) + 1) t(j) group by i, e, j) group by i, e
  ) m using (i, e))"""
    return sql + """,
c as (select rid, string_agg(printf('%02x', e), '' order by i) as code, sum(d)::bigint as error from a2 group by rid)
select s.vec_id, c.code, c.error, (sum(c.error) over (partition by s.label))::bigint as label_error,
  (select sha256(string_agg(x::varchar, ',' order by i, e, j)) from (select i, e, unnest(entry) as x, unnest(range(1, len(entry) + 1)) as j from b2)) as codebooks_sha256
from s join c using (rid)
"""


#: The reversed polynomial and the start value of CRC-32.
CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
OP13 = f"""
with t as (
  select c, row_number() over (partition by c order by turn nulls first, r, x) as p, r, x
  from (select conv_id::bigint as c, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null)
), h as (select c, {CRC} % 6 as h from (select distinct c from t)),
w as (
  select h.c, 1 as own, p, r, x from h join t using (c) where p > h
  union all select h.c, 0, p, r, x from h join t on t.c = h.c - h.c % 100 where p <= h
), s as (select h.c, coalesce(l, []) as l from h left join (select c, list((r, x) order by own, p) as l from w group by c) using (c)),
m as (select c, d, l[1:d] as k, d = len(l) as ends from (select c, l, unnest(range(0, len(l) + 1)) as d from s)),
n as materialized (
  select d, k, count(*) as n, min(c) as c, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as sha from m group by d, k
), f as (select d - 1 as d, k[1:d - 1] as k, count(*) as n from n where d > 0 group by all),
g as (
  select u as d, k[1:u] as k, sum(leaf)::bigint as leaves, sum(saved)::bigint as saved from (
    select n.k, unnest(range(0, n.d + 1)) as u, (f.n is null)::bigint as leaf, case when n.d > 0 then (n.n - 1) * length(n.k[n.d][2]) else 0 end as saved
    from n left join f on f.d = n.d and f.k = n.k) group by all
)
select n.c as conv_id, n.d as depth, a.c as parent_conv_id, n.n as n_convs, coalesce(f.n, 0) as n_children, g.leaves as n_leaves,
  g.saved as saved_tokens, n.sha as ends_sha256
from n join g on g.d = n.d and g.k = n.k left join f on f.d = n.d and f.k = n.k left join n a on a.d = n.d - 1 and a.k = n.k[1:n.d - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": OP1,
        "op3_url_filters": OP3,
        "op9_ngram_jaccard_join": OP9,
        "op10_decontamination": OP10,
        "op11_lattice_dedup": OP11,
        "op12_vector_codes": _codes(),
        "op13_prefix_trie": OP13,
    }
