"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from stratum.llm.centroid_clustering import LIMIT
from stratum.llm.language_id import PROFILE_SIZE
from stratum.llm.quality_rules import CUTOFFS, DELTA, RISKS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, list_sort(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end) as s
  from words),
classes as (select min(doc_id) as c, s as same, len(s) as n from sets where len(s) > 0 group by s),
member as (select sets.doc_id, classes.c from sets join classes on sets.s = classes.same),
shingles as (select c, n, unnest(same) as x from classes),
pairs as (
  select a.c as a, b.c as b, count(*) as shared, any_value(a.n) + any_value(b.n) as total
  from shingles a join shingles b on a.x = b.x and a.c < b.c group by a.c, b.c),
links as (
  select a, b from pairs where 100 * shared >= 75 * (total - shared)
  union select b, a from pairs where 100 * shared >= 75 * (total - shared)),
reach as (select c, c as r from classes union select reach.c, links.b from reach join links on reach.r = links.a),
least as (select c, min(r) as component_id from reach group by c)
select sets.doc_id, cast(len(sets.s) as bigint) as n_shingles, coalesce(component_id, sets.doc_id) as component_id
from sets left join member using (doc_id) left join least using (c)
"""

OP3 = r"""
with parts as (
  select page_id, url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
split as (
  select page_id, url, rest, translate(regexp_extract(rest, '^([^/?#]*)', 1),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
           lambda x: x <> '' and not starts_with(x, 'utm_') and not starts_with(x, 'ref='))) as fields
  from parts),
named as (
  select *, case when strpos(url, '://') > 0 then host || regexp_replace(path, '/+$', '') ||
         case when len(fields) > 0 then '?' || array_to_string(fields, '&') else '' end end as canon
  from split),
listed as (select distinct canon from named where canon is not null and page_id in
           (select doc_id from labels where toxic = 1)),
ruled as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from named)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
       when canon in (select canon from listed) then 'block' else 'allow' end as verdict
from ruled
"""


def op9(cutoffs=CUTOFFS, risks=RISKS, delta: float = DELTA) -> str:
    rules = {"symbols": "n_symbols / nullif(word_chars, 0)", "dup_lines": "n_dup_lines / nullif(n_lines, 0)",
             "repeats": "n_repeat_words / nullif(n_words, 0)", "capitals": "n_capitals / nullif(word_chars, 0)"}
    ratio = {r: f"coalesce(cast({x.split(' / ')[0]} as double) / {x.split(' / ')[1]}, 0)" for r, x in rules.items()}
    counts = ", ".join(f"count(*) filter ({ratio[r]} > {c}) as k_{r}_{i}"
                       for r in rules for i, c in enumerate(cutoffs))
    cuts = ", ".join("coalesce(" + ", ".join(f"case when k_{r}_{i} <= allowed then {c} end"
                                             for i, c in sorted(enumerate(cutoffs), key=lambda x: x[1]))
                     + f") as cut_{r}" for r in rules)
    passes = " and ".join(f"(cut_{r} is null or {ratio[r]} <= cut_{r})" for r in rules)
    level = f"{delta} / ({len(rules) * len(cutoffs)} * (select count(*) from counts))"
    risk = ("case " + " ".join(f"when n * ln(1 - {r}) <= ln({level}) then {r}" for r in sorted(risks))
            + f" else {max(risks)} end")
    return rf"""
with words as (
  select doc_id, lang, coalesce(text, '') as text, {_WORDS} as w, string_split(coalesce(text, ''), chr(10)) as all_lines
  from documents),
windows as (
  select doc_id, i, w[i:i + 2] as x, count(*) over (partition by doc_id, w[i:i + 2]) as c
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words where len(w) >= 3)),
covered as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows where c > 1)
  group by doc_id),
lines as (select doc_id, list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from words),
measured as (
  select words.doc_id, lang, cast(len(w) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, len(l) as n_lines,
    cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
    len(regexp_extract_all(text, '[A-Z]')) as n_capitals
  from words join lines using (doc_id) left join covered using (doc_id)),
based as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured),
good as (select doc_id from labels where doc_id is not null and quality is not null
         group by doc_id having bool_and(quality = 1)),
counts as (
  select lang, count(*) as n, {counts} from based where not base_failed and doc_id in (select doc_id from good)
  group by lang),
terms as (
  select lang, k, exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(risk) + (n - k) * ln(1 - risk)) as p
  from (select *, unnest(range(0, cast(ceil(n * risk) as bigint) + 2)) as k from (select lang, n, {risk} as risk from counts))
  where k <= n),
tails as (select lang, k, sum(p) over (partition by lang order by k) as cdf from terms),
level as (
  select counts.*, coalesce((select max(k) from tails where tails.lang is not distinct from counts.lang
    and cdf <= {level}), -1) as allowed from counts),
cuts as (select lang as cut_lang, {cuts} from level)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {passes} as kept
from based left join cuts on lang is not distinct from cut_lang
"""


def crc32(text: str) -> str:
    """crc32 of an ASCII text: the byte table from its rule, then one step a byte."""
    table = ("list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: "
             "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))")
    codes = f"list_transform(string_split({text}, ''), lambda ch: cast(ascii(ch) as bigint))"
    return (f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: "
            f"xor(c >> 8, ({table})[(xor(c, b) & 255) + 1])), 4294967295)")


def op10(size: int = PROFILE_SIZE) -> str:
    return rf"""
with docs as (
  select doc_id, lang, {crc32("cast(doc_id as varchar)")} % 5 = 0 as held_out,
    regexp_extract_all(lower(coalesce(text, '')), '\p{{L}}+') as w from documents),
words as (select doc_id, lang, held_out, chr(1) || x || chr(1) as x, length(x) as n
  from (select doc_id, lang, held_out, unnest(w) as x from docs)),
places as (select doc_id, lang, held_out, x, n, unnest(range(1, n + 2)) as i from words),
codes as (
  select doc_id, lang, held_out, i, n, cast(unicode(x[i]) as bigint) as a, cast(unicode(x[i + 1]) as bigint) as b,
    case when i <= n then cast(unicode(x[i + 2]) as bigint) end as c from places),
grams as (
  select doc_id, lang, held_out, b as g from codes where i <= n
  union all select doc_id, lang, held_out, a + (b << 21) from codes
  union all select doc_id, lang, held_out, a + (b << 21) + (c << 42) from codes where c is not null),
counts as (select doc_id, any_value(lang) as lang, any_value(held_out) as held_out, g, count(*) as n
  from grams group by doc_id, g),
own as (select doc_id, g, r, count(*) over (partition by doc_id) as m from (
  select doc_id, g, row_number() over (partition by doc_id order by n desc, g) - 1 as r from counts) where r < {size}),
profiles as (select * from (
  select lang, g, row_number() over (partition by lang order by sum(n) desc, g) - 1 as r
  from counts where not held_out and lang is not null group by lang, g) where r < {size}),
langs as (select distinct lang from profiles),
apart as (
  select own.doc_id, langs.lang, any_value(own.m) as m,
    sum(case when p.r is null then {size} else least(abs(p.r - own.r), {size}) end) as d
  from own cross join langs left join profiles p on p.lang = langs.lang and p.g = own.g group by own.doc_id, langs.lang),
best as (select doc_id, arg_min(lang, (d, lang)) as lang, min(d) as d, any_value(m) as m from apart group by doc_id)
select docs.doc_id, docs.held_out, coalesce(best.lang, 'und') as lang_pred,
  coalesce(1 - cast(best.d as double) / ({size} * best.m), 0) as score
from docs left join best using (doc_id)
"""


def op12(k: int = 40, rounds: int = 5, dims: int = 64, limit: int = LIMIT) -> str:
    """Plain Lloyd rounds: every vector against every centroid, one pair of steps a round."""
    square = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (p[i] - m[i]) * (p[i] - m[i])))"
    steps = [f"""
with kept as materialized (
  select row_number() over () as r, vec_id,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as p
  from embeddings where len(embedding) = {dims} and len(list_filter(embedding,
    lambda x: x is not null and isfinite(x) and abs(256 * cast(x as double)) < {limit})) = {dims}),
c0 as materialized (
  select row_number() over (order by h nulls last, p) - 1 as c, p as m
  from (select sha256('2:' || vec_id) as h, p from kept) qualify c < {k})"""]
    for t in range(rounds + 1):
        steps.append(f"""
a{t} as materialized (
  select r, any_value(vec_id) as vec_id, any_value(p) as p, arg_min(c, (d, c)) as c, min(d) as d
  from (select kept.*, c, {square} as d from kept cross join c{t}) group by r)""")
        if t < rounds:
            steps.append(f"""
c{t + 1} as materialized (
  select c, coalesce(n.m, c{t}.m) as m from c{t} left join (
    select c, list((s - (s % n + n) % n) // n order by i) as m
    from (select c, i, sum(x) as s, count(*) as n
          from (select c, unnest(p) as x, unnest(range(1, {dims + 1})) as i from a{t}) group by c, i)
    group by c) n using (c))""")
    return ",".join(steps) + f"""
select vec_id, cast(c as int) as cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(m, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (c)
"""


def op13(family: int = 100, heads: int = 6) -> str:
    """A node is the first 32 d digits of a conversation's digests; every node is set against its ancestors."""
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
digests as (select conv_id, turn, md5(length(role) || ':' || role || text) as g, length(text) as n from turns),
own as (
  select conv_id, list(g order by turn nulls first, g, n) as g, list(n order by turn nulls first, g, n) as n,
    {crc32("cast(conv_id as varchar)")} % {heads} as h
  from digests group by conv_id),
rebuilt as (
  select own.conv_id, list_concat(coalesce(a.g, [])[1:own.h], own.g[own.h + 1:]) as g,
    list_concat(coalesce(a.n, [])[1:own.h], own.n[own.h + 1:]) as n
  from own left join own a on a.conv_id = own.conv_id - own.conv_id % {family}),
paths as (select conv_id, array_to_string(g, '') as path, n, len(g) as size from rebuilt),
steps as (select conv_id, path, n, size, unnest(range(0, size + 1)) as depth from paths),
nodes as (
  select left(path, 32 * depth) as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
    any_value(case when depth > 0 then n[depth] else 0 end) as chars,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (depth = size), '')) as ends_sha256
  from steps group by left(path, 32 * depth), depth),
kids as (select left(node, length(node) - 32) as node, count(*) as n_children from nodes where depth > 0 group by 1),
counted as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (node)),
up as (select n_children, n_convs, chars, left(node, 32 * unnest(range(0, depth + 1))) as node from counted),
sums as (
  select node, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * chars) as saved_tokens from up group by node)
select c.conv_id, c.depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, sums.n_leaves,
  cast(sums.saved_tokens as bigint) as saved_tokens, c.ends_sha256
from counted c join sums using (node) left join nodes p on c.depth > 0 and p.node = left(c.node, length(c.node) - 32)
"""


ORACLE_SQL = {"op1_ngram_join": OP1, "op3_url_filter": OP3, "op9_quality_rules": op9(), "op10_language_id": op10(),
              "op12_centroid_clustering": op12(), "op13_conversation_trie": op13()}
