"""DuckDB SQL of the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"
TRAP = r"\### Assistant: </turn> ok"

OP5 = f"""
with d as (
    select row_number() over () as r, doc_id, regexp_extract_all({LOWER}, '{PLAIN}') as w from documents),
i as (
    select item_id::varchar as item, regexp_extract_all({LOWER}, '{PLAIN}') as w from benchmark
    where text is not null and item_id is not null),
sized as (select item, w, least(10, len(w)) as n from i where len(w) > 0),
item_windows as (
    select distinct item, n, array_to_string(w[k:k + n - 1], ' ') as g
    from (select item, w, n, unnest(range(1, len(w) - n + 2)) as k from sized)),
sizes as (select distinct n from sized),
doc_windows as (
    select r, k, n, array_to_string(w[k:k + n - 1], ' ') as g
    from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from d join sizes on len(w) >= n)),
hits as (select r, k, n, item from doc_windows join item_windows using (n, g)),
marked as (
    select r, count(distinct p) as n_hit from (select r, unnest(range(k, k + n)) as p from hits) group by r),
found as (
    select r, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct r, item from hits) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join marked using (r) left join found using (r)"""

OP6 = f"""
with recursive d as (
    select doc_id, regexp_extract_all({LOWER}, '{WORD}') as w from documents),
shingled as (
    select doc_id, case when len(w) >= 5
        then list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from d),
sizes as (select doc_id, len(s)::bigint as n from shingled),
tokens as (select doc_id, unnest(s) as t from shingled),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from tokens a join tokens b on a.t = b.t and a.doc_id < b.doc_id group by all),
links as (
    select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
    where 100 * c.n >= 85 * (x.n + y.n - c.n)),
both as materialized (select a, b from links union all select b, a from links),
reach(doc_id, place) as (
    select doc_id, doc_id from sizes union select r.doc_id, l.b from reach r join "both" l on l.a = r.place),
least_of as (select doc_id, min(place) as component_id from reach group by doc_id)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept
from sizes join least_of using (doc_id)""".replace("\nboth as", '\n"both" as')

OP9 = f"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '{TRAP}' union all select -7, 1, 'assistant', '{TRAP}'),
sized as (
    select *, 14 + length(role) + length(text)
        + length(regexp_replace(role || text, '[^\\\\#<]', '', 'g')) as chars from t)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), ''))
           as loss_sha256,
       sum(chars)::bigint as formatted_chars, count(*) filter (where role = 'assistant') as examples
from sized group by conv_id"""

OP11 = """
with d as (
    select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as id,
           hex(encode(coalesce(text, ''))) as h
    from documents),
-- pieces first: a place in a long string takes long to find
parts as (select r, id, k, h[2 * k + 1:2 * k + 698] as h
          from (select *, unnest(range(0, length(h) // 2 - 49, 300)) as k from d where length(h) >= 100)),
strings as (
    select r, id, k + j as k, h[2 * j + 1:2 * j + 100] as s
    from (select *, unnest(range(0, length(h) // 2 - 49)) as j from parts)),
gone as (
    select r, k from strings join (select s, min(id) as least from strings group by s having min(id) < max(id)) using (s)
    where least < id),
-- strings that follow each other closely remove one run of bytes
marked as (
    select r, k, case when k <= lag(k) over (partition by r order by k) + 50 then 0 else 1 end as opens from gone),
numbered as (select r, k, sum(opens) over (partition by r order by k) as g from marked),
spans as (select r, g, min(k) as a, max(k) + 50 as b from numbered group by r, g),
pieces as (
    select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as from_ from spans),
kept as (
    select r, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last,
           string_agg(h[2 * from_ + 1:2 * a], '' order by a) as h
    from pieces join (select r, h from d) using (r) group by r)
select doc_id, (length(d.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(case when n_spans is null then d.h else kept.h || d.h[2 * last + 1:] end)) as kept_sha256
from d left join kept using (r)"""

OP12 = """
with valid as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
r as (select distinct on (vec_id) * from valid order by vec_id, label, v),
scored as (
    select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id as id,
           list_sum(list_transform(range(1, len(a.v) + 1), lambda k: a.v[k] * r.v[k]))::bigint as score
    from r a join r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id and len(a.v) = len(r.v)),
p as (
    select anchor_id, id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (
    select anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
           row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank
    from p join scored using (anchor_id)
    where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""

OP13 = f"""
with recursive t as (
    select coalesce(doc_id, 9223372036854775807) as id, doc_id, coalesce(lang, '') as part, coalesce(text, '') as text
    from documents),
w as (select *, regexp_extract_all(text, '{WORD}') as words, min(id) over (partition by text) as least from t),
marks as (
    select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
d as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           [case when len(words) < 200 then 'A' end,
            case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' end,
            case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 'C' end,
            case when regexp_matches(text, '[#$%&*|]') then 'D' end,
            case when id > least then 'E' end] as f
    from w left join marks using (doc_id)),
sets as (
    select part, array_to_string(list_filter(f, lambda x: x is not null), '') as fails,
           count(*) as n, sum(good) as good, sum(toxic) as toxic
    from d group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter),
walks as (
    select '' as o union all select o || letter from walks join letters on not contains(o, letter)),
orders as (select o as filter_order from walks where length(o) = 5),
-- the step at which an order removes a failure set: the first of its letters
gone as (
    select part, filter_order, fails, n, good, toxic,
           list_min([instr(filter_order, x) for x in string_split(fails, '')]) as at
    from sets, orders where fails <> ''),
steps as (select distinct part, filter_order, unnest(range(1, 6)) as step from sets, orders),
totals as (select part, sum(n) as n from sets group by part),
found as (
    select s.part, s.filter_order, s.step,
           coalesce(sum(g.n) filter (where g.at <= s.step), 0) as dropped,
           coalesce(sum(g.n) filter (where g.at = s.step), 0) as removed,
           coalesce(sum(g.n) filter (where g.at < s.step and contains(g.fails, s.filter_order[s.step])), 0) as redundant,
           coalesce(sum(g.n) filter (where g.fails = s.filter_order[s.step]), 0) as unique_fails,
           coalesce(sum(g.good) filter (where g.at = s.step), 0) as good_lost,
           coalesce(sum(g.toxic) filter (where g.at = s.step), 0) as toxic_lost
    from steps s left join gone g on g.part = s.part and g.filter_order = s.filter_order
    group by s.part, s.filter_order, s.step)
select part, filter_order, step::int as step, (t.n - dropped)::bigint as kept, removed::bigint as removed,
       redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
       toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, filter_order[step]))::bigint as shapley
from found join totals t using (part)"""

ORACLE: dict[str, str] = {
    "op5_decontaminate": OP5,
    "op6_minmax_dedup": OP6,
    "op9_chat": OP9,
    "op11_suffix_dedup": OP11,
    "op12_hard_negatives": OP12,
    "op13_filter_audit": OP13,
}
