"""The queries of the llm operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from .collocations import op13_collocations
from .conversation_trie import op12_conversation_trie
from .decontaminate import op4_decontaminate
from .embedding_dedup import op3_embedding_dedup
from .jaccard_join import op6_jaccard_join
from .language_id import op1_language_id
from .mixing import op2_mixing
from .pivot_topk import op11_exact_topk
from .quality import op7_quality
from .secrets import op8_secret_scan
from .sharding import op5_sharding
from .substring_dedup import op10_substring_dedup
from .url_filter import op9_url_filter

QUERIES = {f.__name__: f for f in (op1_language_id, op2_mixing, op3_embedding_dedup, op4_decontaminate, op5_sharding, op6_jaccard_join, op7_quality, op8_secret_scan, op9_url_filter, op10_substring_dedup, op11_exact_topk, op12_conversation_trie, op13_collocations)}

ORACLE_SQL: dict[str, str] = {
    "op3_embedding_dedup": """
with recursive v as (
  select vec_id, row_number() over () as rid, label, list_transform(embedding, lambda x: x::double) as e,
    embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0 as fit
  from embeddings),
links as (
  select a.rid as a, b.rid as b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.rid <> b.rid
  where a.fit and b.fit and list_cosine_similarity(case when a.fit then a.e else [1.0] end, case when a.fit and b.fit then b.e else [1.0] end) >= 0.98),
reach(a, b) as (select rid, rid from v union select reach.a, links.b from reach join links on links.a = reach.b),
least as (select a, min(vec_id) as component_id from reach join v on v.rid = reach.b group by a),
n as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from v join least on least.a = v.rid left join n on n.a = v.rid""",
    "op4_decontaminate": r"""
with d as (
  select doc_id, row_number() over () as rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
i as (
  select item_id, row_number() over () as item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
phrases as (
  select distinct item_id, item, m, unnest(list_transform(range(1, len(w) - m + 2), lambda p: array_to_string(w[p:p + m - 1], ' '))) as phrase
  from (select *, least(13, len(w)) as m from i) where m > 0),
spots as (select rid, w, m, unnest(range(1, len(w) - m + 2)) as p from d, (select distinct m from phrases) where len(w) >= m),
found as (select rid, p, spots.m, item_id from spots join phrases on phrases.m = spots.m and phrase = array_to_string(w[p:p + spots.m - 1], ' ')),
hit as (select rid, count(distinct pos) as n_hit from (select rid, unnest(range(p, p + m)) as pos from found) group by rid),
items as (
  select rid, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct rid, item_id::varchar as id from found) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit on hit.rid = d.rid left join items on items.rid = d.rid""",
    "op6_jaccard_join": r"""
with recursive d as (
  select doc_id, row_number() over () as rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select rid, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) end) as s
  from d),
e as (select rid, len(s) as n, unnest(s) as x from s),
links as (
  select a, b from (select a.rid as a, b.rid as b, a.n as na, b.n as nb, count(*) as common from e a join e b on a.x = b.x and a.rid <> b.rid group by all)
  where 100 * common >= 80 * (na + nb - common)),
reach(a, b) as (select rid, rid from d union select reach.a, links.b from reach join links on links.a = reach.b),
least as (select a, min(doc_id) as component_id from reach join d on d.rid = reach.b group by a)
select doc_id, len(s)::bigint as n_shingles, component_id from d join s on s.rid = d.rid join least on least.a = d.rid""",
    "op10_substring_dedup": r"""
with d as (select doc_id, row_number() over () as rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
spots as (select rid, unnest(range(1, len(w) - 33)) as p, w from d where len(w) >= 35),
h as (select rid, p, md5(array_to_string(w[p:p + 34], ' ')) as h from spots),
again as (select rid, p from h qualify count(*) over (partition by h) > 1),
gone as (select distinct rid, unnest(range(p, p + 35)) as i from again),
words as (select rid, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d),
kept as (
  select words.rid, string_agg(word, ' ' order by words.i) as kept from words left join gone on gone.rid = words.rid and gone.i = words.i
  where gone.i is null group by words.rid),
n as (select rid, count(*) as n from gone group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join n on n.rid = d.rid left join kept on kept.rid = d.rid""",
    "op11_exact_topk": """
with v as (
  select vec_id, row_number() over () as rid, list_transform(embedding, lambda x: floor(x::double * 256)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (
  select q.vec_id as query_id, q.rid as qrid, c.vec_id, c.rid, case when len(q.e) = 0 then 0 else list_inner_product(q.e, c.e) end::bigint as score
  from v q join v c on len(q.e) = len(c.e) and q.rid <> c.rid where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by qrid order by score desc, vec_id nulls last, rid) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5""",
    "op12_conversation_trie": """
with t as (
  select conv_id as c, md5(strlen_role || ':' || role || text) as digest, length(text) as cp,
    row_number() over (partition by conv_id order by turn nulls first, md5(strlen_role || ':' || role || text)) as d
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, length(coalesce(role, ''))::varchar as strlen_role
        from conversations where conv_id is not null)),
convs as (
  select c, c - c % 100 as b, xor(list_reduce(
      list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint),
      lambda a, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(a, x)),
      4294967295::bigint), 4294967295::bigint) % 6 as h
  from (select distinct c from t)),
size as (select c as b, count(*) as n from t group by c),
r as (
  select convs.c, t.d, digest, cp from convs join t on t.c = convs.b and t.d <= convs.h
  union all
  select convs.c, least(h, coalesce(n, 0)) + t.d - h, digest, cp from convs join t on t.c = convs.c and t.d > convs.h left join size on size.b = convs.b),
path as (
  select c, 0 as d, '' as key, '' as parent, 0 as cp from convs
  union all
  select c, d, string_agg(digest, '') over (partition by c order by d), coalesce(string_agg(digest, '') over (partition by c order by d rows between unbounded preceding and 1 preceding), ''), cp from r),
nodes as (select d, key, any_value(parent) as parent, any_value(cp) as cp, count(*) as n, min(c) as least from path group by d, key),
kids as (select parent as key, count(*) as n_children from nodes where d > 0 group by parent),
full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids on kids.key = nodes.key),
subtree as (
  select path.key, sum((n_children = 0)::bigint) as n_leaves, sum((n - 1) * u.cp) as saved
  from full_nodes u join path on path.c = u.least and path.d <= u.d group by path.key),
ends as (
  select key, string_agg(c::varchar, ',' order by c) as ids
  from (select c, arg_max(key, d) as key from path group by c) group by key)
select v.least as conv_id, v.d::bigint as depth, p.least as parent_conv_id, v.n as n_convs, v.n_children, n_leaves::bigint as n_leaves,
  saved::bigint as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from full_nodes v join subtree on subtree.key = v.key left join nodes p on v.d > 0 and p.key = v.parent left join ends on ends.key = v.key""",
    "op13_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
w as (select lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') as w from pieces),
g as (
  select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
  from w, (values (1), (2), (3), (4)) t(m) where len(w) >= m),
f as (select lang, phrase, m, count(*) as f from g group by all),
totals as (select lang, sum(f)::bigint as n from f where m = 1 group by lang),
c as (select lang, phrase, m, f as a, string_split(phrase, ' ') as w from f where m > 1 and f >= 30),
cuts as (
  select lang, phrase, a, k, array_to_string(w[1:k], ' ') as first, array_to_string(w[k + 1:], ' ') as rest
  from c, (values (1), (2), (3)) t(k) where k < m),
scored as (
  select cuts.*, x.f as l, y.f as r, ((2000000::hugeint * a) // (x.f + y.f))::bigint as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = first join f y on y.lang = cuts.lang and y.phrase = rest),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, part, max(a) as longer from (
    select lang, a, array_to_string(w[s:s + q - 1], ' ') as part
    from c, (values (2), (3)) t(q), (values (1), (2), (3)) u(s) where q < m and s + q - 1 <= m)
  group by lang, part),
ranked as (
  select weakest.*, row_number() over (partition by weakest.lang order by score desc, a desc, phrase) as rank
  from weakest left join inside on inside.lang = weakest.lang and part = phrase
  where longer is null or 100 * longer < 80 * a)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join totals on totals.lang = ranked.lang where rank <= 2000""",
}
