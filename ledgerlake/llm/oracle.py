"""DuckDB SQL for the queries that SQL can express.  Values of the contract and the templates are written out here, not
imported from the operators."""

from __future__ import annotations

_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP3 = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) as bigint) size from documents),
s as (
  select source, cast(sum(size) as bigint) total,
    cast([1, 2, 3][1 + (row_number() over (order by source nulls last) - 1) % 3] as double) w
  from d group by source),
c as (select *, 3.0::double * total cap from s),
o as (
  select *, row_number() over (order by cap / w, source nulls last) k,
    coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0) caps,
    sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) open_w,
    cast(sum(total) over () as double) every from c),
l as (select k, (every - caps) / open_w level from o where cap / w > (every - caps) / open_w order by k limit 1),
t as (
  select source, total source_size, case when k >= (select k from l) then least((select level from l) * w, cap) else cap end target,
    cast('0x' || substr(md5('7|' || coalesce('=' || source, 'null')), 1, 5) as bigint) / 1048576.0::double u from o),
r as (
  select d.*, source_size, target, u, case when source_size > 0 then target / source_size else 0 end rate,
    row_number() over (partition by d.source order by size, doc_id nulls first) - 1 place, count(*) over (partition by d.source) n
  from d join t on d.source is not distinct from t.source),
b as (select *, least(case when rate - floor(rate) > 0 then greatest(round(1 / (rate - floor(rate))), 1) else 1 end, n) m from r),
p as (
  select *, case when floor(place / m) % 2 = 1 and (floor(place / m) + 1) * m <= n
    then (2 * floor(place / m) + 1) * m - 1 - place else place end x from b),
z as (select *, cast(least(floor(u + rate * (x + 1)) - floor(u + rate * x), 3) as bigint) copies from p)
select doc_id, source, size, source_size, target, copies, size * copies taken from z"""

OP5 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
  select *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') esc_text,
    regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') esc_role,
    lag(role) over (partition by conv_id order by turn nulls first, role, text) is distinct from role new_run from c),
g as (
  select conv_id, count(*) n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) turns,
    coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '') loss,
    3 + sum(length(esc_text) + 4 + case when new_run then 13 + length(esc_role) else 0 end) chars
  from e group by conv_id)
select conv_id, n_turns, sha256(turns) turns_sha256, cast(length(loss) as bigint) loss_chars, sha256(loss) loss_sha256,
  cast(chars as bigint) formatted_chars from g"""

OP7 = """
select doc_id, max(doc_id) over same keep_id, count(*) over same group_size, doc_id = max(doc_id) over same kept,
  sha256(coalesce(text, '')) text_sha256
from documents window same as (partition by coalesce(text, ''))"""

# label -> words, mandatory places
_PHRASES = {
    "cc-by": ("cc by", range(2)), "gpl": ("general public license", range(3)), "reserved": ("all rights reserved", range(3)),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", range(2, 7)),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", range(2, 7)),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", range(6, 12)),
    "apache-2.0": ("licensed under the apache license version 2 0", range(3, 8)),
    "mit": ("released under the mit license", range(3, 5)),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",
            [*range(8), 11, 12, 13]),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", range(6, 9)),
}


def _op8() -> str:
    found = []
    for label, (notice, must) in _PHRASES.items():
        words = notice.split()
        at = lambda i: f"(case when s + {i} >= 0 then w[s + {i} + 1] end)"
        verify = " and ".join(f"coalesce({at(i)} = '{words[i]}', false)" for i in must)
        share = " + ".join(f"coalesce(cast({at(i)} = '{x}' as int), 0)" for i, x in enumerate(words))
        # a start may lie before the text when only words outside the mandatory phrase are cut off
        found.append(f"select id, '{label}' label, s, ({share}) / {len(words)}.0::double matched from (select id, w, "
                     f"unnest(range(-{len(words)}, len(w))) s from d) where {verify}")
    return rf"""
with d as (
  select row_number() over () id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', '{_Z}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
m as ({" union all ".join(found)}),
a as (
  select id, count(*) filter (label in ('cc-by', 'gpl', 'reserved')) n_base, max(matched) score,
    min(s) filter (label in ('cc-by', 'gpl', 'reserved')) first_word,
    max(s) filter (label in ('cc-by', 'gpl', 'reserved')) last_word,
    string_agg(distinct label, ',' order by label) filter (label in ('cc-by', 'gpl', 'reserved')) base_labels,
    string_agg(distinct label, ',' order by label) labels from m group by id)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_base, 0) n_base, first_word, last_word,
  coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0) score
from d left join a using (id)"""


OP10 = rf"""
with p as (
  select page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), '{_A}', '{_Z}') host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') path from pages),
c as (
  select *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html)?/*$', '') canonical,
    case when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
         when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
         when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
         when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
         when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end rule from p),
l as (
  select distinct canonical from c
  where regexp_matches(host, '(^|\.)(adult-x|ads-track|free-bets|casino-win|spam-farm|cheap-pills)\.'))
select page_id, host, path, rule,
  case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
       when host <> '' and canonical in (select canonical from l) then 'block' else 'allow' end verdict from c"""

OP11 = r"""
with t as (
  select conv_id c, turn, strlen(coalesce(text, '')) n,
    substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) id
  from conversations where conv_id is not null),
o as (select c, list({'id': id, 'n': n} order by turn nulls first, id, n) l from t group by c),
k as (
  select c, l, xor(4294967295::bigint, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::bigint)))) % 9 h
  from o),
s as (select k.c, list_concat(coalesce(o.l[:h], []), k.l[h + 1:]) q from k left join o on o.c = k.c - k.c % 5),
p as (select c, d, q[:d] p, len(q) = d e from (select c, q, unnest(range(len(q) + 1)) d from s)),
m as (
  select p, d, min(c) conv_id, count(*) n_convs,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (e), '')) ends_sha256 from p group by p, d),
h as (select p[:d - 1] p, count(*) n_children from m where d > 0 group by all),
v as (
  select m.p, m.d, coalesce(n_children, 0) = 0 leaf, case when m.d > 0 then (n_convs - 1) * m.p[m.d].n else 0 end saved
  from m left join h on h.p = m.p),
u as (
  select p[:k] p, k, count(*) filter (leaf) n_leaves, sum(saved) saved_tokens
  from (select *, unnest(range(d + 1)) k from v) group by all)
select m.conv_id, m.d::bigint depth, b.conv_id parent_conv_id, m.n_convs, coalesce(h.n_children, 0) n_children, u.n_leaves,
  u.saved_tokens::bigint saved_tokens, m.ends_sha256
from m left join m b on m.d > 0 and b.p = m.p[:m.d - 1] and b.d = m.d - 1 left join h on h.p = m.p
  join u on u.p = m.p and u.k = m.d"""

OP12 = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', '{_Z}'), '[^ \t-\r]+') w from documents),
d as (
  select doc_id, list_sort(list_distinct(case when len(w) >= 3 then
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) s from w),
k as (select s, min(doc_id) node, len(s) n from d where len(s) > 0 group by s),
x as (select node, n, unnest(s) x from k),
l as (
  select a.node a, b.node b from x a join x b on a.x = b.x and a.node < b.node
  where 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e as (select a, b from l union all select b, a from l),
r as (select node, node other from k union select r.node, e.b from r join e on e.a = r.other),
c as (select node, min(other) component from r group by node)
select doc_id, len(d.s)::bigint n_shingles, coalesce(component, doc_id) component_id
from d left join k on k.s = d.s left join c using (node)"""


OP13 = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
    list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id anchor_id, a.label anchor_label, e.vec_id, e.label, list_inner_product(a.v, e.v)::bigint score
  from e a, e where a.vec_id % 100 = 0 and a.vec_id <> e.vec_id),
p as (
  select anchor_id, vec_id positive_id, score positive_score from s where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select anchor_id, positive_id, s.vec_id negative_id, positive_score, score negative_score,
    row_number() over (partition by anchor_id, positive_id order by score desc, s.vec_id) r
  from p join s using (anchor_id)
  where s.label <> s.anchor_label and 100 * score between 30 * positive_score and 90 * positive_score)
select anchor_id, positive_id, r::int as rank, negative_id, positive_score, negative_score from n where r <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mix_sources": OP3, "op5_chat_format": OP5, "op7_exact_dedup": OP7, "op8_license_scan": _op8(),
            "op10_url_filter": OP10, "op11_prefix_trie": OP11,
            "op12_jaccard_join": OP12, "op13_hard_negatives": OP13}
