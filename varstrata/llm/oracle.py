"""SQL for the corpus queries that SQL can express, over whole tables."""

from __future__ import annotations

_WINDOW = 200
_WHITE = "[\\x20\\x09-\\x0D]+"

# texts as hexadecimal bytes, so that positions are bytes; a window is 200 of them
SUFFIX_DEDUP = f"""
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), w as (
  select doc_id, p, md5(substr(h, cast(2 * p + 1 as bigint), {2 * _WINDOW})) as k
  from (select doc_id, h, unnest(range(0, n - {_WINDOW - 1})) as p from d)
), r as (
  select doc_id, p from w where k in (select k from w group by k having count(*) > 1)
), g as (
  select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= {_WINDOW} then 0 else 1 end as first from r
), s as (
  select doc_id, min(p) as a, max(p) + {_WINDOW} as b
  from (select doc_id, p, sum(first) over (partition by doc_id order by p) as span from g) group by doc_id, span
), c as (
  select s.*, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from s
), k as (
  select doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last,
    string_agg(substr(h, cast(2 * before + 1 as bigint), cast(2 * (a - before) as bigint)), '' order by a) as kept
  from c join d using (doc_id) group by doc_id
)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, cast(2 * coalesce(last, 0) + 1 as bigint)))) as kept_sha256
from d left join k using (doc_id)
"""

EMBEDDING_NEAR_DEDUP = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as x from embeddings
  where label is not null and len(embedding) > 0 and not list_contains(list_transform(embedding, lambda c: coalesce(isfinite(c), false)), false)
    and list_sum(list_transform(embedding, lambda c: abs(cast(c as double)))) > 0
), e as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x)
  where list_cosine_similarity(a.x, b.x) >= 0.93
), reach as (
  select vec_id, vec_id as other from embeddings union select r.vec_id, e.b from reach r join e on e.a = r.other
), c as (
  select vec_id, min(other) as component_id from reach group by vec_id
), n as (
  select a as vec_id, count(*) as n_links from e group by a
)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept from c left join n using (vec_id)
"""

EXACT_TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as double)) as x from embeddings
  where len(embedding) > 0 and not list_contains(list_transform(embedding, lambda c: coalesce(isfinite(c), false)), false)
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.x, c.x) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.x) = len(c.x) where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""

NEAR_DEDUP = f"""
with recursive t as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WHITE}'), lambda w: w <> '') as words
  from documents
), g as (
  select distinct doc_id, list_slice(words, p, p + 4) as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as p from t where len(words) > 0)
), n as (
  select doc_id, count(*) as n from g group by doc_id
), m as (
  select a.doc_id as a, b.doc_id as b, count(*) as common from g a join g b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), e as (
  select a, b from m join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 75 * (x.n + y.n - common)
), reach as (
  select doc_id, doc_id as other from documents union select r.doc_id, e.b from reach r join e on e.a = r.other
), c as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from c left join n using (doc_id)
"""


def _crc32(number: str) -> str:
    """Unsigned CRC-32 of a number's decimal digits, bit by bit."""
    # fixed values of CRC-32: the polynomial and the mask
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    digits = f"list_transform(string_split(cast({number} as varchar), ''), lambda d: cast(ord(d) as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {digits}), lambda c, b: {byte}), 4294967295)"


_FIELDS = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", "text"]


def _leaf(fields: list[str]) -> str:
    return "sha256(" + " || ".join(f"case when {f} is null then '-' else octet_length(encode({f})) || ':' || {f} end" for f in fields) + ")"


MERKLE_MANIFEST = f"""
with recursive docs as (
  select doc_id, source, {_leaf(_FIELDS)} as leaf,
    case when {_crc32("doc_id")} % 2 = 0 then {_leaf([*_FIELDS[:4], "replace(text, chr(10), '')"])} end as tampered
  from documents
), leaves as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by source) as n from docs
), low as (
  select 0 as level, source, place, n, leaf as h from leaves
  union all
  select level + 1, source, place // 3, (n + 2) // 3, sha256(string_agg(h, '' order by place)) from low where n > 1
  group by level, source, place // 3, n
), subroots as (
  select source, h as subroot, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n from low where n = 1
), high as (
  select 0 as level, place, n, subroot as h from subroots
  union all
  select level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' order by place)) from high where n > 1 group by level, place // 3, n
), nodes as (
  select 0 as part, level, source, place, n, h from low union all select 1, level, null, place, n, h from high
), steps as (
  select 0 as part, level, source, place, n from low where n > 1 union all select 1, level, null, place, n from high where n > 1
), proofs as (
  select s.part, s.level, s.source, s.place, coalesce(string_agg(o.h, '' order by o.place) filter (o.place < s.place), '') as l,
    coalesce(string_agg(o.h, '' order by o.place) filter (o.place > s.place), '') as r
  from steps s join nodes o on o.part = s.part and o.level = s.level and o.source is not distinct from s.source and o.place // 3 = s.place // 3
  group by all
), ways as (
  select d.doc_id, d.leaf, d.tampered, d.source, u.subroot, d.place as own, list(struct_pack(l := p.l, r := p.r) order by p.part, p.level) as way
  from leaves d join subroots u on u.source is not distinct from d.source
  left join proofs p on (p.part = 0 and p.source is not distinct from d.source and p.place = d.place // cast(pow(3, p.level) as bigint))
    or (p.part = 1 and p.place = u.place // cast(pow(3, p.level) as bigint))
  group by all
), told as (
  select doc_id, leaf, subroot, (select h from high where n = 1) as root, list_filter(way, lambda w: w.l is not null) as way, coalesce(tampered, leaf) as start from ways
)
select doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(way, lambda w: w.l || w.r), ''), '')) as proof_sha256,
  list_reduce(list_prepend(struct_pack(l := start, r := ''), way), lambda a, w: struct_pack(l := sha256(w.l || a.l || w.r), r := '')).l as folded_root,
  folded_root = root as verified
from told
"""

PREFIX_TRIE = f"""
with turns as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first) as r from conversations
  where conv_id is not null
), own as (
  select c, list(struct_pack(role, text) order by r) as l, {_crc32("c")} % 6 as h from turns group by c
), seqs as (
  select a.c, coalesce(list_slice(b.l, 1, a.h), []) || list_slice(a.l, a.h + 1, len(a.l)) as s from own a left join own b on b.c = a.c - a.c % 100
), rows as (
  select c, d, md5(cast(list_slice(s, 1, d) as varchar)) as k, d = len(s) as at_end, case when d > 0 then md5(cast(list_slice(s, 1, d - 1) as varchar)) end as parent,
    case when d > 0 then length(s[d].text) else 0 end as points
  from (select c, s, unnest(range(0, len(s) + 1)) as d from seqs)
), nodes as (
  select k, d, min(c) as c, min(parent) as parent, count(*) as n_convs, min(points) as points,
    sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (at_end), '')) as ends_sha256
  from rows group by k, d
), children as (
  select parent as k, count(*) as n from nodes where parent is not null group by parent
), totals as (
  select a.k, sum((n.n_convs - 1) * n.points) as saved, count(*) filter (ch.k is null) as leaves
  from nodes n join rows a on a.c = n.c and a.d <= n.d left join children ch on ch.k = n.k group by a.k
)
select n.c as conv_id, n.d as depth, p.c as parent_conv_id, n.n_convs, coalesce(ch.n, 0) as n_children, t.leaves as n_leaves,
  cast(t.saved as bigint) as saved_tokens, n.ends_sha256
from nodes n join totals t on t.k = n.k left join nodes p on p.k = n.parent left join children ch on ch.k = n.k
"""
