"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import license, linededup, winnow
from .shared import LOWER, UPPER

_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_SPACE = rf"regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, rank::int rank, vec_id, score from r where rank <= 10
"""

OP2 = f"""
with recursive w as (select doc_id, {_SPACE} w from documents),
s as (
  select doc_id, unnest(case
    when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) x from w),
n as (select doc_id, count(*) n from s group by 1),
l as (
  select a.doc_id a, b.doc_id b from s a join s b on a.x = b.x and a.doc_id < b.doc_id
  join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
e as (select a, b from l union select b, a from l),
r as (select doc_id id, doc_id root from documents union select e.b, r.root from r join e on r.id = e.a),
c as (select id, min(root) component_id from r group by 1)
select doc_id, coalesce(n.n, 0)::bigint n_shingles, component_id, doc_id = component_id kept
from documents join c on c.id = doc_id left join n using (doc_id)
"""


def _templates() -> str:
    rows = ", ".join(f"('{t}', '{label}', {str(base).lower()}, {words}, {k}, {at}, '{gram}')" for t, label, base, words, k, at, gram in license.template_rows())
    return f"(values {rows}) t(template, label, base, words, k, at_, g)"


OP3 = f"""
with w as (select doc_id, {_ALNUM} w from documents),
g as (select doc_id, unnest(range(0, len(w) - 1)) pos, w from w where len(w) >= 2),
p as (select doc_id, pos, array_to_string(w[pos + 1 : pos + k], ' ') g from g, (values (2), (3)) k(k) where pos + k <= len(w)),
d as (select doc_id, template, label, base, words, k, pos - at_ diagonal, at_ from p join {_templates()} using (g)),
f as (select *, case when base or diagonal - lag(diagonal) over o > {license.GAP} or lag(diagonal) over o is null then 1 else 0 end fresh
      from (select distinct doc_id, template, label, base, words, k, diagonal from d) window o as (partition by doc_id, template order by diagonal)),
i as (select *, sum(fresh) over (partition by doc_id, template order by diagonal rows unbounded preceding) span from f),
s as (select i.doc_id, i.template, i.label, i.base, i.words, i.k, span, min(i.diagonal) first, list(distinct at_) ats
      from i join d on i.doc_id = d.doc_id and i.template = d.template and i.diagonal = d.diagonal group by all),
v as (select *, base and len(ats) = words - k + 1 exact, len(list_distinct(flatten(list_transform(ats, lambda a: range(a, a + k))))) / words as share from s),
x as (select *, exact or (not base and share >= {license.COVERAGE}) stands from v),
a as (select doc_id, count(*) filter (exact) n_base, min(first) filter (exact) first_word, max(first) filter (exact) last_word,
      array_to_string(list_sort(list(distinct label) filter (exact)), ',') base_labels,
      array_to_string(list_sort(list(distinct label) filter (stands)), ',') labels,
      max(share) filter (stands) score, count(*) filter (stands and not base) n_notices from x group by 1)
select w.doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word::bigint first_word, last_word::bigint last_word,
  coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0)::double score, coalesce(n_notices, 0)::bigint n_notices
from w left join a using (doc_id)
"""

_PLAIN = f"regexp_replace(regexp_replace(coalesce(html, ''), '{linededup.HIDDEN}', chr(10), 'g'), '{linededup.TAG}', chr(10), 'g')"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _PLAIN = f"replace({_PLAIN}, '{_entity}', '{_char}')"

OP7 = f"""
with p as (
  select page_id, coalesce(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)), '') host,
    list_filter(list_transform(string_split(regexp_replace({_PLAIN}, '{linededup.BLOCKS}', chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: length(x) > 0) lines from pages),
h as (select host, count(*) n_pages from p group by 1),
c as (select host, line, count(*) n from (select host, unnest(list_distinct(lines)) line from p) group by 1, 2),
b as (select host, list(line) drops from c join h using (host) where n >= {linededup.LEAST_PAGES} and n > {linededup.RATIO} * n_pages group by 1),
k as (select page_id, p.host, lines, list_filter(lines, lambda x: not coalesce(list_contains(drops, x), false)) kept from p left join b on p.host = b.host)
select page_id, host, len(lines)::bigint n_lines, (len(lines) - len(kept))::bigint n_dropped, array_to_string(kept, chr(10)) as text from k
"""

OP8 = f"""
with d as (select doc_id, {_ALNUM} w from documents),
i as (select row_number() over () item, item_id, {_ALNUM} w from benchmark where item_id is not null),
k as (select item, item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) at_ from i where len(w) > 0),
t as (select item, item_id, at_ t_at, least(len(w), 13) n, array_to_string(w[at_ : at_ + least(len(w), 13) - 1], ' ') x from k),
n as (select distinct n from t),
p as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) at_ from d, n where len(w) >= n),
m as (select doc_id, p.n, at_, item, item_id, t_at from p join t on t.n = p.n and t.x = array_to_string(w[at_ : at_ + p.n - 1], ' ')),
h as (select doc_id, count(distinct pos) n_hit from (select doc_id, unnest(range(at_, at_ + n)) pos from m) group by 1),
q as (select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) ids from m group by 1),
r as (select *, at_ - row_number() over (partition by doc_id, item, at_ - t_at order by at_) run from m),
l as (select doc_id, max(words) longest from (select doc_id, max(n) + count(*) - 1 words from r group by doc_id, item, at_ - t_at, run) group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(longest, 0)::bigint longest_match, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join h using (doc_id) left join q using (doc_id) left join l using (doc_id)
"""

#: MD5 of seed, id and text; a number in (0, 1) from its first 13 digits.
_KEY = "md5('42|' || coalesce('=' || doc_id::varchar, '-') || '|' || coalesce('=' || text, '-'))"
_UNIT = "(('0x' || substr({}, 1, 13))::bigint + 0.5) / 4503599627370496.0"

OP4 = f"""
with recursive small as materialized (
  select doc_id, source, len({_SPACE})::bigint size, {_KEY} as key, length(bin(len({_SPACE})))::bigint weight from documents),
groups as (select source, weight, count(*) n_docs, sum(size)::bigint words from small group by all),
sources as (select source, sum(words)::bigint source_size from groups group by 1),
weighed as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 w, (3 * source_size)::double cap from sources),
placed as (
  select *, sum(source_size) over ()::double total, sum(cap) over o - cap capped_before, sum(w) over () - sum(w) over o + w weight_from
  from weighed window o as (order by cap / w, source nulls last rows unbounded preceding)),
levels as (select *, (total - capped_before) / weight_from as lvl from placed),
targets as materialized (
  select source, source_size, least(cap, coalesce(arg_min(lvl, cap / w) filter (lvl * w <= cap) over () * w, cap)) target from levels),
loads as (
  select g.*, target, sum(words) over o - words capped, sum(words * g.weight) over s - sum(words * g.weight) over o + words * g.weight as load_
  from groups g join targets t on t.source is not distinct from g.source
  window o as (partition by g.source order by g.weight desc rows unbounded preceding), s as (partition by g.source)),
risen as (select *, case when load_ > 0 then (target - 3 * capped::double) / load_::double end lvl from loads),
chosen as (select *, arg_max(lvl, weight) filter (lvl * weight <= 3) over (partition by source) found from risen),
parted as (select *, case when target <= 0 then 0.0 else least(3.0, coalesce(found * weight, 3.0)) end m from chosen),
plan as materialized (
  select source, weight, floor(m)::bigint sure, m - floor(m) p, floor(sum(n_docs * (m - floor(m))) over a + 0.5) n_sample, target - (sum(words * floor(m)::bigint) over s)::double room
  from parted window s as (partition by source), a as (partition by source order by weight desc rows between unbounded preceding and unbounded following)),
drawn as (
  select r.*, sure, p, n_sample, room, case when p > 0 then (u / (1 - u)) / (p / (1 - p)) else 'infinity'::double end q
  from (select *, {_UNIT.format("key")} u from small) r join plan on plan.source is not distinct from r.source and plan.weight = r.weight),
ranked as (
  select *, row_number() over o - 1 as rank_, sum(size) over o - size before_ from drawn
  window o as (partition by source, p > 0 order by q, key rows unbounded preceding)),
sampled as materialized (select *, case when p > 0 and rank_ < n_sample and before_ + size <= room then 1 else 0 end extra from ranked),
used as (select source, floor(max(room) - sum(extra * size)::double)::bigint as open_ from sampled group by 1),
counts as materialized (select source, size, count(*) n from sampled where extra = 0 and sure < 3 and size > 0 group by all),
fill as (
  select source, null::bigint size, 0::bigint n, open_ from used
  union all
  select f.source, c.size, least(c.n, f.open_ // c.size)::bigint, (f.open_ - least(c.n, f.open_ // c.size) * c.size)::bigint
  from fill f, lateral (select size, n from counts k where k.source is not distinct from f.source and k.size <= f.open_ and k.size < coalesce(f.size, 9223372036854775807) order by k.size desc limit 1) c),
turns as (
  select s.*, case when extra = 0 and sure < 3 then row_number() over (partition by s.source, s.size, extra = 0 and sure < 3 order by q, key) end turn, f.n
  from sampled s left join (select * from fill where n > 0) f on f.source is not distinct from s.source and f.size = s.size),
done as (select *, (sure + case when extra = 1 or turn <= n then 1 else 0 end)::int copies from turns)
select doc_id, size, source_size, target, (copies * size)::bigint taken, copies
from done d join targets t on t.source is not distinct from d.source
"""

# CRC-32 (reflected, polynomial EDB88320): table entries by shifting each byte eight times
_CRC = "list_reduce(list_prepend(x, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"

OP6 = f"""
with crc as materialized (select list(v order by x) as tab from (select x, {_CRC} v from (select unnest(range(256)) x))),
bytes as (select doc_id, source, {_KEY} as key, octet_length(encode(coalesce(text, ''))) + 16 as size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint) b from documents),
small as materialized (
  select doc_id, source, key, size::bigint size, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)::bigint text_crc32 from bytes, crc),
n as (select source, count(*) n, {_UNIT.format("md5('42|' || coalesce(source, ''))")} as off from small group by 1),
f as (
  select s.*, (row_number() over (partition by s.source order by key) - 1 + off) / n as f
  from small s join n on n.source is not distinct from s.source),
p as (select *, row_number() over (order by f, source nulls first, key) - 1 as place, count(*) over () total from f)
select doc_id, size, text_crc32, 'rows' as law, (place * 40 // total)::int shard, (place - ((place * 40 // total) * total + 39) // 40)::bigint slot, null::int grown_shard, source from p
"""

# unsigned CRC of a decimal number, with the table ``crc``
_CRC_OF = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(({})::varchar, ''), lambda c: ascii(c))), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)"
_CRC_TABLE = f"crc as materialized (select list(v order by x) as tab from (select x, {_CRC} v from (select unnest(range(256)) x)))"


def _field(x: str) -> str:
    return f"coalesce(octet_length(encode(({x})::varchar)) || ':' || ({x})::varchar, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


OP11 = f"""
with recursive {_CRC_TABLE},
d as (
  select doc_id, lang, {_leaf("n_chars")} leaf, case when {_CRC_OF.format("doc_id")} % 7 = 0 and n_chars is not null then {_leaf("n_chars::hugeint + 1")} else {_leaf("n_chars")} end claimed
  from documents, crc),
r as materialized (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) n,
    row_number() over (order by lang nulls first, doc_id nulls first, leaf) as id from d),
t(lang, lvl, i, h, n) as (
  select lang, 0, i, leaf, n from r
  union all
  select lang, lvl + 1, i // 2, sha256(string_agg(h, '' order by i)), max((n + 1) // 2) from t where n > 1 group by lang, lvl, i // 2),
tree as materialized (select * from t),
s as materialized (select lang, h, row_number() over (order by lang nulls first) - 1 as i, count(*) over () n from tree where n = 1),
u(lvl, i, h, n) as (
  select 0, i, h, n from s
  union all
  select lvl + 1, i // 2, sha256(string_agg(h, '' order by i)), max((n + 1) // 2) from u where n > 1 group by lvl, i // 2),
top as materialized (select * from u),
steps as (
  select r.id, p.lvl lvl, xor(p.i, 1) < p.i as before, x.h sibling
  from r join tree p on p.lang is not distinct from r.lang and p.n > 1 and p.i = r.i >> p.lvl
  left join tree x on x.lang is not distinct from p.lang and x.lvl = p.lvl and x.i = xor(p.i, 1)
  union all
  select r.id, 1000 + p.lvl, xor(p.i, 1) < p.i, x.h
  from r join s on s.lang is not distinct from r.lang join top p on p.n > 1 and p.i = s.i >> p.lvl
  left join top x on x.lvl = p.lvl and x.i = xor(p.i, 1)),
path as materialized (select id, coalesce(sibling, '') sibling, before, row_number() over (partition by id order by lvl) k from steps),
f(id, k, h) as (
  select id, 0, claimed from r
  union all
  select f.id, f.k + 1, sha256(case when before then sibling || h else h || sibling end) from f join path p on p.id = f.id and p.k = f.k + 1),
folded as (select id, arg_max(h, k) h from f group by id),
proof as (select id, sha256(string_agg(sibling, '' order by k)) h from path group by id)
select r.doc_id, leaf, s.h subroot, top.h root, coalesce(proof.h, sha256('')) proof_sha256, folded.h folded_root, folded.h = top.h verified
from r join s on s.lang is not distinct from r.lang join top on top.n = 1 join folded using (id) left join proof using (id)
"""

_MARKS = """
  select id, which, string_agg(left(c, 12) || '@' || (2147483647 - substr(c, 13)::bigint), ',' order by 2147483647 - substr(c, 13)::bigint) f, list(distinct left(c, 12)) h
  from (
    select distinct id, which, c from (
      select id, which, i, n, min(c) over (partition by id, which order by i rows between current row and {over} following) c from (
        select id, which, len(g) n, unnest(range(len(g))) i, unnest(g) c from (
          select id, which, case when len(w) = 0 then [] else list_transform(range(greatest(len(w) - {k}, 0) + 1), lambda i: left(md5(array_to_string(w[i + 1:i + {k}], ' ')), 12) || (2147483647 - i)) end g
          from (select id, which, regexp_extract_all(translate(x, '{upper}', '{lower}'), '{word}') w from both_))))
    where i <= greatest(n - {window}, 0))
  group by id, which"""

OP12 = f"""
with d as materialized (select doc_id, coalesce(text, '') t, row_number() over (order by doc_id desc nulls last, md5(coalesce(text, '')) desc) id, count(*) over () n from documents),
e as materialized (
  select a.id, a.doc_id, b.id follows, a.t, left(a.t, length(a.t) - length(a.t) // 3) || left(b.t, length(a.t) // 3) x
  from d a join d b on b.id = a.id % a.n + 1),
both_ as (select id, 'own' which, t x from e union all select id, 'edited', x from e),
m as materialized ({_MARKS.format(over=winnow.WINDOW - 1, k=winnow.K, window=winnow.WINDOW, upper=UPPER, lower=LOWER, word=winnow.WORD)}),
f as materialized (select id, which, coalesce(f, '') f, coalesce(h, []) h from both_ left join m using (id, which))
select doc_id, length(t) n_chars, sha256(x) edited_sha256, o.f fingerprint, c.f edited_fingerprint,
  case when len(o.h) + len(c.h) = 0 then 1 else len(list_intersect(o.h, c.h)) / (len(o.h) + len(c.h) - len(list_intersect(o.h, c.h))) end near_edited,
  case when len(o.h) + len(b.h) = 0 then 1 else len(list_intersect(o.h, b.h)) / (len(o.h) + len(b.h) - len(list_intersect(o.h, b.h))) end near_next
from e join f o on o.id = e.id and o.which = 'own' join f c on c.id = e.id and c.which = 'edited' join f b on b.id = follows and b.which = 'own'
"""

OP13 = f"""
with {_CRC_TABLE},
own as materialized (
  select conv_id c, row_number() over (partition by conv_id order by turn nulls first, tok) - 1 as pos, tok, words from (
    select conv_id, turn, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) tok,
      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) words
    from conversations where conv_id is not null)),
convs as materialized (select c, c - c % 20 base, {_CRC_OF.format("c")} % 4 h, max(pos) + 1 n_own from own, crc group by c, tab),
taken as materialized (select k.*, least(h, coalesce(b.n_own, 0)) n_base from convs k left join (select c as b, n_own from convs) b on b.b = k.base),
turns as materialized (
  select k.c, pos + 1 as d, tok, words from taken k join own o on o.c = k.base and pos < h
  union all
  select k.c, n_base + pos - h + 1, tok, words from taken k join own o on o.c = k.c and pos >= h),
paths as materialized (
  select c, d, words, md5(string_agg(tok, ',') over (partition by c order by d)) p from turns union all select c, 0, 0, '' from convs),
ends as (select c, max(d) d from paths group by c),
ended as (select p, sha256(string_agg(c::varchar, ',' order by c)) s from paths join ends using (c, d) group by p),
nodes as materialized (select p, d, min(c) c, count(*) n, any_value(words) words from paths group by p, d),
up as materialized (select v.p, v.d, a.p u from nodes v join paths a on a.c = v.c and a.d = v.d - 1),
kids as (select u p, count(*) k from up group by u),
below as (
  select a.p, sum((v.n - 1) * v.words) saved, count(*) filter (where k is null) leaves
  from nodes v join paths a on a.c = v.c and a.d <= v.d left join kids on kids.p = v.p group by a.p)
select v.c conv_id, v.d::bigint depth, x.c parent_conv_id, v.n::bigint n_convs, coalesce(k, 0)::bigint n_children, leaves::bigint n_leaves, saved::bigint saved_tokens, coalesce(s, sha256('')) ends_sha256
from nodes v left join up using (p) left join nodes x on x.p = up.u left join kids on kids.p = v.p join below on below.p = v.p left join ended on ended.p = v.p
"""

SQL = {"op4_mixing": OP4, "op6_sharding": OP6, "op1_topk": OP1, "op2_neardup": OP2, "op3_license": OP3, "op7_linededup": OP7, "op8_decontam": OP8, "op11_merkle": OP11, "op12_winnow": OP12, "op13_trie": OP13}
