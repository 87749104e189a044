"""DuckDB statements that give the rows of the registered queries."""

_WORDS = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') w from documents),
g as (select distinct doc_id, s from (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) s from d)),
n as (select doc_id, count(*) n from g group by 1),
p as (select a.doc_id x, b.doc_id y, count(*) c from g a join g b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
both_ways as (select x, y from e union all select y, x from e),
reach as (select doc_id a, doc_id b from documents union select reach.a, both_ways.y from reach join both_ways on reach.b = both_ways.x)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, c.component_id
from d left join n using (doc_id) join (select a doc_id, min(b) component_id from reach group by 1) c using (doc_id)
"""



def _feistel() -> str:
    """Six rounds over p(id, v, s), for values that were not permuted yet or are still too great."""
    out = "(select id, s, v // b l, v % b r, a, b, n from p, k where s = 0 or v >= n)"
    for key in (2 * i + i % 2 for i in range(6)):
        half = lambda x: f"('0x' || substr(md5('{key}:' || {x}), 1, 15))::bigint"  # noqa: E731, B023
        out = f"(select id, s, (l + {half('r')}) % a l, r, a, b, n from {out})" if key % 2 == 0 else f"(select id, s, l, (r + {half('l')}) % b r, a, b, n from {out})"
    return out


#: CRC-32 byte by byte, with its table of 256 made from the polynomial; a*b >= n as in the operator.
OP3 = f"""
with recursive d as (select doc_id, coalesce(text, '') t, row_number() over (order by doc_id) - 1 x from documents),
n as (select count(*)::bigint n, floor(sqrt(greatest(count(*) - 1, 0)))::bigint + 1 a from documents),
k as (select n, a, (n + a - 1) // a b from n),
p as (select x id, x v, 0 s from d union all select id, l * b + r, s + 1 from {_feistel()}),
places as (select id, v from p, k where s > 0 and v < n),
crc as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, range(8)), lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) e),
sums as (select x, strlen(t) + 1 size, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen(t)), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)), lambda c, y: xor(c >> 8, e[(xor(c, y) & 255) + 1])), 4294967295) crc from (select x, t, hex(encode(t)) h from d), crc)
select doc_id, size::bigint size, crc::bigint text_crc32, 'rows' law, (v % 16)::int shard, v // 16 slot, null::int grown_shard from d join places on id = x join sums using (x)
"""

OP5 = rf"""
with d as (select doc_id, coalesce(text, '') t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{_WORDS}') w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) l from d),
g as (select doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) s, unnest(range(1, len(w) - 1)) i from w where len(w) >= 3),
h as (select doc_id, i from (select *, count(*) over (partition by doc_id, s) c from g) where c > 1),
r as (select doc_id, count(distinct j) n from (select doc_id, i + k j from h, range(3) x(k)) group by 1),
m as (select doc_id, len(w)::bigint n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
  (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(r.n, 0)::bigint n_repeat_words, len(l) n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) n_upper from w left join r using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or 100 * n_upper > 35 * word_chars or 10 * n_dup_lines > 4 * n_lines) kept from b
"""

OP8 = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
iw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark),
win as (select distinct item_id, n, s from (select item_id, least(len(w), 13) n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) s from iw where len(w) > 0)),
sizes as (select distinct n from win),
dg as (select doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) s, unnest(range(1, len(w) - n + 2)) i from dw, sizes where len(w) >= n),
hit as (select distinct dg.doc_id, dg.n, dg.i, win.item_id from dg join win on dg.n = win.n and dg.s = win.s),
h as (select doc_id, count(distinct i + k) n_hit from hit, range(60) x(k) where k < n group by 1),
it as (select doc_id, count(*) n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) ids from (select distinct doc_id, item_id from hit) group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from dw left join h using (doc_id) left join it using (doc_id)
"""

OP10 = r"""
with u as (select page_id, coalesce(url, '') u, strpos(coalesce(url, ''), '://') p from pages),
h as (select page_id, case when p = 0 then '' else regexp_extract(substr(u, p + 3), '^[^/?#]*') end raw, case when p = 0 then '' else regexp_extract(substr(u, p + 3), '^[^/?#]*([^?#]*)', 1) end path from u),
l as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, path from h),
r as (select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) t(rh, rp, v)),
m as (select page_id, rh || rp as rule, v, row_number() over (partition by page_id order by length(rh || rp) desc) k from l join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select l.page_id, l.host, l.path, m.rule, coalesce(m.v, 'allow') verdict from l left join m on l.page_id = m.page_id and m.k = 1
"""

OP6 = r"""
with m as (select conv_id, turn, role, to_json(coalesce(text, ''))::varchar t, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) before,
  count(*) filter (role = 'user') over (partition by conv_id order by turn rows unbounded preceding)::int as level from conversations),
l as (select *, case when role = 'user' then 't' || turn end call_id, case when role = 'assistant' then 't' || before end answers from m),
a as (select distinct conv_id, answers from l where answers is not null)
select l.conv_id, turn, role, call_id, l.answers, case when call_id is not null then case when a.answers is null then 'no_result' else 'ok' end when l.answers is not null then 'ok' end status, level,
  case when call_id is not null then '{"arguments":{"prompt":' || t || ',"turn":' || turn || '},"call_id":"' || call_id || '","content":' || t || ',"name":"reply","role":"user"}'
    else '{"content":' || t || coalesce(',"result_of":"' || l.answers || '"', '') || ',"role":' || to_json(role)::varchar || '}' end json
from l left join a on a.conv_id = l.conv_id and a.answers = l.call_id
"""



def _op12() -> str:
    """Two rounds over all parts of all vectors, then codes, errors and the codebooks' digest."""
    out = r"""
with v as (select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) q from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select vec_id, label, i pos, q[i * (len(q) // 16) + 1:(i + 1) * (len(q) // 16)] x from v, range(16) t(i)),
s as (select vec_id, row_number() over (order by vec_id) - 1 e from v qualify e < 64),
c0 as (select pos, e, x c from p join s using (vec_id))"""
    far = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    for i in range(3):
        out += f""",
a{i} as (select vec_id, label, pos, x, min(d * 64 + e) % 64 e, min(d) d from (select vec_id, label, p.pos, x, e, {far} d from p join c{i} on p.pos = c{i}.pos) group by all)"""
        if i < 2:
            out += f""",
m{i} as (select pos, e, list((t - ((t % n) + n) % n) // n order by j) c from (select pos, e, j, sum(x[j + 1])::bigint t, count(*) n from a{i}, range(64) r(j) where j < len(x) group by 1, 2, 3) group by 1, 2),
c{i + 1} as (select pos, e, coalesce(m{i}.c, c{i}.c) c from c{i} left join m{i} using (pos, e))"""
    return out + """,
k as (select sha256(string_agg(array_to_string(c, ','), ',' order by pos, e)) codebooks_sha256 from c2),
o as (select vec_id, label, string_agg(format('{:02x}', e), '' order by pos) code, sum(d)::bigint error from a2 group by 1, 2),
l as (select label, sum(error)::bigint label_error from o group by 1)
select vec_id, code, error, label_error, codebooks_sha256 from o join l on o.label is not distinct from l.label, k
"""


OP13 = r"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) p from d)),
g as (select lang, m, array_to_string(w[i:i + m - 1], ' ') phrase from (select lang, w, unnest(range(1, len(w) + 1)) i from w), (values (1), (2), (3), (4)) s(m) where i + m - 1 <= len(w)),
f as (select lang, m, phrase, count(*) f from g group by all having count(*) >= 30),
n as (select lang, sum(len(w))::bigint n from w group by 1),
c as (select lang, m, phrase, f, string_split(phrase, ' ') s from f),
k as (select lang, phrase, f a, k, array_to_string(s[:k], ' ') p1, array_to_string(s[k + 1:], ' ') p2 from c, range(1, 4) r(k) where k < m),
q as (select k.lang, k.phrase, a, x.f l, y.f r, (2000000::hugeint * a // (x.f + y.f))::bigint score, row_number() over (partition by k.lang, k.phrase order by 2000000::hugeint * a // (x.f + y.f), k) o
  from k join f x on x.lang = k.lang and x.phrase = p1 join f y on y.lang = k.lang and y.phrase = p2 qualify o = 1),
h as (select lang, array_to_string(s[i:j], ' ') phrase, max(f) longer from c, range(1, 5) b(i), range(2, 5) e(j) where j > i and j <= m and j - i + 1 < m group by 1, 2),
t as (select q.lang, q.phrase, a, l, r, score, row_number() over (partition by q.lang order by score desc, a desc, q.phrase) rank from q left join h on h.lang = q.lang and h.phrase = q.phrase where longer is null or 100 * longer < 80 * a)
select t.lang, rank, phrase, a, l, r, n.n, score from t join n using (lang) where rank <= 2000
"""

SQL = {"op1_jaccard_join": OP1, "op3_sharding": OP3, "op5_quality_rules": OP5, "op6_chat_format": OP6, "op8_decontamination": OP8, "op10_url_filter": OP10, "op12_vector_codes": _op12(), "op13_phrases": OP13}
