"""DuckDB SQL of the registered queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
with sized as (
  select doc_id, source, len({WORDS})::bigint as size from documents),
per_source as (select source, sum(size)::bigint as source_size from sized group by source),
named as (
  select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3)::int + 1] as weight,
    2.0::double * source_size as cap from per_source),
filling as (
  select *, row_number() over (order by cap / weight, source nulls last) as first,
    sum(cap) over (order by cap / weight, source nulls last) - cap as full_caps,
    sum(weight) over (order by cap / weight, source nulls last) - weight as full_weights,
    sum(source_size) over () as total, sum(weight) over () as weights from named),
levels as (
  select *, (1.5::double * total - full_caps) / (weights - full_weights) as level from filling),
goal as (
  select source, source_size, least(cap, weight * (select arg_min(level, first) from levels where level * weight <= cap))
    as target from levels),
steps as (
  select *, case when source_size > 0 then round(target / source_size * 16777216)::bigint else 0 end as step,
    ('0x' || substr(md5('mix|' || coalesce(source, '')), 1, 6))::bigint as u from goal),
ranked as (
  select s.*, source_size, target, step,
    row_number() over (partition by s.source order by size, doc_id nulls first) * step + u as hi
  from sized s join steps g on s.source is not distinct from g.source)
select doc_id, size, source_size, target, ((hi >> 24) - ((hi - step) >> 24)) * size as taken from ranked
"""

OP4 = rf"""
with d as (select doc_id, coalesce(text, '') as text, {WORDS} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
w as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from d),
tri as (select doc_id, pos, word || chr(10) || lead(word) over x || chr(10) || lead(word, 2) over x as tri
  from w window x as (partition by doc_id order by pos)),
again as (select doc_id, pos, count(*) over (partition by doc_id, tri) as n from tri where tri is not null),
covered as (select doc_id, count(distinct pos + k)::bigint as n_repeat_words
  from again, (values (0), (1), (2)) as o(k) where n > 1 group by doc_id),
m as (
  select doc_id, len(words)::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, len(lines) as n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper
  from d left join covered using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 10 * n_symbols > 3 * n_words
    or 2 * n_dup_lines > n_lines or word_chars < 2 * n_words or word_chars > 20 * n_words
    or 2 * n_upper > word_chars) as kept
from m
"""

OP5 = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as pos from documents),
k as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
often as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*)::bigint as n_lines, count(o.key)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where o.key is null), '')) as kept_sha256
from k left join often o using (key) group by doc_id
"""

OP6 = """
with p as (
  select page_id, encode(coalesce(html, '')) as b, sha1(coalesce(html, '')) as h from pages),
f as (select *, min(page_id) over (partition by b) as first from p)
select page_id, octet_length(b)::bigint as payload_bytes,
  array_to_string([translate(to_base(('0x' || substr(h, 5 * i + 1, 5))::bigint, 32, 4),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') for i in range(8)], '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id > first then first end as refers_to
from f
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# Kind, pattern, group to test, its least length; the first three are the base rules.
_SECRETS = (
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
               r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\x20\x09-\x0D]*(?:Proc-Type:[^\x0A]*\x0A)?(?:DEK-Info:[^\x0A]*\x0A)?"
                    r"[A-Za-z0-9+/=\x20\x09-\x0D]*(?:-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1),
    ("code_host", "(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("url_login", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]{4,}@", 0, 1),
)

_MATCHES = " union all ".join(
    f"""select doc_id, {k} as rule, '{kind}' as kind, {least} as least,
  unnest([length(x) for x in string_split_regex(text, {_quoted(pattern)})]) as gap,
  unnest([length(x) for x in regexp_extract_all(text, {_quoted(pattern)}, 0)]) as whole,
  unnest([length(x) for x in regexp_extract_all(text, {_quoted(pattern)}, {group})]) as tested,
  unnest(range(len(regexp_extract_all(text, {_quoted(pattern)}, 0)))) as pos
from d where regexp_matches(text, {_quoted(pattern)})""" for k, (kind, pattern, group, least) in enumerate(_SECRETS))

OP7 = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
m as ({_MATCHES}),
e as (
  select *, sum(gap + whole) over (partition by doc_id, rule order by pos)::bigint as stop from m where pos is not null),
s as (select doc_id, rule, kind, stop - whole as start, stop from e where tested >= least),
t as (
  select doc_id, string_agg(kind || ':' || start || ':' || stop, ',' order by start, rule) as spans,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, rule) filter (where rule < 3) as base,
    count(*) filter (where rule = 0) as n_assign, count(*) filter (where rule = 1) as n_access,
    count(*) filter (where rule = 2) as n_hex from s group by doc_id)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join t using (doc_id)
"""

OP9 = rf"""
with recursive w as (
  select doc_id, [translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') for x in {WORDS}] as w
  from documents),
s as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) = 1 then w
    else [w[i] || chr(10) || w[i + 1] for i in range(1, len(w))] end) as s from w),
n as (select doc_id, len(s)::bigint as n_shingles, md5(list_sort(s)::varchar) as set from s),
classes as (select set, min(doc_id) as id, any_value(n_shingles) as n from n where n_shingles > 0 group by set),
e as (select doc_id as id, unnest(s) as g from s where doc_id in (select id from classes)),
pairs as (
  select a.id as a, b.id as b from e a join e b on a.g = b.g and a.id <> b.id
    join classes ca on ca.id = a.id join classes cb on cb.id = b.id
  where 100 * least(ca.n, cb.n) >= 80 * greatest(ca.n, cb.n)
  group by a.id, b.id, ca.n, cb.n having 100 * count(*) >= 80 * (ca.n + cb.n - count(*))),
reach(a, b) as (select a, b from pairs union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a),
part as (select a, min(b) as least from reach group by a)
select doc_id, n_shingles, coalesce(least(id, least), id, doc_id) as component_id,
  doc_id = coalesce(least(id, least), id, doc_id) as kept
from n left join classes c on c.set = n.set and n_shingles > 0 left join part on part.a = c.id
"""

OP10 = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select a.vec_id as a, b.vec_id as b from v a join v b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) as (select a, b from pairs union select reach.a, pairs.b from reach join pairs on reach.b = pairs.a),
part as (select a, least(a, min(b)) as component_id from reach group by a),
n as (select a, count(*)::bigint as n_links from pairs group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id,
  vec_id = coalesce(component_id, vec_id) as kept
from embeddings e left join n on n.a = e.vec_id left join part on part.a = e.vec_id
"""

SQL: dict[str, str] = {"op2_mix": OP2, "op4_rules": OP4, "op5_line_dedup": OP5, "op6_warc": OP6, "op7_secrets": OP7,
                       "op9_minhash": OP9, "op10_embeddings": OP10}
