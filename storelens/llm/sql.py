"""SQL twins (DuckDB) of those training-data queries that SQL can express."""

URL_REPUTATION_SQL = r"""
with pages_at as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
located as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from pages_at),
split as (
  select *, array_to_string(string_split(host, '.')[-2:], '.') as two, array_to_string(string_split(host, '.')[-3:], '.') as three,
    string_split(host, '.')[-1] as one from located),
levelled as (
  select page_id, host, path,
    case when two in ('ac.uk', 'co.jp', 'co.uk', 'com.au', 'com.br', 'org.uk') then three else two end as domain,
    case when two in ('ac.uk', 'co.jp', 'co.uk', 'com.au', 'com.br', 'org.uk') then two else one end as suffix from split),
outcomes as (
  select host, domain, suffix, cast(quality as double) as good
  from levelled join labels on try_cast(regexp_extract(path, '/([0-9]{1,18})(/|\.html)?$', 1) as bigint) = labels.doc_id
  where quality is not null),
h as (select host, domain, suffix, cast(count(*) as double) as n, sum(good) as k from outcomes group by all),
d as (select domain, suffix, sum(n) as n, sum(k) as k from h group by all),
s as (select suffix, sum(n) as n, sum(k) as k from h group by all),
a as (select sum(n) as n, sum(k) as k from h),
spread as (
  select 's' as level, s.n, s.k, a.n as pn, a.k / a.n as p from s, a
  union all select 'd', d.n, d.k, s.n, s.k / s.n from d join s using (suffix)
  union all select 'h', h.n, h.k, d.n, d.k / d.n from h join d using (domain)),
rho as (
  select level, case when sum(p * (1 - p) * (1 - n / pn) * (n - 1)) > 0
    then (sum(n * pow(k / n - p, 2)) - sum(p * (1 - p) * (1 - n / pn))) / sum(p * (1 - p) * (1 - n / pn) * (n - 1)) end as r
  from spread group by level),
strength as (
  select level, coalesce(case when r > 0 then greatest(2.0e0, least(10000.0e0, (1 - r) / r)) end, 10000.0e0) as m from rho),
rs as (select suffix, (s.k + m * (a.k / a.n)) / (s.n + m) as rate from s, a, strength where level = 's'),
rd as (select domain, suffix, (d.k + m * rs.rate) / (d.n + m) as rate from d join rs using (suffix), strength where level = 'd'),
rh as (select host, h.n + m as total, (h.k + m * rd.rate) / (h.n + m) as rate from h join rd using (domain), strength where level = 'h'),
prior as (select coalesce((select k / n from a), 0.5e0) as rate, coalesce((select m from strength where level = 'h'), 10000.0e0) as m),
bounds as (
  select l.*, coalesce(
    rh.rate - 1.645e0 * sqrt(rh.rate * (1 - rh.rate) / (rh.total + 1)),
    rd.rate - 1.645e0 * sqrt(rd.rate * (1 - rd.rate) / (prior.m + 1)),
    rs.rate - 1.645e0 * sqrt(rs.rate * (1 - rs.rate) / (prior.m + 1)),
    prior.rate - 1.645e0 * sqrt(prior.rate * (1 - prior.rate) / (prior.m + 1))) as bound
  from levelled l left join rh using (host) left join rd on l.domain = rd.domain left join rs on l.suffix = rs.suffix, prior),
ruled as (
  select *, case
    when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from bounds)
select page_id, host, path, rule,
  case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
    when bound < 0.5 then 'block' else 'allow' end as verdict
from ruled
"""

WARC_SQL = """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
known as (
  select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest, payload_bytes) end as first from payloads)
select page_id, payload_bytes, payload_digest,
  case when first is not null and first <> page_id then 'revisit' else 'response' end as record_type,
  case when first <> page_id then first end as refers_to
from known
"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES_SQL = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key from lines),
frequent as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
judged as (
  select k.*, f.key is not null and k.doc_id <> f.keeper as gone from keyed k left join frequent f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""

PHRASES_SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') as w from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as g
  from words, (values (1), (2), (3)) t(k) where len(w) >= k),
counts as materialized (select lang, k, g, count(*) as f from grams group by all having k = 1 or count(*) >= 10),
totals as (select lang, cast(sum(f) as bigint) as n from counts where k = 1 group by lang),
candidates as materialized (select lang, k, g, f as a, string_split(g, ' ') as w from counts where k >= 2),
halves as materialized (
  select lang, g, a, k, j, array_to_string(w[1:j], ' ') as g1, array_to_string(w[j + 1:k], ' ') as g2
  from (select *, unnest(range(1, k)) as j from candidates)),
cuts as (
  select h.lang, h.g, h.a, h.j, l.f as l, r.f as r, (cast(h.a as hugeint) * h.a * 1000000) // (cast(l.f as hugeint) * r.f) as score
  from halves h join counts l on l.lang = h.lang and l.g = h.g1 join counts r on r.lang = h.lang and r.g = h.g2),
lowest as (select * from cuts qualify row_number() over (partition by lang, g order by score, j) = 1),
inside as (
  select lang, array_to_string(w[s:s + 1], ' ') as g, max(a) as longer from candidates, (values (1), (2)) t(s) where k = 3 group by all),
ranked as (
  select x.*, row_number() over (partition by x.lang order by score desc, a desc, x.g) as rank
  from lowest x left join inside i on i.lang = x.lang and i.g = x.g where i.longer is null or 100 * i.longer < 50 * a)
select lang, rank, g as phrase, a, l, r, n, cast(score as bigint) as score from ranked join totals using (lang) where rank <= 2000
"""


def _codes_sql(rounds: int = 2) -> str:
    """Codebooks after each round as relations of part, entry and components."""
    nearest = """
a{k} as materialized (
  select q.vec_id, q.p, min(64 * list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - b.v[i]) * (q.v[i] - b.v[i]))) + b.e) as best
  from parts q join b{k} b on b.p = q.p group by q.vec_id, q.p)"""
    moved = """
s{k} as (
  select a.p, cast(a.best % 64 as bigint) as e, i, sum(q.v[i]) as s, count(*) as c
  from a{k} a join parts q on q.vec_id = a.vec_id and q.p = a.p, unnest(range(1, len(q.v) + 1)) t(i) group by all),
b{next} as materialized (
  select b.p, b.e, coalesce(m.v, b.v) as v from b{k} b
  left join (select p, e, list(cast((s - ((s % c) + c) % c) // c as bigint) order by i) as v from s{k} group by p, e) m on m.p = b.p and m.e = b.e)"""
    steps = ["".join([nearest.format(k=k), ",", moved.format(k=k, next=k + 1)]) for k in range(rounds)]
    return f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
parts as materialized (
  select vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] as v from kept, range(16) t(p)),
first as (select vec_id, row_number() over (order by vec_id) - 1 as e from kept order by vec_id limit 64),
b0 as materialized (select p, e, v from parts join first using (vec_id)),{",".join(steps)},{nearest.format(k=rounds)},
coded as (
  select vec_id, string_agg(printf('%02x', cast(best % 64 as bigint)), '' order by p) as code, cast(sum(best // 64) as bigint) as error
  from a{rounds} group by vec_id),
digest as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) as codebooks_sha256 from b{rounds})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded join kept using (vec_id), digest
"""


CODES_SQL = _codes_sql()
