"""DuckDB SQL of the queries that SQL can express."""

MIXING = r"""
with d as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents),
s as (
  select source, sum(size)::bigint as n,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
  from d group by source),
o as (  -- the sources that reach their cap first come first
  select *, (select sum(n) from s) - coalesce(sum(3 * n) over (order by n::double / w, source
              rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(w) over (order by n::double / w, source rows between current row and unbounded following) as open_w
  from s),
k as (
  select *, rest * w > 3 * n * open_w as capped from o),
f as (  -- remainder and open weight where the first uncapped source stands
  select rest as r, open_w as ow from k where not capped order by open_w desc limit 1),
g as (
  select source, n, case when capped then (3 * n)::double else (r * w)::double / ow::double end as target
  from k, f),
b as (
  select source, n, target, case when n > 0 then floor(target / n)::bigint else 0 end as whole from g),
c as (
  select d.doc_id, d.size, b.n, b.target, b.whole, b.target - b.whole * b.n as budget,
         sum(d.size) over (partition by d.source order by d.h) as upto,
         sum(d.size) over (partition by d.source, d.h) as own
  from d join b on d.source is not distinct from b.source)
select doc_id, size, n as source_size, target,
       (size * (whole + case when budget > 0 and (upto <= budget
          or (upto - own <= budget and upto - budget <= budget - (upto - own))) then 1 else 0 end))::bigint as taken
from c
"""

#: parts by kind: number, pattern, pattern of what must be true of a match, role
_PARTS = r"""
  (0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+',
      '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]{8,}$', 'secret'),
  (1, 'AKIA[A-Z0-9]+', '^.{16,}$', 'identifier'),
  (2, '[0-9a-f]+', '^.{32,}$', 'secret'),
  (3, '(?:[Uu]ser(?:_?[Nn]ame|_?[Ii][Dd])?|USER|[Ll]ogin|LOGIN|[Cc]lient_?[Ii][Dd]|CLIENT_ID|[Aa]ccount_?[Ii][Dd])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9@._+-]+',
      '[:=]\x20*["'']?[A-Za-z0-9@._+-]{3,}$', 'identifier'),
  (4, '[A-Za-z0-9+/_-]{20,}={0,2}', '[a-z].*[A-Z].*[0-9]|[a-z].*[0-9].*[A-Z]|[A-Z].*[a-z].*[0-9]|[A-Z].*[0-9].*[a-z]|[0-9].*[a-z].*[A-Z]|[0-9].*[A-Z].*[a-z]', 'secret'),
  (5, '(?:https?|ftp|sftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+',
      '.', 'endpoint')"""

SECRETS = f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
kinds(kind, pattern, good, role) as (values {_PARTS}),
cut as (
  select rid, kind, role, good, string_split_regex(text, pattern) as gaps, regexp_extract_all(text, pattern) as hits
  from d, kinds where regexp_matches(text, pattern)),
one as (
  select rid, kind, role, good, unnest(range(1, len(hits) + 1)) as i, unnest(hits) as hit,
         unnest(list_slice(gaps, 1, len(hits))) as gap from cut),
placed as (
  select *, sum(length(gap) + length(hit)) over (partition by rid, kind order by i) as e from one),
part as (
  select rid, kind, role, (e - length(hit))::bigint as s, e::bigint as e from placed where regexp_matches(hit, good)),
linked as (
  select w.rid, w.kind, w.s, w.e from part w join part o
    on o.rid = w.rid and o.s < w.s + 200 and o.e > w.s - 200
  where w.kind >= 3 group by w.rid, w.kind, w.role, w.s, w.e
  having not bool_or(o.kind < 3 and o.s < w.e and o.e > w.s)
     and case w.role when 'identifier' then bool_or(o.role = 'secret')
                     when 'secret' then bool_or(o.role = 'identifier')
                     else bool_or(o.role = 'secret') and bool_or(o.role = 'identifier') end),
span as (
  select rid, kind, s, e from part where kind < 3 union all select * from linked),
shown as (
  select rid, kind, s, (case kind when 0 then 'assign' when 1 then 'access' when 2 then 'hex' when 3 then 'login'
         when 4 then 'token' else 'endpoint' end) || ':' || s || ':' || e as t from span)
select d.doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
       count(*) filter (kind = 2) as n_hex,
       sha256(coalesce(string_agg(t, ',' order by s, kind) filter (kind < 3), '')) as base_sha256,
       coalesce(string_agg(t, ',' order by s, kind), '') as spans
from d left join shown using (rid) group by d.rid, d.doc_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SEARCH = rf"""
with terms as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts
  from documents where text is not null),
d as (select rid, doc_id, len(ts)::bigint as n, ts from terms where len(ts) > 0),
whole as (select count(*)::bigint as nd, sum(n)::bigint as l from d),
tf as (select rid, t, count(*)::bigint as tf from (select rid, unnest(ts) as t from d) group by rid, t),
item as (
  select distinct i, item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
  from (select row_number() over () as i, item_id, text from (select distinct item_id, text from benchmark))),
w as (
  select t, floor(1000 * ln((2 * nd + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf, whole where t in (select t from item) group by t, nd),
m as (select rid, doc_id, (100 - 50 + (50 * n * nd) // l)::bigint as m from d, whole),
s as (
  select i, item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from item join tf using (t) join w using (t) join m using (rid) group by i, item_id, rid),
r as (
  select item_id, row_number() over (partition by i order by score desc, doc_id nulls last) as rank, doc_id, score
  from s join m using (rid) where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 50
"""

_CANONICAL = r"""
  regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(?:80|443)$', ''), '^(?:www|m)\.', '')
  || regexp_replace(regexp_replace(path, '/index\.html?$', ''), '/+$', '')
  || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end"""

URLS = rf"""
with split as (
  select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)', 1), '') as query
  from pages),
kept as (
  select *, list_sort(list_filter(string_split(query, '&'),
            lambda p: p != '' and not regexp_matches(p, '^(?:utm_[a-z]+|ref|gclid|fbclid)(?:=|$)'))) as kept from split),
named as (select page_id, host, path, {_CANONICAL} as canonical from kept),
list as (
  select distinct canonical from named
  where host != '' and regexp_matches(host, '(?:^|\.)(?:ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.')),
rules(verdict, h, p) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
                                ('allow', 'org', '/fr/')),
ruled as (
  select n.*, (select max_by(h || p, length(h || p)) from rules
               where (n.host = h or n.host like '%.' || h) and starts_with(n.path, p)) as rule from named n)
select page_id, host, path, rule,
       coalesce((select verdict from rules where h || p = rule),
                case when canonical in (select canonical from list) then 'block' else 'allow' end) as verdict,
       rule is null and host != '' and canonical in (select canonical from list) as listed
from ruled
"""

PHRASES = rf"""
with piece as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from piece),
total as (select lang, sum(len(ws))::bigint as n from w group by lang),
gram as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
  from w, range(1, 6) as t(k) where len(ws) >= k),
f as (select lang, k, phrase, count(*)::bigint as a from gram group by lang, k, phrase having count(*) >= 100),
cand as (
  select * from f c where k > 1 and not exists (
    select 1 from f q where q.lang = c.lang and q.k > c.k and q.a >= c.a
    and contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))),
cut as (
  select lang, phrase, a, string_split(phrase, ' ') as ws, unnest(range(1, k)) as cut from cand),
scored as (
  select c.lang, c.phrase, c.a, cut, l.a as l, r.a as r, n,
         ((1000::hugeint * c.a * n) // (l.a::hugeint * r.a))::bigint as score
  from cut c join total using (lang)
  join f l on l.lang = c.lang and l.phrase = array_to_string(ws[1:cut], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(ws[cut + 1:], ' ')),
low as (
  select *, row_number() over (partition by lang, phrase order by score, cut) as nth from scored),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
  from low where nth = 1)
select * from ranked where rank <= 2000
"""

ORACLES = {"op5_secrets": SECRETS, "op8_mixing": MIXING, "op11_search": SEARCH, "op12_urls": URLS, "op13_phrases": PHRASES}
