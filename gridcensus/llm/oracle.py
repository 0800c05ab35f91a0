"""DuckDB SQL for the queries that SQL can express."""

OP3 = """
with texts as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as t from documents
), worded as (
  select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as l from texts
), windows as (
  select rid, i, [w[i], w[i + 1], w[i + 2]] as g
  from (select rid, w, unnest(range(1, len(w) - 1)) as i from worded where len(w) > 2)
), twice as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) as n from windows) where n > 1
), repeated as (
  select rid, count(distinct i + k) as n from twice, (values (0), (1), (2)) v(k) group by rid
), counted as (
  select worded.rid, doc_id, source, len(w)::bigint as n_words,
    coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words
  from worded left join repeated on worded.rid = repeated.rid
), ruled as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words or 100 * n_symbols > 20 * word_chars
      or 100 * n_dup_lines > 50 * n_lines as rule_failed
  from counted
), hosts as (
  select source, count(*) as n, sum(rule_failed::int) as f from ruled group by source
), moments as (select avg(f / n) as m, var_pop(f / n) as v from hosts
), prior as (
  select m, case when v > 1e-12 then greatest(m * (1 - m) / v - 1, 0) else 1 end as s from moments
), rated as (
  select source, (f + m * s) / (n + m * s + (1 - m) * s) as rate from hosts, prior
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rate <= 0.5 as kept
from ruled join rated on ruled.source is not distinct from rated.source
"""

OP4 = """
with recursive worded as (
  select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), sets as (
  select rid, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [w]
    else list_distinct(list_transform(range(len(w) - 4), lambda i: w[i + 1 : i + 5])) end as s from worded
), shingles as (select rid, len(s) as n, unnest(s) as g from sets
), shared as (
  select a.rid as a, b.rid as b, a.n + b.n - count(*) as joint, count(*) as common
  from shingles a join shingles b on a.g = b.g and a.rid <> b.rid group by a.rid, b.rid, a.n, b.n
), links as (select a, b from shared where 100 * common >= 80 * joint
), reached as (select rid as a, rid as b from sets union select r.a, l.b from reached r join links l on r.b = l.a
), least as (select a, min(doc_id) as component_id from reached join sets on b = rid group by a
), counted as (select a, count(*) as n from links group by a)
select doc_id, len(s)::bigint as n_shingles, component_id, coalesce(c.n, 0)::bigint as n_links
from sets s join least l on s.rid = l.a left join counted c on s.rid = c.a
"""

OP9 = """
with payloads as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, '')))::bigint as n from pages
), digested as (
  select *, sha1(encode(html)) as h, max(page_id) over (partition by html) as original from payloads
)
select page_id, n as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', d, 1) for d in
    flatten([[x // 32768 + 1, x // 1024 % 32 + 1, x // 32 % 32 + 1, x % 32 + 1] for x in
      [('0x' || substr(h, 1 + 5 * i, 5))::int for i in range(8)]])], '') as payload_digest,
  case when page_id is distinct from original then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from original then original end as refers_to
from digested
"""

OP11 = """
with given as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents
), occurring as (select rid, lang, source, unnest(w) as term from given
), kept as (select lang, term, count(*) as n from occurring group by lang, term having count(distinct rid) >= 3
), langs as (select lang, count(*) as v, sum(n) as held from kept group by lang
), groups as (select distinct lang, source from given
), counted as (
  select lang, source, term, count(*) as n from occurring semi join kept using (lang, term) group by lang, source, term
), held as (select lang, source, sum(n) as held from counted group by lang, source
), shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    (1 + 1000000000::hugeint * (coalesce(c.n, 0) + 1) // (coalesce(h.held, 0) + l.v))::hugeint as p,
    (1 + 1000000000::hugeint * (k.n + 1) // (l.held + l.v))::hugeint as q
  from groups g join langs l using (lang) join kept k using (lang) left join held h using (lang, source)
    left join counted c using (lang, source, term)
), distances as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), rows as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(d.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join distances d on d.lang = a.lang and d.source = a.source and d.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from shares where n > 0 and p > q
), ranked as (
  select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from rows
)
select * from ranked where part = 'pair' or rank <= 200
"""

OP13 = """
with given as (
  select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    xor(4294967295, list_reduce(list_concat([4294967295::bigint],
      list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), lambda crc, byte:
        list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) as h
  from documents
), cut as (
  select *, len(w) as n, case when len(w) > 0 then h // 10 % len(w) end as a, h // 10 % 8 as e from given
), ordered as (
  select rid, doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i:
    case when i < a then w[i + 1] else w[a + (i - a) % (1 + (n - a) // (3 + e)) + 1] end) else w end as w from cut
), placed as (
  select rid, n, i, w[i + 1] as word from (select *, unnest(range(n)) as i from ordered)
), equal as (
  select x.rid, x.i, y.i - x.i as q, x.i - row_number() over (partition by x.rid, y.i - x.i order by x.i) as island
  from placed x join placed y on x.rid = y.rid and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n
), stretches as (
  select rid, q, min(i) as s, count(*) + q as l from equal group by rid, q, island
  having count(*) + q >= greatest(6, 4 * q)
), runs as (
  select * from stretches r where not exists (
    select 1 from stretches o where o.rid = r.rid and o.q < r.q and o.s <= r.s and o.s + o.l >= r.s + r.l)
), listed as (
  select rid, count(*) as n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' order by s, q) as lines from runs group by rid
), longest as (
  select * from (select *, row_number() over (partition by rid order by l desc, s, q) as nth from runs) where nth = 1
), dropped as (
  select distinct rid, unnest(range(s + q, s + l)) as i from runs
), left_over as (
  select p.rid, string_agg(word, ' ' order by p.i) as t from placed p anti join dropped d on p.rid = d.rid and p.i = d.i group by p.rid
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, s::bigint as start, l::bigint as length, q::bigint as period,
  (1000 * l // q)::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
  sha256(coalesce(t, '')) as collapsed_sha256
from ordered o left join listed using (rid) left join longest using (rid) left join left_over using (rid)
"""

ORACLE: dict[str, str] = {
    "op3_host_rules": OP3,
    "op4_overlap_join": OP4,
    "op9_warc_revisits": OP9,
    "op11_source_divergence": OP11,
    "op13_periodic_runs": OP13,
}
