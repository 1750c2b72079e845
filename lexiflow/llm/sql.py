"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

# Chunks of lines that start where a rolling hash of two lines with content says
# so and reach to the first line of the next; the first occurrence of each chunk
# stays, and lines that equal those beside it go with the others.
OP1 = """
with t as (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null),
l as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) - 1 as i from t),
g as (
  select doc_id, i, ('0x' || substr(md5(line), 1, 7))::bigint as h from l
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
r as (
  select doc_id, i, (lead(h) over w + 31 * h) % 1000003 % 8 as r, row_number() over w as j
  from g window w as (partition by doc_id order by i)),
s as (select doc_id, i as start from r where j > 1 and r <> 0 union all select doc_id, 0 from t),
e as (
  select doc_id, start, coalesce(lead(start) over w, len(ls) - 1) as stop, coalesce(lag(start) over w, start) as low, ls
  from s join t using (doc_id) window w as (partition by doc_id order by start)),
c as (
  select doc_id, start, stop, low, coalesce(lead(stop) over (partition by doc_id order by start), stop) as high,
    ls[start + 1 : stop + 1] as body from e),
k as (
  select *, row_number() over (partition by body order by doc_id, start) as nth from c
  where len(list_distinct(list_filter(body, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) >= 2),
f as (
  select k.body, ls[stop + 2 : high + 1] as after, list_reverse(ls[low + 1 : start]) as before
  from k join t using (doc_id) where nth = 1),
m as (
  select k.doc_id, k.start, k.stop, f.after, f.before, ls[k.stop + 2 : k.stop + 1 + len(f.after)] as own_after,
    list_reverse(ls[greatest(k.start - len(f.before), 0) + 1 : k.start]) as own_before
  from k join f using (body) join t using (doc_id) where nth > 1),
x as (
  select doc_id,
    start - len(list_filter(range(1, len(before) + 1), lambda z: before[1 : z] = own_before[1 : z])) as a,
    stop + len(list_filter(range(1, len(after) + 1), lambda z: after[1 : z] = own_after[1 : z])) as b from m),
gone as (select distinct doc_id, unnest(range(a, b + 1)) as i from x),
n as (
  select l.doc_id, coalesce(string_agg(line, chr(10) order by l.i) filter (where gone.i is null), '') as text,
    count(gone.i)::int as removed_lines
  from l left join gone on l.doc_id = gone.doc_id and l.i = gone.i group by l.doc_id)
select d.doc_id, n.text, d.lang, d.source, length(n.text)::bigint as n_chars, coalesce(n.removed_lines, 0) as removed_lines
from documents d left join n using (doc_id)
"""

# Cosines of all pairs of a label; components by walking the links.
OP2 = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
walk as (
  select vec_id as a, vec_id as b from v
  union select w.a, l.b from walk w join links l on l.a = w.b),
low as (select a, min(b) as component_id from walk group by a),
n as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n.n, 0) as n_links, coalesce(low.component_id, e.vec_id) as component_id,
  e.vec_id = coalesce(low.component_id, e.vec_id) as kept
from embeddings e left join low on low.a = e.vec_id left join n on n.a = e.vec_id
"""

# Integer scores of every query against every other row.
OP4 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as e from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

# Shares of all kept terms in every group, then all pairs of a language's sources.
OP12 = r"""
with d as (
  select row_number() over () as id, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source
  from documents),
w as (select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as raw from d),
t as (
  select id, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from w),
kept as (select lang, term, count(*) as q_n from t group by lang, term having count(distinct id) >= 30),
seen as (select lang, source, term, count(*) as n from t semi join kept using (lang, term) group by lang, source, term),
groups as (select distinct lang, source from d),
cells as (
  select g.lang, g.source, k.term, coalesce(s.n, 0) as n, k.q_n
  from groups g join kept k using (lang) left join seen s using (lang, source, term)),
sums as (
  select *, sum(n) over (partition by lang, source) as total, sum(q_n) over (partition by lang, source) as q_total,
    count(*) over (partition by lang, source) as v from cells),
shares as (
  select lang, source, term, n, 1 + ((1000000000::hugeint * (n + 5)) // (total + 5 * v)) as p,
    1 + ((1000000000::hugeint * (q_n + 5)) // (q_total + 5 * v)) as q from sums),
diffs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join diffs f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select lang, source, 'term' as part, term as item, p - q as value from shares where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= 50
"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": OP1, "op2_itq_embedding_dedup": OP2, "op4_exact_top_k": OP4,
    "op12_source_divergence": OP12}
