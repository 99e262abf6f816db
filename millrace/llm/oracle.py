"""DuckDB SQL for the queries that SQL expresses."""

ORACLE = {}

ORACLE["op6_exact_dedup"] = r"""
with rows as (
    select doc_id, length(coalesce(text, '')) as chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as digest
    from documents)
select doc_id,
       first_value(doc_id) over (partition by digest order by chars desc, doc_id) as keep_id,
       count(*) over (partition by digest) as group_size,
       doc_id = first_value(doc_id) over (partition by digest order by chars desc, doc_id) as kept,
       digest as text_sha256
from rows
"""

ORACLE["op4_jaccard_join"] = r"""
with recursive split as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents),
shingles as (
    select distinct doc_id, unnest(case when len(w) >= 5
        then list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
        when len(w) > 0 then [list_aggregate(w, 'string_agg', ' ')] else [] end) as s
    from split),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
    select a.doc_id as x, b.doc_id as y, count(*) as o
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
    group by 1, 2),
links as (
    select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y
    where 100 * o >= 80 * (p.n + q.n - o)),
edges as (select x, y from links union all select y, x from links),
linked as (select x, count(*) as n_links from edges group by x),
reach as (
    select x, y from edges
    union
    select reach.x, edges.y from reach join edges on reach.y = edges.x)
select d.doc_id, coalesce(any_value(n), 0) as n_shingles,
       least(d.doc_id, coalesce(min(reach.y), d.doc_id)) as component_id,
       coalesce(any_value(linked.n_links), 0) as n_links
from documents d left join sizes using (doc_id) left join linked on linked.x = d.doc_id
left join reach on reach.x = d.doc_id
group by d.doc_id
"""


def _ranks(rounds: int) -> str:
    """The rounds of the two personalised PageRanks, one table each; 0.85 ** 90 is 4e-7."""
    return ",\n".join(f"""r{k} as (
    select kind, host, sum(rank) as rank from (
        select r.kind, dst as host, rank * share * 0.85 as rank
        from {f"r{k - 1}" if k > 1 else "seeds"} r join shares s on r.kind = s.kind and r.host = s.src
        union all select kind, host, rank * (1 - 0.85) from seeds)
    group by kind, host)""" for k in range(1, rounds + 1))


ORACLE["op7_url_filter"] = r"""
with rest as (
    select page_id, coalesce(html, '') as html,
           case when instr(coalesce(url, ''), '://') > 0
                then substr(url, instr(url, '://') + 3) else '' end as rest
    from pages),
parts as (
    select page_id, html,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
    from rest),
rules(h, p, says) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fitting as (
    select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(says, length(h || p)) as says
    from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
    group by page_id),
rows as (select page_id, html, host, path, rule, says from parts left join fitting using (page_id)),
links as (
    select host as src, translate(unnest(regexp_extract_all(html,
        '(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as dst
    from rows where host <> ''),
names as (select host from rows union select dst from links),
own as (select host, substr(host, instr(host, '.') + 1) as domain from names where host like '%.%.%'),
edges as (
    select src, dst, sum(n) as n from (
        select src, dst, count(*) as n from links group by 1, 2
        union all select host, domain, 1 from own union all select domain, host, 1 from own)
    where src <> dst group by src, dst),
directed as (select 'trust' as kind, src, dst, n from edges
             union all select 'distrust', dst, src, n from edges),
shares as (select kind, src, dst, n / sum(n) over (partition by kind, src) as share from directed),
marked as (
    select case says when 'allow' then 'trust' else 'distrust' end as kind, host, count(*) as n
    from rows where says is not null and host <> '' group by 1, 2),
seeds as (select kind, host, n / sum(n) over (partition by kind) as rank from marked),
""" + _ranks(90) + r""",
per as (select host, coalesce(sum(rank) filter (where kind = 'distrust'), 0)
               > 1.001 * coalesce(sum(rank) filter (where kind = 'trust'), 0) as distrusted
        from r90 group by host)
select page_id, host, path, rule,
       coalesce(says, case when distrusted then 'block' else 'allow' end) as verdict
from rows left join per using (host)
"""

ORACLE["op11_hard_negatives"] = r"""
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
           cast(list_dot_product(a.v, r.v) as bigint) as score
    from usable a join usable r on a.vec_id <> r.vec_id
    where a.vec_id % 50 = 0),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score
    from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
found as (
    select p.anchor_id, p.positive_id,
           row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id) as place,
           n.other_id as negative_id, p.positive_score, n.score as negative_score
    from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
     and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score)
select anchor_id, positive_id, cast(place as integer) as rank, negative_id, positive_score, negative_score
from found where place <= 3
"""

ORACLE["op12_line_dedup"] = r"""
with split as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (select doc_id, unnest(l) as line, unnest(range(len(l))) as pos from split),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines),
repeated as (
    select key, max(doc_id) as keeper from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5),
judged as (
    select doc_id, line, pos, keeper is not null and doc_id <> keeper as goes
    from keyed left join repeated using (key))
select doc_id, count(*) as n_lines, count(*) filter (where goes) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not goes), '')) as kept_sha256
from judged group by doc_id
"""
