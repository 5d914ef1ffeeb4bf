"""SQL twin of the mix of single-source documents."""

from deskcorpus.llm.mixing import MAX_REPEATS, SEED, WEIGHTS

MIXING_SQL = rf"""
with docs as (
    select doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
           md5('{SEED}:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) as place
    from documents
), sources as (
    select source, sum(size)::bigint as source_size,
           {list(WEIGHTS)}[1 + (row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)}] as w
    from docs group by source
), ordered as (
    select *, row_number() over o as k,
           coalesce(sum({MAX_REPEATS} * source_size) over (o rows between unbounded preceding and 1 preceding), 0) as capped,
           sum(w) over (o rows between current row and unbounded following) as free,
           (select sum(size) from docs) as total
    from sources
    window o as (order by {MAX_REPEATS} * source_size / w, source nulls last)
), level as (
    select min_by((total - capped)::double / free::double, k) as t
    from ordered where w * ((total - capped)::double / free::double) <= {MAX_REPEATS} * source_size
), targets as (
    select source, source_size,
           case when w * t > {MAX_REPEATS} * source_size then ({MAX_REPEATS} * source_size)::double else w * t end as target
    from ordered, level
), shares as (
    select *, floor(target)::bigint // greatest(source_size, 1) as passes,
           floor(target)::bigint % greatest(source_size, 1) as rest
    from targets
)
select doc_id, size, source_size, target,
       (passes * size + greatest(least(size, rest - coalesce(sum(size) over (
           partition by d.source order by place, doc_id, size
           rows between unbounded preceding and 1 preceding), 0)), 0))::bigint as taken
from docs d join shares s on d.source is not distinct from s.source
"""
