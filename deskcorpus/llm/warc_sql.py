"""SQL twin of the archives' round trip."""

from deskcorpus.llm.warc import MIN_REVISIT_BYTES

WARC_SQL = f"""
with p as (
    select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages
), k as (
    select *, case when n >= {MIN_REVISIT_BYTES} then max(page_id) over (partition by body) end as keep from p
)
select page_id, n::bigint as payload_bytes, sha1(body) as payload_digest,
       case when keep is null or page_id is not distinct from keep then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from keep then keep end as refers_to
from k
"""
