"""SQL twin of the exact-duplicate table."""

DEDUP_SQL = """
with texts as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') as t
    from documents
)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id is not distinct from max(doc_id) over same as kept, sha256(t) as text_sha256
from texts
window same as (partition by t)
"""
