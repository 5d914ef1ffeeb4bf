"""SQL twins of the preference segments and pairs."""

PARTS = """
with chosen as (
    select conv_id, turn, role, text from conversations
), last_turn as (
    select conv_id, max(turn) as t from chosen where role = 'assistant' group by conv_id
), rejected as (
    select c.conv_id, turn, role,
           case when role = 'assistant' and turn = t then left(text, length(text) // 2) else text end as text
    from chosen c left join last_turn l on c.conv_id = l.conv_id
), odd as (
    select conv_id, turn from (
        select *, 1 as n from chosen union all select *, -1 as n from rejected
    ) group by conv_id, turn, role, text having sum(n) != 0
), cuts as (
    select conv_id, min(turn) as begin_at from odd group by conv_id
), parts as (
    select c.*, case when begin_at is null or turn < begin_at then 'prompt' else 'chosen' end as part
    from chosen c left join cuts using (conv_id)
    union all
    select r.*, 'rejected' as part from rejected r join cuts using (conv_id) where turn >= begin_at
), segments as (
    select conv_id, turn, part, role, '<|im_start|>' || role || chr(10) as opening,
           text || '<|im_end|>' || chr(10) as content, part != 'prompt' and role = 'assistant' as loss
    from parts
)
"""
SEGMENTS_SQL = PARTS + "select * from segments"

PAIRS_SQL = PARTS + """
, placed as (
    select *, cast(sum(length(opening) + length(content)) over (
        partition by conv_id, part order by turn, role, content
        rows between unbounded preceding and current row) as bigint) as upto
    from segments
)
select conv_id, cast(0 as bigint) as stretch,
       coalesce(string_agg(opening || content, '' order by turn, role, content) filter (part = 'prompt'), '') as prompt,
       coalesce(string_agg(opening || content, '' order by turn, role, content) filter (part = 'chosen'), '') as chosen,
       coalesce(string_agg(opening || content, '' order by turn, role, content) filter (part = 'rejected'), '') as rejected,
       coalesce(string_agg((upto - length(content)) || '-' || upto, ',' order by turn, role, content)
           filter (part = 'chosen' and loss), '') as chosen_spans,
       coalesce(string_agg((upto - length(content)) || '-' || upto, ',' order by turn, role, content)
           filter (part = 'rejected' and loss), '') as rejected_spans
from placed group by conv_id
"""
