"""SQL twin of the ranked lexical search."""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SEARCH_SQL = rf"""
with terms as (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) as term
    from documents
), postings as (
    select doc_id, term, cast(count(*) as bigint) as tf from terms group by all
), lengths as (
    select doc_id, cast(count(*) as bigint) as n from terms group by doc_id
), totals as (
    select cast(count(*) as bigint) as n_docs, cast(sum(n) as bigint) as n_terms from lengths
), weights as (
    select term, cast(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) as bigint) as w
    from postings, totals group by term
), norms as (
    select doc_id, 50 + (50 * n * n_docs) // n_terms as m from lengths, totals
), asked as (
    select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) as term
    from benchmark
), scores as (
    select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
    from asked join postings using (term) join weights using (term) join norms using (doc_id)
    group by item_id, doc_id
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scores where score > 0
qualify rank <= 50
"""
