"""SQL twin of the quality table."""

from __future__ import annotations

from deskcorpus.llm.quality import (
    MAX_DUPLICATE_LINES,
    MAX_REPEATED_PERCENT,
    MAX_SYMBOLS_PER_WORD,
    MIN_LETTERS,
    MIN_WORDS,
    WORD_LENGTHS,
)

QUALITY_SQL = rf"""
with words as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines,
           row_number() over () as r
    from documents
), windows as (
    select r, i, [w[i], w[i + 1], w[i + 2]] as g
    from (select r, w, unnest(range(1, len(w) - 1)) as i from words)
), repeated as (
    select r, count(distinct j) as n from (
        select r, unnest([i, i + 1, i + 2]) as j
        from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1
    ) group by r
), counts as (
    select doc_id, len(w)::bigint as n_words,
           coalesce(length(array_to_string(w, '')), 0)::bigint as word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
           coalesce(n, 0)::bigint as n_repeat_words,
           len(lines) as n_lines,
           length(regexp_replace(text, '\P{{L}}+', '', 'g')) as letters
    from words left join repeated using (r)
), judged as (
    select *, (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words) as base_failed
    from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or n_symbols > {MAX_SYMBOLS_PER_WORD} * n_words
            or n_dup_lines > {MAX_DUPLICATE_LINES} * n_lines
            or word_chars < {WORD_LENGTHS[0]} * n_words or word_chars > {WORD_LENGTHS[1]} * n_words
            or letters < {MIN_LETTERS} * word_chars) as kept
from judged
"""
