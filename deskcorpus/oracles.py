"""DuckDB statements that compute the registered queries independently.

They restate each rule over whole tables with plain SQL: global ``row_number`` where
the engine uses cut points, ``unnest`` and ``group by`` where it folds arrays."""

from __future__ import annotations

from deskcorpus.config import SYSTEM_PROMPT
from deskcorpus.functions.prompts import CONTEXT_LEAD, CONTEXT_QUESTION
from deskcorpus.operators.filters import CATEGORIES
from deskcorpus.operators.guardrail import KEYWORDS, OFF_TOPIC_REPLY
from deskcorpus.queries import DATA_KEYWORDS, PART_TYPES, STOP_WORDS

TOKEN_RE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
PAIRS = """select u.conv_id || ':' || u.turn as pair_id, u.text as instruction, u.reply as response
    from (select *, lead(role) over w as next_role, lead(text) over w as reply
          from conversations window w as (partition by conv_id order by turn)) u
    where u.role = 'user' and u.next_role = 'assistant'"""
DOC_PAIRS = """select doc_id, 'Document in ' || lang as instruction, text as response,
    source as category from documents"""
LABELLED = "select d.*, l.quality, l.toxic from documents d left join labels l using (doc_id)"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def names(values) -> str:
    return ", ".join(lit(v) for v in values)


def swap(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def squeeze(x: str) -> str:
    return f"trim({swap(x, chr(92) + 's+', ' ')})"


def core(x: str) -> str:
    x = swap(x, "<[^>]+>", " ")
    x = swap(x, r"https?://\S+|www\.\S+", " ")
    x = swap(x, r"[\n\t\r]", "")
    x = swap(x, r"""[^\p{L}\p{N}_\s.,!?'"%$€£@#:/()-]""", " ")
    return squeeze(x)


def decoded(x: str) -> str:
    x = swap(x, "<[^>]+>", " ")
    for entity, plain in (
        ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"),
        ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ):
        x = f"replace({x}, {lit(entity)}, {lit(plain)})"
    return x


def ascii_clean(x: str) -> str:
    return squeeze(swap(f"strip_accents({decoded(x)})", r"[^\x00-\x7F]", ""))


def n_words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"


def toks(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(TOKEN_RE)})"


def n_toks(x: str) -> str:
    return f"len({toks(x)})"


def order_by_hash(key: str) -> str:
    return f"order by md5('42:' || {key}::varchar), {key}"


def ranked(source: str, key: str) -> str:
    return f"""select *, row_number() over ({order_by_hash(key)}) as rn, count(*) over () as n
        from ({source})"""


def floor_split(source: str, key: str) -> str:
    return f"""select * exclude (rn, n), case
        when rn <= floor(n * 0.8::double) then 'train'
        when rn <= floor(n * 0.8::double) + floor(n * 0.1::double) then 'val'
        else 'test' end as split from ({ranked(source, key)})"""


def ceil_split(source: str, key: str) -> str:
    return f"""select * exclude (rn, n), case
        when rn <= n - ceil(n * 0.2::double) then 'train'
        when rn <= n - ceil(ceil(n * 0.2::double) * 0.5::double) then 'val'
        else 'test' end as split from ({ranked(source, key)})"""


def approx_split(source: str, key: str) -> str:
    place = f"('0x' || substr(md5('42:' || {key}::varchar), 1, 8))::bigint / 4294967296.0::double"
    return f"""select * exclude (place), case when place < 0.8::double then 'train'
        when place < 0.8::double + 0.1::double then 'val' else 'test' end as split
        from (select *, {place} as place from ({source}))"""


def bounded(x: str, low: int, high: int) -> str:
    return f"({n_words(x)} between {low} and {high})"


def core_pairs(source: str, key: str, extra: str = "", low: int = 2, high: int = 512) -> str:
    """The reference order of steps: deduplicate, clean, filter, deduplicate."""
    more = f", {extra}" if extra else ""
    return f"""select * from (
        select {key}, {core('instruction')} as instruction, {core('response')} as response{more}
        from (select * from ({source})
              qualify row_number() over (partition by instruction, response order by {key}) = 1))
        where length(instruction) > 0 and length(response) > 0
          and {bounded('instruction', low, high)} and {bounded('response', low, high)}
        qualify row_number() over (partition by instruction, response order by {key}) = 1"""


def prompt(i: str, r: str | None = None, strip: bool = True) -> str:
    t = (lambda x: f"trim({x}, e' \\n\\t')") if strip else (lambda x: x)
    head = f"e'### Instruction:\\nCustomer:\\n' || {t(i)} || e'\\n\\n### Response:\\n'"
    return head if r is None else f"{head} || {t(r)}"


def prompt_minimal(i: str, r: str | None = None) -> str:
    t = lambda x: f"trim({x}, e' \\n\\t')"
    head = f"e'### Instruction:\\n\\nCustomer:\\n\\n' || {t(i)} || e'\\n\\n\\n\\n### Response:\\n'"
    return head if r is None else f"{head} || e'\\n' || {t(r)}"


def noisy(i: str, r: str) -> str:
    return f"""(length({i}) < 3 or length({r}) < 3 or length({i}) > 2000 or length({r}) > 2000
        or trim({i}, e' \\n\\t') = trim({r}, e' \\n\\t')
        or contains({i}, '{{{{') or contains({r}, '{{{{'))"""


def word_hit(x: str, keywords, whole: bool = True) -> str:
    end = r"([^\p{L}\p{N}_]|$)" if whole else ""
    pattern = rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(keywords)}){end}"
    return f"regexp_matches(lower({x}), {lit(pattern)})"


def on_topic(x: str, keywords=KEYWORDS, whole: bool = True) -> str:
    return f"({n_words(x)} <= 3 or {word_hit(x, keywords, whole)})"


def describe(source: str, columns) -> str:
    return " union all ".join(
        f"""select '{c}' as name, count({c}) as count, avg({c})::double as mean,
        stddev_samp({c})::double as std, min({c})::double as min,
        quantile_cont({c}::double, 0.25) as q25, quantile_cont({c}::double, 0.5) as q50,
        quantile_cont({c}::double, 0.75) as q75, max({c})::double as max from ({source})"""
        for c in columns
    )


def text_profile(source: str, columns) -> str:
    return " union all ".join(
        f"""select '{c}' as name, sum(n)::bigint as count, count(*) as "unique",
        arg_min(v, (-n, sha256(length(v)::varchar || ':' || v))) as top, max(n) as freq
        from (select {c} as v, count(*) as n from ({source}) where {c} is not null group by 1)"""
        for c in columns
    )


def histogram(source: str, column: str, bins: int = 40) -> str:
    return f"""with s as (select min({column})::double as lo,
            (max({column}) - min({column}))::double / {bins} as w from ({source})),
        c as (select least(floor(({column}::double - lo) / w), {bins - 1})::bigint as bin,
            count(*) as n from ({source}), s group by 1)
        select b.range as bin, round(lo + b.range * w, 6) as left_edge,
            round(lo + (b.range + 1) * w, 6) as right_edge, coalesce(n, 0) as n
        from range({bins}) b cross join s left join c on c.bin = b.range"""


# --- scores ---------------------------------------------------------------------


def rouge_toks(x: str) -> str:
    text = swap(f"lower({x})", "[^a-z0-9]+", " ")
    return f"list_filter(string_split({text}, ' '), lambda w: w <> '')"


def bleu_toks(x: str) -> str:
    x = f"replace(replace(replace({x}, '<skipped>', ''), e'-\\n', ''), e'\\n', ' ')"
    for entity, plain in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        x = f"replace({x}, {lit(entity)}, {lit(plain)})"
    x = swap(f"' ' || {x} || ' '", r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 ")
    x = swap(x, r"([^0-9])([\.,])", r"\1 \2 ")
    x = swap(x, r"([\.,])([^0-9])", r" \1 \2")
    x = swap(x, r"([0-9])(-)", r"\1 \2 ")
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def overlap(orders, tokenise) -> str:
    """CTEs: base(pair_id, p, r) and per pair and order n the matches and totals."""
    orders = ", ".join(map(str, orders))
    gram = "unnest(list_transform(range(1, len({t}) - n + 2), lambda i: array_to_string({t}[i:i + n - 1], ' ')))"
    return f"""base as materialized (select pair_id, {tokenise('instruction')} as p,
            {tokenise('response')} as r from ({PAIRS})),
        sides as (select pair_id, n, 0 as side, {gram.format(t='p')} as g
                  from base, (select unnest([{orders}]) as n)
                  union all
                  select pair_id, n, 1, {gram.format(t='r')}
                  from base, (select unnest([{orders}]) as n)),
        counted as (select pair_id, n, g, count(*) filter (side = 0) as a,
                    count(*) filter (side = 1) as b from sides group by all),
        hits as (select pair_id, n, sum(least(a, b))::bigint as hits,
                 sum(a)::bigint as a, sum(b)::bigint as b from counted group by all)"""


LCS = """list_reduce(p, lambda prev, x: list_reduce(range(1, len(r) + 1),
    lambda acc, j: list_append(acc, greatest(acc[-1], prev[j + 1], prev[j] + (r[j] = x)::int)),
    [0]), list_transform(range(len(r) + 1), lambda j: 0))[-1]"""


def rouge_rows() -> str:
    def score(n: int) -> str:
        return f"""coalesce(max(case when n = {n} and hits > 0
            then 2.0::double * hits / (a + b) end), 0) as rouge{n}"""

    return f"""with {overlap((1, 2), rouge_toks)},
        rl as (select pair_id, case when len(p) > 0 and len(r) > 0
               then 2.0::double * {LCS} / (len(p) + len(r)) else 0 end as rougeL from base),
        rn as (select base.pair_id, {score(1)}, {score(2)}
               from base left join hits using (pair_id) group by 1)
        select pair_id, rouge1, rouge2, rougeL from rn join rl using (pair_id)"""


def bleu_value() -> str:
    hits = ", ".join(f"coalesce(max(h) filter (n = {n}), 0) as h{n}" for n in (1, 2, 3, 4))
    totals = ", ".join(f"coalesce(max(t) filter (n = {n}), 0) as t{n}" for n in (1, 2, 3, 4))
    misses = [" + ".join(f"(h{m} = 0)::int" for m in range(1, n + 1)) for n in (1, 2, 3, 4)]
    logs = " + ".join(
        f"ln(case when h{n} = 0 then 1.0 / (pow(2, {misses[n - 1]}) * t{n}) "
        f"else h{n}::double / t{n} end)"
        for n in (1, 2, 3, 4)
    )
    return f"""with {overlap((1, 2, 3, 4), bleu_toks)},
        per as (select n, sum(hits) as h, sum(a) as t from hits group by n),
        wide as (select {hits}, {totals} from per),
        lens as (select sum(len(p))::double as c, sum(len(r))::double as rf from base)
        select case when greatest(h1, h2, h3, h4) = 0 or least(t1, t2, t3, t4) = 0 then 0
            else 100 * (case when c < rf then exp(1 - rf / c) else 1 end)
                 * exp(({logs}) / 4) end as bleu from wide, lens"""


def bigrams(source: str, carry: str = "") -> str:
    return f"""select {carry} unnest(w[1:len(w) - 1]) as prev, unnest(w[2:len(w)]) as word
        from (select *, list_filter(regexp_split_to_array(lower(text), '\\s+'),
              lambda t: t <> '') as w from ({source})) where len(w) > 1"""


def bigram_loss() -> str:
    split = approx_split("select doc_id, text from documents", "doc_id")
    return f"""with s as materialized ({split}),
        c2 as (select prev, word, count(*) as n
               from ({bigrams("select * from s where split = 'train'")}) group by all),
        c1 as (select prev, sum(n) as m from c2 group by prev),
        v as (select count(distinct w) + 1 as v
              from (select prev as w from c2 union all select word from c2)),
        f as ({bigrams("select * from s where split = 'test'", 'doc_id,')})
        select doc_id, round(avg(-ln((coalesce(n, 0) + 1.0::double)
                                   / (coalesce(m, 0) + 1.0::double * v))), 6) as loss
        from f left join c2 using (prev, word) left join c1 using (prev), v group by doc_id"""


def backoff_loss(order: int = 3, d: float = 0.75) -> str:
    """The model by its definition, order by order, for every place of the test texts."""
    split = approx_split("select doc_id, text from documents", "doc_id")
    some = range(1, order + 1)
    words = "list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda t: t <> '')"
    steps, p = [], "1.0::double / (v + 1)"
    for n in some:
        raw = f"r where n = {n}" if n == order else f"""(select context[2:] as context, word
            from r where n = {n + 1}) group by all"""
        count = "count" if n == order else "count(*) as count"
        steps.append(f"g{n} as materialized (select context, word, {count} from {raw})")
        steps.append(f"h{n} as materialized (select context, sum(count) as total, count(*) as kinds from g{n} group by all)")
    joins = ""
    for n in some:
        tail = f"f.context[len(f.context) - {n - 2}:]" if n > 1 else "f.context[1:0]"
        joins += f""" left join h{n} on f.n >= {n} and h{n}.context = {tail}
            left join g{n} on f.n >= {n} and g{n}.context = {tail} and g{n}.word = f.word"""
        p = f"""case when h{n}.total is null then {p} else greatest(coalesce(g{n}.count, 0) - {d}::double, 0) / h{n}.total
            + {d}::double * h{n}.kinds / h{n}.total * ({p}) end"""
    places = f"""select *, unnest(range(1, len(w) + 1)) as i from (select *, {words} as w from s)"""
    return f"""with s as materialized ({split}),
        places as materialized ({places}),
        r as materialized (select n, context, word, count(*) as count from (
            select n, w[i - n + 1:i - 1] as context, w[i] as word
            from (select *, unnest(range(1, least(i, {order}) + 1)) as n from places where split = 'train')) group by all),
        v as (select count(*) as v from r where n = 1),
        {", ".join(steps)},
        f as materialized (select doc_id, least(i, {order}) as n, w[i] as word,
                  w[i - least(i, {order}) + 1:i - 1] as context from places where split = 'test')
        select doc_id, round(avg(-ln({p})), 6) as loss from f {joins}, v group by doc_id"""


def packed(length: int, shards: int, keep_tail: bool) -> str:
    shard = f"(('0x' || substr(md5('42:' || doc_id::varchar), 1, 8))::bigint % {shards})::int"
    full = "" if keep_tail else f"where n_tokens = {length}"
    return f"""with t as (select doc_id, {shard} as shard, {toks('text')} as w from documents),
        f as (select shard, doc_id, unnest(w) as token, generate_subscripts(w, 1) as i from t),
        o as (select shard, token,
              row_number() over (partition by shard order by doc_id, i) - 1 as place from f),
        b as (select shard, ((place - place % {length}) / {length})::bigint as block,
              count(*)::int as n_tokens,
              string_agg(token, ' ' order by place) as packed from o group by 1, 2)
        select shard, block, n_tokens, packed from b {full}"""


def model(x: str) -> str:
    """What the counting stand-in model adds to a prompt."""
    return f"'This message has ' || length({prompt(x)})::varchar || ' characters.'"


def funnel() -> str:
    return f"""with raw as ({DOC_PAIRS}),
        d as (select distinct instruction, response from raw),
        c as (select {core('instruction')} as i, {core('response')} as r from d),
        f as (select * from c where length(i) > 0 and length(r) > 0),
        s as (select * from f where {bounded('i', 2, 512)} and {bounded('r', 2, 512)})
        select 0 as position, 'raw' as stage, (select count(*) from raw) as n_rows
        union all select 1, 'distinct', (select count(*) from d)
        union all select 2, 'filled', (select count(*) from f)
        union all select 3, 'sized', (select count(*) from s)
        union all select 4, 'final', (select count(*) from (select distinct i, r from s))"""


def leaks() -> str:
    split = floor_split(DOC_PAIRS, "doc_id")
    return f"""with c as (select lower({ascii_clean('instruction')}) as i,
            lower({ascii_clean('response')}) as r, split from ({split})),
        g as (select i, r, count(*) as n from c group by all having count(distinct split) > 1)
        select count(*) as shared_values, coalesce(sum(n), 0)::bigint as rows_involved from g"""


def eval_job() -> str:
    split = floor_split(PAIRS, "pair_id")
    chosen = f"""select pair_id, {model('instruction')} as instruction, response
        from ({split}) where split = 'test'"""
    return report(chosen, "null::double")


def report(source: str, ppl: str) -> str:
    rows = rouge_rows().replace(PAIRS, source)
    score = bleu_value().replace(PAIRS, source)
    return f"""select round(avg(rouge1), 6) as rouge1, round(avg(rouge2), 6) as rouge2,
        round(avg(rougeL), 6) as rougeL, (select round(bleu, 6) from ({score})) as bleu,
        {ppl} as perplexity, count(*) as n_eval_samples from ({rows})"""


def build() -> dict[str, str]:
    text_core = prompt("instruction", "response")
    noisy_text = f"'so: ' || {text_core} || e'\\n### Response:\\n again ' || instruction"
    last = lambda x, mark: f"string_split({x}, {mark})[-1]"
    strip = lambda x: f"trim({x}, e' \\n\\t')"
    ppl = "(select round(exp(avg(value / 100)), 6) from events)"
    documents_50 = f"select * from documents {order_by_hash('doc_id')} limit 50"
    prepared = f"""select doc_id, {prompt('i', 'r')} as text, split from (
        select doc_id, split, {core('instruction')} as i, {core('response')} as r
        from ({approx_split(DOC_PAIRS, 'doc_id')}))
        where length(i) > 0 and length(r) > 0
          and {bounded('i', 2, 512)} and {bounded('r', 2, 512)}"""
    return {
        "flagship_split_summary": f"""select split, count(*) as n_examples,
            sum({n_toks('text')})::bigint as n_tokens, round(avg({n_toks('text')}), 6) as mean_tokens
            from (select split, {text_core} as text
                  from ({floor_split(core_pairs(PAIRS, 'pair_id'), 'pair_id')})) group by split""",
        "preprocess_core": core_pairs(DOC_PAIRS, "doc_id", "category"),
        "preprocess_core_pairs": core_pairs(PAIRS, "pair_id", "", 2, 400),
        "preprocess_ascii": f"""select doc_id, split, instruction, response, category from (
            select doc_id, split, category, lower({ascii_clean('instruction')}) as instruction,
                   lower({ascii_clean('response')}) as response
            from ({floor_split(DOC_PAIRS, 'doc_id')}))
            where not {noisy('instruction', 'response')}
            qualify row_number() over (partition by split, instruction, response
                                       order by doc_id) = 1""",
        "preprocess_minimal": f"""select * from ({DOC_PAIRS})
            where instruction is not null and response is not null
            qualify row_number() over (partition by instruction, response order by doc_id) = 1""",
        "preprocess_funnel": funnel(),
        "postconditions": f"""select count(*) as n_rows,
            count(*) filter (instruction = '') as empty_instruction,
            count(*) filter (response = '') as empty_response,
            count(*) - count(distinct (instruction, response)) as duplicate_pairs
            from ({DOC_PAIRS})""",
        "split_leak_report": leaks(),
        "clean_core_pages": f"select page_id, {core('html')} as cleaned from pages",
        "clean_ascii_pages": f"select page_id, lower({ascii_clean('html')}) as cleaned from pages",
        "clean_core_documents": f"select doc_id, lower({core('text')}) as cleaned from documents",
        "clean_ascii_documents": f"select doc_id, {ascii_clean('text')} as cleaned from documents",
        "clean_steps": rf"""select page_id, {swap('html', '<[^>]+>', ' ')} as no_tags,
            {swap('html', r'https?://\S+|www\.\S+', ' ')} as no_urls,
            {swap('html', r'[\n\t\r]', '')} as visible, {squeeze('html')} as squeezed,
            {decoded('html')} as decoded from pages""",
        "noise_no_punct": rf"""select doc_id, {swap('text', r'[^\p{L}\p{N}_\s]', ' ')} as bare,
            {swap('text', r'''[^\p{L}\p{N}_\s.,!?'"%$€£@#:/()-]''', ' ')} as punctuated
            from documents""",
        "word_and_char_counts": f"""select doc_id, {n_words('text')} as n_words,
            length(text) as n_code_points from documents""",
        "standardize_alias": """select doc_id, text as instruction, source as response,
            lang as category from documents""",
        "resolve_loose": """select doc_id, text as "Text", n_chars from documents""",
        "resolve_explore": f"""select lang as category, {n_words('text')} as text_words,
            {n_words('source')} as response_words from documents""",
        "drop_empty_and_bounds": f"""select doc_id, {n_words('text')} as n_words from documents
            where length(text) > 0 and {bounded('text', 2, 512)}""",
        "noise_predicate": f"select doc_id, {noisy('source', 'text')} as noisy from documents",
        "category_whitelist": f"""select p_partkey, p_type from part
            where upper(p_type) in ({names(PART_TYPES)})
               or not exists (select 1 from part where upper(p_type) in ({names(PART_TYPES)}))""",
        "category_whitelist_fallback": f"""select p_partkey, p_type from part
            where upper(p_type) in ({names(CATEGORIES)})
               or not exists (select 1 from part where upper(p_type) in ({names(CATEGORIES)}))""",
        "dropna_subset": f"""select doc_id, quality, toxic from ({LABELLED})
            where quality is not null and toxic is not null""",
        "guardrail_flags": f"""select kind, id, {on_topic('body')} as on_topic from (
            select 'page' as kind, page_id as id, html as body from pages
            union all select 'document', doc_id, text from documents)""",
        "guardrail_keywords": f"""select doc_id, {on_topic('text', DATA_KEYWORDS)} as whole_word,
            {on_topic('text', DATA_KEYWORDS, False)} as prefix from documents""",
        "guardrail_phrases": rf"""with d as (select doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') as w from documents),
            b as (select regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') as w from benchmark),
            p as (select distinct array_to_string(w[i:i + 2], ' ') as phrase, 3 as k
                  from (select w, unnest(range(1, len(w) - 1)) as i from b)
                  union all select unnest([{names(DATA_KEYWORDS)}]), 1),
            g as (select doc_id, i - 1 as position, k, array_to_string(w[i:i + k - 1], ' ') as phrase
                  from (select *, unnest(range(1, len(w) + 1)) as i from d), (select distinct k from p)
                  where i + k - 1 <= len(w))
            select doc_id, phrase, position::int as position from g join p using (phrase, k)""",
        "guardrail_routed": f"""select pair_id, on_topic,
            case when on_topic then {model('instruction')} else {lit(OFF_TOPIC_REPLY)} end as reply
            from (select *, {on_topic('instruction', DATA_KEYWORDS)} as on_topic from ({PAIRS}))""",
        "dedup_keep_first": """select * from documents
            qualify row_number() over (partition by text order by doc_id) = 1""",
        "stream_keep_first": """select * from documents
            qualify row_number() over (partition by text order by doc_id) = 1""",
        "duplicate_counts": """select count(*) as n_rows, count(distinct (text, lang)) as n_distinct,
            count(*) - count(distinct (text, lang)) as n_duplicates from documents""",
        "duplicate_rows": """select sum(n)::bigint as n_rows, count(*) as n_distinct,
            sum(n - 1)::bigint as n_duplicates from (select text, lang, source, n_chars,
            count(*) as n from documents group by all)""",
        "profile_nulls": " union all ".join(
            f"""select '{c}' as name, '{t}' as dtype, count(*) as n_rows, count({c}) as non_null,
            count(*) - count({c}) as nulls from ({LABELLED})"""
            for c, t in (
                ("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
                ("source", "string"), ("n_chars", "bigint"), ("quality", "int"),
                ("toxic", "int"),
            )
        ),
        "profile_mixed": f"""select name, count, "unique", top, freq, null::double as mean,
                null::double as std, null::double as min, null::double as q25,
                null::double as q50, null::double as q75, null::double as max
            from ({text_profile('select * from customer', ['c_name', 'c_mktsegment'])})
            union all select name, count, null, null, null, round(mean, 6), round(std, 6),
                round(min, 6), round(q25, 6), round(q50, 6), round(q75, 6), round(max, 6)
            from ({describe('select * from customer', ['c_custkey', 'c_nationkey', 'c_acctbal'])})""",
        "profile_text": text_profile("select * from documents", ["text", "lang", "source"]),
        "describe_lengths": f"""select name, count, round(mean, 6) as mean, round(std, 6) as std,
            min, round(q25, 6) as q25, round(q50, 6) as q50, round(q75, 6) as q75, max from ({
            describe(f'''select length(text) as chars, {n_words('text')} as words,
            {n_toks("source || ' ' || text")} as tokens from documents''',
            ['chars', 'words', 'tokens'])})""",
        "describe_numeric": f"""select name, count, round(mean, 6) as mean, round(std, 6) as std,
            round(min, 6) as min, round(q25, 6) as q25, round(q50, 6) as q50,
            round(q75, 6) as q75, round(max, 6) as max from ({
            describe('select * from lineitem',
                     ['l_quantity', 'l_extendedprice', 'l_discount'])})""",
        "value_counts": "select event_type, count(*) as count from events group by 1",
        "value_counts_labels": f"""select quality, count(*) as count from ({LABELLED})
            where quality is not null group by 1""",
        "histogram_40": histogram("select * from documents", "n_chars"),
        "histogram_prices": f"""select bin, n from ({
            histogram('select * from lineitem', 'l_extendedprice')})""",
        "pct_over_limit": f"""select round(avg(({n_toks('text')} > 512)::int) * 100, 6) as pct_over
            from documents""",
        "top_terms": rf"""select term, count(*) as count from (
            select unnest(regexp_extract_all(lower(source || ' ' || text),
                   '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_'']*')) as term from documents)
            where term not in ({names(STOP_WORDS)}) and not regexp_full_match(term, '\p{{N}}+')
            group by 1 order by count desc, term limit 200""",
        "frequent_terms": rf"""select term, count(*) as count from (
            select unnest(regexp_extract_all(lower(source || ' ' || text),
                   '[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_'']*')) as term from documents)
            where term not in ({names(STOP_WORDS)}) and not regexp_full_match(term, '\p{{N}}+')
            group by 1 order by count desc, term limit 200""",
        "value_counts_all": " union all ".join(
            f"""select '{c}' as name, {c}::varchar as value, count(*) as count from ({source})
                where {c} is not null group by all"""
            for source, columns in (
                ("select * from orders", ("o_orderstatus", "o_orderpriority")),
                (LABELLED, ("lang", "source", "quality", "toxic")),
            )
            for c in columns
        ),
        "sample_k": f"select * from documents {order_by_hash('doc_id')} limit 100",
        "cap_k": f"""select o_orderkey, o_custkey, o_orderstatus from orders
            {order_by_hash('o_orderkey')} limit 6000""",
        "shuffle_order": f"""select doc_id, row_number() over ({order_by_hash('doc_id')}) - 1
            as rank from documents""",
        "head_k": "select doc_id, lang from documents order by doc_id limit 10",
        "split_floor": f"select doc_id, split from ({floor_split('select * from documents', 'doc_id')})",
        "split_ceil": f"select doc_id, split from ({ceil_split('select * from documents', 'doc_id')})",
        "split_approx": f"select doc_id, split from ({approx_split('select * from documents', 'doc_id')})",
        "split_sizes": f"""select split, count(*) as n_rows
            from ({floor_split('select * from orders', 'o_orderkey')}) group by 1""",
        "prompt_core": f"select pair_id, {text_core} as text from ({PAIRS})",
        "prompt_unstripped": f"""select pair_id, {prompt('instruction', 'response', False)} as text
            from ({PAIRS})""",
        "prompt_only": f"""select pair_id, {prompt('instruction')} as core,
            {prompt_minimal('instruction')} as minimal from ({PAIRS})""",
        "prompt_minimal": f"""select pair_id, {prompt_minimal('instruction', 'response')} as text
            from ({PAIRS})""",
        "messages": f"""select pair_id, 0 as position, 'system' as role,
                {lit(SYSTEM_PROMPT)} as content from ({PAIRS})
            union all select pair_id, 1, 'user', {strip('instruction')} from ({PAIRS})
            union all select pair_id, 2, 'assistant', {strip('response')} from ({PAIRS})""",
        "messages_open": f"""select doc_id, case when quality = 1 then 3 else 2 end as n,
            {strip('text')} as user from ({LABELLED})""",
        "history_display": """select conv_id, cast(row_number() over (partition by conv_id order by turn) - 1 as integer)
            as position, role, text as content from conversations""",
        "extract_response": f"""select pair_id, {strip('response')} as led,
            {strip(last(noisy_text, "'### Response:'"))} as marked,
            {strip(last('response', "'### Response:'"))} as plain,
            {last(noisy_text, "e'### Response:" + chr(92) + "n'")} as minimal from ({PAIRS})""",
        "context_prefix": f"""select pair_id, case when coalesce(text, '') = '' then instruction
            else {lit(CONTEXT_LEAD)} || e'\\n' || text || e'\\n\\n' || {lit(CONTEXT_QUESTION)}
                 || e'\\n' || instruction end as message
            from ({PAIRS}) p
            left join documents d on d.doc_id = split_part(p.pair_id, ':', 1)::bigint""",
        "context_truncate": f"""select doc_id,
            left({strip("lang || e'" + chr(92) + "n' || text || e'" + chr(92) + "n' || source")},
                 3000) as context from documents""",
        "token_lengths": f"""select pair_id, {n_toks(text_core)} as token_length from ({PAIRS})""",
        "truncate_tokens": f"""select doc_id, len(t) as n_tokens, array_to_string(t, ' ') as kept
            from (select doc_id, ({toks('text')})[1:512] as t from documents)""",
        "pack_sequences": packed(512, 16, True),
        "pack_full_blocks": packed(2048, 4, False),
        "generate_reply": f"select doc_id, {model('text')} as prediction from documents",
        "rouge_per_pair": f"""select pair_id, round(rouge1, 6) as rouge1, round(rouge2, 6) as rouge2,
            round(rougeL, 6) as rougeL from ({rouge_rows()})""",
        "rouge_corpus": f"""select round(avg(rouge1), 6) as rouge1, round(avg(rouge2), 6) as rouge2,
            round(avg(rougeL), 6) as rougeL from ({rouge_rows()})""",
        "bleu_corpus": f"select round(bleu, 6) as bleu from ({bleu_value()})",
        "bleu_counts": f"""with {overlap((1, 2, 3, 4), bleu_toks)}
            select base.pair_id, {', '.join(
                f"coalesce(max(hits) filter (n = {n}), 0)::int as hits{n}, "
                f"coalesce(max(a) filter (n = {n}), 0)::int as total{n}" for n in (1, 2, 3, 4))},
            any_value(len(p))::int as sys_len, any_value(len(r))::int as ref_len
            from base left join hits using (pair_id) group by 1""",
        "comparison_table": f"""select pair_id, instruction, response as ground_truth,
            'Re: ' || instruction as prediction from ({PAIRS})""",
        "eval_report": report(PAIRS, ppl),
        "eval_job": eval_job(),
        "perplexity": "select round(exp(avg(value / 100)), 6) as perplexity from events",
        "bigram_loss": bigram_loss(),
        "backoff_loss": backoff_loss(),
        "loss_curves": """select event_id as step, case when event_type = 'view'
            then 'eval_loss' else 'train_loss' end as series, value from events""",
        "csv_roundtrip": "select * from documents",
        "csv_ranges_roundtrip": "select * from documents",
        "jsonl_roundtrip": LABELLED,
        "split_roundtrip": floor_split("select * from documents", "doc_id"),
        "raw_copy": "select * from documents",
        "column_map": "select doc_id, text as instruction, source as response from documents",
        "metrics_sink": report(PAIRS, "null::double"),
        "caller_tokens": """select doc_id, len(string_split(text, ' ')) as n_tokens from documents""",
        "order_status": """select o_orderkey, 'Order ' || o_orderkey || ': ' || o_orderstatus as message
            from orders""",
        "missing_predictions": f"""select pair_id, instruction, response as ground_truth,
            case when length(instruction) % 2 = 0 then instruction end as prediction from ({PAIRS})""",
        "duplicate_exchanges": f"""select count(*) as n_rows, count(distinct m) as n_distinct,
            count(*) - count(distinct m) as n_duplicates from (
            select [{{'role': 'user', 'content': instruction}},
                {{'role': 'assistant', 'content': response}}] as m from ({PAIRS}))""",
        "profile_nan": f"""select name, count, round(mean, 6) as mean, round(std, 6) as std,
            round(min, 6) as min, round(q25, 6) as q25, round(q50, 6) as q50,
            round(q75, 6) as q75, round(max, 6) as max from ({
            describe("select case when l_discount > 0 then l_extendedprice / l_discount end as ratio from lineitem",
                     ['ratio'])})""",
        "profile_events": f"""select name, count, "unique", top, freq, null::double as mean,
                null::double as std, null::double as min, null::double as q25,
                null::double as q50, null::double as q75, null::double as max
            from ({text_profile("select strftime(ts, '%Y-%m-%d %H:%M:%S') || case when microsecond(ts) % 1000000 = 0 then '' else '.' || rtrim(strftime(ts, '%f'), '0') end as ts, event_type, props from events", ['ts', 'event_type', 'props'])})
            union all select name, count, null, null, null, round(mean, 6), round(std, 6),
                round(min, 6), round(q25, 6), round(q50, 6), round(q75, 6), round(max, 6)
            from ({describe('select * from events', ['event_id', 'user_id', 'value'])})""",
        "training_export": f"""select case split when 'val' then 'validation' else split end as split,
            {text_core} as text from ({ceil_split(PAIRS, 'pair_id')})""",
        "published_source": "select * from documents",
        "fallback_source": "select * from documents",
        "preview_sample": documents_50,
        "stream_prepared": prepared,
    }
