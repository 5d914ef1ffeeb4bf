"""Quality rules as a short-circuit cascade, in built-in functions alone.

A rule rejects a document by a few signals, and a signal is an expression over the text or
over other signals. The cascade first learns on a bounded sample what each rule costs and
how many documents it rejects; rules then run in order of rejection per cost, and a
signal is computed only for the documents that no earlier rule has rejected. The order
changes the speed, never a verdict.

A rule's cost is the work of its signals in elementary steps (characters matched, elements
compared), counted on the sample: unlike clock times, it is the same in every run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import SPACE, WORD, text_of
from deskcorpus.stages import evaluate_once

SAMPLE_ROWS = 1000  # about so many documents set the order of the rules
SAMPLE_SEED = 17
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 0.1
MAX_DUPLICATE_LINES = 0.5
WORD_LENGTHS = (2.0, 15.0)
MIN_LETTERS = 0.5

CHARS = "char_length(_text)"


@dataclass(frozen=True)
class Signal:
    """``expression`` is SQL over the column ``_text`` and the signals in ``needs``, and
    ``work`` says how many steps it takes, over the same and the signal itself."""

    name: str
    expression: str
    needs: tuple[str, ...] = ()
    work: str = "1"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over signals, never null once they are known."""

    name: str
    rejects: str
    needs: tuple[str, ...]


SIGNALS = {
    s.name: s
    for s in (
        Signal("_words", rf"filter(split(_text, r'{SPACE}+'), w -> w != '')", work=f"4 * {CHARS}"),
        Signal("n_words", "cast(size(_words) as long)", ("_words",)),
        Signal("word_chars", "cast(char_length(array_join(_words, '')) as long)", ("_words",), f"2 * {CHARS}"),
        Signal("n_symbols", "cast(regexp_count(_text, '[#*$%&|<>]') as long)", work=f"2 * {CHARS}"),
        Signal("_lines", rf"filter(split(_text, r'\n'), l -> l rlike r'{WORD}')", work=f"2 * {CHARS}"),
        Signal("n_lines", "cast(size(_lines) as long)", ("_lines",)),
        Signal("n_dup_lines", "cast(size(_lines) - size(array_distinct(_lines)) as long)", ("_lines",), f"{CHARS}"),
        Signal("letters", r"cast(char_length(regexp_replace(_text, r'\P{L}+', '')) as long)", work=f"6 * {CHARS}"),
        Signal("_hashes", "transform(_words, w -> xxhash64(w))", ("_words",), f"{CHARS}"),
        # one number per window of three words
        Signal(
            "_windows",
            "transform(slice(_hashes, 1, greatest(size(_hashes) - 2, 0)),"
            " (h, i) -> xxhash64(h, get(_hashes, i + 1), get(_hashes, i + 2)))",
            ("_hashes",),
            "12 * size(_hashes)",
        ),
        # equal windows side by side, only where the text has any
        Signal(
            "_sorted",
            "if(size(array_distinct(_windows)) = size(_windows), null,"
            " array_sort(transform(_windows, (g, i) -> struct(g as g, i as i))))",
            ("_windows",),
            "4 * size(_windows) + 8 * coalesce(size(_sorted), 0) * log2(1 + coalesce(size(_sorted), 0))",
        ),
        Signal(
            "_repeated",
            "array_sort(transform(filter(transform(_sorted, (x, i) -> struct(x.i as i,"
            " x.g <=> get(_sorted, i - 1).g or x.g <=> get(_sorted, i + 1).g as twice)),"
            " x -> x.twice), x -> x.i))",
            ("_sorted",),
            "20 * coalesce(size(_sorted), 0)",
        ),
        Signal(
            "n_repeat_words",
            "coalesce(aggregate(transform(_repeated, (p, i) -> least(coalesce(get(_repeated, i + 1) - p, 3), 3)),"
            " 0L, (a, x) -> a + x), 0L)",
            ("_repeated",),
            "10 * coalesce(size(_repeated), 0)",
        ),
    )
}

BASE_RULES = (
    Rule("few_words", f"n_words < {MIN_WORDS}", ("n_words",)),
    Rule(
        "repeated_words",
        f"100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words",
        ("n_repeat_words", "n_words"),
    ),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", f"n_symbols > {MAX_SYMBOLS_PER_WORD}D * n_words", ("n_symbols", "n_words")),
    Rule("duplicate_lines", f"n_dup_lines > {MAX_DUPLICATE_LINES}D * n_lines", ("n_dup_lines", "n_lines")),
    Rule(
        "word_length",
        f"word_chars < {WORD_LENGTHS[0]}D * n_words or word_chars > {WORD_LENGTHS[1]}D * n_words",
        ("word_chars", "n_words"),
    ),
    Rule("letters", f"letters < {MIN_LETTERS}D * word_chars", ("letters", "word_chars")),
)


def _closure(names: Sequence[str], known: Sequence[str] = ()) -> list[str]:
    """The signals and those they need that are not known, each after what it needs."""
    found: list[str] = []

    def visit(name: str) -> None:
        if name not in known and name not in found:
            for n in SIGNALS[name].needs:
                visit(n)
            found.append(name)

    for name in names:
        visit(name)
    return found


def _bound(names: Sequence[str], result: str) -> str:
    """SQL in which each signal is computed once, under its name, for those after it and
    for ``result``: a function over an array of one element is a binding."""
    for name in reversed(names):
        result = f"transform(array({SIGNALS[name].expression}), {name} -> {result})[0]"
    return result


def _fields(entries: dict[str, str]) -> str:
    return "struct(" + ", ".join(f"{value} as {name}" for name, value in entries.items()) + ")"


def _sampled(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """About ``rows`` texts from all over the table, by a seeded hash of the row's number, so
    that copies of one text do not come together. No row moves, and every run over the same
    files finds the same ones. Small tables are taken whole."""
    n = docs.count()
    body = docs.select(text_of(f"`{text}`").alias("_text"))
    if n <= rows:
        return body
    drawn = body.withColumn("_draw", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(SAMPLE_SEED)), F.lit(1 << 40)))
    return drawn.where(F.col("_draw") < int(rows / n * (1 << 40))).select("_text")


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost, as one job over a seeded sample finds them.

    A rule costs the work of those of its signals that no rule before it has computed; it
    is worth the share of the sample that it rejects. Rules that reject nothing there come
    last, the cheapest first. An empty sample leaves the order as it is."""
    names = _closure([s for r in rules for s in r.needs])
    steps = {f"w{i}": f"double({SIGNALS[n].work})" for i, n in enumerate(names)}
    hits = {f"r{i}": f"int({r.rejects})" for i, r in enumerate(rules)}
    measured = evaluate_once(_sampled(docs, text, rows), {"_m": F.expr(_bound(names, _fields(steps | hits)))})
    found = measured.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"_m.{c}").alias(c) for c in (*steps, *hits)]).first()
    if not found["n"]:
        return list(rules)
    work = {n: found[f"w{i}"] for i, n in enumerate(names)}
    worth = {r.name: found[f"r{i}"] for i, r in enumerate(rules)}
    left, known, order = list(rules), [], []
    while left:
        cost = {r.name: 1 + sum(work[n] for n in _closure(r.needs, known)) for r in left}
        best = max(left, key=lambda r: (worth[r.name] / cost[r.name], -cost[r.name]))
        left.remove(best)
        order.append(best)
        known += _closure(best.needs, known)
    return order


def cascade(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    report: Sequence[str] = (),
    text: str = "text",
    order: Sequence[Rule] | None = None,
    drop: bool = False,
) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with ``failed_rule``, the first rule in the
    learnt order that rejects the row, or null, and the signals in ``report``, which are
    computed for all rows. With ``drop``, rejected rows go at once.

    Each rule is one generator, which computes the signals that are not known yet. Null
    texts count as empty and fail the word count. Rows are judged each on its own, so
    copies and rows with null ids stay. The struct keeps any columns of the input apart
    from those added."""
    order = list(rule_order(docs, rules, text) if order is None else order)
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of(f"`{text}`").alias("_text"))
    df = df.withColumn("failed_rule", F.lit(None).cast("string"))
    known: list[str] = []
    if report:
        names = _closure(report)
        known = [n for n in names if n in report or any(n in _closure(r.needs, report) for r in order)]
        made = F.expr(_bound(names, _fields({n: n for n in known})))
        df = evaluate_once(df, {"_made": made}).select("row", "_text", "failed_rule", *[f"_made.{n}" for n in known])
    for k, rule in enumerate(order):
        names = _closure(rule.needs, known)
        later = {n for r in order[k + 1 :] for n in _closure(r.needs, known)} | {
            n for r in order[k + 1 :] for m in _closure(r.needs, known) for n in SIGNALS[m].needs
        }
        kept = [n for n in names if n in later]
        verdict = f"case when {rule.rejects} then '{rule.name}' end"
        step = F.expr(_bound(names, _fields({n: n for n in kept} | {"_verdict": verdict})))
        df = evaluate_once(df, {"_step": step if drop else F.when(F.col("failed_rule").isNull(), step)})
        carried = [n for n in known if n in report or n in later or any(n in r.needs for r in order[k + 1 :])]
        df = df.select(
            "row",
            "_text",
            F.coalesce("failed_rule", "_step._verdict").alias("failed_rule"),
            *carried,
            *[f"_step.{n}" for n in kept],
        )
        known = [*carried, *kept]
        if drop:
            df = df.where("failed_rule is null")
    return df.select("row", *report, "failed_rule")


def quality_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's counts and verdict: (doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept). Null texts have zero counts; an empty
    table gives no rows."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    judged = cascade(rows, report=counts)
    base = F.expr(" or ".join(f"({r.rejects})" for r in BASE_RULES))
    return judged.select(
        "row.doc_id", *counts, base.alias("base_failed"), F.col("failed_rule").isNull().alias("kept")
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the columns of ``docs``."""
    return cascade(docs, text=text, drop=True).select("row.*")
