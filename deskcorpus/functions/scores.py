"""Per-row building blocks of ROUGE and BLEU. Corpus scores are sums of these."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from deskcorpus.functions.text import as_text, split_words

BLEU_ORDERS = (1, 2, 3, 4)

# The published 13a tokenisation, as (pattern, replacement).
BLEU_13A = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def rouge_tokens(col: Column, stemmer=None) -> Column:
    """Runs of lower-cased letters and digits; ``stemmer`` maps one token Column to
    another (U01)."""
    out = F.array_remove(F.split(F.lower(as_text(col)), "[^a-z0-9]+"), "")
    return F.transform(out, stemmer) if stemmer else out


def bleu_tokens(col: Column) -> Column:
    """13a tokens, case kept."""
    text = F.replace(F.replace(as_text(col), F.lit("<skipped>"), F.lit("")), F.lit("-\n"), F.lit(""))
    text = F.replace(text, F.lit("\n"), F.lit(" "))
    for entity, plain in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in BLEU_13A:
        text = F.regexp_replace(text, pattern, replacement)
    return split_words(text)


def gram_total(token_array: Column, n: int) -> Column:
    return F.greatest(F.size(token_array) - (n - 1), F.lit(0))


def f1(hits: Column, predicted: Column, expected: Column) -> Column:
    """Harmonic mean of hits/predicted and hits/expected, 0 without hits."""
    return F.when(hits > 0, 2.0 * hits / (predicted + expected)).otherwise(0.0)


@F.arrow_udf(IntegerType())
def lcs_length(left: pa.Array, right: pa.Array) -> pa.Array:
    """Longest common subsequence of two space-joined token strings. One integer
    holds a whole row of the table as bits, so a pair takes one big-integer
    addition per token."""

    def length(a: str, b: str) -> int:
        first, second = a.split(), b.split()
        places: dict[str, int] = {}
        for i, token in enumerate(first):
            places[token] = places.get(token, 0) | (1 << i)
        full = (1 << len(first)) - 1
        row = full
        for token in second:
            hit = row & places.get(token, 0)
            row = ((row + hit) | (row - hit)) & full
        return len(first) - row.bit_count()

    pairs = zip(left.to_pylist(), right.to_pylist())
    return pa.array([length(a or "", b or "") for a, b in pairs], type=pa.int32())


def token_places(line: Sequence[str]) -> dict[str, int]:
    """Where each token stands in a line, as bits of one integer."""
    at: dict[str, int] = {}
    for i, token in enumerate(line):
        at[token] = at.get(token, 0) | (1 << i)
    return at


def bits(places: int) -> list[int]:
    """The places of the bits that are set, ascending."""
    return [i for i, bit in enumerate(reversed(f"{places:b}")) if bit == "1"]


def lcs_places(first: Sequence[str], second: Sequence[str]) -> list[int]:
    """Places in ``first`` of one longest common subsequence, ascending. Of several, the one
    met by going back from the ends, stepping to an earlier token of ``second`` only where
    one of ``first`` would lose length, as published scores do."""
    return bits(lcs_bits(token_places(first), len(first), second))


def lcs_bits(at: dict[str, int], length: int, second: Sequence[str]) -> int:
    """:func:`lcs_places` as bits, of a line of ``length`` tokens with places ``at``.

    Each token of ``second`` leaves the places at which the length grows as bits of one
    integer, so the table takes a bit per cell. At a token, the way back leaves ``first`` at
    the last place that holds it or at which the length grows, whichever is later, so it
    takes a step per token of ``second``."""
    full = (1 << length) - 1
    row, grows, hits = full, [], []
    for token in second:
        hit = at.get(token, 0)
        both = row & hit
        row = ((row + both) | (row - both)) & full
        grows.append(full ^ row)
        hits.append(hit)
    below, places = full, 0
    for j in range(len(second) - 1, -1, -1):
        stop = ((grows[j] | hits[j]) & below).bit_length() - 1
        if stop < 0:
            break
        if hits[j] >> stop & 1:
            places |= 1 << stop
            below = (1 << stop) - 1
        else:
            below = (2 << stop) - 1
    return places


def summary_hits(prediction: list[list[str]], reference: list[list[str]]) -> int:
    """Tokens of the reference that its lines have in common with the prediction's: each
    line's union of its longest common subsequences with all lines of the prediction, no
    token counted more often than either side has it. Equal lines are compared once, and a
    pair of lines only if it can add to the union: if they share a token at a place that
    is not in it yet. Lines that share the most places come first."""
    lines = list(dict.fromkeys(map(tuple, prediction)))
    holders: dict[str, list[int]] = {}
    for k, line in enumerate(lines):
        for token in set(line):
            holders.setdefault(token, []).append(k)
    left = Counter(t for line in prediction for t in line) & Counter(t for line in reference for t in line)
    known: dict[tuple[str, ...], list[int]] = {}
    hits = 0
    for line in map(tuple, reference):
        if line not in known:
            known[line] = _union_places(line, lines, holders)
        for i in known[line]:
            if left[line[i]] > 0:
                left[line[i]] -= 1
                hits += 1
    return hits


def _union_places(line: tuple[str, ...], lines: list[tuple[str, ...]], holders: dict[str, list[int]]) -> list[int]:
    """Places of ``line`` in a longest common subsequence with any of ``lines``, ascending."""
    at = token_places(line)
    shared: dict[int, int] = {}
    for token, places in at.items():
        for k in holders.get(token, ()):
            shared[k] = shared.get(k, 0) | places
    union = 0
    for k in sorted(shared, key=lambda k: (-shared[k].bit_count(), len(lines[k]))):
        if shared[k] & ~union:
            union |= lcs_bits(at, len(line), lines[k])
    return bits(union)


@F.arrow_udf(IntegerType())
def summary_overlap(prediction: pa.Array, reference: pa.Array) -> pa.Array:
    """:func:`summary_hits` of two texts, tokens joined by spaces and lines by line breaks."""

    def lines(text: str | None) -> list[list[str]]:
        return [line.split() for line in (text or "").split("\n")]

    pairs = zip(prediction.to_pylist(), reference.to_pylist())
    return pa.array([summary_hits(lines(p), lines(r)) for p, r in pairs], type=pa.int32())


def rouge_lines(col: Column, stemmer=None) -> Column:
    """The tokens of :func:`rouge_tokens`, joined by spaces, with the line breaks kept."""
    return F.array_join(
        F.transform(F.split(as_text(col), "\n"), lambda line: F.array_join(rouge_tokens(line, stemmer), " ")), "\n"
    )


def bleu_score(hits: list[Column], totals: list[Column], sys_len: Column, ref_len: Column) -> Column:
    """Corpus BLEU (0-100) from summed matches and totals per order. An order
    without a match is smoothed by a halving factor, one without n-grams gives 0."""
    misses = F.lit(0)
    log_sum = F.lit(0.0)
    for hit, total in zip(hits, totals):
        misses = misses + (hit == 0).cast("int")
        smoothed = 1.0 / (F.pow(F.lit(2.0), misses) * total)
        precision = F.when(hit == 0, smoothed).otherwise(hit / total)
        log_sum = log_sum + F.ln(precision)
    some, all_orders = F.greatest(*hits) > 0, F.least(*totals) > 0
    brevity = F.when(sys_len < ref_len, F.exp(1 - ref_len / sys_len)).otherwise(1.0)
    score = brevity * F.exp(log_sum / len(hits)) * 100
    return F.when(some & all_orders, score).otherwise(0.0)
