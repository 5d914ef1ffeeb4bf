"""Column resolution and standard names. Decided on ``df.columns`` while the plan
is built, so none of these start a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = ("instruction", "response")

# Accepted column names, in order of preference.
INSTRUCTION_ALIASES = ("instruction", "question", "query", "customer", "input", "text")
RESPONSE_ALIASES = ("response", "answer", "response_text", "output", "reply")
CATEGORY_ALIASES = ("category", "intent", "topic", "label")
# Names accepted by the case-insensitive and exploration lookups.
LOOSE_TEXT = ("instruction", "question", "text", "utterance")
LOOSE_RESPONSE = ("response", "answer", "output")
EXPLORE_TEXT = ("instruction", "question", "customer")
EXPLORE_RESPONSE = ("response", "answer")


def resolve(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    """First alias that is a column, exact case; alias order decides."""
    return next((name for name in aliases if name in columns), None)


def resolve_loose(columns: Sequence[str]) -> tuple[str, str]:
    """Case-insensitive text and response columns; column order decides, and the
    first / last column stand in when nothing matches (P02)."""

    def pick(names: Sequence[str], default: str) -> str:
        return next((c for c in columns if c.lower() in names), default)

    return pick(LOOSE_TEXT, columns[0]), pick(LOOSE_RESPONSE, columns[-1])


def resolve_explore(columns: Sequence[str]) -> dict[str, str | None]:
    """Category, text and response columns for profiling, with the first two
    columns as positional stand-ins (P03)."""
    second = columns[1] if len(columns) > 1 else None
    return {
        "category": resolve(columns, CATEGORY_ALIASES),
        "text": resolve(columns, EXPLORE_TEXT) or columns[0],
        "response": resolve(columns, EXPLORE_RESPONSE) or second,
    }


def keep_columns(df: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """Project to ``names``; absent ones are skipped unless ``strict``."""
    return df.select(*(n for n in names if strict or n in df.columns))


def standardize(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Rename the instruction- and response-like columns and keep them, plus
    ``category`` and any ``carry`` columns such as a row id (P04)."""
    text = resolve(df.columns, INSTRUCTION_ALIASES)
    response = resolve(df.columns, RESPONSE_ALIASES)
    if text is None or response is None:
        raise ValueError(f"no instruction/response columns among {df.columns}")
    extra = [c for c in ("category", *carry) if c in df.columns]
    return df.select(
        *(F.col(c) for c in extra if c in carry),
        F.col(text).alias("instruction"),
        F.col(response).alias("response"),
        *(F.col(c) for c in extra if c not in carry),
    )


def standardize_mapped(df: DataFrame, names: dict[str, str], carry: Sequence[str] = ()) -> DataFrame:
    """Like :func:`standardize`, with the columns that a stored column map names (S12). A
    map that names a missing column is an error: it belongs to another table."""
    wanted = [names["text_col"], names["response_col"]]
    absent = [n for n in wanted if n not in df.columns]
    if absent:
        raise ValueError(f"the column map names {absent}, not among {df.columns}")
    text, response = (F.col(f"`{n}`") for n in wanted)
    extra = [c for c in ("category", *carry) if c in df.columns]
    return df.select(
        *(F.col(f"`{c}`") for c in extra if c in carry),
        text.alias("instruction"),
        response.alias("response"),
        *(F.col(f"`{c}`") for c in extra if c not in carry),
    )
