"""Prompt, chat-message and reply-extraction expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskcorpus.config import DEFAULTS, Settings
from deskcorpus.functions.text import strip

# The wording wrapped around store context.
CONTEXT_LEAD = "Store FAQ reference (use only if relevant, otherwise ignore):"
CONTEXT_QUESTION = "Customer question:"


def prompt_only(
    instruction: Column, settings: Settings = DEFAULTS, stripped: bool = True
) -> Column:
    """Inference half of the prompt, ending after the response header."""
    body = strip(instruction) if stripped else instruction
    return F.concat(
        F.lit(f"{settings.instruction_header}\nCustomer:\n"),
        body,
        F.lit(f"\n\n{settings.response_header}\n"),
    )


def training_prompt(
    instruction: Column,
    response: Column,
    settings: Settings = DEFAULTS,
    stripped: bool = True,
) -> Column:
    """Full training text (T15); the ``ascii`` profile passes stripped=False."""
    body = strip(response) if stripped else response
    return F.concat(prompt_only(instruction, settings, stripped), body)


def prompt_only_minimal(instruction: Column, settings: Settings = DEFAULTS) -> Column:
    """``minimal`` inference prompt: blank lines between parts, one final newline."""
    return F.concat(
        F.lit(f"{settings.instruction_header}\n\nCustomer:\n\n"),
        strip(instruction),
        F.lit(f"\n\n\n\n{settings.response_header}\n"),
    )


def training_prompt_minimal(
    instruction: Column, response: Column, settings: Settings = DEFAULTS
) -> Column:
    """``minimal`` training text (T17), one newline more than its inference half."""
    return F.concat(
        prompt_only_minimal(instruction, settings), F.lit("\n"), strip(response)
    )


def chat_messages(
    instruction: Column, response: Column | None = None, settings: Settings = DEFAULTS
) -> Column:
    """System, user and (where a response exists) assistant messages."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    opening = F.array(
        message("system", F.lit(settings.system_prompt)),
        message("user", strip(instruction)),
    )
    if response is None:
        return opening
    reply = F.array(message("assistant", strip(response)))
    return F.when(response.isNull(), opening).otherwise(F.concat(opening, reply))


def extract_reply(
    generated: Column,
    prompt: Column | None = None,
    settings: Settings = DEFAULTS,
    minimal: bool = False,
) -> Column:
    """The model's own words out of a decoded text (T21): cut the prompt when it
    leads, else keep what follows the last response header. The ``minimal`` form
    splits on header plus newline and leaves the white space."""
    mark = settings.response_header + ("\n" if minimal else "")
    after = F.substring_index(generated, mark, -1)
    if minimal:
        return after
    if prompt is None:
        return strip(after)
    rest = F.substr(generated, F.length(prompt) + 1)
    return strip(F.when(generated.startswith(prompt), rest).otherwise(after))


def with_context(message: Column, context: Column) -> Column:
    """Put store context before the message when there is any."""
    framed = F.concat(
        F.lit(CONTEXT_LEAD + "\n"), context, F.lit(f"\n\n{CONTEXT_QUESTION}\n"), message
    )
    return F.when(F.coalesce(context, F.lit("")) == "", message).otherwise(framed)


def context_text(pages: Column, max_chars: int = 3000) -> Column:
    """Page texts joined by newlines, stripped, first ``max_chars`` kept."""
    filled = F.transform(pages, lambda p: F.coalesce(p, F.lit("")))
    return F.substring(strip(F.array_join(filled, "\n")), 1, max_chars)


def history_messages(history: Column) -> Column:
    """(role, content) history entries as message records (P10)."""
    return F.transform(
        history,
        lambda turn: F.struct(
            turn.getField("role").alias("role"),
            turn.getField("content").alias("content"),
        ),
    )
