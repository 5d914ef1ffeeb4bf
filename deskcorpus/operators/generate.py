"""Batch reply generation through a model function supplied by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from deskcorpus.config import DEFAULTS, Settings
from deskcorpus.functions.prompts import (
    chat_messages,
    extract_reply,
    prompt_only,
    with_context,
)


@dataclass(frozen=True)
class Generation:
    """How to call the model. ``factory`` runs once per Python task and returns
    ``predict(prompts, *, max_new_tokens, temperature, top_p, do_sample)``, which maps
    a list of prompts to a list of texts. Prompts are strings, or message lists for
    the ``chat`` style, and a call gets at most ``batch_size`` of them, of like length: a model
    pads a batch to its longest prompt. For that, up to ``buffer_size`` rows are ordered by
    length before they are sent, and the replies go back to their rows. ``echoes_prompt`` says
    that texts repeat their prompt."""

    factory: Callable[[], Callable]
    style: str = "instruction"
    echoes_prompt: bool = True
    max_new_tokens: int = DEFAULTS.default_max_new_tokens
    temperature: float = DEFAULTS.default_temperature
    top_p: float = DEFAULTS.default_top_p
    temperature_floor: float = 1e-3
    batch_size: int = 32
    buffer_size: int = 2048
    settings: Settings = DEFAULTS

    def options(self) -> dict:
        return {
            "max_new_tokens": self.max_new_tokens,
            "temperature": max(self.temperature, self.temperature_floor),
            "top_p": self.top_p,
            "do_sample": self.temperature > 0,
        }


def _predictor(generation: Generation):
    factory, options = generation.factory, generation.options()
    size, room = generation.batch_size, max(generation.buffer_size, generation.batch_size)

    def length(prompt) -> int:
        return len(prompt) if isinstance(prompt, str) else sum(len(m["content"] or "") for m in prompt)

    @F.arrow_udf(StringType())
    def predict_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predict = factory()
        for prompts in batches:
            replies = []
            for begin in range(0, len(prompts), room):
                rows = prompts.slice(begin, room).to_pylist()
                order = sorted((k for k, p in enumerate(rows) if p is not None), key=lambda k: length(rows[k]))
                found = [None] * len(rows)
                for i in range(0, len(order), size):
                    call = order[i : i + size]
                    for k, answer in zip(call, predict([rows[k] for k in call], **options), strict=True):
                        found[k] = answer
                replies.append(pa.array(found, pa.string()))
            yield pa.concat_arrays(replies) if replies else pa.array([], pa.string())

    return predict_batches


def reply_column(
    message: Column, generation: Generation, context: Column | None = None
) -> Column:
    """Reply to each message (M02, U03); null messages are not sent to the model and
    stay null."""
    full = message if context is None else with_context(message, context)
    if generation.style == "chat":
        asked = F.when(message.isNotNull(), chat_messages(full, None, generation.settings))
        return extract_reply(_predictor(generation)(asked), None, generation.settings)
    if generation.style != "instruction":
        raise ValueError(f"unknown style {generation.style!r}: use 'instruction' or 'chat'")
    prompt = prompt_only(full, generation.settings)
    text = _predictor(generation)(F.when(message.isNotNull(), prompt))
    lead = prompt if generation.echoes_prompt else None
    return extract_reply(text, lead, generation.settings)


def generate_replies(
    df: DataFrame,
    message: str,
    generation: Generation,
    context: Column | None = None,
    name: str = "prediction",
) -> DataFrame:
    """Add the model's reply to every row."""
    return df.withColumn(name, reply_column(F.col(message), generation, context))
