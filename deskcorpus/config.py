"""Constants of the corpus build, as one immutable settings object."""

from __future__ import annotations

from dataclasses import dataclass

# Prompt wording that stored corpora and trained models depend on.
SYSTEM_PROMPT = (
    "You are a helpful, polite Ecommerce Customer Support Assistant. "
    "You answer questions about orders, shipping, refunds, returns, "
    "payments, coupons, delivery, and account management. "
    "If a question is unrelated to ecommerce customer support, politely "
    "say that you can only help with ecommerce support questions."
)
INSTRUCTION_HEADER = "### Instruction:"
RESPONSE_HEADER = "### Response:"


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    train_ratio: float = 0.8
    val_ratio: float = 0.1
    min_words: int = 2
    max_words: int = 512
    packed_length: int = 512
    eval_max_new_tokens: int = 128
    eval_temperature: float = 0.3
    default_max_new_tokens: int = 256
    default_temperature: float = 0.7
    default_top_p: float = 0.9
    system_prompt: str = SYSTEM_PROMPT
    instruction_header: str = INSTRUCTION_HEADER
    response_header: str = RESPONSE_HEADER


DEFAULTS = Settings()
