"""Topic guardrail: keyword test and routing of off-topic messages."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.functions.text import WORD, as_text, at_most_words
from deskcorpus.operators.generate import Generation, reply_column

# Words that mark a message as a shopping-support question.
KEYWORDS = (
    "order", "ship", "deliver", "refund", "return", "exchange", "payment",
    "pay", "coupon", "discount", "promo", "account", "password", "cart",
    "checkout", "tracking", "track", "invoice", "receipt", "cancel",
    "subscription", "warranty", "product", "item", "package", "address",
    "size", "stock", "availability", "price", "review", "wishlist",
)
# Fixed value: the reply given to everything else.
OFF_TOPIC_REPLY = (
    "I'm your Ecommerce Customer Support Assistant, so I'm only able to help "
    "with questions about orders, shipping, refunds, returns, payments, "
    "coupons, delivery, or your account. Could you rephrase your question "
    "around one of those topics?"
)
SHORT_MESSAGE = 3


def mentions(col: Column, keywords: Sequence[str] = KEYWORDS, match: str = "word") -> Column:
    """True when the lower-cased text holds a keyword as a whole word, or at the
    start of a word with ``match="prefix"``."""
    if not keywords:
        return F.lit(False)
    # alternatives are grouped by first letter, which most positions fail at once
    initials = "".join(re.escape(c) for c in sorted({k[0] for k in keywords}))
    groups = "|".join(
        f"{re.escape(letter)}(?:{'|'.join(re.escape(k[1:]) for k in words)})"
        for letter, words in groupby(sorted(keywords), key=lambda k: k[0])
    )
    end = f"(?![{WORD}])" if match == "word" else ""
    return F.lower(col).rlike(f"(?=[{initials}])(?<![{WORD}])(?:{groups}){end}")


def on_topic(
    col: Column, keywords: Sequence[str] = KEYWORDS, match: str = "word"
) -> Column:
    """Short messages and those that mention a keyword."""
    text = as_text(col)
    return at_most_words(text, SHORT_MESSAGE) | mentions(text, keywords, match)


def route_replies(
    df: DataFrame,
    message: str,
    generation: Generation,
    context: Column | None = None,
    keywords: Sequence[str] = KEYWORDS,
    off_topic_reply: str = OFF_TOPIC_REPLY,
) -> DataFrame:
    """Answer every message (F07): off-topic rows get the fixed reply, the others go
    to the model. The model function is handed on-topic messages only, in the same
    pass over the table."""
    routed = df.withColumn("on_topic", on_topic(F.col(message), keywords))
    asked = F.when(F.col("on_topic"), as_text(F.col(message)))
    reply = reply_column(asked, generation, context)
    return routed.withColumn(
        "reply", F.when(F.col("on_topic"), reply).otherwise(F.lit(off_topic_reply))
    )
