"""Preference pairs: the turns that two conversations share, and what differs.

Chosen and rejected conversations are tables of turns. Their longest common prefix of
turns is rendered once, as the prompt; from the first difference on, each side is a
completion. A turn of an assistant in a completion is trained on, except for its opening
marker; all else is masked. Everything works on turns as rows: the first difference is an
aggregate, combined on the map side, so no conversation has to fit in a task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import HOT_SHARE, hot_lookup
from deskcorpus.operators.running import prefix_sums
from deskcorpus.stages import materialize


@dataclass(frozen=True)
class Template:
    """``opening`` has the placeholder {role}."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"

    def open(self, role: Column) -> Column:
        before, _, after = self.opening.partition("{role}")
        return F.concat(F.lit(before), role, F.lit(after))


FIRST = -(1 << 63)
PAIR_TURNS = 1000


def _turns(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    return df.select(
        F.col(f"`{key}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )


def _place() -> Column:
    return F.coalesce("turn", F.lit(FIRST))


def first_differences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(conv_id, differs_at) of conversations whose sides differ anywhere: the first turn
    with rows that one side has more often than the other."""
    said = F.sha2(F.to_json(F.struct("role", "text")), 256).alias("said")
    signed = lambda df, n: df.select("conv_id", _place().alias("at"), said, F.lit(n).alias("n"))
    both = signed(chosen, 1).unionByName(signed(rejected, -1))
    odd = both.groupBy("conv_id", "at", "said").agg(F.sum("n").alias("n")).where("n != 0")
    return odd.groupBy("conv_id").agg(F.min("at").alias("differs_at"))


def preference_segments(
    chosen: DataFrame,
    rejected: DataFrame,
    template: Template = Template(),
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turn, part, role, opening, content, loss) of every turn of the pairs.

    ``part`` is prompt, chosen or rejected; ``opening`` is always masked, ``content``, with
    the closing marker, is trained on where ``loss`` is true. Turns are compared by number;
    rows that repeat a number count together, each kept. Null texts and roles are rendered
    as empty but differ from empty ones, a null number comes before all others, and a null
    conversation is one conversation. Sides that are the same are all prompt; a conversation
    of one side alone is all completion."""
    sides = [_turns(df, key, turn, role, text) for df in (chosen, rejected)]
    # a null conversation takes part in the lookup under a flag
    sides = [df.withColumn("_null", F.col("conv_id").isNull()).withColumn("_conv", F.coalesce("conv_id", F.lit(0))) for df in sides]
    differs = materialize(first_differences(*sides))
    sizes = sides[0].unionByName(sides[1]).groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    cuts = sizes.join(differs.withColumnRenamed("conv_id", "_c"), F.col("_c").eqNullSafe(F.col("conv_id")), "left")
    cuts = materialize(
        cuts.select(F.col("conv_id").isNull().alias("_null"), F.coalesce("conv_id", F.lit(0)).alias("_conv"), "differs_at", "_n")
    )
    total = cuts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    # a hot conversation is looked up even where its sides agree, so that its turns are spread
    cuts = cuts.where((F.col("_n") > HOT_SHARE * max(total, 1)) | F.col("differs_at").isNotNull())
    parts = []
    for side, df in zip(("chosen", "rejected"), sides):
        placed = hot_lookup(df, cuts, ["_null", "_conv"], "_n", total)
        prompt = F.col("differs_at").isNull() | (_place() < F.col("differs_at"))
        part = F.when(prompt, "prompt").otherwise(side)
        parts.append(placed.withColumn("part", part).where("part != 'prompt'" if side == "rejected" else "true"))
    name, said = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return parts[0].unionByName(parts[1]).select(
        "conv_id",
        "turn",
        "part",
        "role",
        template.open(name).alias("opening"),
        F.concat(said, F.lit(template.closing)).alias("content"),
        ((F.col("part") != "prompt") & (name == "assistant")).alias("loss"),
    )


def _stretches(segments: DataFrame, limit: int) -> DataFrame:
    """``segments`` with ``stretch``: 0 for conversations of up to ``limit`` turns on both
    sides together; longer ones are numbered through in order and cut every ``limit``."""
    zero = F.lit(0).cast("long").alias("stretch")
    flagged = segments.withColumn("_null", F.col("conv_id").isNull()).withColumn("_conv", F.coalesce("conv_id", F.lit(0)))
    sizes = flagged.groupBy("_null", "_conv").agg(F.count(F.lit(1)).alias("_n"))
    long_ones = materialize(sizes.where(F.col("_n") > limit).withColumn("_long", F.lit(True)))
    if long_ones.isEmpty():
        return segments.select("*", zero)
    total = segments.count()
    marked = materialize(hot_lookup(flagged, long_ones, ["_null", "_conv"], "_n", total))
    short = marked.where("_long is null").select(*segments.columns, zero)
    order = ["_null", "_conv", "_place", "part", "role", "content", "_row"]
    rows = marked.where("_long").withColumns(
        {"_place": _place(), "_one": F.lit(1), "_row": F.monotonically_increasing_id()}
    )
    placed = materialize(prefix_sums(rows, order, "_one", "_nth"))
    first = placed.groupBy("_null", "_conv").agg(F.min("_nth").alias("_first"), F.count(F.lit(1)).alias("_n"))
    found = hot_lookup(placed, materialize(first), ["_null", "_conv"], "_n", total)
    cut = found.withColumn("stretch", F.expr(f"(_nth - _first) div {limit}"))
    return short.unionByName(cut.select(*segments.columns, "stretch"))


def assemble(segments: DataFrame, limit: int = PAIR_TURNS) -> DataFrame:
    """(conv_id, stretch, prompt, chosen, rejected, chosen_spans, rejected_spans), a row per
    pair: rendered texts, and the character spans of each completion that are trained on,
    as "first-end" joined by commas.

    Turns are in order of number, then role and text. A pair of over ``limit`` turns comes as
    several rows, numbered by ``stretch``, whose texts follow each other, so that no row
    grows without bound. A part without turns is an empty text. Null conversations are one;
    an empty table gives no rows."""
    piece = F.struct(_place().alias("at"), "role", "content", "opening", "loss")
    sides = [
        F.array_sort(F.collect_list(F.when(F.col("part") == p, piece))).alias(p) for p in ("prompt", "chosen", "rejected")
    ]
    grouped = _stretches(segments, limit).groupBy("conv_id", "stretch").agg(*sides)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["opening"], x["content"])), "").alias(c)

    def spans(c: str) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

        def step(a: Column, x: Column) -> Column:
            first = a["at"] + F.char_length(x["opening"])
            end = first + F.char_length(x["content"])
            span = F.array(F.concat_ws("-", first, end))
            return F.struct(end.alias("at"), F.when(x["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

        return F.array_join(F.aggregate(c, start, step)["spans"], ",").alias(f"{c}_spans")

    return grouped.select(
        "conv_id", "stretch", *map(text, ("prompt", "chosen", "rejected")), spans("chosen"), spans("rejected")
    )


def curtailed(conversations: DataFrame) -> DataFrame:
    """Rejected sides for conversations that come without: the last answer of each stops
    half-way through its characters. Turns of no conversation (a null key) have no last
    answer and stay as they are."""
    turns = _turns(conversations, "conv_id", "turn", "role", "text")
    # null keys take part in the lookup under a flag, which spreads them if they are many
    turns = turns.withColumn("_null", F.col("conv_id").isNull()).withColumn("_conv", F.coalesce("conv_id", F.lit(0)))
    answer = (F.col("role") == "assistant") & ~F.col("_null")
    last = turns.groupBy("_null", "_conv").agg(F.max(F.when(answer, F.col("turn"))).alias("_last"), F.count(F.lit(1)).alias("_n"))
    placed = hot_lookup(turns, materialize(last), ["_null", "_conv"], "_n", turns.count())
    half = F.expr("left(text, char_length(text) div 2)")
    cut = (F.col("role") == "assistant") & (F.col("turn") == F.col("_last"))
    return placed.select("conv_id", "turn", "role", F.when(cut, half).otherwise(F.col("text")).alias("text"))


def preference_table(conversations: DataFrame) -> DataFrame:
    """Segments of every conversation against its curtailed form; see
    :func:`preference_segments` for nulls and repeated turns. An empty table has none."""
    return preference_segments(conversations, curtailed(conversations))


def preference_pairs(conversations: DataFrame) -> DataFrame:
    """Every conversation against its curtailed form, rendered; see :func:`assemble`."""
    return assemble(materialize(preference_table(conversations)))
