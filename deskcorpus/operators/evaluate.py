"""Reply scoring: ROUGE, BLEU, perplexity, comparison tables, loss curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskcorpus.functions.scores import (
    BLEU_ORDERS,
    bleu_score,
    bleu_tokens,
    f1,
    gram_total,
    lcs_length,
    rouge_lines,
    rouge_tokens,
    summary_overlap,
)
from deskcorpus.functions.tokens import clipped_overlap, ngrams
from deskcorpus.stages import evaluate_once

ROUGE_ORDERS = (1, 2)


def attach_predictions(df: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Put predictions next to their rows by key, not by position (P09). Every row stays:
    without a prediction it has null, which scores as an empty one. A key with several
    predictions fails the job, for its row would be scored more than once."""
    kept = [c for c in predictions.columns if c != key]
    once = predictions.groupBy(key).agg(*[F.first(c).alias(c) for c in kept], F.count(F.lit(1)).alias("_n"))
    repeated = F.concat(F.lit("several predictions for "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") > 1, F.raise_error(repeated).cast("int"))
    joined = df.join(once, key, "left").withColumn("_n", checked)
    return joined.where("_n is null").drop("_n")


def comparison_table(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """instruction, ground_truth, prediction side by side."""
    return df.select(
        *carry, "instruction", F.col("response").alias("ground_truth"), "prediction"
    )


def _with_overlaps(
    df: DataFrame, prediction: Column, reference: Column, orders: tuple[int, ...]
) -> DataFrame:
    """Token arrays ``_p`` and ``_r``, and per order n the clipped matches ``_hits{n}``
    with the totals ``_total{n}`` and ``_wanted{n}`` of both sides."""
    tokens = evaluate_once(df, {"_p": prediction, "_r": reference})
    p, r = F.col("_p"), F.col("_r")
    longer = [n for n in orders if n > 1]
    grams = evaluate_once(
        tokens,
        {f"_{side}{n}": ngrams(F.col(f"_{side}"), n) for n in longer for side in "pr"},
    )
    scored = {}
    for n in orders:
        left, right = (p, r) if n == 1 else (F.col(f"_p{n}"), F.col(f"_r{n}"))
        scored[f"_hits{n}"] = clipped_overlap(left, right)
        scored[f"_total{n}"] = gram_total(p, n)
        scored[f"_wanted{n}"] = gram_total(r, n)
    return grams.withColumns(scored).drop(*[f"_{s}{n}" for n in longer for s in "pr"])


def rouge_per_row(
    df: DataFrame, prediction: str = "prediction", reference: str = "response", stemmer=None
) -> DataFrame:
    """Add rouge1, rouge2 (A12) and rougeL (A13) F-scores to each row. The scores of
    a pair depend on that pair alone, so this is a map-only plan."""
    staged = _with_overlaps(
        df,
        rouge_tokens(F.col(prediction), stemmer),
        rouge_tokens(F.col(reference), stemmer),
        ROUGE_ORDERS,
    )
    p, r = F.col("_p"), F.col("_r")
    scores = {
        f"rouge{n}": f1(F.col(f"_hits{n}"), F.col(f"_total{n}"), F.col(f"_wanted{n}"))
        for n in ROUGE_ORDERS
    }
    lcs = lcs_length(F.array_join(p, " "), F.array_join(r, " "))
    scores["rougeL"] = f1(lcs, F.size(p), F.size(r))
    return staged.withColumns(scores).select(*df.columns, *scores)


def rouge_summary_per_row(
    df: DataFrame, prediction: str = "prediction", reference: str = "response", stemmer=None
) -> DataFrame:
    """Add rougeLsum (A13): every line of the reference is compared with all lines of the
    prediction. Null texts count as empty and score 0; where neither text has a line break
    the score is rougeL. Map-only, like :func:`rouge_per_row`."""
    staged = evaluate_once(
        df, {"_p": rouge_lines(F.col(prediction), stemmer), "_r": rouge_lines(F.col(reference), stemmer)}
    )
    sizes = [F.size(F.array_remove(F.split(F.col(c), r"[ \n]+"), "")) for c in ("_p", "_r")]
    score = f1(summary_overlap("_p", "_r"), *sizes)
    return staged.withColumn("rougeLsum", score).select(*df.columns, "rougeLsum")


def rouge_summary(
    df: DataFrame, prediction: str = "prediction", reference: str = "response", stemmer=None
) -> DataFrame:
    """Mean rougeLsum, one row; 0 for an empty table."""
    scored = rouge_summary_per_row(df, prediction, reference, stemmer)
    return scored.agg(F.coalesce(F.avg("rougeLsum"), F.lit(0.0)).alias("rougeLsum"))


def _rouge_means() -> list[Column]:
    return [
        F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in ("rouge1", "rouge2", "rougeL")
    ]


def rouge(
    df: DataFrame, prediction: str = "prediction", reference: str = "response", stemmer=None
) -> DataFrame:
    """Mean ROUGE scores, one row."""
    return rouge_per_row(df, prediction, reference, stemmer).agg(*_rouge_means())


def bleu_per_row(
    df: DataFrame, prediction: str = "prediction", reference: str = "response"
) -> DataFrame:
    """Add clipped matches and totals per n-gram order and both lengths."""
    staged = _with_overlaps(
        df, bleu_tokens(F.col(prediction)), bleu_tokens(F.col(reference)), BLEU_ORDERS
    )
    parts = {"_sys_len": F.size("_p"), "_ref_len": F.size("_r")}
    names = [f"_{kind}{n}" for n in BLEU_ORDERS for kind in ("hits", "total")]
    return staged.withColumns(parts).select(*df.columns, *names, *parts)


def _bleu_sums() -> Column:
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint"))

    hits = [total(f"_hits{n}") for n in BLEU_ORDERS]
    totals = [total(f"_total{n}") for n in BLEU_ORDERS]
    return bleu_score(hits, totals, total("_sys_len"), total("_ref_len"))


def bleu(
    df: DataFrame, prediction: str = "prediction", reference: str = "response"
) -> DataFrame:
    """Corpus BLEU from 0 to 100, one row."""
    return bleu_per_row(df, prediction, reference).agg(_bleu_sums().alias("bleu"))


def perplexity(losses: DataFrame, loss: str = "loss", empty: float = 1.0) -> DataFrame:
    """exp of the plain mean of per-text losses, one row (A15). An empty table gives
    1 in the ``core`` profile; pass ``float("inf")`` for the ``ascii`` one."""
    mean = F.avg(F.col(loss).cast("double"))
    return losses.agg(F.coalesce(F.exp(mean), F.lit(float(empty))).alias("perplexity"))


def full_report(
    df: DataFrame,
    losses: DataFrame | None = None,
    prediction: str = "prediction",
    reference: str = "response",
    loss: str = "loss",
) -> DataFrame:
    """All metrics in one row (A16): one map-only pass over the pairs and one
    aggregate; perplexity is null unless losses are given."""
    scored = bleu_per_row(
        rouge_per_row(df, prediction, reference), prediction, reference
    )
    ppl = (
        F.lit(None).cast("double")
        if losses is None
        else perplexity(losses, loss).scalar()
    )
    return scored.agg(
        *_rouge_means(),
        _bleu_sums().alias("bleu"),
        F.count(F.lit(1)).alias("n_eval_samples"),
    ).select("rouge1", "rouge2", "rougeL", "bleu", ppl.alias("perplexity"), "n_eval_samples")


def loss_curves(log: DataFrame) -> DataFrame:
    """Training and evaluation loss series by step (A17). A series whose column is
    absent is empty (F08)."""
    series = [
        F.struct(F.lit(label).alias("series"), F.col(c).cast("double").alias("value"))
        for label, c in (("train_loss", "loss"), ("eval_loss", "eval_loss"))
        if c in log.columns
    ]
    if not series:
        return log.select(
            "step",
            F.lit(None).cast("string").alias("series"),
            F.lit(None).cast("double").alias("value"),
        ).where(F.lit(False))
    return log.select("step", F.inline(F.array(*series))).where("value is not null")
