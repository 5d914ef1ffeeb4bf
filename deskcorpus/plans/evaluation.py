"""Evaluation job: sample, generate, score, write."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from deskcorpus.config import DEFAULTS, Settings
from deskcorpus.operators.evaluate import comparison_table, full_report
from deskcorpus.operators.generate import Generation, generate_replies
from deskcorpus.operators.sampling import sample_exact
from deskcorpus.sources.writers import write_csv, write_metrics
from deskcorpus.stages import materialize


def for_evaluation(generation: Generation, settings: Settings = DEFAULTS) -> Generation:
    """Generation with the length and temperature that evaluation asks for."""
    return replace(
        generation,
        max_new_tokens=settings.eval_max_new_tokens,
        temperature=settings.eval_temperature,
    )


def evaluation_table(
    test: DataFrame,
    generation: Generation,
    key: str,
    samples: int | None = None,
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """Test rows with a prediction each: all, or a seeded sample of ``samples``."""
    chosen = test if samples is None else sample_exact(test, samples, key, seed)
    return generate_replies(chosen, "instruction", generation)


def evaluate_model(
    test: DataFrame,
    generation: Generation,
    key: str,
    samples: int | None = None,
    seed: int = DEFAULTS.seed,
    losses: DataFrame | None = None,
    table_path: str | None = None,
    metrics_path: str | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """The whole job (M05) over all rows, or over a seeded sample of ``samples`` rows, with
    the generation settings of evaluation; returns the one-row report. Replies are written once, so
    the model is not run again for the table and the metrics."""
    answered = materialize(evaluation_table(test, for_evaluation(generation, settings), key, samples, seed))
    report = full_report(answered, losses)
    if table_path:
        write_csv(comparison_table(answered), table_path)
    if metrics_path:
        write_metrics(report, metrics_path)
    return report
