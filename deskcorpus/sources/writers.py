"""Writers. Every sink is an ordinary distributed write; only previews and one-row
sidecars are gathered into a single file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deskcorpus.config import DEFAULTS
from deskcorpus.operators.sampling import sample_exact

CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
ROWS_PER_FILE = 100_000
TRAINING_NAMES = {"train": "train", "val": "validation", "test": "test"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, doubled quotes and untouched cell white space (S04). Files are
    bounded in rows, so that multi-line ones stay small enough for a task to read."""
    df.write.mode(mode).options(maxRecordsPerFile=ROWS_PER_FILE, **CSV_OPTIONS).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """JSON Lines in UTF-8 with missing values as null (S06). Returns the record
    count, which is observed by the write itself rather than by reading back."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).option("ignoreNullFields", False).json(path)
    return seen.get["rows"]


def write_splits(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """All splits in one pass, a folder per split."""
    df.write.mode(mode).option("ignoreNullFields", False).partitionBy("split").json(root)


def write_raw_copy(df: DataFrame, path: str) -> None:
    """Untouched audit copy; refuses to replace an existing one."""
    write_csv(df, path, mode="errorifexists")


def write_column_map(spark: SparkSession, text_col: str, response_col: str, path: str) -> None:
    """Which columns later steps should use, as a one-row JSON."""
    row = spark.createDataFrame([(text_col, response_col)], "text_col string, response_col string")
    row.coalesce(1).write.mode("overwrite").json(path)


def write_metrics(report: DataFrame, path: str) -> None:
    """The six named metrics of a report, one JSON row."""
    names = ("rouge1", "rouge2", "rougeL", "bleu", "perplexity", "n_eval_samples")
    one_row = report.select(*names).coalesce(1)
    one_row.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_training_export(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Prompt text only, Parquet per split as train / validation / test."""
    names = F.create_map(*[F.lit(x) for pair in TRAINING_NAMES.items() for x in pair])
    export = df.select("text", names[F.col("split")].alias("split"))
    export.write.mode(mode).partitionBy("split").parquet(root)


def write_preview(
    df: DataFrame, path: str, key: str, k: int = 20, seed: int = DEFAULTS.seed
) -> None:
    """A seeded sample of min(k, n) rows as one small CSV."""
    write_csv(sample_exact(df, k, key, seed).repartition(1), path)  # only the k rows move
