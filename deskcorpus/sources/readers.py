"""Readers with explicit schemas: nothing is inferred by scanning the data."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

RAW_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("flags", "instruction", "category", "intent", "response")]
)
SPLITS = ("train", "val", "test")

# Cells that common CSV tools read as missing.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_published(
    spark: SparkSession, root: str, splits: Sequence[str] = ("train",)
) -> DataFrame:
    """A landed dataset laid out as ``root/<split>`` Parquet: the first wanted split
    that exists, else the first split there is (S01)."""
    for split in splits:
        try:
            return spark.read.parquet(f"{root.rstrip('/')}/{split}")
        except AnalysisException as error:
            if not _is_absent(error):
                raise
    # file names alone, from a listing that leaves out hidden and temporary folders
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.rstrip("/").rsplit("/", 1)[-1]
    split = F.regexp_extract("path", f"/{re.escape(base)}/([^/]+)/", 1)
    first = files.select(split.alias("split")).where("split != ''").agg(F.min("split")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no splits under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{first}")


def _is_absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_else(
    primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]
) -> DataFrame:
    """The primary source, or the fallback when there is none at its path (S02), which is
    logged. Any other failure is raised: a source that cannot be read is no reason to go
    on with another one."""
    try:
        return primary()
    except AnalysisException as error:
        if not _is_absent(error):
            raise
        absent: Exception = error
    except FileNotFoundError as error:
        absent = error
    log.warning("reading the fallback: %s", absent)
    return fallback()


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    na_strings: Sequence[str] = NA_STRINGS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header, quoted cells and doubled quotes (S03); missing value strings
    become null in columns of any type. Cells may have line breaks with ``multi_line``,
    but such a file cannot be cut, so it is one task's work: pass False where no cell has
    any, or use ``csv_ranges.read_csv_ranges``, and files of every size are read in parallel."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = (
        spark.read.schema(raw)
        .options(
            header=True,
            multiLine=multi_line,
            quote='"',
            escape='"',
            mode="FAILFAST",
            encoding="UTF-8",
            enforceSchema=True,
        )
        .csv(path)
    )
    return typed_cells(df, schema, na_strings)


def typed_cells(df: DataFrame, schema: T.StructType, na_strings: Sequence[str]) -> DataFrame:
    """Cells read as strings in the types of ``schema``, missing value strings as null."""
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(*na_strings), F.col(f"`{f.name}`"))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON Lines; blank lines are skipped and a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_splits(
    spark: SparkSession, root: str, schema: T.StructType, split: str | None = None
) -> DataFrame:
    """Splits written by ``write_splits``, with their ``split`` column (S08). Asking
    for one split prunes the others at the file listing."""
    fields = [f for f in schema.fields if f.name != "split"]
    full = T.StructType([*fields, T.StructField("split", T.StringType())])
    df = read_jsonl(spark, root, full)
    return df if split is None else df.where(F.col("split") == split)


def read_column_map(spark: SparkSession, path: str) -> dict[str, str]:
    """The column-map sidecar as a dict."""
    row = spark.read.schema("text_col string, response_col string").json(path).first()
    return row.asDict()
