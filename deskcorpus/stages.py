"""Stage borders: shared scratch space, materialised tables, evaluate-once columns."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process gets a folder of its own
    where the setting is missing, one per application, removed when the process ends (a
    running session's setting cannot be changed, so it is remembered here); a cluster must
    name one that every executor can reach."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _own_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/deskcorpus-{uuid.uuid4().hex}"


@cache
def _own_folder(application: str) -> str:
    root = tempfile.mkdtemp(prefix="deskcorpus-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in scratch space and read it back. Use it where a
    costly result is read more than once: it cuts the lineage, survives the loss
    of executors, and later readers still get column pruning and pushdown."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns``, for costly expressions that later filters refer to.

    The optimiser moves a filter below a projection by copying the expression into
    it, once per mention, so a text would be cleaned again for every condition. It
    does not do that across a generator: the columns are produced by an ``inline``
    of one row, while filters on other columns still pass through it."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row = F.struct(*[e.alias(n) for n, e in columns.items()])
    names = [*df.columns, *(n for n in columns if n not in df.columns)]
    return df.select(*kept, F.inline(F.array(row))).select(*[F.col(f"`{n}`") for n in names])
