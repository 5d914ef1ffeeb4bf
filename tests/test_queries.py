"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert {r.split for r in entry.entry(spark).collect()} == {"train", "val", "test"}


def test_all_queries(spark, sf_dir):
    assert compare(spark, sf_dir) == []


@pytest.mark.parametrize("name", ["stream_prepared", "stream_keep_first"])
def test_streams_read_tables_of_several_files(spark, sf_dir, tmp_path, name):
    """A table may be a folder of files, which need not be named like the table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = entry.queries()[name](spark, sf_dir).collect()
    got = entry.queries()[name](spark, str(tmp_path)).collect()
    assert want and sorted(got) == sorted(want)
