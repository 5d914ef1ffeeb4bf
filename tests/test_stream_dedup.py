"""Keep-first on a stream: micro-batches, restarts, order, types, expiry."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from deskcorpus.operators import dedup
from deskcorpus.streaming import prepare
from deskcorpus.streaming.dedup import keep_first_stream

SCHEMA = "id long, instruction string, response string"


def land(spark, rows, folder, n, schema=SCHEMA, files=2):
    spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(f"{folder}/in{n}")


def run(spark, folder, schema=SCHEMA, **options):
    """Everything that has landed and not been read, as one or more micro-batches."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", options.pop("files", 1000)).parquet(f"{folder}/in*")
    kept = keep_first_stream(stream, **options)
    prepare.start_sink(kept, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{folder}/out")


def test_micro_batches_and_a_restart(spark, tmp_path):
    """A hot key, null keys and repeated rows over four runs; each continues the last."""
    rows = [(i, "hot" if i % 3 else f"k{i % 40}", None if i % 5 == 0 else "r") for i in range(600)]
    rows += [(600 + i, None, None) for i in range(40)] + [(3, "k3", "r")] * 5
    rows.sort()
    for n in range(4):
        land(spark, rows[n * 161 : (n + 1) * 161], tmp_path, n)
        got = run(spark, tmp_path, order=["id"])
        want = dedup.keep_first(spark.createDataFrame(rows[: (n + 1) * 161], SCHEMA), order=["id"])
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert run(spark, tmp_path, order=["id"]).count() == want.count()  # nothing new


def test_one_file_at_a_time(spark, tmp_path):
    rows = [(i, f"k{i % 7}", "r") for i in range(60)]
    land(spark, rows, tmp_path, 0, files=5)
    got = run(spark, tmp_path, order=["id"], files=1)
    assert got.count() == 7 and {r.instruction for r in got.collect()} == {f"k{i}" for i in range(7)}


def test_order_and_ties(spark, tmp_path):
    kinds = "k string, x double, b boolean, s string"
    nan = float("nan")
    rows = [("a", nan, True, "z"), ("a", 2.0, True, "z"), ("a", 2.0, False, "z"), ("b", nan, None, "z"), ("c", None, True, "z"), ("c", -1.0, True, "a")]
    land(spark, rows, tmp_path, 0, kinds, files=3)
    got = sorted(map(tuple, run(spark, tmp_path, kinds, keys=["k"], order=["x", "b"]).collect()))
    assert got[0] == ("a", 2.0, False, "z") and got[1][0] == "b" and got[2] == ("c", None, True, "z")


def test_columns_of_any_type_pass_unchanged(spark, tmp_path):
    kinds = "k string, big long, d decimal(20,3), t timestamp, day date, raw binary, list array<long>, m map<string,int>, s struct<a:long,b:string>"
    rows = [
        ("a", 2**60 + 1, Decimal("1.125"), dt.datetime(2024, 1, 2, 3, 4, 5, 678901), dt.date(2024, 2, 29), bytearray(b"\x00\xff"), [2**60 + 1, None], {"x": None}, (1, None)),
        ("b", None, None, None, None, None, None, None, None),
    ]
    land(spark, rows, tmp_path, 0, kinds, files=1)
    got = run(spark, tmp_path, kinds, keys=["k"], order=["big"])
    assert got.schema == spark.createDataFrame(rows, kinds).schema
    want = spark.createDataFrame(rows, kinds)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_expiry(spark, tmp_path):
    """A key comes again once the watermark is past its time by the expiry."""
    kinds = "id long, k string, at timestamp"
    start = dt.datetime(2024, 1, 1)

    def rows(*items):
        return [(i, k, None if m is None else start + dt.timedelta(minutes=m)) for i, k, m in items]

    options = {"keys": ["k"], "order": ["id"], "event_time": "at", "late": "1 minute", "expire_seconds": 600, "schema": kinds}
    steps = [
        (rows((1, "a", 0), (2, "a", 1), (3, "n", None)), [1, 3]),
        (rows((4, "a", 5), (5, "b", 6)), [1, 3, 5]),
        (rows((6, "c", 40)), [1, 3, 5, 6]),  # the watermark passes a's and b's expiry
        (rows((7, "a", 41), (8, "n", None), (9, "c", 42)), [1, 3, 5, 6, 7]),
    ]
    for n, (landed, want) in enumerate(steps):
        land(spark, landed, tmp_path, n, kinds, files=1)
        assert sorted(r.id for r in run(spark, tmp_path, **options).collect()) == want, n


def test_wrong_use(spark, tmp_path):
    land(spark, [(1, "a", "b")], tmp_path, 0)
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in0")
    with pytest.raises(ValueError, match="expire_seconds"):
        keep_first_stream(stream, event_time="id")
    with pytest.raises(ValueError, match="used inside"):
        keep_first_stream(stream.withColumn("_row", F.lit(1)))
    with pytest.raises(ValueError, match="order"):
        keep_first_stream(stream.withColumn("list", F.array("id")), order=["list"])


def test_empty_stream(spark, tmp_path):
    land(spark, [], tmp_path, 0, files=1)
    assert run(spark, tmp_path, order=["id"]).collect() == []
