"""Readers, writers and streams."""

import json
import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskcorpus import stages
from deskcorpus.operators import sampling
from deskcorpus.sources import readers, writers
from deskcorpus.streaming import prepare

TEXTS = ['a "q" b', "l1\n\nl2, x", "  padded  ", "tab\there", "é 😀", "back\\slash", 'ends "', ",", "plain"]
SCHEMA = T.StructType().add("id", "integer").add("t", "string")


def table(spark, values):
    return spark.createDataFrame(list(enumerate(values)), SCHEMA)


def test_csv_round_trip(spark, tmp_path):
    df = table(spark, TEXTS)
    writers.write_csv(df, f"{tmp_path}/c")
    assert sorted(readers.read_csv(spark, f"{tmp_path}/c", SCHEMA).collect()) == sorted(df.collect())


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,t\n1,"a ""q"" b"\n2,"l1\n\nl2, x"\n3,NA\n4,\n5,null\n6,n/a \nNA,x\n')
    got = {r.id: r.t for r in readers.read_csv(spark, str(path), SCHEMA).collect()}
    assert got == {1: 'a "q" b', 2: "l1\n\nl2, x", 3: None, 4: None, 5: None, 6: "n/a ", None: "x"}


def test_many_multi_line_cells_stay_whole(spark, tmp_path):
    cells = [f"step {i}\n\n2. say ""no"", then\n{{{{Slot {i}}}}}" for i in range(50)]
    body = "".join(f'{i},"' + c.replace('"', '""') + '"\n' for i, c in enumerate(cells))
    (tmp_path / "many.csv").write_text("id,t\n" + body)
    got = {r.id: r.t for r in readers.read_csv(spark, f"{tmp_path}/many.csv", SCHEMA).collect()}
    assert got == dict(enumerate(cells))


def test_jsonl(spark, tmp_path):
    df = table(spark, [*TEXTS, None])
    assert writers.write_jsonl(df, f"{tmp_path}/j") == len(TEXTS) + 1
    assert sorted(readers.read_jsonl(spark, f"{tmp_path}/j", SCHEMA).collect(), key=str) == sorted(df.collect(), key=str)
    lines = [l for p in (tmp_path / "j").glob("part*") for l in p.read_text("utf-8").splitlines()]
    assert any("é 😀" in l for l in lines) and {"id": 9, "t": None} in map(json.loads, lines)
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id": 1, "t": "x"}\n\n{"id": 2, "t"\n')
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(bad), SCHEMA).collect()
    bad.write_text('{"id": 1, "t": "x"}\n\n\n{"id": 2, "t": "y"}\n')
    assert readers.read_jsonl(spark, str(bad), SCHEMA).count() == 2


def test_splits(spark, tmp_path):
    df = sampling.split_floor(table(spark, ["x"] * 40), "id")
    writers.write_splits(df, f"{tmp_path}/s")
    back = readers.read_splits(spark, f"{tmp_path}/s", df.schema)
    assert sorted(back.collect()) == sorted(df.collect())
    val = readers.read_splits(spark, f"{tmp_path}/s", df.schema, "val")
    assert val.count() == 4 and len(val.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()
    writers.write_training_export(df.withColumnRenamed("t", "text"), f"{tmp_path}/e")
    assert sorted(p.name for p in (tmp_path / "e").glob("split=*")) == ["split=test", "split=train", "split=validation"]


def test_small_sinks(spark, tmp_path):
    df = table(spark, ["x"] * 40)
    writers.write_raw_copy(df, f"{tmp_path}/raw")
    with pytest.raises(Exception):
        writers.write_raw_copy(df, f"{tmp_path}/raw")
    writers.write_column_map(spark, "a", "b", f"{tmp_path}/m")
    assert readers.read_column_map(spark, f"{tmp_path}/m") == {"text_col": "a", "response_col": "b"}
    writers.write_preview(df, f"{tmp_path}/p", "id", k=20)
    assert len(list((tmp_path / "p").glob("*.csv"))) == 1
    assert readers.read_csv(spark, f"{tmp_path}/p", SCHEMA).count() == 20


def test_published_source_and_fallback(spark, tmp_path):
    table(spark, ["t"]).write.parquet(f"{tmp_path}/d/validation")
    assert readers.read_published(spark, f"{tmp_path}/d").first().t == "t"
    table(spark, ["u"]).write.parquet(f"{tmp_path}/d/train")
    assert readers.read_published(spark, f"{tmp_path}/d").first().t == "u"
    made = readers.read_or_else(
        lambda: readers.read_published(spark, f"{tmp_path}/none"),
        lambda: table(spark, ["t"] * 10),
    )
    assert made.count() == 10


def test_unreadable_sources_are_not_replaced(spark, tmp_path):
    (tmp_path / "bad" / "train").mkdir(parents=True)
    (tmp_path / "bad" / "train" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        readers.read_published(spark, f"{tmp_path}/bad").count()
    table(spark, ["t"]).write.parquet(f"{tmp_path}/h/_temporary")
    table(spark, ["v"]).write.parquet(f"{tmp_path}/h/val")
    assert readers.read_published(spark, f"{tmp_path}/h").first().t == "v"
    with pytest.raises(ZeroDivisionError):
        readers.read_or_else(lambda: 1 / 0, lambda: table(spark, ["x"]))


def test_preview_moves_only_its_rows(spark):
    from deskcorpus.operators.sampling import sample_exact

    df = spark.range(0, 1000, 1, 8)
    plan = sample_exact(df, 5, "id").repartition(1)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "Exchange SinglePartition, REPARTITION_BY_NUM" in plan


def test_stream_equals_batch(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, instruction string, response string")
    rows = [(i, f"<b>q</b> {i} words", f"reply number {i}") for i in range(30)] + [(99, "x", "too short")]
    df = spark.createDataFrame(rows, schema)
    writers.write_jsonl(df, f"{tmp_path}/in")
    stream = prepare.prepare_pairs(prepare.pair_stream(spark, f"{tmp_path}/in", schema), "id")
    prepare.start_sink(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select("id", "text", "split")
    want = prepare.prepare_pairs(df, "id").select("id", "text", "split")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 30


def fake_session(master, root):
    settings = {} if root is None else {"spark.checkpoint.dir": root}
    return SimpleNamespace(
        conf=SimpleNamespace(get=settings.get, set=settings.__setitem__),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_space(spark, tmp_path):
    one, two = (stages.scratch_dir(fake_session("spark://h", "hdfs://x/")) for _ in range(2))
    assert one.startswith("hdfs://x/deskcorpus-") and one != two
    with pytest.raises(ValueError):
        stages.scratch_dir(fake_session("spark://h", None))
    with pytest.raises(ValueError):
        stages.scratch_dir(fake_session("local-cluster[2,1,1024]", None))
    assert stages.materialize(spark.range(5)).count() == 5


ALONE = """
from pyspark.sql import SparkSession
from deskcorpus import stages
session = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert not session.conf.get("spark.checkpoint.dir", None)
one, two = stages.scratch_dir(session), stages.scratch_dir(session)
assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
print("rows", stages.materialize(session.range(5)).count())
"""


def test_scratch_space_of_a_session_without_the_setting(tmp_path):
    plain = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK", "PYSPARK"))} | {"SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run(
        [sys.executable, "-c", ALONE], capture_output=True, text=True, timeout=300, cwd=Path(__file__).parent.parent, env=plain
    )
    assert "rows 5" in done.stdout, done.stderr[-2000:]


def test_evaluate_once_blocks_copies_but_not_pushdown(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    once = stages.evaluate_once(docs, {"text": F.lower("text")})
    assert once.columns == docs.columns
    plan = once.where("length(text) > 3 and lang = 'en'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") == 1 and "EqualTo(lang,en)" in plan
