"""CSV byte ranges against Spark's own multi-line reader and the csv module."""

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from deskcorpus.sources import csv_ranges, readers

SCHEMA = T.StructType().add("id", "integer").add("t", "string").add("u", "string")
CELLS = ['a "q" b', "l1\n\nl2, x", '"', '""', '\n"\n', "", "  padded  ", "é 😀\n", "x\r\ny", ",", "plain", '","', "NA", "\n"]


def written(rows, header=("id", "t", "u"), end="\n", last=True):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([header, *rows])
    text = out.getvalue()
    return (text if last else text[: -len(end)]).encode()


def read_all(path, size, block):
    """Records of all ranges of a file, without Spark."""
    ranges = csv_ranges.plan_ranges(csv_ranges.data_files(str(path)), size)
    ranges = csv_ranges.with_states(ranges, {r.number: csv_ranges.count_quotes(r, block) for r in ranges})
    rows = []
    for r in ranges:
        for portion in csv_ranges.whole_records(r, block):
            rows += [tuple(x) for x in csv.reader(io.StringIO(portion.decode(), newline=""))]
    return rows


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("last", [True, False])
def test_every_border(tmp_path, end, last):
    rows = [(str(i), c, CELLS[-i]) for i, c in enumerate(CELLS)] + [("99", "last", "one")]
    path = tmp_path / "in.csv"
    path.write_bytes(body := written(rows, ("id", "t\n,x", 'u"'), end, last))
    for size in range(1, len(body) + 1):
        assert read_all(path, size, 7 if size % 2 else 1 << 20) == rows, size


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.text('"\n,ab', max_size=6)] * 2), max_size=8), st.integers(1, 40), st.integers(1, 9))
def test_any_cells(tmp_path_factory, cells, size, block):
    rows = [(str(i), *c) for i, c in enumerate(cells)]
    path = tmp_path_factory.mktemp("c") / "in.csv"
    path.write_bytes(written(rows))
    assert read_all(path, size, block) == rows


def test_equals_the_multi_line_reader(spark, tmp_path):
    rows = [(str(i), CELLS[i % len(CELLS)], CELLS[i * 5 % len(CELLS)]) for i in range(300)]
    folder = tmp_path / "many"
    (folder / "sub").mkdir(parents=True)
    (folder / "a.csv").write_bytes(written(rows[:200]))
    (folder / "b.csv").write_bytes(written(rows[200:], last=False))
    (folder / "c.csv").write_bytes(written([]))
    (folder / "d.csv").write_bytes(b"")
    (folder / "_SUCCESS").write_bytes(b"x")
    want = sorted(readers.read_csv(spark, str(folder), SCHEMA).collect(), key=str)
    for size in (37, 1000, 1 << 20):
        got = csv_ranges.read_csv_ranges(spark, str(folder), SCHEMA, range_bytes=size)
        assert got.schema == SCHEMA and sorted(got.collect(), key=str) == want and len(want) == 300
    one = csv_ranges.read_csv_ranges(spark, str(folder / "a.csv"), SCHEMA, range_bytes=500)
    assert one.rdd.getNumPartitions() == -(-(folder / "a.csv").stat().st_size // 500) and one.count() == 200


def test_what_cannot_be_read(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_bytes(b'id,t,u\n1,"open,x\n2,y,z\n')
    with pytest.raises(Exception, match="never closed"):
        csv_ranges.read_csv_ranges(spark, str(bad), SCHEMA, range_bytes=5).collect()
    bad.write_bytes(b"id,t,u\n1,x\n")
    with pytest.raises(Exception, match="(?i)columns"):
        csv_ranges.read_csv_ranges(spark, str(bad), SCHEMA).collect()
    with pytest.raises(FileNotFoundError):
        csv_ranges.read_csv_ranges(spark, str(tmp_path / "none"), SCHEMA)
    empty = tmp_path / "empty"
    empty.mkdir()
    assert csv_ranges.read_csv_ranges(spark, str(empty), SCHEMA).collect() == []
