import gzip
import hashlib

from deskcorpus.llm import preference, warc
from deskcorpus.stages import scratch_dir

BIG = "<p>ünï</p>" * 200
PAGES = [
    (1, "http://a/1", BIG), (5, "http://a/5 x\r\ny", BIG), (3, None, BIG), (4, "http://a/4", BIG + "!"), (6, "http://b", "small"),
    (7, "http://b", "small"), (8, "http://c", None), (9, "http://c", ""), (None, "http://d", "lost"), (5, "http://a/5", BIG),
    (None, "http://e", BIG), (10, "http://f", "a\r\n\r\nWARC/1.1\r\n" * 100),
]


def pages(spark, rows=PAGES):
    full = [(*r, "p", "r") for r in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, payload string, record_type string").repartition(3)


def expected():
    out = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        keep = max((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        same = len(body) < 1000 or keep is None or keep == i
        digest = hashlib.sha1(body).hexdigest()
        out.append((i, len(body), digest, "response" if same else "revisit", None if same else keep))
    return sorted(out, key=repr)


def test_round_trip(spark):
    got = [tuple(r) for r in warc.archive_round_trip(pages(spark)).collect()]
    assert sorted(got, key=repr) == expected()
    assert warc.archive_round_trip(pages(spark).where("false")).count() == 0


def test_plain_archives_and_small_files(spark):
    path = scratch_dir(spark)
    warc.write_warc(warc.page_records(pages(spark)), path, compression="none", file_bytes="2000")
    table = warc.page_table(warc.read_warc(spark, path))
    assert sorted(map(tuple, table.collect()), key=repr) == expected()


def test_predicates_are_pushed_down(spark):
    path = scratch_dir(spark)
    warc.write_warc(warc.page_records(pages(spark)), path)
    found = warc.read_warc(spark, path).where("record_type = 'revisit' and record_id like 'urn:page:%' and refers_to is not null")
    assert ") Filter " not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 3
    heads = warc.read_warc(spark, path, payload=False).where("target_uri in ('http://a/4', 'http://b')").collect()
    assert len(heads) == 3 and all(r.payload is None and len(r.payload_digest) == 40 for r in heads)
    assert warc.read_warc(spark, path).where("payload_length > 1500").count() == 6


def record(kind, block, **headers):
    lines = [f"WARC/1.0\r\nWARC-Type: {kind}", *[f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]]
    return ("\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    body = b"x" * 70_000
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body
    records = [
        record("warcinfo", b"software: test", WARC_Record_ID="<urn:1>"),
        record("response", http, WARC_Record_ID="<urn:2>", Content_Type="application/http; msgtype=response", WARC_Payload_Digest="sha1:ABCDEF"),
        record("metadata", b"", WARC_Record_ID="<urn:3>"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r.record_id for r in rows) == ["urn:1", "urn:1", "urn:2", "urn:2", "urn:3", "urn:3"]
    full = [r for r in rows if r.record_type == "response"]
    assert all(r.payload == body and r.payload_length == len(body) and r.payload_digest == "abcdef" for r in full)
    assert warc.read_warc(spark, str(tmp_path)).where("record_type = 'metadata'").count() == 2


def test_archives_of_few_members(spark, tmp_path):
    records = [record("resource", b"r%d" % i * 40_000 * (i % 3), WARC_Record_ID=f"<urn:{i}>") for i in range(9)]
    whole = b"".join(records)
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "few.warc.gz").write_bytes(b"".join(gzip.compress(b"".join(records[a:b])) for a, b in ((0, 4), (4, 5), (5, 9))))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.record_id, r.payload) for r in rows) == sorted((f"urn:{i}", b"r%d" % i * 40_000 * (i % 3)) for i in [*range(9)] * 2)
    assert warc.read_warc(spark, str(tmp_path), payload=False).count() == 18
    assert warc.read_warc(spark, str(tmp_path)).where("record_id = 'urn:7'").count() == 2


def test_members_are_ordinary_gzip():
    data = warc.info_record() * 50
    assert gzip.decompress(warc.gzip_member(data) + warc.gzip_member(b"")) == data


TURNS = "conv_id long, turn long, role string, text string, part string"


def segments(spark, chosen, rejected):
    make = lambda rows: spark.createDataFrame([(*r, "z") for r in rows], TURNS)
    return preference.preference_segments(make(chosen), make(rejected))


def spanned(text, spans):
    return [text[slice(*map(int, s.split("-")))] for s in spans.split(",") if s]


def test_long_pairs_come_in_stretches(spark):
    """A conversation of more turns than a row takes, repeated numbers and a hot null one."""
    long_one = [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(25)]
    hot = [(None, 4, "assistant", f"n{i:03d}") for i in range(30)]
    short = [(2, 0, "user", "q"), (2, 1, "assistant", "a")]
    got = preference.assemble(segments(spark, [*long_one, *hot, *short], [*long_one[:20], *short]), limit=10).collect()
    rows = {(r.conv_id, r.stretch): r for r in got}
    assert [s for c, s in sorted(rows, key=str) if c == 1] == [0, 1, 2] and (2, 0) in rows
    assert sum(1 for c, _ in rows if c is None) == 3 and len(rows) == 7
    joined = lambda part, c: "".join(getattr(rows[k], part) for k in sorted(k for k in rows if k[0] == c))
    render = lambda turns: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for _, _, r, x in turns)
    assert joined("prompt", 1) == render(long_one[:20]) and joined("chosen", 1) == render(long_one[20:])
    stretches = sorted(s for c, s in rows if c is None)
    assert "".join(rows[None, s].chosen for s in stretches) == render(hot) and joined("rejected", 1) == ""
    trained = [x for s in stretches for x in spanned(rows[None, s].chosen, rows[None, s].chosen_spans)]
    assert trained == [f"{x}<|im_end|>\n" for _, _, _, x in hot]


def test_longest_common_prefix(spark):
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "good")]
    rejected = [*chosen[:3], (1, 3, "assistant", "bad"), (1, 4, "user", "why")]
    got = segments(spark, chosen, rejected)
    rows = sorted((r.part, r.turn, r.role, r.content, r.loss) for r in got.collect())
    end = "<|im_end|>\n"
    assert rows == [
        ("chosen", 3, "assistant", "good" + end, True),
        ("prompt", 0, "user", "q" + end, False),
        ("prompt", 1, "assistant", "a" + end, False),
        ("prompt", 2, "user", "more" + end, False),
        ("rejected", 3, "assistant", "bad" + end, True),
        ("rejected", 4, "user", "why" + end, False),
    ]
    pair = preference.assemble(got).first()
    assert pair.prompt.count("<|im_start|>") == 3 and pair.chosen == "<|im_start|>assistant\ngood" + end
    assert spanned(pair.chosen, pair.chosen_spans) == ["good" + end]
    assert spanned(pair.rejected, pair.rejected_spans) == ["bad" + end]


def test_pairs_of_odd_conversations(spark):
    same = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    only = [(2, 0, "user", "alone")]
    nulls = [(None, None, None, None), (None, 3, "user", ""), (None, 3, "user", "")]
    gap = [(3, 0, "user", "q"), (3, 5, "assistant", "x" * 100_000)]
    got = segments(spark, [*same, *only, *nulls, *gap], [*same, (None, None, None, None), (None, 3, "user", ""), gap[0]]).collect()
    parts = sorted((str(r.conv_id), str(r.turn), r.part) for r in got)
    assert parts == sorted([
        ("1", "0", "prompt"), ("1", "1", "prompt"), ("2", "0", "chosen"), ("None", "None", "prompt"),
        ("None", "3", "chosen"), ("None", "3", "chosen"), ("None", "3", "rejected"), ("3", "0", "prompt"), ("3", "5", "chosen"),
    ])
    empty = segments(spark, [], [])
    assert empty.count() == 0 and preference.assemble(empty).count() == 0
