import zlib
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from deskcorpus.llm import packing_dp, simple8b, token_counts, token_files
from deskcorpus.llm.encode import default_tokenizer, encoder
from deskcorpus.stages import scratch_dir
from helpers import frame
from test_llm_queries import check_packing

MODEL = Tokenizer.from_file(default_tokenizer())
ODD = [
    "", " ", "a", "<|endoftext|> x<|STARTOFTEXT|>y <|startoftext|>", "it's o'clock 's. I'LL.,", "é Ångström Å",
    "x y z", "100.00, 0 00 a0b", "end. .", "́ ́a.́", "\x00\x1f a\x0bb\x0c", "日本語 テスト。", "a.,b .,",
    "ſ K İ İ. ΣΑΣ.", "x." * 3000, "ªº ǅ ﬁ ㎏ ² ½", "don't, 're) we'd!", "q%$& z|* 5# a#b",
]


def plain(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aA z.,'<|>\n0é")), max_size=30), max_size=6))
def test_encoder_agrees_with_the_library(texts):
    texts = texts + ODD
    ids, bounds = encoder(default_tokenizer()).ids(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [plain(t) for t in texts]
    assert (encoder(default_tokenizer()).lengths(pa.array(texts, pa.string())) + 1 == np.diff(bounds)).all()


def test_letters_that_the_normal_form_takes_apart():
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    apart = [c for c in letters if not normalize("NFC", c).isalpha()]
    assert len(apart) >= 59
    texts = ["\u0958\u0932\u092e", "\u09b9\u09df", *apart, *(f"{a}{c}{b}" for c in letters for a, b in (("a", "b"), ("\u0932", "\u092e")))]
    ids, bounds = encoder(default_tokenizer()).ids(pa.array(texts, pa.string()), end=None)
    full = MODEL.encode_batch(texts, add_special_tokens=False)
    assert [t for t, e, a, b in zip(texts, full, bounds[:-1], bounds[1:]) if ids[a:b].tolist() != e.ids] == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**20), st.integers(0, 2**64 - 1)), max_size=900), st.integers(1, 9))
def test_simple8b_round_trip(values, parts):
    values = np.array(values, np.uint64)
    coded = simple8b.encode(values)
    assert (simple8b.decode(*coded, len(values)) == values).all()
    packer = simple8b.Packer()
    for part in np.array_split(values, parts):
        packer.add(part)
    assert all((a == b).all() for a, b in zip(coded, packer.finish()))


def test_simple8b_is_small():
    assert len(simple8b.encode(np.zeros(2560, np.uint64))[0]) == 30
    assert len(simple8b.encode(np.full(256, 49_000, np.uint64))[0]) == 86


ROWS = [(3, "Three three."), (1, None), (2, ""), (None, "none"), (2, "two again"), (7, " ".join(ODD)), (5, "w " * 5000)]


def test_token_files_in_order(spark):
    folder = scratch_dir(spark)
    manifest = token_files.write_token_files(frame(spark, ROWS), folder, file_ids=2000)
    rows = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r.start)
    want = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (d, text) in zip(rows, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (d, start, len(plain(text)))
        assert np.frombuffer(r.ids, "<u4").tolist() == plain(text)
        start += r.n_tokens
    assert manifest.count() > 1
    empty = token_files.write_token_files(frame(spark, ROWS).where("false"), scratch_dir(spark))
    assert token_files.read_checksums(empty).count() == 0


def test_random_access(spark):
    manifest = token_files.write_token_files(frame(spark, [(1, "a b " * 3000)]), scratch_dir(spark))
    file = token_files.TokenFile(manifest.first().path)
    ids = plain("a b " * 3000)
    for a, b in ((0, 1), (255, 257), (1000, 5000), (6000, 6001), (7, 7)):
        assert file.ids(a, b).tolist() == ids[a:b]
    file.close()


def test_counts(spark):
    lengths = token_counts.encoded_lengths(frame(spark, ROWS))
    n = np.array([len(plain(t)) for _, t in ROWS])
    assert sorted(r.length for r in lengths.collect()) == sorted(n.tolist())
    hist = token_counts.length_histogram(lengths)
    limits = [0, 1, 3, 100, 10**9]
    got = {r.context_limit: (r.truncated_tokens, r.docs_cut) for r in token_counts.truncated_totals(hist, limits).collect()}
    assert got == {x: (np.minimum(n, x).sum(), (n > x).sum()) for x in limits}
    q = {r.share: r.length for r in token_counts.length_quantiles(hist, [0.01, 0.5, 1.0]).collect()}
    assert q == {s: sorted(n)[max(int(np.ceil(s * len(n))) - 1, 0)] for s in (0.01, 0.5, 1.0)}
    assert token_counts.length_histogram(lengths.where("false")).count() == 0


def test_packing_rows(spark):
    tokens = packing_dp.encoded(frame(spark, [r for r in ROWS if r != (2, "two again")]))
    got = packing_dp.piece_checksums(tokens, packing_dp.pack_documents(tokens)).toPandas()
    got["doc_id"] = got.doc_id.fillna(-1)
    check_packing(got, {-1 if d is None else d: np.array(plain(t), "<u4") for d, t in ROWS if t != "two again"})
    rows = packing_dp.piece_rows(tokens, packing_dp.pack_documents(tokens)).toPandas()
    stream = b"".join(rows.sort_values(["sequence_id", "offset"]).ids)
    want = sorted((r for r in ROWS if r != (2, "two again")), key=lambda r: (r[0] is not None, r[0] or 0))
    assert np.frombuffer(stream, "<u4").tolist() == [i for _, t in want for i in plain(t)]


def test_packing_repeats_and_empty(spark):
    rows = [(1, "a b c.")] * 5 + [(1, "d")]
    tokens = packing_dp.encoded(frame(spark, rows))
    got = packing_dp.piece_checksums(tokens, packing_dp.pack_documents(tokens)).collect()
    assert sum(r.length for r in got) == sum(len(plain(t)) for _, t in rows)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got) == 6
    empty = packing_dp.encoded(frame(spark, rows).where("false"))
    assert packing_dp.pack_documents(empty).count() == 0


def test_packing_does_not_depend_on_the_cluster(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    answers = []
    for n in ("4", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        tokens = packing_dp.encoded(docs.repartition(int(n)))
        packed = packing_dp.pack_documents(tokens, block_tokens=20_000)
        answers.append(sorted(map(tuple, packing_dp.piece_checksums(tokens, packed).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert answers[0] == answers[1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 6)), min_size=1, max_size=40), st.integers(9, 20))
def test_cuts_are_the_cheapest(steps, length):
    places = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalty = np.array([0] + [p for _, p in steps], float)

    def cost(chosen):
        return sum(length - (places[j] - places[i]) + penalty[j] for i, j in zip([0, *chosen], chosen))

    best = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= length:
                best[j] = min(best[j], best[i] + length - (places[j] - places[i]) + penalty[j])
    chosen = packing_dp.best_cuts(places, penalty, length)
    assert chosen[-1] == len(places) - 1 and cost(chosen) == best[-1]


def test_crc_is_unsigned_little_endian(spark):
    tokens = packing_dp.encoded(frame(spark, [(1, "hello")]))
    got = packing_dp.piece_checksums(tokens, packing_dp.pack_documents(tokens)).first()
    assert got.ids_crc32 == zlib.crc32(np.array(plain("hello"), "<u4").tobytes())
    with pytest.raises(ValueError):
        packing_dp.pack_documents(tokens, length=10)


def test_rows_of_one_key_spread_over_tasks(spark, tmp_path):
    """Two thirds of the rows have a null key, many of them one text: no task has them all."""
    rows = [(None, "same words here")] * 300 + [(None, f"other {i}") for i in range(300)] + [(i, f"text {i}") for i in range(300)]
    manifest = token_files.write_token_files(frame(spark, rows), str(tmp_path))
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == 900 and max(sizes) < 500
    got = token_files.read_documents(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 600 + list(range(300))
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    assert [r.start for r in got] == (np.cumsum([r.n_tokens for r in got]) - [r.n_tokens for r in got]).tolist()
    assert sorted(bytes(r.ids) for r in got) == sorted(np.array(plain(t), "<u4").tobytes() for _, t in rows) and len(ids)
