"""Best-fit packing: units, bounds, blocks, rounds, and the registered query."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from deskcorpus.llm import best_fit
from deskcorpus.llm.encode_bytes import UnitEncoder, default_tokenizer
from deskcorpus.llm.queries import QUERIES
from helpers import DOCS, frame

ODD = ["", " ", "  a", "a  b", "a\n b", "\n\na", "a\n", "a \n b", "don't", "x 's y", "it''s", "  a", "a  b", "a 　b",
       "<|endoftext|>", "a <|endoftext|> b", "12 345,6", "a\tb", "é è\né", "ab12cd", "...\n\n\n...", "日本 語\n", "\x00 \x1f a", "a.\nB", "a\r\nb", "´s 's'S"]


@pytest.fixture(scope="module")
def encoder():
    return UnitEncoder(default_tokenizer())


@pytest.fixture(scope="module")
def plain():
    model = Tokenizer.from_file(default_tokenizer())
    model.encode_special_tokens = True
    return model


def same_ids(encoder, plain, texts):
    flat, bounds = encoder.ids(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert flat[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_units_on_odd_texts(encoder, plain):
    same_ids(encoder, plain, ODD)
    same_ids(encoder, plain, ["".join(ODD), *ODD, " ".join(ODD)])


PIECES = st.lists(st.sampled_from([" ", "\n", "\t", "'", "'s", "a", "B", "7", ".", "é", " ", " ", "語", "́", "ª", "<|endoftext|>"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES.map("".join), min_size=1, max_size=6))
def test_units_on_any_text(encoder, plain, texts):
    same_ids(encoder, plain, texts)


def best_fit_one_by_one(sizes, length):
    """Loads of best-fit decreasing, a piece at a time."""
    loads = []
    for s in sizes:
        fits = [i for i, x in enumerate(loads) if x + s <= length]
        if fits:
            loads[max(fits, key=lambda i: loads[i])] += s
        else:
            loads.append(s)
    return sorted(loads)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_packing_by_counts(sizes):
    sizes = np.array(sorted(sizes, reverse=True), np.int64)
    bins, offset, loads = best_fit.best_fit_decreasing(sizes, 20)
    assert sorted(loads.tolist()) == best_fit_one_by_one(sizes.tolist(), 20)
    for b in range(len(loads)):
        at = 0
        for s, o in sorted(zip(sizes[bins == b], offset[bins == b]), key=lambda x: x[1]):
            assert o == at
            at += s
        assert at == loads[b] <= 20


def fewest_bins(sizes, length):
    """The optimum by trying everything."""
    best = len(sizes)

    def place(k, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if k == len(sizes):
            best = len(loads)
            return
        for i in sorted(set(loads)):
            if i + sizes[k] <= length:
                j = loads.index(i)
                place(k + 1, loads[:j] + [i + sizes[k]] + loads[j + 1 :])
        place(k + 1, loads + [sizes[k]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_bound_never_exceeds_the_optimum(sizes):
    sizes = sorted(sizes, reverse=True)
    bound = best_fit.lower_bound(np.bincount(sizes, minlength=13))
    assert -(-sum(sizes) // 12) <= bound <= fewest_bins(sizes, 12)


def test_bound_beats_the_sum():
    assert best_fit.lower_bound(np.bincount([7] * 10, minlength=13)) == 10  # halves
    assert best_fit.lower_bound(np.bincount([5] * 10, minlength=13)) == 5  # u(2): two in a bin


def check_pieces(got, ids, length=1024):
    """Every id once, cut by the rule; sequences gapless and short enough."""
    for (d, copy), pieces in got.sort_values(["row", "piece"]).groupby(["doc_id", "row"], dropna=False):
        x, at = ids[None if d != d else d], 0
        full = max(-(-len(x) // length), 1)
        assert pieces.piece.tolist() == list(range(full))
        assert pieces.length.tolist() == [len(x) - (full - 1) * length] + [length] * (full - 1)
        for p in pieces.itertuples():
            assert p.start == at and p.ids_crc32 == zlib.crc32(x[at : at + p.length].tobytes())
            at += p.length
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        assert (pieces.length.cumsum() - pieces.length == pieces.offset).all() and pieces.length.sum() <= length


def token_ids(plain, text):
    return np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_query(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op11_best_fit"](spark, sf_dir).toPandas()
    assert got.columns.tolist() == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = docs.toPandas()
    assert got.doc_id.nunique() == len(rows)
    got["row"] = 0
    ids = {r.doc_id: token_ids(plain, r.text) for r in rows.itertuples()}
    check_pieces(got, ids)
    least = best_fit.lower_bound(np.bincount(got.length, minlength=1025))
    assert got.sequence_id.nunique() <= least + 1


def test_rounds_and_rest(spark, plain):
    """Null ids, repeated rows, empty and very long texts, in small blocks over rounds."""
    texts = [None, "", "word " * 3000, "short"] + [f"text {'abc ' * (i % 90)}" for i in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "same")] * 50 + [(500, "one text")] * 50
    docs = frame(spark, rows)
    pieces = best_fit.encoded_pieces(docs)
    packed = best_fit.pack_pieces(pieces, block_pieces=60)
    got = packed.toPandas()
    assert got.row.nunique() == len(rows)
    check_pieces(got, {i: token_ids(plain, t) for i, t in rows})
    proof = best_fit.certified(pieces, packed)
    assert proof["bound"] <= proof["sequences"] <= proof["bound"] + 1
    one = best_fit.pack_pieces(pieces, block_pieces=60).toPandas()
    keys = ["row", "piece"]
    assert one.fillna(-1).sort_values(keys).values.tolist() == got.fillna(-1).sort_values(keys).values.tolist()
    whole = best_fit.piece_rows(pieces, packed).collect()
    assert all(zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32 for r in whole)
    assert len(whole) == len(got)


def test_gaps_are_exchanged():
    sizes = np.array([6] * 3 + [4] * 1, np.int64)  # 6+4, 6, 6: no better packing
    _, _, loads = best_fit.best_fit_decreasing(sizes, 10)
    assert best_fit.given_up(sizes, loads, 10).tolist() == [False, True, False]  # certified: the emptiest alone
    sizes = np.array([5, 4, 4, 3, 2, 2], np.int64)  # 10 + 10 is possible, best fit takes three bins
    _, _, loads = best_fit.best_fit_decreasing(sizes, 10)
    assert len(loads) == 3 and best_fit.given_up(sizes, loads, 10).tolist() == (loads < 10).tolist()


def test_empty_table(spark):
    assert best_fit.pack_table(spark.createDataFrame([], DOCS)).collect() == []
