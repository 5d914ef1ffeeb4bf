"""rougeLsum against a plain table of lengths walked back."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from deskcorpus.functions import scores
from deskcorpus.functions.scores import lcs_places, summary_hits
from deskcorpus.operators import evaluate


def walked_back(first, second):
    table = [[0] * (len(second) + 1) for _ in range(len(first) + 1)]
    for i, a in enumerate(first, 1):
        for j, b in enumerate(second, 1):
            table[i][j] = table[i - 1][j - 1] + 1 if a == b else max(table[i - 1][j], table[i][j - 1])
    i, j, out = len(first), len(second), []
    while i and j:
        if first[i - 1] == second[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif table[i][j - 1] > table[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out[::-1]


def lines(text):
    return [re.findall("[a-z0-9]+", line.lower()) for line in (text or "").split("\n")]


def score(prediction, reference):
    p, r = lines(prediction), lines(reference)
    n, m = (sum(map(len, x)) for x in (p, r))
    left_p, left_r = (Counter(t for line in x for t in line) for x in (p, r))
    hits = 0
    for line in r:
        for i in sorted({i for other in p for i in walked_back(line, other)}):
            if left_p[line[i]] > 0 and left_r[line[i]] > 0:
                left_p[line[i]] -= 1
                left_r[line[i]] -= 1
                hits += 1
    return 2 * hits / (n + m) if hits else 0.0


TOKENS = st.lists(st.sampled_from("abcd"), max_size=9)


@settings(max_examples=300, deadline=None)
@given(TOKENS, TOKENS)
def test_matched_places(first, second):
    assert lcs_places(first, second) == walked_back(first, second)


@settings(max_examples=200, deadline=None)
@given(st.lists(TOKENS, max_size=5), st.lists(TOKENS, max_size=5))
def test_hits_of_lines(p, r):
    p_text, r_text = ("\n".join(" ".join(line) for line in x) for x in (p, r))
    n = sum(map(len, p)) + sum(map(len, r))
    hits = summary_hits(p, r)
    assert (2 * hits / n if hits else 0.0) == pytest.approx(score(p_text, r_text))
    if len(p) == len(r) == 1:
        assert hits == len(walked_back(r[0], p[0]))


def test_texts(spark):
    rows = [
        ("the cat\nsat down", "sat down\nthe cat"), ("the cat sat", "the cat sat"), ("", "a"), (None, "a b"), ("a", None),
        ("\n\n", "\n"), ("a\n\n b a", "a a a\nb"), ("x " * 3000, "x\n" * 3000), ("A-1 b", "a 1\nB"),
    ]
    df = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "id int, prediction string, response string, _p int")
    got = {r.id: r.rougeLsum for r in evaluate.rouge_summary_per_row(df.drop("_p")).collect()}
    for i, (p, r) in enumerate(rows):
        if i != 7:
            assert got[i] == pytest.approx(score(p, r)), i
    assert got[0] == 1.0 and got[7] == 2 / 6000 * 3000
    assert evaluate.rouge_summary(df).first().rougeLsum == pytest.approx(sum(got.values()) / len(rows))
    assert evaluate.rouge_summary(df.limit(0)).first().rougeLsum == 0.0


def test_without_line_breaks_it_is_rouge_l(spark):
    rows = [("a b c b d a b", "b d c a b a"), ("x", "y"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, prediction string, response string")
    both = evaluate.rouge_summary_per_row(evaluate.rouge_per_row(df)).collect()
    assert all(r.rougeL == r.rougeLsum for r in both)


def test_queries(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r.rougeLsum for r in entry.queries()["rouge_summary"](spark, sf_dir).collect()}
    assert len(got) == len(docs) and any("\n" in r.text for r in docs)
    for r in docs:
        if len(r.text) < 4000:
            first, _, rest = r.text.partition("\n")
            assert got[r.doc_id] == pytest.approx(score(rest + "\n" + first, r.text), abs=1e-6)
    table = entry.queries()["rouge_summary_pairs"](spark, sf_dir)
    from deskcorpus.queries import scored_pairs

    said = {r.pair_id: (r.prediction, r.response) for r in scored_pairs(spark, sf_dir).collect()}
    got = {r.pair_id: r.rougeLsum for r in table.collect()}
    assert got.keys() == said.keys() and all(got[k] == pytest.approx(score(*said[k]), abs=1e-6) for k in said)


def test_pairs_that_add_nothing_are_not_compared(monkeypatch):
    """A word that all lines hold links them all; most pairs cannot add to a line's union."""
    calls = []
    plain = scores.lcs_bits
    monkeypatch.setattr(scores, "lcs_bits", lambda *a: calls.append(1) or plain(*a))
    reference = [["the", f"a{i}", f"b{i}", "of", f"c{i}"] for i in range(60)]
    prediction = [[line[0], line[2], line[3], line[4]] for line in reference]  # no line is equal to one
    want = {(i, p) for i, r in enumerate(reference) for other in prediction for p in walked_back(r, other)}
    assert summary_hits(prediction, reference) == len(want) == 240
    assert len(calls) == 60  # of 3,600 pairs
