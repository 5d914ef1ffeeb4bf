"""Frequent terms by bounded summaries, grouped value counts, phrase tables, n-gram back-off."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskcorpus import stages
from deskcorpus.operators import backoff, guardrail, packs, phrases, profile


def terms_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def zipf(spark):
    draw = random.Random(3)
    words = [f"w{int(1 / (draw.random() + 0.0005))}" for _ in range(8000)] + [f"tail{i}" for i in range(8000)]
    draw.shuffle(words)
    rows = [(i, " ".join(words[i : i + 16])) for i in range(0, len(words), 16)] + [(-1, None), (-2, "")]
    return spark.createDataFrame(rows, "id int, text string").repartition(6).cache()


@pytest.mark.parametrize("capacity", [2, 40, 400, 20_000])
def test_frequent_terms_equal_the_full_count(zipf, capacity):
    want = terms_of(profile.term_counts(zipf, ["text"], 12, ["w1"]))
    assert terms_of(profile.frequent_terms(zipf, ["text"], 12, ["w1"], capacity=capacity)) == want


def test_summaries_bound_what_is_shuffled(zipf):
    terms = profile._terms(zipf, ["text"], ["none"])
    rows = profile.term_summaries(terms, 400).withColumn("task", F.spark_partition_id()).collect()
    per_task = Counter(r.task for r in rows)
    assert max(per_task.values()) <= 400 + 1 and len(per_task) == 6
    short = sum(r.least for r in rows if r.term is None)
    exact, least = Counter(r.term for r in terms.collect()), Counter()
    for r in rows:
        if r.term is not None:
            least[r.term] += r.least
    assert 0 < short <= sum(exact.values()) / 400
    assert all(least[t] <= n <= least[t] + short for t, n in exact.items())
    plan = profile.frequent_terms(zipf, ["text"], 12, ["none"], capacity=400)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan  # the bounds sufficed


def test_ties_at_the_end_of_the_list(spark):
    df = spark.createDataFrame([("a a b b c c d",), ("e",)], "text string")
    for capacity in (1, 3, 100):
        assert terms_of(profile.frequent_terms(df, ["text"], 2, ["x"], capacity=capacity)) == [("a", 2), ("b", 2)]
    assert terms_of(profile.frequent_terms(df, ["text"], 50, ["x"])) == terms_of(profile.term_counts(df, ["text"], 50, ["x"]))
    assert profile.frequent_terms(df.limit(0), ["text"], 5, ["x"]).collect() == []


def test_value_counts_of_all_columns(spark):
    kinds = "t string, x double, b boolean, a array<int>, n int"
    rows = [("u", 1.0, True, [1], None), ("u", float("nan"), None, [1], None), (None, 1.0, False, None, None), ("", -0.5, True, [2, None], None)]
    df = spark.createDataFrame(rows, kinds)
    counted = profile.value_counts_all(df, df.columns)
    got = {}
    for r in counted.collect():
        got.setdefault(r.name, []).append((r.value, r["count"]))
    assert got == {
        "a": [("[1]", 2), ("[2,null]", 1)], "b": [("true", 2), ("false", 1)], "t": [("u", 2), ("", 1)], "x": [("1.0", 2), ("-0.5", 1)],
    }
    one = profile.value_counts(df, "t").collect()
    assert [(r.t, r["count"]) for r in one] == got["t"]


def test_value_counts_of_all_columns_scan_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = profile.value_counts_all(orders, ["o_orderstatus", "o_orderpriority"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


TEXTS = ["Gift card, GIFT  card!", None, "", "the card-gift card", "a b a b a", "gift", "été carte. Été", "x_1 x 1", "hot " * 400]
PHRASES = ["gift card", "card", "a b a", "été", "x_1", "hot", "Hot hot", "!!!", None, "card gift card", "Gift-Card"]


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def test_phrases_and_places(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)] + [(4, "a b a", "k")], "id int, text string, words string").repartition(3)
    table = spark.createDataFrame([(p,) for p in PHRASES], "phrase string")
    got = sorted(map(tuple, phrases.find_phrases(docs, "id", "text", table).collect()))
    want = []
    named = {}
    for p in sorted(p for p in PHRASES if p and words(p)):
        named.setdefault(tuple(words(p)), p)
    for i, t in [*enumerate(TEXTS), (4, "a b a")]:
        w = words(t)
        want += [(i, p, a) for key, p in named.items() for a in range(len(w)) if tuple(w[a : a + len(key)]) == key]
    assert got == sorted(want)
    assert phrases.find_phrases(docs, "id", "text", table.limit(0)).collect() == []
    assert phrases.find_phrases(docs.limit(0), "id", "text", table).collect() == []


def test_single_words_agree_with_mentions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    listed = ("hand", "stone", "thing", "des", "order", "la")
    table = spark.createDataFrame([(w,) for w in listed], "phrase string")
    hit = {r.doc_id for r in phrases.find_phrases(docs, "doc_id", "text", table).select("doc_id").distinct().collect()}
    flagged = docs.where(guardrail.mentions(F.col("text"), listed)).select("doc_id").collect()
    assert hit == {r.doc_id for r in flagged} and hit
    plan = phrases.find_phrases(docs, "doc_id", "text", table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_too_many_phrase_lengths(spark):
    table = spark.createDataFrame([("w " * n,) for n in range(1, 70)], "phrase string")
    with pytest.raises(ValueError, match="lengths"):
        phrases.find_phrases(table, "phrase", "phrase", table)


def model_by_hand(train, order, d=0.75):
    texts = [t.lower().split() for t in train if t]
    raw = [Counter() for _ in range(order + 1)]
    for w in texts:
        for n in range(1, order + 1):
            for i in range(n - 1, len(w)):
                raw[n][tuple(w[i - n + 1 : i + 1])] += 1
    counts = [None] * (order + 1)
    counts[order] = raw[order]
    for n in range(1, order):
        counts[n] = Counter(g[1:] for g in raw[n + 1])
    vocabulary = {w for t in texts for w in t}

    def p(context, word):
        if len(context) == 0:
            lower = 1 / (len(vocabulary) + 1)
        else:
            lower = p(context[1:], word)
        table = {g: c for g, c in counts[len(context) + 1].items() if g[:-1] == tuple(context)}
        total = sum(table.values())
        if not total:
            return lower
        return max(table.get((*context, word), 0) - d, 0) / total + d * len(table) / total * lower

    return p, vocabulary


TRAIN = ["a b a b c", "b c a", "The cat sat", "the cat ran the cat sat", None, "", "lone"]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_losses_by_hand(spark, order):
    train = spark.createDataFrame([(i, t) for i, t in enumerate(TRAIN)], "id int, text string")
    tests = ["a b c", "the cat sat the dog", "x y z", None, " ", "a", "c c c c the cat", "hot pair " * 200]
    test = spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "id int, text string").repartition(2)
    got = {r.id: r.loss for r in backoff.backoff_losses(train, test, "id", "text", order=order).collect()}
    p, _ = model_by_hand(TRAIN, order)
    for i, t in enumerate(tests):
        w = (t or "").lower().split()
        if not w:
            assert i not in got
            continue
        want = [-math.log(p(w[max(0, k - order + 1) : k], w[k])) for k in range(len(w))]
        assert got[i] == pytest.approx(sum(want) / len(want))


def test_probabilities_of_a_context_sum_to_one(spark):
    train = spark.createDataFrame([(t,) for t in TRAIN], "text string")
    model = backoff.train_backoff(train, "text", 3)
    _, vocabulary = model_by_hand(TRAIN, 3)
    assert model.vocabulary == len(vocabulary)
    contexts = ["", "a", "cat", "nowhere", "the cat", "a b", "nowhere cat", "x y"]
    rows = [(len(c.split()) + 1, c, w) for c in contexts for w in [*vocabulary, "<unknown>"]]
    asked = spark.createDataFrame(rows, "n int, context string, word string")
    sums = Counter()
    for r in backoff.backoff_probabilities(asked, model).collect():
        sums[r.context] += r.p
    assert all(sums[c] == pytest.approx(1.0) for c in contexts)


def test_backoff_without_training_texts(spark):
    none = spark.createDataFrame([], "id int, text string")
    test = spark.createDataFrame([(1, "a b")], "id int, text string")
    assert backoff.backoff_losses(none, test, "id", "text").first().loss == 0.0  # one word, the unknown one
    assert backoff.backoff_losses(test, none, "id", "text").collect() == []
    with pytest.raises(ValueError):
        backoff.train_backoff(test, "text", 0)


def test_backoff_writes_each_window_of_the_training_texts_once(spark, tmp_path, monkeypatch):
    """Only what the test texts look up is written besides the longest windows and their ends."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(100)) for _ in range(120)]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    test = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:2] + ["w1 w2 new w1"])], "id int, text string")
    monkeypatch.setattr(stages, "scratch_dir", lambda spark: f"{tmp_path}/{len(list(tmp_path.iterdir()))}")
    got = {r.id: r.loss for r in backoff.backoff_losses(train, test, "id", "text").collect()}
    p, _ = model_by_hand(texts, 3)
    w = ["w1", "w2", "new", "w1"]
    assert got[2] == pytest.approx(sum(-math.log(p(w[max(0, k - 2) : k], w[k])) for k in range(4)) / 4)
    written = sum(spark.read.parquet(str(folder)).count() for folder in tmp_path.iterdir())
    assert written < 3 * 120 * 100


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_windows_travel_in_packs(spark, tmp_path, monkeypatch, order):
    """Rows hold many windows each, and nothing changes when they come in small pieces."""
    rng = random.Random(5)
    texts = [" ".join(f"w{int(1 / (rng.random() + 0.003))}" for _ in range(rng.randrange(120))) for _ in range(90)]
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    asked = [(i % 3, " ".join(t.split()[::-1]) if i % 2 else t) for i, t in enumerate(texts[:7])] + [(None, "w1 w1 new"), (9, "")]
    test = spark.createDataFrame(asked, "id int, text string").repartition(2)
    monkeypatch.setattr(stages, "scratch_dir", lambda spark: f"{tmp_path}/{len(list(tmp_path.iterdir()))}")

    def losses():
        return {r.id: r.loss for r in backoff.backoff_losses(train, test, "id", "text", order=order).collect()}

    whole = losses()
    written = sum(spark.read.parquet(str(folder)).count() for folder in tmp_path.iterdir())
    assert written < 100 < sum(len(t.split()) for t in texts) / 40
    for name, value in {"CHUNK": 150, "LOOKUPS": 40, "HOLD": 100, "SHARE_BYTES": 2000}.items():
        monkeypatch.setattr(backoff, name, value)
    assert losses() == pytest.approx(whole, rel=1e-12)
    p, _ = model_by_hand(texts, order)
    want = {}
    for key, t in asked:
        w = t.split()
        want.setdefault(key, []).extend(-math.log(p(w[max(0, k - order + 1) : k], w[k])) for k in range(len(w)))
    assert whole == pytest.approx({key: sum(v) / len(v) for key, v in want.items() if v})


def test_texts_without_words_before_others_have_no_loss(spark):
    train = spark.createDataFrame([(1, "a b")], "id int, text string")
    test = spark.createDataFrame([(1, ""), (2, "b a"), (3, None), (4, "a"), (5, " ")], "id int, text string").coalesce(1)
    assert {r.id for r in backoff.backoff_losses(train, test, "id", "text").collect()} == {2, 4}


def test_codes_order_rows_and_find_them():
    draw = np.random.default_rng(1)
    ids, others = ([draw.integers(low, 9, 400) for _ in range(3)] for low in (0, -1))
    rows, asked = (list(zip(*(c.tolist() for c in some), strict=True)) for some in (ids, others))
    for largest in (packs.LARGEST, 2000, 81):
        codes = packs.Codes(ids, 9, largest)
        assert [rows[i] for i in np.argsort(codes.code, kind="stable")] == sorted(rows)
        number = dict(zip(rows, codes.code.tolist(), strict=True))
        assert len(set(number.values())) == len(number)
        found = codes.of(others).tolist()
        assert all(code == number[row] if row in number else code not in codes.code for row, code in zip(asked, found, strict=True))


@pytest.mark.parametrize("limit", [phrases.BROADCAST_BYTES, -1])
def test_phrases_by_both_ways(spark, tmp_path, monkeypatch, limit):
    """A small table goes to the texts, and none of their windows is written."""
    monkeypatch.setattr(stages, "scratch_dir", lambda spark: f"{tmp_path}/{len(list(tmp_path.iterdir()))}")
    monkeypatch.setattr(phrases, "BROADCAST_BYTES", limit)
    table = spark.createDataFrame([("b c",), ("C!",), ("b  C",), ("hot",), (None,)], "phrase string")
    texts = [(1, "a b c, B-c"), (1, "c"), (2, None), (None, "hot " * 50)]
    got = phrases.find_phrases(spark.createDataFrame(texts, "id int, t string"), "id", "t", table)
    want = [(1, "C!", 2), (1, "C!", 4), (1, "C!", 0), (1, "b  C", 1), (1, "b  C", 3)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want + [(None, "hot", i) for i in range(50)], key=str)
    written = sum(spark.read.parquet(str(folder)).count() for folder in tmp_path.iterdir())
    assert (written == 3) == (limit > 0)
