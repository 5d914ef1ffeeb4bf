"""Prompts, guardrail, generation, tokens, packing and scores."""

import math
import sys
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from deskcorpus.config import Settings
from deskcorpus.functions import prompts as P
from deskcorpus.functions import scores, tokens
from deskcorpus.operators import evaluate, generate, guardrail, loss, packing, running
from deskcorpus.operators.generate import Generation, generate_replies
from deskcorpus.plans import corpus, evaluation

cloudpickle.register_pickle_by_value(sys.modules[__name__])
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expr.alias("o")).first().o


def test_prompt_layouts(spark):
    i, r = F.lit("  Where is my order? "), F.lit(" It shipped. ")
    whole = "### Instruction:\nCustomer:\nWhere is my order?\n\n### Response:\nIt shipped."
    assert one(spark, P.training_prompt(i, r)) == whole
    assert one(spark, P.prompt_only(i)) == whole[: -len("It shipped.")]
    assert one(spark, P.training_prompt(i, r, stripped=False)).endswith("\n It shipped. ")
    minimal = "### Instruction:\n\nCustomer:\n\nWhere is my order?\n\n\n\n### Response:\n\nIt shipped."
    assert one(spark, P.training_prompt_minimal(i, r)) == minimal
    assert one(spark, P.prompt_only_minimal(i)) == minimal[: -len("\nIt shipped.")]


def test_messages(spark):
    full = one(spark, P.chat_messages(F.lit(" q "), F.lit(" a ")))
    assert [(m.role, m.content) for m in full][1:] == [("user", "q"), ("assistant", "a")]
    assert len(one(spark, P.chat_messages(F.lit("q"), F.lit(None).cast("string")))) == 2
    assert len(one(spark, P.chat_messages(F.lit("q")))) == 2


def test_extract_reply(spark):
    prompt = P.prompt_only(F.lit("q"))
    assert one(spark, P.extract_reply(F.concat(prompt, F.lit("X ")), prompt)) == "X"
    twice = F.lit("a ### Response: b ### Response: c ")
    assert one(spark, P.extract_reply(twice, prompt)) == "c"
    assert one(spark, P.extract_reply(F.lit(" whole "), prompt)) == "whole"
    assert one(spark, P.extract_reply(F.lit("h### Response:\n x "), minimal=True)) == " x "


def test_context(spark):
    assert one(spark, P.with_context(F.lit("m"), F.lit(""))) == "m"
    assert one(spark, P.with_context(F.lit("m"), F.lit(None).cast("string"))) == "m"
    framed = one(spark, P.with_context(F.lit("m"), F.lit("faq")))
    assert framed.splitlines()[1:] == ["faq", "", "Customer question:", "m"]
    pages = F.array(F.lit("  a"), F.lit(None).cast("string"), F.lit("b" * 5000))
    assert one(spark, P.context_text(pages)) == "a\n\n" + "b" * 2997


ON = ["hi", "thanks a lot", "Where is my order #48213?", "My coupon code SAVE20 isn't applying at checkout."]
OFF = ["Where are all my orders today?", "How long does shipping take?", "Has it been delivered to my house?",
       "do you take returns on shoes", "I want my money returned now please",
       "Can you help me book a flight to Paris?", "one two three éorder here"]


def test_guardrail(spark):
    df = spark.createDataFrame([(t,) for t in ON + OFF], "t string")
    got = [r.o for r in df.select(guardrail.on_topic(F.col("t")).alias("o")).collect()]
    assert got == [True] * len(ON) + [False] * len(OFF)
    prefix = guardrail.on_topic(F.col("t"), match="prefix")
    assert [r.o for r in df.select(prefix.alias("o")).collect()][len(ON)] is True


def strict_model():
    def predict(prompts, max_new_tokens, temperature, top_p, do_sample):
        assert prompts and all("Paris" not in str(p) for p in prompts)
        assert (max_new_tokens, temperature, do_sample) == (256, 1e-3, False)
        if isinstance(prompts[0], list):
            return [f" {p[-1]['role']}:{p[-1]['content']} " for p in prompts]
        return [p + " fine " for p in prompts]

    return predict


def test_routing_keeps_off_topic_from_the_model(spark):
    df = spark.createDataFrame([(t,) for t in ON + OFF], "t string")
    rows = guardrail.route_replies(df, "t", Generation(strict_model, temperature=0.0)).collect()
    assert [r.reply for r in rows] == ["fine"] * len(ON) + [guardrail.OFF_TOPIC_REPLY] * len(OFF)
    chat = Generation(strict_model, style="chat", temperature=0.0)
    assert generate_replies(df.limit(1), "t", chat).first().prediction == "user:hi"
    with pytest.raises(ValueError):
        generate_replies(df, "t", Generation(strict_model, style="x"))


def test_tokens(spark):
    df = spark.createDataFrame([("a-b, c",), ("",), (None,)], "t string")
    got = df.select(tokens.token_length(F.col("t")).alias("n"), tokens.tokens(F.col("t")).alias("t")).collect()
    assert [r.n for r in got] == [5, 0, 0] and got[0].t == ["a", "-", "b", ",", "c"]
    chars = tokens.tokenizer_udf(lambda: list)
    assert [r.n for r in df.select(chars("t").alias("n")).collect()] == [6, 0, 0]


@FEW
@given(st.lists(st.integers(0, 40), min_size=1, max_size=30), st.integers(1, 9), st.integers(1, 3))
def test_packing_keeps_the_token_stream(spark, sizes, length, shards):
    rows = [(i, " ".join(f"t{i}x{j}" for j in range(n))) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "id int, t string").repartition(3)
    blocks = packing.pack(df, "id", "t", length=length, shards=shards).collect()
    streams: dict = {}
    for b in sorted(blocks, key=lambda b: (b.shard, b.block)):
        streams.setdefault(b.shard, []).extend(b.tokens)
        assert b.n_tokens == len(b.tokens)
    assert sorted(t for s in streams.values() for t in s) == sorted(t for _, text in rows for t in text.split())
    for stream in streams.values():
        owners = [int(t[1:].split("x")[0]) for t in stream]
        assert owners == sorted(owners)
    last = {b.shard: max(x.block for x in blocks if x.shard == b.shard) for b in blocks}
    assert all(b.n_tokens == length for b in blocks if b.block != last[b.shard])
    full = packing.pack(df, "id", "t", length=length, shards=shards, keep_tail=False).collect()
    assert len(full) == sum(b.n_tokens == length for b in blocks)


WORDS = st.lists(st.sampled_from(["a", "b", "c", "d."]), max_size=12).map(" ".join)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@FEW
@given(st.lists(st.tuples(WORDS, WORDS), min_size=1, max_size=25))
def test_overlaps_match_counting(spark, texts):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "id int, prediction string, response string")
    rows = sorted(evaluate.bleu_per_row(evaluate.rouge_per_row(df)).collect(), key=lambda r: r.id)
    for row, (p, r) in zip(rows, texts):
        ps, rs = p.replace(".", "").split(), r.replace(".", "").split()
        shared = sum((Counter(ps) & Counter(rs)).values())
        assert row.rouge1 == pytest.approx(2 * shared / (len(ps) + len(rs)) if shared else 0)
        common = lcs(ps, rs)
        assert row.rougeL == pytest.approx(2 * common / (len(ps) + len(rs)) if common else 0)
        pb, rb = (list(t.replace(".", " .").split()) for t in (p, r))
        for n in (1, 2, 3, 4):
            grams = [Counter(tuple(t[k : k + n]) for k in range(len(t) - n + 1)) for t in (pb, rb)]
            assert row[f"_hits{n}"] == sum((grams[0] & grams[1]).values())
            assert row[f"_total{n}"] == sum(grams[0].values())


def bleu_of(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "prediction string, response string")
    return evaluate.bleu(df).first().bleu


def test_scores_by_hand(spark):
    same = spark.createDataFrame([("Hello, big world!", "Hello, big world!")], "prediction string, response string")
    r = evaluate.rouge(same).first()
    assert (r.rouge1, r.rouge2, r.rougeL) == (1, 1, 1)
    assert bleu_of(spark, ("Hello, big world!", "Hello, big world!")) == pytest.approx(100)
    assert bleu_of(spark, ("a b c d", "e f g h")) == 0
    assert bleu_of(spark, ("a b c", "a b c")) == 0  # no 4-grams
    # matches 4/5, 2/4, 1/3, then none out of 2: smoothed to 1/(2*2)
    expected = 100 * (4 / 5 * 2 / 4 * 1 / 3 * 1 / 4) ** 0.25
    assert bleu_of(spark, ("a b c x d", "a b c y d")) == pytest.approx(expected)
    # shorter than the reference: exp(1 - 8/4)
    assert bleu_of(spark, ("a b c d", "a b c d e f g h")) == pytest.approx(100 * math.exp(-1))
    assert one(spark, scores.lcs_length(F.lit("a b c b d a b"), F.lit("b d c a b a"))) == 4


def test_13a_tokens(spark):
    text = "Pay $1,000.50 now (e.g. 5-6)&quot;ok&quot; don't"
    got = one(spark, scores.bleu_tokens(F.lit(text)))
    assert got == ["Pay", "$", "1,000.50", "now", "(", "e", ".", "g", ".", "5", "-", "6", ")", '"', "ok", '"', "don't"]


def test_perplexity(spark):
    def of(values, **options):
        df = spark.createDataFrame([(v,) for v in values], "loss double")
        return evaluate.perplexity(df, **options).first().perplexity

    assert of([0.0, 0.0]) == 1 and of([math.log(2), math.log(8)]) == pytest.approx(4)
    assert of([]) == 1 and of([], empty=float("inf")) == math.inf


def test_bigram_losses(spark):
    train = spark.createDataFrame([(1, "a b a b"), (2, "a c")], "id int, text string")
    test = spark.createDataFrame([(3, "a b"), (4, "z"), (5, "a q a")], "id int, text string")
    got = {r.id: r.loss for r in loss.bigram_losses(train, test, "id", "text").collect()}
    p = lambda n, m: -math.log((n + 1) / (m + 4))  # noqa: E731  vocabulary a, b, c plus one
    assert set(got) == {3, 5}
    assert got[3] == pytest.approx(p(2, 3)) and got[5] == pytest.approx((p(0, 3) + p(0, 0)) / 2)


def test_loss_curves(spark):
    log = spark.createDataFrame([(1, 0.5, None), (2, None, 0.7)], "step int, loss double, eval_loss double")
    assert sorted(map(tuple, evaluate.loss_curves(log).collect())) == [(1, "train_loss", 0.5), (2, "eval_loss", 0.7)]
    assert evaluate.loss_curves(log.drop("eval_loss")).count() == 1
    assert evaluate.loss_curves(log.select("step")).count() == 0


def test_evaluation_job_writes_its_outputs(spark, tmp_path):
    test = spark.createDataFrame([(i, f"question {i} here", f"fine {i}") for i in range(70)], "id int, instruction string, response string")
    model = Generation(strict_model, temperature=0.0)
    report = evaluation.evaluate_model(
        test,
        model,
        "id",
        samples=50,
        table_path=f"{tmp_path}/table",
        metrics_path=f"{tmp_path}/metrics",
        settings=Settings(eval_max_new_tokens=256, eval_temperature=0.0),
    ).first()
    assert report.n_eval_samples == 50 and report.perplexity is None and 0 < report.rouge1 < 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/table").count() == 50
    metrics = spark.read.json(f"{tmp_path}/metrics").first()
    assert metrics.n_eval_samples == 50 and metrics.rouge1 == pytest.approx(report.rouge1)


def test_packing_does_not_depend_on_the_cluster(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    answers = []
    for n in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        blocks = packing.pack(docs.repartition(int(n)), "doc_id", "text", shards=1, length=100)
        answers.append(sorted((r.block, tuple(r.tokens)) for r in blocks.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert answers[0] == answers[1]
    tail = packing.tail_tokens(packing.pack(docs, "doc_id", "text", shards=1, length=100), 100).first()
    assert (tail.n_blocks, tail.n_tokens) == (1, len(answers[0][-1][1]))


def test_one_shard_is_many_tasks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.lit(1).alias("n"), F.lit(0).alias("g"))
    placed = running.prefix_sums(docs, ["doc_id"], "n", "before", ["g"])
    spread = placed.select("doc_id", "before").collect()
    assert sorted(r.before for r in spread) == list(range(len(spread)))
    assert [r.doc_id for r in sorted(spread, key=lambda r: r.before)] == sorted(r.doc_id for r in spread)


def test_predictions_stay_with_their_rows(spark):
    rows = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, instruction string, response string")
    some = spark.createDataFrame([(1, "p")], "id int, prediction string")
    got = evaluate.attach_predictions(rows, some, "id")
    assert sorted((r.id, r.prediction) for r in got.collect()) == [(1, "p"), (2, None)]
    with pytest.raises(Exception, match="several predictions for 1"):
        evaluate.attach_predictions(rows, some.unionByName(some), "id").collect()


def test_model_calls_are_bounded(spark):
    def factory():
        def predict(prompts, **_):
            assert len(prompts) <= 3
            return [f"{p} ok" for p in prompts]

        return predict

    df = spark.range(20).select(F.col("id").cast("string").alias("m"))
    got = generate.generate_replies(df, "m", Generation(factory, batch_size=3)).collect()
    assert {r.prediction for r in got} == {"ok"}


def test_pairs_over_gaps_and_long_conversations(spark):
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"a{t}") for t in range(2500)]
    turns += [(2, 0, "user", "q"), (2, 5, "assistant", "far"), (2, 3000, "user", "late"), (2, 9000, "assistant", "later")]
    turns += [(3, 0, "user", "x"), (3, 1, "user", "y")]
    got = {r.pair_id: (r.instruction, r.response) for r in corpus.reply_pairs(
        spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert len(got) == 1252
    assert got["1:998"] == ("a998", "a999") and got["1:2498"] == ("a2498", "a2499")
    assert got["2:0"] == ("q", "far") and got["2:3000"] == ("late", "later")


def test_loss_with_a_hot_pair_unseen_in_training(spark):
    train = spark.createDataFrame([(1, "a b a b c")], "id int, text string")
    test = spark.createDataFrame([(2, "x y " * 500), (3, "a b")], "id int, text string")
    got = {r.id: r.loss for r in loss.bigram_losses(train, test, "id", "text").collect()}
    p = lambda n, m: -math.log((n + 1) / (m + 4))
    assert got[2] == pytest.approx(p(0, 0)) and got[3] == pytest.approx(p(2, 2))


def test_loss_lookups_shuffle_only_what_the_test_texts_ask(spark):
    """Of many training pairs the joins get the few that occur in the test texts."""
    train = spark.createDataFrame([(i, f"a{i} b{i} c{i} a0") for i in range(3000)], "id int, text string")
    test = spark.createDataFrame([(1, "a0 b0 a0"), (2, "x")], "id int, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = loss.bigram_losses(train, test, "id", "text")
        (row,) = found.collect()
        plan = found._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    v = 9001
    assert row.loss == pytest.approx((-math.log(2 / (1 + v)) - math.log(1 / (1 + v))) / 2)
    text = plan.toString()
    assert "SortMergeJoin" in text and "asked" in text and "PushedFilters: [IsNotNull(asked), GreaterThan(asked,0)" in text


TURN = "conv_id long, turn long, role string, text string"


def test_turns_without_a_place_and_repeated_numbers(spark):
    turns = [(None, 0, "user", "lost"), (None, 1, "assistant", "lost too"), (1, None, "user", "nowhere"), (1, 0, "user", "q")]
    turns += [(1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", None), (2, 0, None, None), (2, 1, "assistant", "x")]
    df = spark.createDataFrame(turns, TURN).repartition(3)
    assert [tuple(r) for r in corpus.reply_pairs(df).collect()] == [("1:0", "q", None)]
    assert corpus.reply_pairs(df.limit(0)).collect() == [] and corpus.histories(df.limit(0)).collect() == []
    got = {r.conv_id: [tuple(t) for t in r.history] for r in corpus.histories(df).collect()}
    assert got == {
        1: [("user", "q"), ("assistant", None), ("assistant", "a"), ("assistant", "b")],
        2: [(None, None), ("assistant", "x")],
    }


def test_pairs_filter_before_anything_moves(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    plan = corpus.reply_pairs(turns)._jdf.queryExecution().executedPlan().toString()
    scans = [part for part in plan.split("Filter (")[1:] if "FileScan" in part.split("Filter (")[0]]
    assert len(scans) >= 2 and all("isnotnull(conv_id" in x and "isnotnull(turn" in x for x in scans)


def test_histories_of_long_conversations(spark):
    turns = [(1, t, "user", f"t{t}") for t in range(2500)] + [(2, 7, "user", "only")]
    got = {(r.conv_id, r.stretch): [t.content for t in r.history] for r in corpus.histories(spark.createDataFrame(turns, TURN)).collect()}
    assert got[2, 0] == ["only"] and [len(got[1, s]) for s in range(3)] == [1000, 1000, 500]
    assert sum((got[1, s] for s in range(3)), []) == [f"t{t}" for t in range(2500)]


def test_prompts_of_like_length_share_a_call(spark):
    """Replies stay with their rows; padding, summed over calls, is a fraction of what
    calls in row order would need."""
    texts = [None if i % 11 == 0 else "w" * (i * 37 % 500) for i in range(1000)]

    def factory():
        def predict(prompts, **_):
            longest = max(map(len, prompts))
            return [f"{p} {longest}" for p in prompts]

        return predict

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, m string").coalesce(1)
    sent = {}
    for buffer in (1, 10_000):
        made = Generation(factory, batch_size=8, buffer_size=buffer)
        got = {r.id: r.prediction for r in generate.generate_replies(df, "m", made).collect()}
        assert len(got) == 1000 and all((got[i] is None) == (t is None) for i, t in enumerate(texts))
        sent[buffer] = sum(int(r) for r in got.values() if r is not None)
    lead = min(int(r) for r in got.values() if r is not None)
    whole = sum(len(t) for t in texts if t is not None) + 909 * lead
    assert sent[10_000] - whole < 0.1 * (sent[1] - whole)


def test_chat_prompts_of_like_length(spark):
    def factory():
        def predict(prompts, **_):
            sizes = [len(p[1]["content"]) for p in prompts]
            return [f"{len(p[1]['content'])} {max(sizes) - min(sizes)}" for p in prompts]

        return predict

    df = spark.createDataFrame([(i, "w" * (1 + i * 7 % 40)) for i in range(400)], "id int, m string").coalesce(1)
    got = generate.generate_replies(df, "m", Generation(factory, style="chat", batch_size=10)).collect()
    for r in got:
        n, spread = map(int, r.prediction.split())
        assert n == 1 + r.id * 7 % 40 and spread <= 1
    with pytest.raises(Exception, match="(?i)zip|argument"):
        few = Generation(lambda: lambda prompts, **_: ["only one"], batch_size=10)
        generate.generate_replies(df, "m", few).collect()
