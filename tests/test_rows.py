"""Filters, deduplication, schema, sampling and splits."""

import statistics
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskcorpus.operators import dedup, filters, joins, profile, ranking, sampling, schema
from deskcorpus.plans import preprocess

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def pair_table(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "id int, instruction string, response string"
    )


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_noise_predicate_edges(spark):
    rows = [
        ("", "abc"), ("abc", ""), (None, "abc"), ("ab", "anything"), ("x" * 2001, "abc"),
        (" same ", "same"), ("a {{b}}", "abc"), ("abc", "{{ x"), ("abc", "y" * 2000), ("abc", "xyz"),
    ]
    assert ids(filters.drop_noisy(pair_table(spark, rows))) == [8, 9]


@pytest.mark.parametrize("high,kept", [(512, [1, 2, 3, 4]), (400, [1, 2])])
def test_length_bounds(spark, high, kept):
    rows = [(" ".join("w" * n), "two words") for n in (1, 2, 400, 401, 512, 513)]
    assert ids(filters.within_words(pair_table(spark, rows), high=high)) == kept


def test_category_whitelist(spark):
    rows = [(0, "order"), (1, "other"), (2, None), (3, "REFUND")]
    df = spark.createDataFrame(rows, "id int, category string")
    assert ids(filters.category_whitelist(df)) == [0, 3]
    assert ids(filters.category_whitelist(df, allowed=("ABSENT",))) == [0, 1, 2, 3]
    assert filters.category_whitelist(df.drop("category")).count() == 4


def test_violations(spark):
    dirty = pair_table(spark, [("a", "b"), ("a", "b"), ("", "x"), ("y", "")])
    row = filters.violations(dirty).first()
    assert (row.n_rows, row.empty_instruction, row.empty_response, row.duplicate_pairs) == (4, 1, 1, 1)
    with pytest.raises(ValueError):
        filters.require_clean(dirty)
    filters.require_clean(pair_table(spark, [("a", "b"), ("a", "c")]))


def test_column_resolution(spark):
    assert schema.resolve(["text", "query"], schema.INSTRUCTION_ALIASES) == "query"
    assert schema.resolve(["Text"], schema.INSTRUCTION_ALIASES) is None
    assert schema.resolve_loose(["id", "Utterance", "TEXT", "Output"]) == ("Utterance", "Output")
    assert schema.resolve_loose(["a", "b", "c"]) == ("a", "c")
    found = schema.resolve_explore(["a", "b", "label"])
    assert found == {"category": "label", "text": "a", "response": "b"}
    df = spark.createDataFrame([(1, "q", "a", "c")], "id int, question string, reply string, category string")
    assert schema.standardize(df).columns == ["instruction", "response", "category"]
    assert schema.standardize(df, carry=["id"]).columns[0] == "id"
    with pytest.raises(ValueError):
        schema.standardize(df.drop("reply"))


KEYS = st.sampled_from(["a", "b", "c", None])


@FEW
@given(st.lists(st.tuples(KEYS, KEYS), max_size=40), st.integers(1, 5))
def test_keep_first(spark, rows, partitions):
    df = pair_table(spark, rows).repartition(partitions)
    first = {}
    for i, r in enumerate(rows):
        first.setdefault(r, i)
    once = dedup.keep_first(df, order=["id"])
    assert ids(once) == sorted(first.values())
    assert ids(dedup.keep_first(once, order=["id"])) == ids(once)
    row = dedup.duplicate_count(df, ["instruction", "response"]).first()
    assert (row.n_rows, row.n_distinct) == (len(rows), len(first))
    assert row.n_duplicates == len(rows) - len(first)


def test_digest_tells_rows_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), ("", None), (None, ""), ("1:a", "b"), ("1", ":ab"), (None, None)]
    df = pair_table(spark, rows).select(dedup.row_digest(["instruction", "response"], T.StructType.fromDDL("instruction string, response string")).alias("d"))
    assert df.distinct().count() == len(rows)


def test_keep_first_limits_groups_before_the_shuffle(spark):
    plan = dedup.keep_first(pair_table(spark, [("a", "b")]), order=["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def raw_then_clean(spark, rows):
    """The same job with both deduplications, step by step."""
    df = dedup.keep_first(pair_table(spark, rows), order=["id"])
    df = filters.drop_empty(preprocess.clean_columns(df))
    return dedup.keep_first(filters.within_words(df), order=["id"])


@FEW
@given(st.lists(st.tuples(*[st.sampled_from(["a b", "a  b", "<i>a b", "", "x", "~", "c d", None])] * 2), max_size=40))
def test_one_deduplication_is_enough(spark, rows):
    df = pair_table(spark, rows)
    mine = preprocess.preprocess_core(df, order=["id"])
    assert sorted(mine.collect()) == sorted(raw_then_clean(spark, rows).collect())
    funnel = {r.stage: r.n_rows for r in preprocess.funnel_core(df).collect()}
    assert funnel["raw"] == len(rows) and funnel["distinct"] == len(set(rows))
    assert funnel["final"] == mine.count()


SIZES = [(1, (0, 0, 1), None), (5, (4, 0, 1), (4, 0, 1)), (9, (7, 0, 2), (7, 1, 1)), (10, (8, 1, 1), (8, 1, 1)),
         (20, (16, 2, 2), (16, 2, 2)), (500, (400, 50, 50), (400, 50, 50)), (1001, (800, 100, 101), (800, 100, 101))]


@pytest.mark.parametrize("n,floor,ceil", SIZES)
def test_split_sizes(spark, n, floor, ceil):
    for split, wanted in ((sampling.split_floor, floor), (sampling.split_ceil, ceil)):
        if wanted is None:
            continue
        got = Counter(r.split for r in split(spark.range(n), "id").collect())
        assert tuple(got[s] for s in ("train", "val", "test")) == wanted


def test_split_does_not_depend_on_layout_and_follows_the_order(spark):
    df = spark.range(300)
    one = {r.id: r.split for r in sampling.split_floor(df.coalesce(1), "id").collect()}
    many = {r.id: r.split for r in sampling.split_floor(df.repartition(7), "id").collect()}
    ranks = {r.id: r["rank"] for r in sampling.shuffle_positions(df, "id").collect()}
    assert one == many and sorted(ranks.values()) == list(range(300))
    assert {i for i, s in one.items() if s == "train"} == {i for i, r in ranks.items() if r < 240}
    ordered = [r.id for r in sampling.shuffled(df, "id").collect()]
    assert ordered == sorted(ranks, key=ranks.get)


def test_split_moves_no_rows(spark):
    df = spark.range(100).withColumn("text", F.lit("x"))
    plan = sampling.split_floor(df, "id")._jdf.queryExecution().executedPlan()
    main = plan.toString().split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


@pytest.mark.parametrize("k,n,wanted", [(0, 10, 0), (3, 10, 3), (10, 10, 10), (50, 10, 10), (5, 0, 0)])
def test_sample_sizes(spark, k, n, wanted):
    got = sampling.sample_exact(spark.range(n), k, "id").collect()
    assert len(got) == wanted == len(set(got))
    assert sorted(got) == sorted(sampling.sample_exact(spark.range(n).repartition(3), k, "id").collect())


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(99).select((F.col("id") % 3).alias("id"))
    per_key = sampling.split_floor(df, "id").groupBy("id").agg(F.count_distinct("split").alias("n"))
    assert [r.n for r in per_key.collect()] == [1, 1, 1]


def test_leaks(spark):
    rows = [("train", "a"), ("test", "a"), ("val", "b"), ("val", "b")]
    row = sampling.split_leaks(spark.createDataFrame(rows, "split string, t string"), ["t"]).first()
    assert (row.shared_values, row.rows_involved) == (1, 2)


NUMBERS = st.one_of(st.integers(-5, 5).map(float), st.floats(-1e9, 1e9), st.just(7.0), st.none())


@FEW
@given(st.lists(NUMBERS, min_size=1, max_size=80))
def test_describe_matches_plain_statistics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = profile.describe_numeric(df, ["x"]).first()
    seen = sorted(v for v in values if v is not None)
    assert row["count"] == len(seen)
    if not seen:
        assert row.q50 is None and row["mean"] is None
        return
    for p, got in ((0.25, row.q25), (0.5, row.q50), (0.75, row.q75)):
        at = (len(seen) - 1) * p
        low, high = seen[int(at)], seen[min(int(at) + 1, len(seen) - 1)]
        assert got == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-9, abs=1e-9)
    assert row["mean"] == pytest.approx(statistics.fmean(seen), rel=1e-9, abs=1e-6)
    assert (row["min"], row["max"]) == (seen[0], seen[-1])


def test_quantiles_of_a_lopsided_column(spark):
    # two thirds of the rows share a value and one outlier stretches the range
    df = spark.range(9000).select(
        F.when(F.col("id") < 6000, 1.0).when(F.col("id") == 8999, 1e12).otherwise(F.col("id") / 7).alias("x")
    )
    row = profile.describe_numeric(df, ["x"]).first()
    assert (row.q25, row.q50) == (1.0, 1.0)
    assert row.q75 == pytest.approx((6749 + 0.25) / 7)
    assert ranking.CELLS ** len(ranking.REFINEMENTS) > 9000


def test_histogram(spark):
    df = spark.range(81).select((F.col("id") / 2).alias("x"))
    rows = profile.histogram(df, "x").orderBy("bin").collect()
    assert [r.n for r in rows] == [2] * 39 + [3] and rows[0].left_edge == 0 and rows[-1].right_edge == 40
    flat = profile.histogram(spark.range(5).select(F.lit(3).alias("x")), "x").collect()
    assert sum(r.n for r in flat) == 5 and len(flat) == 40


def test_profile_text_and_terms(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", None), ("b", None), (None, None)], "t string, u string")
    rows = {r.name: r for r in profile.describe_text(df, ["t", "u"]).collect()}
    assert (rows["t"]["count"], rows["t"].unique, rows["t"].top, rows["t"].freq) == (4, 2, "a", 2)
    assert (rows["u"]["count"], rows["u"].unique, rows["u"].top) == (0, 0, None)
    texts = spark.createDataFrame([("The cat's hat 42 cat", "CAT the")], "a string, b string")
    assert [tuple(r) for r in profile.term_counts(texts, ["a", "b"], 200, ["the"]).collect()] == [
        ("cat", 2), ("cat's", 1), ("hat", 1)]
    assert "the" in profile.default_stop_words()


@pytest.mark.parametrize("weight", [None, "n"])
def test_lookup_join(spark, weight):
    facts = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    lookup = spark.createDataFrame([("hot", 1000), ("k1", 2), ("k499", 3), ("zz", 9)], "k string, n int")
    mine = joins.lookup_join(facts, lookup, ["k"], weight=weight, share=0.1)
    plain = facts.join(lookup, ["k"], "left")
    assert sorted(map(str, mine.select("id", "k", "n").collect())) == sorted(map(str, plain.select("id", "k", "n").collect()))


def test_unknown_style(spark):
    with pytest.raises(ValueError):
        preprocess.add_text(pair_table(spark, [("a", "b")]), style="other")


def test_nested_values_are_told_apart(spark):
    df = spark.createDataFrame([(["a, b"],), (["a", "b"],), (["a", "b"],), (None,)], "m array<string>")
    got = dedup.duplicate_count(df).first()
    assert (got.n_rows, got.n_distinct, got.n_duplicates) == (4, 3, 1)


def test_nan_is_missing_in_profiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert profile.null_counts(df).first().nulls == 2
    stats = profile.describe_numeric(df, ["x"]).first()
    assert (stats["count"], stats["mean"], stats["q75"], stats["max"]) == (2, 1.5, 1.75, 2.0)
    bins = profile.histogram(df, "x", bins=2).orderBy("bin").collect()
    assert [b.n for b in bins] == [1, 1] and bins[0].left_edge == 1.0


def test_profile_of_all_types(spark):
    df = spark.sql("select true as b, date'2020-01-02' as d, array(1, 2) as a, cast(null as timestamp) as t, 3 as n")
    got = {r.name: (r["count"], r.top) for r in profile.describe(df).collect()}
    assert got == {"b": (1, "true"), "d": (1, "2020-01-02"), "a": (1, "[1,2]"), "t": (0, None), "n": (1, None)}


@pytest.mark.parametrize("spread", ["exp(id / 100 - 500)", "id", "if(id = 0, 1e300, id)", "if(id < 10, double('infinity'), -exp(id / 1000))"])
def test_quantiles_leave_little_to_order(spark, spread):
    counts = spark.range(100_000).selectExpr("'x' as name", f"double({spread}) as value", "1L as weight")
    bounds = counts.groupBy("name").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("weight").alias("total"))
    targets = bounds.select("name", F.lit(0.5).alias("prob"), F.lit(50_000).alias("rank"), F.lit(50_000).alias("local"), "low", "high")
    for scale in ranking.REFINEMENTS:
        targets = ranking._refine(counts, targets, ["name", "prob", "rank"], scale)
    assert ranking._inside(counts, targets).count() <= 100
    got = ranking.exact_quantiles(counts, bounds, (0.5,)).first()
    ordered = sorted(r.value for r in counts.collect())
    assert got.q50 == pytest.approx(statistics.median(ordered), rel=1e-12)


def test_duplicate_exchanges_read_whole_texts(spark, tmp_path):
    """Replies that start alike, or whose texts only join alike, are no duplicates."""
    import __spark_entry__ as entry

    said = [("hello", "yes, at once"), ("hello", "yes, later"), ("hello", "yes, at once"), ("hello yes", ", at once"), ("help", "yes, at once")]
    turns = [(i, t, r, x) for i, (a, b) in enumerate(said) for t, (r, x) in enumerate([("user", a), ("assistant", b)])]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = entry.queries()["duplicate_exchanges"](spark, str(tmp_path)).first()
    assert (got.n_rows, got.n_distinct, got.n_duplicates) == (5, 4, 1)


@pytest.mark.parametrize("spread", ["exp(id / 100 - 500)", "id", "if(id = 0, 1e300, id)", "if(id < 10, double('infinity'), -exp(id / 1000))", "id % 3 - 1", "0.0", "if(id % 3 = 0, -0.0, 0.0)"])
def test_radix_quantiles(spark, spread):
    values = spark.range(0, 20_000, 1, 8).selectExpr("'x' as name", f"double({spread}) as value")
    bounds = values.groupBy("name").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("total"))
    got = ranking.radix_quantiles(values, bounds, (0.0, 0.1, 0.5, 0.9, 1.0)).first()
    ordered = sorted(r.value for r in values.collect())
    for p, q in ((0.0, got.q0), (0.1, got.q10), (0.5, got.q50), (0.9, got.q90), (1.0, got.q100)):
        at = (len(ordered) - 1) * p
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        assert q == (low if low == high else pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12))


def test_image_orders_like_the_numbers(spark):
    inf = float("inf")
    numbers = [-inf, -1e300, -2.0, -1.0000000000000002, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, inf]
    df = spark.createDataFrame([(v,) for v in [*numbers, -0.0]], "v double").select("v", ranking.ordered_image(F.col("v")).alias("i"))
    images = {str(r.v): r.i for r in df.collect()}
    assert [images[str(v)] for v in numbers] == sorted(images[str(v)] for v in numbers) and len(set(images.values())) == len(numbers)
    assert images["-0.0"] == images["0.0"]


def test_only_counters_are_shuffled(spark):
    """100,000 distinct values in 8 tasks send a row per counter and task at most."""
    values = spark.range(0, 100_000, 1, 8).selectExpr("'x' as name", "id / 7 + 1000 as value")
    spans = spark.createDataFrame([("x", 1000.0, 20000.0)], "name string, low double, high double")
    counts = ranking.radix_counts(values, spans, 0)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(name")
    assert "partial_count" in plan[exchange:] and plan.count("Exchange hashpartitioning") == 1
    rows = counts.collect()
    assert sum(r["size"] for r in rows) == 100_000 and len(rows) <= 80  # 16 steps to a doubling
    per_task = values.groupBy(F.spark_partition_id(), ranking._digit(F.col("value"), 0)).count()
    assert per_task.count() <= 8 * 80


def test_column_map_standardises_a_table(spark, tmp_path):
    from deskcorpus.sources import readers, writers

    df = spark.createDataFrame([(1, None, "a", "c"), (2, "q", None, None)], "id int, `my question` string, a string, category string")
    writers.write_column_map(spark, "my question", "a", f"{tmp_path}/m")
    names = readers.read_column_map(spark, f"{tmp_path}/m")
    got = schema.standardize_mapped(df, names, carry=["id"])
    assert got.columns == ["id", "instruction", "response", "category"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, None, "a", "c"), (2, "q", None, None)]
    with pytest.raises(ValueError, match="my question"):
        schema.standardize_mapped(df.drop("my question"), names)
