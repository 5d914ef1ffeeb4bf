"""Registered queries: every operator on the driver's tables, each over whole tables.

Adapters: reply pairs come from ``conversations``; ``document_pairs`` reads each
document as a response; row ids are the table keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskcorpus.functions import prompts as P
from deskcorpus.functions import text as X
from deskcorpus.functions import tokens as K
from deskcorpus.operators import dedup, evaluate, filters, guardrail, phrases, profile, sampling, schema
from deskcorpus.operators.backoff import backoff_losses
from deskcorpus.operators.generate import Generation, generate_replies
from deskcorpus.operators.loss import bigram_losses
from deskcorpus.operators.packing import pack
from deskcorpus.plans import corpus, evaluation, preprocess
from deskcorpus.sources import csv_ranges, readers, writers
from deskcorpus.stages import evaluate_once, materialize, scratch_dir
from deskcorpus.streaming import dedup as stream_dedup
from deskcorpus.streaming import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STOP_WORDS = ("the", "of", "and", "to", "in", "is", "la", "de", "der", "die", "und", "que")
DATA_KEYWORDS = ("hand", "stone", "ender", "thing", "des")
PART_TYPES = ("ECONOMY", "SMALL")
CSV_RANGE = 1 << 20


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.reply_pairs(table(spark, sf_dir, "conversations"))


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("Document in "), "lang").alias("instruction"),
        F.col("text").alias("response"),
        F.col("source").alias("category"),
    )


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply pairs with the instruction standing in for a prediction."""
    return pairs(spark, sf_dir).withColumn("prediction", F.col("instruction"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


def counting_model():
    """A deterministic stand-in for a model: it repeats the prompt and counts it."""

    def predict(prompts, **_):
        return [f"{p} This message has {len(p)} characters. " for p in prompts]

    return predict


MODEL = Generation(factory=counting_model)

# --- whole jobs ---------------------------------------------------------------


@query
def flagship_split_summary(spark, sf_dir):
    return corpus.split_summary(corpus.training_corpus(pairs(spark, sf_dir)))


@query
def preprocess_core(spark, sf_dir):
    return preprocess.preprocess_core(document_pairs(spark, sf_dir), order=["doc_id"])


@query
def preprocess_core_pairs(spark, sf_dir):
    return preprocess.preprocess_core(pairs(spark, sf_dir), ["pair_id"], low=2, high=400)


@query
def preprocess_ascii(spark, sf_dir):
    split = sampling.split_floor(document_pairs(spark, sf_dir), "doc_id")
    return preprocess.preprocess_ascii(split, order=["doc_id"])


@query
def preprocess_minimal(spark, sf_dir):
    return preprocess.preprocess_minimal(document_pairs(spark, sf_dir), order=["doc_id"])


@query
def preprocess_funnel(spark, sf_dir):
    return preprocess.funnel_core(document_pairs(spark, sf_dir))


@query
def postconditions(spark, sf_dir):
    return filters.violations(document_pairs(spark, sf_dir))


@query
def split_leak_report(spark, sf_dir):
    split = sampling.split_floor(document_pairs(spark, sf_dir), "doc_id")
    return sampling.split_leaks(preprocess.clean_columns(split, "ascii"), schema.PAIR)


# --- cleaning -----------------------------------------------------------------


@query
def clean_core_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", X.clean_core(F.col("html")).alias("cleaned")
    )


@query
def clean_ascii_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", X.clean_ascii(F.col("html")).alias("cleaned")
    )


@query
def clean_core_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.clean_core(F.col("text"), lowercase=True).alias("cleaned")
    )


@query
def clean_ascii_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.clean_ascii(F.col("text"), lowercase=False).alias("cleaned")
    )


@query
def clean_steps(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        X.strip_tags(html).alias("no_tags"),
        X.strip_urls(html).alias("no_urls"),
        X.drop_nonprintable(X.nfkc(html)).alias("visible"),
        X.squeeze(html).alias("squeezed"),
        X.decode_markup(html).alias("decoded"),
    )


@query
def noise_no_punct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        X.drop_noise(F.col("text"), keep_punct=False).alias("bare"),
        X.drop_noise(F.col("text")).alias("punctuated"),
    )


@query
def word_and_char_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        X.word_count(F.col("text")).alias("n_words"),
        X.char_count(F.col("text")).alias("n_code_points"),
    )


# --- schema -------------------------------------------------------------------


@query
def standardize_alias(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select(
        "doc_id",
        "n_chars",
        F.col("source").alias("reply"),
        "text",
        F.col("lang").alias("category"),
    )
    return schema.standardize(raw, carry=["doc_id"])


@query
def resolve_loose(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").withColumnRenamed("text", "Text")
    text, response = schema.resolve_loose(raw.columns)
    return schema.keep_columns(raw, ["doc_id", text, response, "absent"])


@query
def resolve_explore(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select("text", "source", F.col("lang").alias("topic"))
    found = schema.resolve_explore(raw.columns)
    return raw.select(
        F.col(found["category"]).alias("category"),
        X.word_count(F.col(found["text"])).alias("text_words"),
        X.word_count(F.col(found["response"])).alias("response_words"),
    )


# --- filters ------------------------------------------------------------------


@query
def drop_empty_and_bounds(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = filters.within_words(filters.drop_empty(docs, ["text"]), ["text"])
    return kept.select("doc_id", X.word_count(F.col("text")).alias("n_words"))


@query
def noise_predicate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", filters.is_noisy(F.col("source"), F.col("text")).alias("noisy")
    )


@query
def category_whitelist(spark, sf_dir):
    kept = filters.category_whitelist(table(spark, sf_dir, "part"), "p_type", PART_TYPES)
    return kept.select("p_partkey", "p_type")


@query
def category_whitelist_fallback(spark, sf_dir):
    kept = filters.category_whitelist(table(spark, sf_dir, "part"), "p_type")
    return kept.select("p_partkey", "p_type")


@query
def dropna_subset(spark, sf_dir):
    kept = filters.drop_nulls(labelled(spark, sf_dir), ["quality", "toxic"])
    return kept.select("doc_id", "quality", "toxic")


@query
def guardrail_flags(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("body")
    )
    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("body")
    )
    both = pages.unionByName(docs)
    return both.select("kind", "id", guardrail.on_topic(F.col("body")).alias("on_topic"))


@query
def guardrail_keywords(spark, sf_dir):
    body = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        guardrail.on_topic(body, DATA_KEYWORDS).alias("whole_word"),
        guardrail.on_topic(body, DATA_KEYWORDS, match="prefix").alias("prefix"),
    )


@query
def guardrail_phrases(spark, sf_dir):
    """Where single keywords and three-word phrases of the benchmark stand in documents."""
    words = phrases.phrase_words(F.col("text"))
    items = evaluate_once(table(spark, sf_dir, "benchmark").select("text"), {"w": words})
    three = items.select(F.explode(K.ngrams(F.col("w"), 3)).alias("phrase")).distinct()
    single = spark.createDataFrame([(w,) for w in DATA_KEYWORDS], "phrase string")
    docs = table(spark, sf_dir, "documents")
    return phrases.find_phrases(docs, "doc_id", "text", three.unionByName(single))


@query
def guardrail_routed(spark, sf_dir):
    routed = guardrail.route_replies(
        pairs(spark, sf_dir), "instruction", MODEL, keywords=DATA_KEYWORDS
    )
    return routed.select("pair_id", "on_topic", "reply")


# --- deduplication ------------------------------------------------------------


@query
def dedup_keep_first(spark, sf_dir):
    return dedup.keep_first(table(spark, sf_dir, "documents"), ["text"], ["doc_id"])


@query
def duplicate_counts(spark, sf_dir):
    return dedup.duplicate_count(table(spark, sf_dir, "documents"), ["text", "lang"])


@query
def duplicate_rows(spark, sf_dir):
    return dedup.duplicate_count(table(spark, sf_dir, "documents").drop("doc_id"))


@query
def duplicate_exchanges(spark, sf_dir):
    """Duplicates among exchanges, arrays of a turn and its reply with their whole texts."""
    asked, replied = (
        F.struct(F.lit(role).alias("role"), F.col(text).alias("content"))
        for role, text in (("user", "instruction"), ("assistant", "response"))
    )
    return dedup.duplicate_count(
        pairs(spark, sf_dir).select(F.array(asked, replied).alias("messages"))
    )


# --- profiling ----------------------------------------------------------------


@query
def profile_nulls(spark, sf_dir):
    return profile.null_counts(labelled(spark, sf_dir))


@query
def profile_mixed(spark, sf_dir):
    out = profile.describe(table(spark, sf_dir, "customer"))
    return rounded(out, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def profile_events(spark, sf_dir):
    """All columns, of any type."""
    out = profile.describe(table(spark, sf_dir, "events"))
    return rounded(out, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def profile_nan(spark, sf_dir):
    """A column with NaN, which counts as missing."""
    ratio = F.when(F.col("l_discount") > 0, F.col("l_extendedprice") / F.col("l_discount"))
    rows = table(spark, sf_dir, "lineitem").select(F.coalesce(ratio, F.lit(float("nan"))).alias("ratio"))
    out = profile.describe_numeric(rows, ["ratio"])
    return rounded(out, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def profile_text(spark, sf_dir):
    return profile.describe_text(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query
def describe_lengths(spark, sf_dir):
    lengths = table(spark, sf_dir, "documents").select(
        F.length("text").alias("chars"),
        X.word_count(F.col("text")).alias("words"),
        K.token_length(X.joined(F.col("source"), F.col("text"))).alias("tokens"),
    )
    out = profile.describe_numeric(lengths, lengths.columns)
    return rounded(out, "mean", "std", "q25", "q50", "q75")


@query
def describe_numeric(spark, sf_dir):
    out = profile.describe_numeric(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    )
    return rounded(out, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


@query
def value_counts_labels(spark, sf_dir):
    return profile.value_counts(labelled(spark, sf_dir), "quality")


@query
def histogram_40(spark, sf_dir):
    out = profile.histogram(table(spark, sf_dir, "documents"), "n_chars")
    return rounded(out, "left_edge", "right_edge")


@query
def histogram_prices(spark, sf_dir):
    out = profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.select("bin", "n")


@query
def pct_over_limit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = profile.percent_over(docs, K.token_length(F.col("text")), 512)
    return rounded(out, "pct_over")


@query
def top_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return profile.term_counts(docs, ["source", "text"], top=200, stop_words=STOP_WORDS)


@query
def frequent_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return profile.frequent_terms(docs, ["source", "text"], top=200, stop_words=STOP_WORDS)


@query
def value_counts_all(spark, sf_dir):
    """All columns of few values of two tables, each in one scan."""
    orders = table(spark, sf_dir, "orders")
    docs = labelled(spark, sf_dir)
    return profile.value_counts_all(orders, ["o_orderstatus", "o_orderpriority"]).unionByName(
        profile.value_counts_all(docs, ["lang", "source", "quality", "toxic"])
    )


# --- sampling and splits ------------------------------------------------------


@query
def sample_k(spark, sf_dir):
    return sampling.sample_exact(table(spark, sf_dir, "documents"), 100, "doc_id")


@query
def cap_k(spark, sf_dir):
    return sampling.cap_rows(table(spark, sf_dir, "orders"), "o_orderkey", limit=6000).select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@query
def shuffle_order(spark, sf_dir):
    ranked = sampling.shuffle_positions(table(spark, sf_dir, "documents"), "doc_id")
    return ranked.select("doc_id", "rank")


@query
def head_k(spark, sf_dir):
    return sampling.head(table(spark, sf_dir, "documents"), 10, "doc_id").select("doc_id", "lang")


@query
def split_floor(spark, sf_dir):
    return sampling.split_floor(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "split"
    )


@query
def split_ceil(spark, sf_dir):
    return sampling.split_ceil(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "split"
    )


@query
def split_approx(spark, sf_dir):
    return sampling.split_approx(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "split"
    )


@query
def split_sizes(spark, sf_dir):
    return sampling.split_sizes(
        sampling.split_floor(table(spark, sf_dir, "orders"), "o_orderkey")
    )


# --- prompts ------------------------------------------------------------------


@query
def prompt_core(spark, sf_dir):
    return preprocess.add_text(pairs(spark, sf_dir)).select("pair_id", "text")


@query
def prompt_unstripped(spark, sf_dir):
    return preprocess.add_text(pairs(spark, sf_dir), stripped=False).select("pair_id", "text")


@query
def prompt_only(spark, sf_dir):
    return pairs(spark, sf_dir).select(
        "pair_id",
        P.prompt_only(F.col("instruction")).alias("core"),
        P.prompt_only_minimal(F.col("instruction")).alias("minimal"),
    )


@query
def prompt_minimal(spark, sf_dir):
    i, r = F.col("instruction"), F.col("response")
    return pairs(spark, sf_dir).select("pair_id", P.training_prompt_minimal(i, r).alias("text"))


@query
def messages(spark, sf_dir):
    chat = preprocess.add_text(pairs(spark, sf_dir), style="chat")
    return chat.select("pair_id", F.posexplode("messages").alias("position", "message")).select(
        "pair_id", "position", "message.role", "message.content"
    )


@query
def messages_open(spark, sf_dir):
    docs = labelled(spark, sf_dir)
    reply = F.when(F.col("quality") == 1, F.col("source"))
    chat = docs.select("doc_id", P.chat_messages(F.col("text"), reply).alias("messages"))
    return chat.select(
        "doc_id", F.size("messages").alias("n"), F.expr("messages[1].content").alias("user")
    )


@query
def history_display(spark, sf_dir):
    """Whole histories, an ordered array of turns each, shown as message records."""
    whole = corpus.histories(table(spark, sf_dir, "conversations"))
    shown = whole.select("conv_id", P.history_messages(F.col("history")).alias("shown"))
    return shown.select("conv_id", F.posexplode("shown").alias("position", "message")).select(
        "conv_id", "position", "message.role", "message.content"
    )


@query
def extract_response(spark, sf_dir):
    i, r = F.col("instruction"), F.col("response")
    whole = P.training_prompt(i, r)
    noisy = F.concat(F.lit("so: "), whole, F.lit("\n### Response:\n again "), i)
    return pairs(spark, sf_dir).select(
        "pair_id",
        P.extract_reply(whole, P.prompt_only(i)).alias("led"),
        P.extract_reply(noisy, P.prompt_only(i)).alias("marked"),
        P.extract_reply(r, P.prompt_only(i)).alias("plain"),
        P.extract_reply(noisy, minimal=True).alias("minimal"),
    )


@query
def context_prefix(spark, sf_dir):
    conversation = F.split("pair_id", ":")[0].cast("bigint")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = pairs(spark, sf_dir).withColumn("doc_id", conversation).join(docs, "doc_id", "left")
    return joined.select(
        "pair_id", P.with_context(F.col("instruction"), F.col("text")).alias("message")
    )


@query
def context_truncate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", P.context_text(F.array("lang", "text", "source")).alias("context")
    )


# --- tokens -------------------------------------------------------------------


@query
def token_lengths(spark, sf_dir):
    corpus_text = preprocess.add_text(pairs(spark, sf_dir))
    return corpus_text.select("pair_id", K.token_length(F.col("text")).alias("token_length"))


@query
def caller_tokens(spark, sf_dir):
    """A caller's own tokeniser in place of the word one."""
    docs = table(spark, sf_dir, "documents")
    count = K.tokenizer_udf(lambda: lambda text: text.split(" "))
    return docs.select("doc_id", count("text").alias("n_tokens"))


@query
def order_status(spark, sf_dir):
    """A template filled from given columns."""
    template = F.concat(F.lit("Order {oid}: "), "o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", X.fill(template, F.col("o_orderkey")).alias("message")
    )


@query
def truncate_tokens(spark, sf_dir):
    kept = K.truncate(K.tokens(F.col("text")), 512)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(kept).alias("n_tokens"), F.array_join(kept, " ").alias("kept")
    )


def _packed(spark, sf_dir, **options) -> DataFrame:
    blocks = pack(table(spark, sf_dir, "documents"), "doc_id", "text", **options)
    return blocks.select(
        "shard", "block", "n_tokens", F.array_join("tokens", " ").alias("packed")
    )


@query
def pack_sequences(spark, sf_dir):
    return _packed(spark, sf_dir, length=512, shards=16)


@query
def pack_full_blocks(spark, sf_dir):
    return _packed(spark, sf_dir, length=2048, shards=4, keep_tail=False)


# --- generation and evaluation --------------------------------------------------


@query
def generate_reply(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return generate_replies(docs, "text", MODEL).select("doc_id", "prediction")


@query
def rouge_per_pair(spark, sf_dir):
    out = evaluate.rouge_per_row(scored_pairs(spark, sf_dir))
    return rounded(out.select("pair_id", "rouge1", "rouge2", "rougeL"), "rouge1", "rouge2", "rougeL")


@query
def rouge_summary(spark, sf_dir):
    """Documents against their own lines in another order: the first line moved to the end."""
    first = F.regexp_extract("text", r"^[^\n]*", 0)
    rest = F.regexp_replace("text", r"^[^\n]*\n?", "")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("response"), F.concat_ws("\n", rest, first).alias("prediction")
    )
    out = evaluate.rouge_summary_per_row(docs)
    return rounded(out.select("doc_id", "rougeLsum"), "rougeLsum")


@query
def rouge_summary_pairs(spark, sf_dir):
    out = evaluate.rouge_summary_per_row(scored_pairs(spark, sf_dir))
    return rounded(out.select("pair_id", "rougeLsum"), "rougeLsum")


@query
def rouge_corpus(spark, sf_dir):
    out = evaluate.rouge(scored_pairs(spark, sf_dir))
    return rounded(out, "rouge1", "rouge2", "rougeL")


@query
def bleu_corpus(spark, sf_dir):
    return rounded(evaluate.bleu(scored_pairs(spark, sf_dir)), "bleu")


@query
def bleu_counts(spark, sf_dir):
    out = evaluate.bleu_per_row(scored_pairs(spark, sf_dir))
    names = [f"_{kind}{n}" for n in (1, 2, 3, 4) for kind in ("hits", "total")]
    names += ["_sys_len", "_ref_len"]
    return out.select("pair_id", *[F.col(n).alias(n[1:]) for n in names])


@query
def comparison_table(spark, sf_dir):
    base = pairs(spark, sf_dir)
    predictions = base.select("pair_id", F.concat(F.lit("Re: "), "instruction").alias("prediction"))
    joined = evaluate.attach_predictions(base, predictions, "pair_id")
    return evaluate.comparison_table(joined, carry=("pair_id",))


@query
def missing_predictions(spark, sf_dir):
    base = pairs(spark, sf_dir)
    some = base.where(F.length("instruction") % 2 == 0)
    predictions = some.select("pair_id", F.col("instruction").alias("prediction"))
    joined = evaluate.attach_predictions(base, predictions, "pair_id")
    return evaluate.comparison_table(joined, carry=("pair_id",))


@query
def eval_report(spark, sf_dir):
    losses = table(spark, sf_dir, "events").select((F.col("value") / 100).alias("loss"))
    out = evaluate.full_report(scored_pairs(spark, sf_dir), losses)
    return rounded(out, "rouge1", "rouge2", "rougeL", "bleu", "perplexity")


@query
def eval_job(spark, sf_dir):
    test = sampling.split_floor(pairs(spark, sf_dir), "pair_id").where("split = 'test'")
    out = evaluation.evaluate_model(materialize(test), MODEL, "pair_id")
    return rounded(out, "rouge1", "rouge2", "rougeL", "bleu")


@query
def perplexity(spark, sf_dir):
    losses = table(spark, sf_dir, "events").select((F.col("value") / 100).alias("loss"))
    return rounded(evaluate.perplexity(losses), "perplexity")


@query
def bigram_loss(spark, sf_dir):
    split = sampling.split_approx(table(spark, sf_dir, "documents"), "doc_id")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    return rounded(bigram_losses(train, test, "doc_id", "text"), "loss")


@query
def backoff_loss(spark, sf_dir):
    split = sampling.split_approx(table(spark, sf_dir, "documents"), "doc_id")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    return rounded(backoff_losses(train, test, "doc_id", "text", order=3), "loss")


@query
def loss_curves(spark, sf_dir):
    train_row: Column = F.col("event_type") != "view"
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("step"),
        F.when(train_row, F.col("value")).alias("loss"),
        F.when(~train_row, F.col("value")).alias("eval_loss"),
    )
    return evaluate.loss_curves(log)


# --- sources and sinks ----------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_dir(spark)
    writers.write_csv(docs, path)
    return readers.read_csv(spark, path, docs.schema)


@query
def csv_ranges_roundtrip(spark, sf_dir):
    """One file of multi-line cells, read in many byte ranges."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_dir(spark)
    writers.write_csv(docs, path)
    return csv_ranges.read_csv_ranges(spark, path, docs.schema, range_bytes=CSV_RANGE)


@query
def jsonl_roundtrip(spark, sf_dir):
    docs = labelled(spark, sf_dir)
    path = scratch_dir(spark)
    writers.write_jsonl(docs, path)
    return readers.read_jsonl(spark, path, docs.schema)


@query
def split_roundtrip(spark, sf_dir):
    split = sampling.split_floor(table(spark, sf_dir, "documents"), "doc_id")
    path = scratch_dir(spark)
    writers.write_splits(split, path)
    return readers.read_splits(spark, path, split.schema)


@query
def training_export(spark, sf_dir):
    split = sampling.split_ceil(pairs(spark, sf_dir), "pair_id")
    path = scratch_dir(spark)
    writers.write_training_export(preprocess.add_text(split), path)
    return spark.read.parquet(path).select("split", "text")


@query
def raw_copy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_dir(spark)
    writers.write_raw_copy(docs, path)
    return readers.read_csv(spark, path, docs.schema)


@query
def column_map(spark, sf_dir):
    """Columns found by their aliases, written as a map, and the whole table standardised
    through the map that is read back."""
    raw = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("topic"), F.col("text").alias("question"), F.col("source").alias("reply")
    )
    path = scratch_dir(spark)
    writers.write_column_map(
        spark,
        schema.resolve(raw.columns, schema.INSTRUCTION_ALIASES),
        schema.resolve(raw.columns, schema.RESPONSE_ALIASES),
        path,
    )
    return schema.standardize_mapped(raw, readers.read_column_map(spark, path), carry=["doc_id"])


@query
def metrics_sink(spark, sf_dir):
    path = scratch_dir(spark)
    writers.write_metrics(evaluate.full_report(scored_pairs(spark, sf_dir)), path)
    kinds = "rouge1 double, rouge2 double, rougeL double, bleu double, perplexity double, n_eval_samples long"
    return rounded(spark.read.schema(kinds).json(path), "rouge1", "rouge2", "rougeL", "bleu")


@query
def published_source(spark, sf_dir):
    path = scratch_dir(spark)
    table(spark, sf_dir, "documents").write.parquet(f"{path}/train")
    return readers.read_published(spark, path)


@query
def fallback_source(spark, sf_dir):
    missing = f"{scratch_dir(spark)}/absent"
    return readers.read_or_else(
        lambda: readers.read_published(spark, missing),
        lambda: table(spark, sf_dir, "documents"),
    )


@query
def preview_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_dir(spark)
    writers.write_preview(docs, path, "doc_id", k=50)
    return readers.read_csv(spark, path, docs.schema)


def document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table as a file stream, be it one file or a folder of files. A
    stream takes a single file for a folder unless its path is a pattern."""
    docs_schema = T.StructType.fromDDL(
        "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    return spark.readStream.schema(docs_schema).parquet(f"{sf_dir}/documents[.]parquet")


@query
def stream_keep_first(spark, sf_dir):
    """The first document of every text, found by keyed state."""
    kept = stream_dedup.keep_first_stream(document_stream(spark, sf_dir), ["text"], ["doc_id"])
    path = scratch_dir(spark)
    prepare.start_sink(kept, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{path}/out")


@query
def stream_prepared(spark, sf_dir):
    """The stateless steps run as a file stream over the whole documents table."""
    stream = document_stream(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit("Document in "), "lang").alias("instruction"),
        F.col("text").alias("response"),
    )
    prepared = prepare.prepare_pairs(stream, "doc_id").select("doc_id", "text", "split")
    path = scratch_dir(spark)
    prepare.start_sink(prepared, f"{path}/out", f"{path}/offsets").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("doc_id", "text", "split")
