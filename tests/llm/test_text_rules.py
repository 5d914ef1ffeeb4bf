import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from deskcorpus.llm import licenses, mixing, quality
from deskcorpus.llm.license_rules import BASE_PHRASES, Rule, build, gates
from helpers import WORD, frame, lower

TEXTS = [
    None, "", " \t\r\n", "one", "a b c a b c a b c", "x y\nx y\n\n \nX y\nx y", "# * $ % & | < >", "\x1f\x00 é ü 日本",
    "the cat sat on the mat " * 20, "w" * 100_000, " ".join(f"{a}{b}y" for a in "abcdefgh" for b in "ijklmnop"), "a b " * 40, "1234 5678 " * 40,
]


def counts(text):
    w = WORD.findall(text or "")
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = collections.Counter(g)
    covered = {j for i, x in enumerate(g) if seen[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[4]), (4, TEXTS[4])]
    got = quality.quality_table(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        n, chars, symbols, dup, rep = counts(TEXTS[4] if r.doc_id is None else texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (r.kept and r.base_failed)
    assert {r.doc_id for r in got if r.kept} == {10}


def test_cascade_order_changes_no_verdict(spark):
    df = frame(spark, list(enumerate(TEXTS)))
    verdicts = set()
    for order in (quality.RULES, quality.RULES[::-1]):
        judged = quality.cascade(df, order=order)
        verdicts.add(frozenset(r.doc_id for r in judged.where("failed_rule is null").select("row.doc_id").collect()))
    assert len(verdicts) == 1
    assert sorted(r.name for r in quality.rule_order(df)) == sorted(r.name for r in quality.RULES)
    assert quality.rule_order(df.where("false")) == list(quality.RULES)
    assert quality.keep_good(df).columns == df.columns and quality.keep_good(df.where("false")).count() == 0


def test_cheap_rejecting_rules_come_first(spark):
    df = frame(spark, [(i, "short text") for i in range(300)])
    cheap = quality.Rule("cheap", "n_symbols = 0", ("n_symbols",))
    idle = quality.Rule("idle", "n_repeat_words > 5", ("n_repeat_words",))
    assert [r.name for r in quality.rule_order(df, [idle, cheap])] == ["cheap", "idle"]


def test_order_is_the_same_in_every_run_and_samples_all_partitions(spark):
    df = spark.range(0, 6000, 1, 12).selectExpr("id as doc_id", "concat('word ', repeat('# ', int(id % 40)), id) as text")
    picked = quality._sampled(df, "text", 500)
    texts = sorted(r._text for r in picked.collect())
    assert texts == sorted(r._text for r in quality._sampled(df, "text", 500).collect()) and 350 < len(texts) < 650
    same = spark.range(0, 6000, 1, 12).selectExpr("'copy' as text")
    assert 350 < quality._sampled(same, "text", 500).count() < 650
    tasks = {r.p for r in picked.select(F.spark_partition_id().alias("p")).collect()}
    assert len(tasks) == 12
    assert "Exchange" not in picked._jdf.queryExecution().executedPlan().toString()
    assert quality.rule_order(df) == quality.rule_order(df)


def test_one_generator_a_rule(spark):
    df = frame(spark, [(1, "a b c")])
    plan = quality.cascade(df, order=quality.RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate inline") == len(quality.RULES)
    whole = quality.quality_table(df)._jdf.queryExecution().executedPlan().toString()
    assert whole.count("Generate inline") <= 1 + len(quality.RULES)


def test_cascade_runs_no_python(spark):
    plan = quality.quality_table(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def scan(spark, texts, rules=None):
    df = frame(spark, list(enumerate(texts)))
    return {r.doc_id: r for r in licenses.scan_licenses(df, rules).collect()}


def test_license_rules_are_many_and_gated():
    rules = build()
    assert len(rules) > 300 and all(r.keyword for r in rules)
    assert len({(r.label, r.pattern) for r in rules}) == len(rules)
    words = gates(rules)
    assert all(any(g in r.keyword for g in words) for r in rules)


def example(pattern, draw):
    """A text that a rule's pattern matches, with optional parts there or not by chance."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("(?:", i):
            depth, j = 1, i + 3
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[j], 0)
                j += 1
            options, level, cut = [], 0, i + 3
            for k in range(i + 3, j):
                level += {"(": 1, ")": -1}.get(pattern[k], 0)
                if (pattern[k] == "|" and level == 0) or k == j - 1:
                    options.append(pattern[cut:k])
                    cut = k + 1
            optional = pattern[j : j + 1] == "?"
            if not (optional and draw.random() < 0.5):
                out += example(draw.choice(options), draw)
            i = j + optional
        elif pattern[i] == "[":
            j = pattern.index("]", i)
            optional = pattern[j + 1 : j + 2] == "?"
            out += "" if optional and draw.random() < 0.5 else draw.choice(pattern[i + 1 : j])
            i = j + 1 + optional
        elif pattern.startswith(".{", i):
            out += "some body"
            i = pattern.index("}", i) + 2
        else:
            optional = pattern[i + 1 : i + 2] == "?"
            out += "" if optional and draw.random() < 0.5 else pattern[i]
            i += 1 + optional
    return out


def by_brute_force(text, rules):
    """Spans and labels of a text by all rules, none of them gated, each against each."""
    words = " ".join(licenses.WORDS.findall(text))
    found = []
    for k, r in enumerate(rules):
        for m in re.finditer(rf"(?<![^ ]){r.pattern}(?![^ ])", words):
            found.append((-r.priority, m.start() - m.end(), m.start(), k, m.start(), m.end()))
    kept = []
    for p, _, _, k, a, b in sorted(found):
        label = rules[k].label
        inside = any(c <= a and b <= d for c, d, _ in kept)
        if not inside and not any(label != x and a < d and c < b for c, d, x in kept):
            kept.append((a, b, label))
    at = lambda i: words[:i].count(" ")
    return sorted((at(a), at(b - 1) + 1, x) for a, b, x in kept)


def test_every_rule_is_reached_through_its_keyword():
    draw = random.Random(1)
    for r in build():
        for _ in range(6):
            text = example(r.pattern, draw)
            assert re.fullmatch(r.pattern, text) and r.keyword in text, (r, text)


def test_labels_against_brute_force(spark, sf_dir):
    """All documents, and texts in which examples of rules stand side by side and overlap."""
    draw, rules = random.Random(2), build()
    texts = [lower(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for _ in range(300):
        parts = [example(draw.choice(rules).pattern, draw) for _ in range(draw.choice([1, 2, 5, 12]))]
        texts.append(draw.choice([" ", ", ", "\n"]).join(p.upper() if draw.random() < 0.3 else p for p in parts))
    texts.append(" ".join(["gnu general public license version 2 or version 3"] * 400))
    got = scan(spark, texts)
    labelled = 0
    for i, t in enumerate(texts):
        want = by_brute_force(lower(t), rules)
        assert sorted((s["first"], s["end"], s.label) for s in got[i].spans) == want
        base = set(got[i].base_labels.split(",")) - {""}
        assert got[i].labels == ",".join(sorted({x for *_, x in want} | base))
        labelled += bool(want)
    assert labelled > 300


def test_license_detections(spark):
    got = scan(spark, [
        None, "", "Released\nunder the MIT-License!", "Apache License, Version 2.0", "CC BY-NC cc-by-nc", "under the gnu general public license, version 3",
        "SPDX-License-Identifier: LGPL-2.1-or-later", "All rights reserved. Licensed under the BSD 3-Clause License", "the committee met mit Lizenz",
        "This work: Creative Commons Attribution-ShareAlike 4.0 International", "permission is hereby granted, free of charge, to any person obtaining a copy",
        "word " * 50_000 + "under the mit license",
    ])
    assert [got[i].labels for i in range(12)] == [
        "", "", "mit", "apache-2", "cc-by-nc", "gpl-3", "lgpl-2.1", "all-rights-reserved,bsd-3", "", "cc-by-sa", "mit", "mit",
    ]
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (2, 0, 3)
    assert got[11].first_word == 50_000 and got[11].n_words == 50_004 and got[0].n_words == 0
    assert got[5].base_labels == "" and got[5].first_word is None and 0 < got[5].score < 1 and got[2].score == 1
    span = got[5].spans[0]
    assert (span.first, span.end, span.label) == (2, 8, "gpl-3")


def test_overlaps_go_to_the_higher_priority(spark):
    rules = (Rule("wide", "a b c d", "a b", 1), Rule("narrow", "b c", "b c", 5), Rule("end", "d e", "d e", 3), Rule("in", "d", "d", 2))
    got = scan(spark, ["a b c d e", "a b c d"], rules)
    assert [s.label for s in got[0].spans] == ["narrow", "end"] and [s.label for s in got[1].spans] == ["narrow", "in"]
    assert scan(spark, [])== {} and BASE_PHRASES[0][1] == "mit"


def test_targets_and_flow():
    sizes = {"a": 100, "b": 1, None: 50}
    weights = mixing.cycle_weights(list(sizes))
    assert weights == {"a": 5, "b": 2, None: 1}
    goal = mixing.capped_targets(sizes, weights)
    assert goal["b"] == 3 and sum(goal.values()) == pytest.approx(151) and goal["a"] == pytest.approx(148 * 5 / 6)
    assert mixing.capped_targets({}, {}) == {} and mixing.capped_targets({"a": 0}, {"a": 1}) == {"a": 0.0}
    sent = mixing.route({("a",): 10, ("a", "b"): 10, ("b",): 0}, {"a": 15, "b": 9})
    assert sum(sent[("a",)].values()) == 10 and sent[("a", "b")]["b"] == 9 and sent[("a", "b")]["a"] <= 5
    # the second repetition is used only when the first ones do not suffice
    sent = mixing.route({("a",): 10, ("a", "b"): 10}, {"a": 25, "b": 10})
    assert sum(map(sum, (s.values() for s in sent.values()))) == 35


def test_mix_of_sources(spark):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 3}") for i in range(300)]
    rows += [(900, None, "s0"), (901, "", "s1"), (902, "x y", None), (902, "x y", None), (None, "big " * 500, "s2")]
    got = mixing.mix_table(frame(spark, rows)).toPandas()
    assert len(got) == len(rows) and (got.taken <= 3 * got["size"]).all() and (got.taken >= 0).all()
    per = got.groupby("target").agg(taken=("taken", "sum"), size=("source_size", "first"))
    assert (abs(per.taken - per.index) < 1).all() and len(per) == 4
    again = mixing.mix_table(frame(spark, rows).repartition(7)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got.sort_values(key)[key].values.tolist().__repr__() == again.sort_values(key)[key].values.tolist().__repr__()


def test_mixed_documents(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(i % 7 + 1)), f"s{i % 3}") for i in range(200)] + [(500, None, "s1")]
    df = frame(spark, rows)
    takes = {r.doc_id: r.taken for r in mixing.mix_table(df).collect()}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    copies = collections.Counter()
    texts = {a: b for a, b, _ in rows}
    for r in out.collect():
        copies[r.doc_id] += 1
        assert texts[r.doc_id] == r.text
    # whole texts, once more where a share ends past the middle
    sizes = {k: len(WORD.findall(t or "")) for k, t in texts.items()}
    assert copies == {k: (2 * v + sizes[k]) // (2 * sizes[k]) for k, v in takes.items() if 2 * v >= sizes[k] > 0}
    assert max(copies.values()) <= 3 and any(v % sizes[k] for k, v in takes.items() if sizes[k])
    assert mixing.mixed_documents(df.where("false")).count() == 0 and mixing.mix_table(df.where("false")).count() == 0


def test_overlapping_sources(spark):
    from pyspark.sql import functions as F

    rows = [(i, "w " * 4, "a" if i % 4 else "a,b") for i in range(100)]
    both = F.split("source", ",")
    got = mixing.mix(frame(spark, rows), both).toPandas()
    assert (got.taken <= 12).all()
    assert got.taken.sum() <= 400
    shared = got[got.pattern.map(len) == 2]
    assert shared.taken.sum() >= 100  # b has its quota only from documents of both


def test_more_sources_than_the_driver_takes(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(i, "w " * (i % 7 + 1), f"s{i * i % 83}") for i in range(1200)]
    rows += [(i, "w " * 40, "s0") for i in range(2000, 2300)] + [(i, "w", f"t{i}") for i in range(3000, 3400)]
    rows += [(900, None, "s3"), (901, "", "empty"), (902, "x y", None), (902, "x y", None), (None, "big " * 500, "s2")]
    both = F.when(F.col("doc_id") % 97 == 5, F.array("source", F.lit("both"))).otherwise(F.array("source"))
    both = F.when(F.col("doc_id") != 7, both).otherwise(F.array().cast("array<string>"))
    small = frame(spark, rows)
    mixes = []
    for limit in (100_000, 100):
        monkeypatch.setattr(mixing, "MAX_PATTERNS", limit)
        mixes.append((mixing.mix(small).collect(), mixing.mix(small, both).collect()))
    (one, shared), (one_many, shared_many) = mixes
    values = lambda r: (str(r.doc_id), r.place, r["size"], r.taken, [tuple(x) for x in r.stats])
    assert sorted(map(repr, map(values, one_many))) == sorted(map(repr, map(values, one))) and len(one) == len(rows)
    # flows can differ in the way they take, not in how much
    assert len(shared_many) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in shared_many)
    linked = {s for r in shared if len(r.pattern) > 1 for s in r.pattern}
    taken = [collections.Counter(), collections.Counter()]
    for sums, got in zip(taken, (shared, shared_many)):
        for r in got:
            sums["linked" if linked & set(r.pattern) else str(r.pattern)] += r.taken
    assert 2 < len(linked) < 40 and all(abs(taken[0][k] - taken[1][k]) <= (len(linked) if k == "linked" else 1) for k in taken[0])


def test_more_linked_patterns_than_the_driver_takes(spark, monkeypatch):
    """Rounds of shares come as near to the targets as the flow does, within a few percent."""
    draw = random.Random(4)
    names = [f"s{i}" for i in range(12)] + [None]
    rows = [(i, "w " * draw.randrange(1, 30), ",".join(str(k) for k in draw.sample(range(13), draw.choice([1, 1, 2, 3])))) for i in range(800)]
    rows += [(900, None, "1,2"), (901, "", "5"), (None, "x y z", "0,12"), (902, "hot " * 2000, "3")]
    sources = F.transform(F.split("source", ","), lambda k: F.get(F.array(*[F.lit(n) for n in names]), k.cast("int")))
    df = frame(spark, rows)
    weights = spark.createDataFrame([(n, float(1 + i % 3)) for i, n in enumerate(names)], "source string, w double")
    for how in ({}, {"weigh": weights}):
        taken = []
        for limit in (100_000, 2):
            monkeypatch.setattr(mixing, "MAX_PATTERNS", limit)
            got = mixing.mix(df, sources, **how).collect()
            assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in got)
            taken.append(sum(r.taken for r in got))
            goal = sum({x.source: x.target for r in got for x in r.stats}.values())
        assert taken[1] <= goal and taken[1] >= 0.95 * taken[0] > 0
    again = mixing.mix(df, sources, weigh=weights).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    with pytest.raises(ValueError, match="as a table"):
        mixing.mix(df, sources, weigh=lambda names: dict.fromkeys(names, 1.0))
