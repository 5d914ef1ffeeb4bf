import random
import time

import numpy as np
import pytest

from deskcorpus.llm import chosen_path, components, digest_runs
from helpers import frame, lower, near_components

ROWS = [
    (1, "Same TEXT"), (2, "same text"), (3, "same  text"), (4, None), (5, ""), (None, "same text"),
    (None, "lonely"), (6, "ÄÖ"), (7, "äö"), (8, "x" * 300_000), (9, "X" * 300_000), (9, "x" * 300_000), (10, " "),
]


@pytest.mark.parametrize("largest", [True, False])
def test_exact_groups(spark, largest):
    got = digest_runs.dedup_table(frame(spark, ROWS), largest).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(lower(t), []).append(i)
    for i, t in ROWS:
        ids = groups[lower(t)]
        known = [x for x in ids if x is not None]
        keep = (max if largest else min)(known) if known else None
        assert (i, keep, len(ids), i == keep) in {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got}


def test_exact_keep_one(spark):
    got = digest_runs.keep_one(frame(spark, ROWS))
    assert got.columns == frame(spark, ROWS).columns
    assert sorted(lower(r.text) for r in got.collect()) == sorted({lower(t) for _, t in ROWS})
    assert {r.doc_id for r in got.collect()} == {2, 3, 5, None, 6, 7, 9, 10}


@pytest.mark.parametrize("limit", [digest_runs.BROADCAST_ROWS, -1])
def test_exact_keep_one_of_repeated_identifiers(spark, monkeypatch, limit):
    """Identifiers with rows that go and rows that stay, with rivals, and a frequent one."""
    monkeypatch.setattr(digest_runs, "BROADCAST_ROWS", limit)
    rows = [(1, "a"), (1, "b"), (2, "A"), (2, "a"), (3, "c"), (3, "c"), (None, "b"), (None, "n"), (None, "N"), (4, "d")]
    rows += [(5, f"own {i}") for i in range(30)] + [(0, "n")] * 3
    got = digest_runs.keep_one(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    want = [(2, "A"), (1, "b"), (3, "c"), (4, "d"), (0, "n"), *rows[10:40]]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(want)


def test_exact_keep_one_shuffles_no_texts(spark):
    """Which rows go is told by digests, however the lookup of these is joined."""
    docs = frame(spark, [(i, f"text {i % 40}") for i in range(60)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = digest_runs.keep_one(docs)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in got.collect()) == list(range(20, 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plan


def test_exact_rounds_and_empty_table(spark):
    assert digest_runs.rounds(50) == (64, [(0, 3), (3, 3)]) and digest_runs.rounds(1)[0] == 2
    empty = frame(spark, ROWS).where("false")
    assert digest_runs.dedup_table(empty).count() == 0 and digest_runs.keep_one(empty).count() == 0


def test_hot_text_over_many_rounds(spark):
    rows = [(i, "hot" if i % 3 else f"t{i % 50}") for i in range(900)]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = digest_runs.dedup_table(frame(spark, rows)).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    hot = got[got.group_size == 600]
    assert len(hot) == 600 and (hot.keep_id == 899).all() and hot.kept.sum() == 1
    assert got.kept.sum() == len({t for _, t in rows})


def near_rows(seed=3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for family in range(12):
        base = draw.choices(words, k=draw.choice([3, 8, 60, 150]))
        for _ in range(draw.choice([1, 2, 5, 30])):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append((n, draw.choice([" ", "\n"]).join(text).upper() if n % 4 else " ".join(text)))
            n += 1
    passage = " ".join(draw.choices(words, k=60))
    rows += [(n + i, passage + " " + " ".join(draw.choices(words, k=200))) for i in range(40)]
    n += 40
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two")]


def check_near(spark, rows, width=4, percent=80):
    got = chosen_path.near_duplicates(frame(spark, rows), width, percent).toPandas().set_index("doc_id")
    roots, sizes = near_components(rows, width, percent)
    assert got.n_shingles.to_dict() == sizes
    assert got.component_id.to_dict() == roots
    assert (got.kept == (got.component_id == got.index)).all()


def test_near_against_all_pairs(spark):
    check_near(spark, near_rows())
    check_near(spark, near_rows(4), width=2, percent=60)


def test_near_with_crowded_nodes(spark, monkeypatch):
    """Small limits send the same data through pivots, branching and the depth limit, and
    nodes through several batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    monkeypatch.setattr(chosen_path, "NODE_LIMIT", 4)
    monkeypatch.setattr(chosen_path, "PIVOTS", 3)
    monkeypatch.setattr(chosen_path, "MAX_DEPTH", 2)
    check_near(spark, near_rows(5))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_near_repeats_nulls_and_empty(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "q"), (2, "A B C D E"), (3, None)]
    got = chosen_path.near_duplicates(frame(spark, rows), 4).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == sorted(
        [("1", "1", True), ("1", "1", True), ("None", "1", False), ("None", "None", True), ("2", "1", False), ("3", "3", True)]
    )
    kept = chosen_path.keep_one(frame(spark, rows), 4)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3", "None", "None"]
    empty = frame(spark, rows).where("false")
    assert chosen_path.near_duplicates(empty, 4).count() == 0 and chosen_path.keep_one(empty).count() == 0


def test_recall_arithmetic():
    assert chosen_path.tree_recall(0.8, depth=1) == pytest.approx(0.96)
    assert chosen_path.trees_for(0.9999, 0.8) == 4 and chosen_path.trees_for(0.9, 0.8) == 1


def node_paths(spark, tokens, trees):
    """class -> its nodes at the depth limit, by the library's own branching."""
    rows = [(bytes([k >> 8, k & 255]), t.astype("<u4").tobytes()) for k, t in enumerate(tokens)]
    classes = spark.createDataFrame(rows, "class binary, tokens binary").cache()
    level = chosen_path.first_nodes(classes, trees)
    for depth in range(1, chosen_path.MAX_DEPTH):
        level = chosen_path.children(level.join(classes, "class"), depth)
    nodes = {}
    for r in level.collect():
        nodes.setdefault(r["class"], set()).add((r.tree, r.node))
    return [nodes[r[0]] for r in rows]


def test_recall_of_the_branching(spark):
    """600 pairs whose tokens agree with a chance of 0.8 each: how many share a node of a
    tree at the depth limit, all levels branched, is what the arithmetic says; and trees
    are independent: they lose pairs as often together as chance has it."""
    draw = np.random.default_rng(4)
    n, trees = 600, 4
    left = draw.integers(0, 1 << 32, (n, chosen_path.n_tokens(trees)), dtype=np.uint32)
    right = np.where(draw.random(left.shape) < 0.8, left, draw.integers(0, 1 << 32, left.shape, dtype=np.uint32))
    paths = node_paths(spark, np.concatenate([left, right]), trees)
    shared = [{t for t, _ in paths[k] & paths[n + k]} for k in range(n)]
    expected = chosen_path.tree_recall(0.8)
    met = np.array([[t in s for t in range(trees)] for s in shared])
    assert abs(met.mean() - expected) < 4 * (expected * (1 - expected) / (n * trees)) ** 0.5
    lost_two = (~met[:, 0] & ~met[:, 1]).mean()
    assert lost_two < (1 - expected) ** 2 + 4 * ((1 - expected) ** 2 / n) ** 0.5
    assert all(shared)  # four trees lose one pair in 37,000


def test_pages_of_one_template(spark, monkeypatch):
    """Pages about 70 % alike, none of them linked, in large nodes and in small ones; and
    some true copies among them."""
    draw = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    template = draw.choices(words, k=120)
    rows = [(i, " ".join(template + draw.choices(words, k=22))) for i in range(900)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(40)]
    want = {i: i for i, _ in rows} | {1000 + i: i for i in range(40)}
    for limit in (chosen_path.NODE_LIMIT, 100):
        monkeypatch.setattr(chosen_path, "NODE_LIMIT", limit)
        began = time.time()
        got = {r.doc_id: r.component_id for r in chosen_path.near_duplicates(frame(spark, rows), 4).collect()}
        assert got == want, limit
        assert time.time() - began < 120


def test_overlaps_and_forest(monkeypatch):
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 300, draw.integers(1, 200)).astype(np.uint64)) for _ in range(50)]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    i, j = np.triu_indices(50, 1)
    node = np.searchsorted([0, 20], i, "right") - 1
    same = node == np.searchsorted([0, 20], j, "right") - 1
    i, j = i[same], j[same]
    want = [100 * len(np.intersect1d(sets[a], sets[b])) >= 30 * len(np.union1d(sets[a], sets[b])) for a, b in zip(i, j)]
    for few, columns in ((10**6, 2048), (5, 2048), (5, 7)):
        monkeypatch.setattr(chosen_path, "FEW_PAIRS", few)
        monkeypatch.setattr(chosen_path._Overlaps, "COLUMNS", columns)
        exact = chosen_path._Overlaps(np.concatenate(sets), ends, np.array([0, 20]), 30)
        assert exact.linked(i, j).tolist() == want and 0 < sum(want) < len(want)
    root = np.arange(50)
    a, b = chosen_path._forest(root, i[want], j[want])
    label = list(range(50))
    for x, y in zip(i[want], j[want]):
        low, high = sorted((label[x], label[y]))
        label = [low if k == high else k for k in label]
    assert root.tolist() == label and len(a) == 50 - len(set(label))


def test_prefixes_meet_whatever_the_order(spark, monkeypatch):
    draw = np.random.default_rng(9)
    base = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sets = [np.sort(draw.choice(base, draw.integers(1, 60), replace=False)) for _ in range(60)]
    sets += [np.sort(np.append(s[: max(len(s) - len(s) // 11, 1)], draw.choice(base, 1))) for s in sets]
    sets = [np.unique(s) for s in sets]
    rows = [(bytes([k]), s.tobytes()) for k, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "class binary, shingles binary")
    nodes = {}
    for r in chosen_path.prefix_nodes(table, 80).collect():
        nodes.setdefault(r["class"][0], set()).add(r.node)
    linked = 0
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                assert nodes[a] & nodes[b]
                linked += 1
    assert linked > 30


@pytest.mark.parametrize("few,hub", [(20_000, 200_000), (0, 200_000), (0, 10)])
def test_components_of_a_hub(spark, monkeypatch, few, hub):
    """In one task, by windows, and by lookups that spread the hub."""
    monkeypatch.setattr(components, "FEW_EDGES", few)
    monkeypatch.setattr(components, "HUB_EDGES", hub)
    links = [(0, i) for i in range(1, 3000)] + [(i, i + 5000) for i in range(1, 500)] + [(9000, 9001), (-5, -4)]
    links += [(20_000 + i, 20_001 + i) for i in range(40)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in [*range(3000), *range(5001, 5500)]} | {9000: 9000, 9001: 9000, -5: -5, -4: -5}
    assert got == want | {20_000 + i: 20_000 for i in range(41)}
    none = spark.createDataFrame([(1, 1)], "a long, b long")
    assert components.components(none).collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 130)] + [(7, 7), (5, 4)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 130)}}
