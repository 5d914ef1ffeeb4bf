"""Ranked search against brute force; the whole query also runs against its SQL twin."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from deskcorpus.llm import lexical
from helpers import DOCS, frame, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, rank int, item string"


def terms(text):
    return TERM.findall(lower(text))


def brute(docs, items, top=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, bag, n in bags:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in wanted if bag[t]
            )
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(found)[:top], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], ITEMS)


def found(table):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in table.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["Été", "x1", "日本"]
    weight = 1 / np.arange(1, len(words) + 1)
    docs = [(i, " ".join(draw.choice(words, draw.integers(1, 60), p=weight / weight.sum()))) for i in range(400)]
    docs += [(1000 + i, "w1 w2, W3! w2") for i in range(120)]  # many equal scores
    docs += [(2000, None), (2001, ""), (2002, "!!! \n"), (2003, "w5 " * 20000), (2004, "rare-term_here")]
    docs += [(3000, "w7 w8 w8")] * 3 + [(None, "w7 w8 w9"), (None, "w59")]
    items = [(1, "w1 w2 w3 w3"), (2, "RARE x1"), (3, None), (4, ""), (5, "nowhere"), (6, "w7"), (6, "w8 été"), (None, "w59 日本"), (8, " ".join(words))]
    return docs, items


def test_against_brute_force(spark, corpus, monkeypatch):
    docs, items = corpus
    wanted = brute(docs, items)
    assert found(lexical.search_table(frame(spark, docs), items_frame(spark, items))) == wanted
    small = lexical.build_index(frame(spark, docs))
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)  # several blocks
    assert found(lexical.search(small, items_frame(spark, items))) == wanted
    assert found(lexical.search(small, items_frame(spark, items), top=3)) == brute(docs, items, 3)


def test_segments(corpus):
    """Strata, groups and bounds of one segment, and search over many small ones."""
    docs, items = corpus
    docs = sorted((len(terms(t)), i, t) for i, t in docs if i is not None and terms(t))
    n_docs, n_terms = len(docs), sum(n for n, _, _ in docs)
    m = lexical.normalisers(np.array([n for n, _, _ in docs]), n_docs, n_terms)
    assert m.tolist() == [50 + 50 * n * n_docs // n_terms for n, _, _ in docs]
    row = lexical.segment(pa.array([i for _, i, _ in docs]), pa.array([t for _, _, t in docs]), m)
    a = {name: lexical._wide(row.column(name)[0]) for name in lexical.ARRAYS}
    assert a["stratum_m"].tolist() == sorted(set(m.tolist()))
    names = row.column("terms")[0].as_py()
    at = start = 0
    for k, last in enumerate(a["term_groups"]):
        seen = []
        for g in range(at, last):
            here = a["post_doc"][start : a["group_end"][g]]
            start = a["group_end"][g]
            s, tf = a["group_stratum"][g], a["group_tf"][g]
            seen.append((s, -tf))
            for d in here:
                assert m[d] == a["stratum_m"][s] and Counter(terms(docs[d][2]))[names[k]] == tf
        assert seen == sorted(set(seen)) and sum(a["group_end"][at:last] - np.append(0, a["group_end"])[at:last]) == a["term_df"][k]
        at = last


def test_empty_tables(spark, corpus):
    docs, items = corpus
    none = spark.createDataFrame([], DOCS)
    assert lexical.search_table(none, items_frame(spark, items)).collect() == []
    assert lexical.search_table(frame(spark, docs[:5]), spark.createDataFrame([], ITEMS)).collect() == []
