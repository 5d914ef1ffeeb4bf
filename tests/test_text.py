import re
import sys
import unicodedata
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskcorpus.functions import text as X


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.o for r in df.select("i", expr(F.col("t")).alias("o")).orderBy("i").collect()]


GOLDEN = [
    ("<b>Hi</b>  there", "Hi there", "hi there"),
    ("line one.\n\nTo check", "line one.To check", "line one. to check"),
    ("see https://x.io/a?b=1 now", "see now", "see https://x.io/a?b=1 now"),
    ("www.shop.com/ok done", "done", "www.shop.com/ok done"),
    ("café ﬁne ①", "café fine 1", "cafe fine 1"),
    ("bill for {{Person Name}}", "bill for Person Name", "bill for {{person name}}"),
    ("R&amp;D &lt;tag&gt;", "R amp D lt tag gt", "r&d <tag>"),
    ("&amp;lt;", "amp lt", "<"),
    ("5 < 6 and 7 > 3", "5 3", "5 3"),
    ("don’t — stop", "don t stop", "dont stop"),
    ("tab\there", "tabhere", "tab here"),
    ("\U0001f600 ok", "ok", "ok"),
    ("**Bold:** 50% off [x]", "Bold: 50% off x", "**bold:** 50% off [x]"),
    ("", "", ""),
    (None, "", ""),
    # characters newer than the JVM's tables follow Python's
    ("a\U0001fae0b", "a b", "ab"),
    ("x y​z ½", "x yz 1 2", "x yz 12"),
]


def test_golden_core_and_ascii(spark):
    raw = [g[0] for g in GOLDEN]
    assert column(spark, raw, X.clean_core) == [g[1] for g in GOLDEN]
    assert column(spark, raw, X.clean_ascii) == [g[2] for g in GOLDEN]
    assert column(spark, ["AÉ <b> B"], lambda c: X.clean_core(c, True)) == ["aé b"]
    assert column(spark, ["AÉ"], lambda c: X.clean_ascii(c, False)) == ["AE"]


def test_stable_class_is_closed_under_nfkc():
    member = re.compile(f"[{X.NFKC_STABLE}]")
    seconds = set()
    for p in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(p)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(chr(int(parts[1], 16)))
    for p in range(sys.maxunicode + 1):
        c = chr(p)
        if member.fullmatch(c):
            assert unicodedata.normalize("NFKC", c) == c
            assert unicodedata.combining(c) == 0 and c not in seconds
            assert unicodedata.category(c) != "Cn"
            assert c.isprintable() or p < 0x20 or p == 0x7F
    # conjoining jamo compose by rule rather than by table
    assert not any(member.fullmatch(chr(p)) for p in range(0x1100, 0x1200))


def apply_all(text, rules):
    return reduce(lambda t, rule: rule(t), rules, text)


def swap(pattern, to):
    return lambda t: re.sub(pattern, to, t)


SQUEEZE = lambda t: " ".join(t.split())
CORE_RULES = [
    swap(X.TAG, " "),
    swap(r"https?://\S+|www\.\S+", " "),
    lambda t: unicodedata.normalize("NFKC", t),
    lambda t: "".join(filter(str.isprintable, t)),
    swap(rf"[^\w\s{X.KEPT_PUNCTUATION}]", " "),
    SQUEEZE,
]
ASCII_RULES = [
    swap(X.TAG, " "),
    *[lambda t, e=e: t.replace(*e) for e in X.ENTITIES],
    lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if c < "\x80"),
    SQUEEZE,
    str.lower,
]


PIECES = st.one_of(
    st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
    st.sampled_from(["<b>", "http://a.b/c ", "www.x", "&amp;", "&nbsp;", "\n", "é", "é", "ﬁ", "각", "각", "{{x}}", " ", "\x1c"]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=10).map("".join), min_size=30, max_size=60))
def test_cleaners_match_plain_python(spark, texts):
    assert column(spark, texts, X.clean_core) == [apply_all(t, CORE_RULES) for t in texts]
    assert column(spark, texts, X.clean_ascii) == [apply_all(t, ASCII_RULES) for t in texts]
    assert column(spark, texts, X.word_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, X.strip) == [t.strip() for t in texts]
    assert column(spark, texts, X.char_count) == [len(t) for t in texts]
    assert column(spark, texts, X.nfkc) == [unicodedata.normalize("NFKC", t) for t in texts]


def test_every_code_point_that_folds(spark):
    points = [p for p in range(0x80, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    texts = ["x" + chr(p) + "y" for p in points if X._ascii_part(chr(p)) or p % 97 == 0]
    assert column(spark, texts, X.fold_ascii) == [X._ascii_part(t) for t in texts]


def test_all_white_space(spark):
    spaces = [chr(p) for p in range(sys.maxunicode + 1) if chr(p).isspace()]
    assert set(spaces) == set(X.WS_CHARS)
    assert column(spark, ["a" + s + "b" for s in spaces], X.squeeze) == ["a b"] * len(spaces)


def test_squeeze_is_idempotent_and_counts_agree(spark):
    texts = [" a  b\tc ", "", "   ", "one", None]
    once = column(spark, texts, X.squeeze)
    assert column(spark, once, X.squeeze) == once
    plain = [t for t in once if t is not None]
    assert column(spark, plain, X.word_count_squeezed) == [len(t.split()) for t in plain]
    assert column(spark, [None], X.word_count) == [0]


@pytest.mark.parametrize("keep,expected", [(True, "a, b? c d_e"), (False, "a  b  c d_e")])
def test_noise(spark, keep, expected):
    assert column(spark, ["a, b? c~d_e"], lambda c: X.drop_noise(c, keep)) == [expected]


def test_missing_values_as_text(spark):
    assert column(spark, [None, "x"], lambda c: X.joined(c, F.lit("y"))) == ["nan y", "x y"]
