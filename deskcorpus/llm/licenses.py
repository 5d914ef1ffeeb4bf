"""License scans by ordered signature rules.

A text is lower-cased (A-Z) and brought to words parted by one space. Every rule names a
keyword, and only texts that have it are tried with the rule's regular expression, so
most texts meet no rule at all. Detections then compete: in order of priority, a detection
goes unless an accepted one contains it or, of another label, overlaps it with more
priority. The phrases of the base are always reported."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import text_bytes, text_chunks, text_of, tidy, word_bounds, worker_cache
from deskcorpus.llm.license_rules import BASE_PHRASES, Rule, build, gates

IS_WORD = np.zeros(256, np.bool_)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


class Scanner:
    """Compiled rules; each worker builds one."""

    def __init__(self, rules: Sequence[Rule]):
        import ahocorasick

        self.rules = list(rules)
        self.compiled = [re.compile(rf"(?<![^ ]){r.pattern}(?![^ ])") for r in self.rules]
        self.by_keyword: dict[str, list[int]] = {}
        for k, r in enumerate(self.rules):
            self.by_keyword.setdefault(r.keyword, []).append(k)
        self.words = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.words.add_word(keyword, keyword)
        self.words.make_automaton()
        self.base = [(re.compile(rf"(?<![^ ])(?={re.escape(p)}(?![^ ]))"), p, label) for p, label in BASE_PHRASES]

    def scan(self, text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, int]]]:
        """(start, end, label) of the base, and (start, end, label, priority) of accepted
        detections, in characters of the text's words parted by one space."""
        base = [(m.start(), m.start() + len(p), label) for pattern, p, label in self.base for m in pattern.finditer(text)]
        present = {k for _, k in self.words.iter(text)}
        found = []
        for keyword in present:
            for k in self.by_keyword[keyword]:
                r = self.rules[k]
                found += [(-r.priority, m.start() - m.end(), m.start(), k, m.start(), m.end()) for m in self.compiled[k].finditer(text)]
        return base, self._suppress(sorted(found))

    def _suppress(self, found: list[tuple]) -> list[tuple[int, int, str, int]]:
        """In order of priority, then of length, place and rule: a detection goes if an accepted
        one contains it, or one of another label overlaps it. Only accepted ones that begin
        less than the longest one before its end can do so."""
        starts: list[int] = []
        kept: list[tuple[int, int, str, int]] = []
        longest = 0
        for priority, _, _, k, a, b in found:
            label = self.rules[k].label
            near = kept[bisect_left(starts, a - longest) : bisect_left(starts, b)]
            if any((c <= a and b <= d) or (other != label and a < d) for c, d, other, _ in near):
                continue
            i = bisect_left(starts, a)
            starts.insert(i, a)
            kept.insert(i, (a, b, label, -priority))
            longest = max(longest, b - a)
        return kept


def words_of(text: str) -> str:
    return " ".join(WORDS.findall(text))


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, spans array<struct<first: long, end: long, label: string, priority: int>>"
)


def scan_licenses(docs: DataFrame, rules: Sequence[Rule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    ``spans`` are the accepted detections as word intervals. ``score`` is the confidence of
    the best detection, 1 where a base phrase stands, 0 without any. Null texts count as
    empty. Every row is scanned on its own, whole; nothing is moved."""
    rules = build() if rules is None else tuple(rules)
    top = max([r.priority for r in rules], default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache("scanners")
        if (name := hash(rules)) not in known:
            known[name] = Scanner(rules)
        scanner = known[name]
        for batch in batches:
            for chunk in text_chunks(batch):
                texts = pc.ascii_lower(chunk.column("text"))
                raw, ends = text_bytes(texts)
                _, _, before = word_bounds(raw, ends, IS_WORD)
                gate = pc.match_substring_regex(texts, "|".join(map(re.escape, gates(rules))))
                rows = [(0, None, None, "", "", 0.0, [])] * chunk.num_rows
                for i in np.flatnonzero(gate.to_numpy(zero_copy_only=False)).tolist():
                    rows[i] = _row(scanner, texts[i].as_py(), top)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), SPANS)
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id"),
                        pa.array(np.diff(before), pa.int64()),
                        *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                    ],
                    names=["doc_id", *[c.split()[0] for c in SCHEMA.split(", ")[:7]], "spans"],
                )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id long, {SCHEMA}")


SPANS = pa.list_(
    pa.struct(
        [
            pa.field("first", pa.int64()),
            pa.field("end", pa.int64()),
            pa.field("label", pa.string()),
            pa.field("priority", pa.int32()),
        ]
    )
)


def _row(scanner: Scanner, text: str, top: int) -> tuple:
    text = words_of(text)
    base, found = scanner.scan(text)
    if not base and not found:
        return (0, None, None, "", "", 0.0, [])
    spaces = [m.start() for m in re.finditer(" ", text)]
    at = lambda place: bisect_right(spaces, place)  # noqa: E731  words before a place in the text
    firsts = [at(a) for a, _, _ in base]
    base_labels = sorted({label for _, _, label in base})
    labels = sorted({*base_labels, *(label for _, _, label, _ in found)})
    best = 1.0 if base else max(p for *_, p in found) / top
    spans = [{"first": at(a), "end": at(b - 1) + 1, "label": label, "priority": p} for a, b, label, p in found]
    return (len(base), min(firsts, default=None), max(firsts, default=None), ",".join(base_labels), ",".join(labels), best, spans)


def license_table(docs: DataFrame) -> DataFrame:
    """What is found in every row of ``docs``, without the spans. Null and empty texts have no
    words and no labels; repeated rows and null ids stay; an empty table gives no rows."""
    return scan_licenses(docs).drop("spans")
