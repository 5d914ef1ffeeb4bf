"""Small fixtures and brute-force versions."""

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, place int, class string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def frame(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names
    operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "x", 1, "c") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def shingles(text, width):
    w = WORD.findall(lower(text))
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def near_components(rows, width, percent):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}
