"""Small inputs and plain reference implementations for the operator tests."""
from __future__ import annotations

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label string"


def words(text: str | None) -> list[str]:
    return SPACE.findall((text or "").translate(LOWER))


def documents(spark, rows):
    """Documents with extra columns whose names clash with those that operators add."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 0.5, "x") for i, t, s in rows], DOCS)


def components(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
