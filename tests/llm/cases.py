"""Small inputs every operator must survive, and plain-Python helpers."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("score", "start", "n", "v", "id", "rep", "digest", "kept", "component_id", "label", "block", "position")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def edge_rows():
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
    base = "one two three four five six seven eight nine ten eleven twelve"
    return [
        (1, base, "en", "a", len(base)),
        (2, base.upper(), "en", "a", None),
        (2, base.upper(), "en", "a", None),          # a repeated row
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", "en", "b", 4),
        (6, "two words", "en", None, 9),
        (7, "Two  WORDS", None, "b", 10),
        (8, long, "en", "a", len(long)),
        (9, long + " tail", "en", "a", len(long) + 5),
        (None, base, "en", "a", 1),
        (10, "naïve text 　 mixed", "fr", "c", 3),
    ]


def with_clashes(df):
    """Extra columns whose names the operators use inside."""
    return df.withColumns({c: F.lit("x") for c in CLASHES if c not in df.columns})


def least_reachable(ids, links):
    """id -> smallest id connected to it."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    root = {}
    for start in sorted(ids):
        todo = [start] if start not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = start
                todo += near[x]
    return root
