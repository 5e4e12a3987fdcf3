"""Line dedup by overlapping three-line windows (op2).

Every three consecutive lines that are not blank are hashed (white space at
their ends does not count).  A window that occurs more than once anywhere is
removed at all its later occurrences: the lines that any of them covers go,
with their line breaks.  Texts of fewer than three such lines keep everything.
See ``spans`` for the method at scale and the defined results.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from metamart.llm import spans

LINES = 3


def lines(text: bytes) -> spans.Units:
    start, end, code, at = [], [], [], 0
    for line in text.split(b"\n"):
        stop = at + len(line)
        if body := line.strip():
            start.append(at)
            end.append(min(stop + 1, len(text)))
            code.append(xxhash.xxh3_64_intdigest(body))
        at = stop + 1
    return spans.Units(np.array(start, np.int64), np.array(end, np.int64), np.array(code, np.uint64), np.ones(len(code), np.int64))


RUNS = spans.Runs(lines, LINES)


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, first_ids, starts, ends, text of every document that loses lines."""
    return spans.removals(docs, RUNS)


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    return spans.drop_repeats(docs, RUNS)
