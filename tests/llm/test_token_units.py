"""op6: texts cut into units that repeat, each encoded by the library once."""

import random

import numpy as np
import pyarrow as pa
import pytest

from metamart.llm import tokens as T
from tests.llm.cases import DOCS
from tests.llm.test_tokens import PATH, expected, library  # noqa: F401 - a fixture

PARTS = ["a", "Word", "é", "ÿ", "Ā", "ɏ", "ɐ", "×", "÷", "ª", "²", "23", "٣", "'", "'s", "’", "\n", "\n\n", "\r\n", "\t", " ", "  ",
         "\u0085", " ", " ", " ", "　", "​", "\x1c", "\x00", ".", "!!", "_", "|", "\x7f", "日本", "🙂", "é",
         "<|endoftext|>", "<|endof", "Ġ", "Ċ", " foo", " bar.", ",\n"]


def ids(flat, counts):
    ends = np.cumsum(counts).tolist()
    return [flat[z - n:z].tolist() for z, n in zip(ends, counts.tolist(), strict=True)]


@pytest.mark.parametrize("seed", range(3))
def test_columns_equal_whole_texts(library, seed):  # noqa: F811
    rnd, enc = random.Random(seed), T.PieceEncoder(PATH)
    texts = ["".join(rnd.choices(rnd.choice([PARTS, PARTS[:17], rnd.sample(PARTS, 6)]), k=rnd.randint(0, 15))) for _ in range(4000)]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["left out", *texts, "left out"], kind).slice(1, len(texts))
        assert ids(*enc.encode_column(column)) == [library(t) for t in texts]
    assert ids(*enc.encode_column(pa.array(["", ""]))) == [[], []]


class Counted:
    def __init__(self, tok):
        self.tok, self.words = tok, 0

    def encode(self, text, **kw):
        self.words += len(text.split())
        return self.tok.encode(text, **kw)

    def encode_batch_fast(self, texts, **kw):
        self.words += sum(len(t.split()) for t in texts)
        return self.tok.encode_batch_fast(texts, **kw)


def test_new_pairs_of_known_words_cost_no_call(library):  # noqa: F811
    enc = T.PieceEncoder(PATH)
    enc.tok = Counted(enc.tok)
    words = [f"{a}{b}ön" for a in "bdfgklmn" for b in "aeiou"]
    texts = ["first " + " ".join(f"{a}{mark}\n{b.title()}" for b in words) for a in words for mark in (".", "!?", ",")]
    for some in (texts[::2], texts[1::2]):
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(some)] == [library(t) for t in some]
    assert enc.tok.words <= 2 * len(words) + 10      # of 4800 pieces


def test_long_units_are_not_remembered(library):  # noqa: F811
    enc = T.PieceEncoder(PATH)
    text = "x" * 5000 + " " + "日本" * 4000 + " short"
    for _ in range(2):
        assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == library(text)
    assert set(enc.now) == {" short"}


def test_steps_by_bytes():
    texts = [None, "", "a" * 30, None, "b" * 250, "", "c" * 5] + ["d" * 7] * 100 + [None]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, min(a + 9, len(texts))), pa.int64()), pa.array(texts[a:a + 9], pa.string())],
                                          names=["doc_id", "text"]) for a in range(0, len(texts), 9)]
    got = list(T._by_bytes(batches, 100))
    assert [r["doc_id"] for b in got for r in b.to_pylist()] == list(range(len(texts)))
    assert [r["text"] for b in got for r in b.to_pylist()] == texts
    sizes = [sum(len(r["text"] or "") for r in b.to_pylist()) for b in got]
    assert all(n >= 100 for n in sizes[:-1]) and all(n <= 200 + 250 for n in sizes) and len(got) >= 5


def test_files(spark, tmp_path, library):  # noqa: F811
    rows = [(i, t, None, None, None) for i, t in enumerate(["a  b", None, "", "one two.\n\nThree", "x" * 300, "tail \n"] * 20)]
    T.write_tokens(spark.createDataFrame(rows, DOCS), str(tmp_path / "t"))
    got = sorted((tuple(r) for r in T.digests(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)
