"""op6: literal added tokens in a text have the library's ids."""

import numpy as np

from metamart.llm import tokens as T
from tests.llm.cases import DOCS
from tests.llm.test_tokens import PATH, expected, library  # noqa: F401 - a fixture

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>b c", "x  <|endoftext|>\n\ny", "<|endoftext|><|endoftext|> z", "plain text", "<|endoftext|"]


def test_added_tokens_equal_the_library(library):  # noqa: F811
    enc = T.PieceEncoder(PATH)
    added = [t.content for t in enc.tok.get_added_tokens_decoder().values()]
    texts = TEXTS + [f"one {x} two{x} {x}" for x in added]
    assert added and "<|endoftext|>" in added
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [library(t) for t in texts]


def test_starts_after_a_text_with_an_added_token(spark, tmp_path, library):  # noqa: F811
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS)]
    T.write_tokens(spark.createDataFrame(rows, DOCS), str(tmp_path / "t"))
    got = sorted((tuple(r) for r in T.digests(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)
