import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from metamart.llm import queries, tokens as T
from tests.llm.cases import DOCS, edge_rows, with_clashes

PATH = T.default_tokenizer()


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


ENC = T.PieceEncoder(PATH)
PIECES = ["word", "Word.", "it's", " ", "  ", "\n", "\n\n", "\t", " ", "　", "é", "日本", "1.5", "a,b", ".", "!!",
          "don't", "²", "é", "\r\n", "​", "🙂", "'s", "naïve", "x\ny", ":", "\x1c", " "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=6))
def test_pieces_equal_whole_texts(texts):
    tok = Tokenizer.from_file(PATH) if not hasattr(test_pieces_equal_whole_texts, "t") else test_pieces_equal_whole_texts.t
    test_pieces_equal_whole_texts.t = tok
    for text, got in zip(texts, ENC.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_small_generations_change_nothing(monkeypatch, library):
    monkeypatch.setattr(T, "GENERATION", 3)
    enc = T.PieceEncoder(PATH)
    for _ in range(3):
        for text in ("a b c d e f g", "The cat, the dog.\nA line.", "one  two", "x y z a b c"):
            assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == library(text)


def expected(rows, library):
    out, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library(text), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, tmp_path, library):
    docs = with_clashes(spark.createDataFrame(edge_rows(), DOCS)).repartition(3)
    T.write_tokens(docs, str(tmp_path / "t"))
    got = sorted((tuple(r) for r in T.digests(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert got == expected(edge_rows(), library)
    places = T.index(spark, str(tmp_path / "t")).collect()
    assert sorted(r.start for r in places) == [r[1] for r in got]
    ids = {r.doc_id: r.token_ids for r in T.read_tokens(spark, str(tmp_path / "t")).filter("doc_id = 6").collect()}
    assert ids == {6: [*library("two words"), 0]}


@pytest.mark.parametrize("encoding,name", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_file_layout(spark, tmp_path, library, encoding, name):
    docs = spark.createDataFrame([(i, f"text number {i} " + "word " * (i % 40), None, None, None) for i in range(3000)], DOCS)
    T.write_tokens(docs, str(tmp_path / "t"), encoding=encoding, row_group_bytes=20_000, page_bytes=2_000)
    metas = [pq.ParquetFile(f).metadata for f in sorted(glob.glob(str(tmp_path / "t/part-*")))]
    column = metas[0].row_group(0).column(2)
    assert name in column.encodings and column.has_offset_index and column.has_column_index
    assert sum(m.num_row_groups for m in metas) > len(metas)
    ids = [i for f in sorted(glob.glob(str(tmp_path / "t/part-*"))) for i in pq.read_table(f)["doc_id"].to_pylist()]
    assert ids == list(range(3000))
    plan = T.read_tokens(spark, str(tmp_path / "t"), "doc_id", "n_tokens").filter("doc_id > 2990")._jdf.queryExecution().toString()
    assert "token_ids" not in plan.split("ReadSchema")[-1] and "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,2990)]" in plan


def test_files_of_one_task_keep_their_order(spark, tmp_path, library):
    rows = [(i, f"text number {i}", None, None, None) for i in range(70)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        T.write_tokens(spark.createDataFrame(rows, DOCS), str(tmp_path / "t"))
        got = sorted(tuple(r) for r in T.digests(spark, str(tmp_path / "t")).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(glob.glob(str(tmp_path / "t/part-*"))) > 1 and got == expected(rows, library)


def test_empty(spark, tmp_path):
    T.write_tokens(spark.createDataFrame([], DOCS), str(tmp_path / "t"))
    assert T.digests(spark, str(tmp_path / "t")).collect() == []


def test_query_equals_library(spark, library):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op6_token_output"](spark, d).collect())
    assert got == sorted(expected(rows, library))


def test_unknown_pieces_share_calls_of_the_library(library):
    enc, calls = T.PieceEncoder(PATH), []

    class Counted:
        def __init__(self, tok):
            self.encode, self.many = tok.encode, tok.encode_batch_fast

        def encode_batch_fast(self, texts, **kw):
            calls.append(len(texts))
            return self.many(texts, **kw)

    enc.tok = Counted(enc.tok)
    text = "start " + " ".join(f"wörd{i}\nLine{i}," if i % 3 else f"Abc{i}é日本" for i in range(2500))
    assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == library(text)
    assert len(calls) == 3
