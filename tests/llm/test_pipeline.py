import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from metamart.llm import quality, tokens
from tests.llm import test_minhash_dedup, test_mixing
from tests.llm.cases import DOCS, edge_rows, with_clashes, words

SF = "/root/testdata/sf0.01"


def brute(spark, rows):
    """The stages one after the other over plain rows."""
    docs = spark.createDataFrame(rows, DOCS)
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = model.scores([None if r[1] is None else r[1].encode() for r in rows]) >= 0.5
    rows = [r for r, g in zip(rows, good, strict=True) if g]
    root = test_minhash_dedup.brute(rows)
    rows = [r for r in rows if root[r[0]][1] == r[0]]
    items = [f" {' '.join(words(r.text))} " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(i in f" {' '.join(words(r[1]))} " for i in items)]
    place = test_mixing.brute(rows)
    tok = Tokenizer.from_file(tokens.default_tokenizer())
    out, start = [], 0
    for r in sorted(rows, key=lambda r: place[r[0]][4]):
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        out.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_run_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted((tuple(r) for r in P.run(spark, SF).collect()), key=lambda r: r[1])
    assert got == brute(spark, rows)
    assert 0 < len(got) < len(rows)


@pytest.mark.parametrize("i", range(len(P.STAGES)))
def test_stages_survive_edges(spark, i):
    name, stage = P.STAGES[i]
    docs = with_clashes(spark.createDataFrame(edge_rows(), DOCS))
    out = stage(spark, docs, SF)
    rows = out.collect()
    if i < len(P.STAGES) - 1:
        assert out.columns == docs.columns
    assert rows
    assert stage(spark, docs.limit(0), SF).collect() == []
