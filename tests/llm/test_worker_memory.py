"""What Python workers remember: it is bounded, and no step keeps another's."""

import pyarrow as pa

from metamart.llm import common, minhash_dedup, quality, tokens


def batch():
    return pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three", None])], names=["doc_id", "text"])


def test_long_words_are_not_remembered():
    known = common.WordHashes(limit=3, longest=5)
    codes = [known[w] for w in (b"a" * 1_000_000, b"a", b"b", b"c", b"d", b"a" * 1_000_000)]
    assert codes[0] == codes[-1] and len(set(codes)) == 5
    assert 0 < len(known) <= 3 and all(len(w) <= 5 for w in known)


def test_a_step_keeps_nothing_of_others():
    written = list(tokens._tokenise(tokens.default_tokenizer(), 0)(iter([batch()])))
    assert tokens._ENCODERS and not common._WORDS
    first = list(minhash_dedup._profile(iter([batch()])))
    assert common._WORDS and not tokens._ENCODERS
    assert list(minhash_dedup._profile(iter([batch()]))) == first and common._WORDS
    assert list(tokens._tokenise(tokens.default_tokenizer(), 0)(iter([batch()]))) == written
    assert tokens._ENCODERS and not common._WORDS


def test_pickled_steps_forget_for_the_worker(spark):
    """The functions reach the workers as copies; what they free is the worker's own."""
    step = tokens._digest
    assert quality.features(b"a b")[0].size

    def probe(batches):
        for b in batches:
            common.word_codes([b"one"])
            before = len(common._WORDS)
            list(step(iter([])))
            yield pa.RecordBatch.from_arrays([pa.array([before]), pa.array([len(common._WORDS)])], names=["before", "after"])

    rows = spark.range(1, numPartitions=1).mapInArrow(probe, "before long, after long").collect()
    assert [(r.before > 0, r.after) for r in rows] == [(True, 0)]
