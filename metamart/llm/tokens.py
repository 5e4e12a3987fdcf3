"""Token ids as Parquet list columns, with selective reads (op6).

Format.  A folder of Parquet files, one row per document: ``doc_id``,
``n_tokens`` and ``token_ids array<int>``.  Files are written in ascending
order (part number, then row), so the order of documents needs no column.
Token ids are dictionary encoded (one bit-packed page dictionary of the used
ids) or delta encoded; the small columns are delta encoded (format version 2).
Row groups and pages have set sizes and carry column and offset indexes, so a
filter on ``doc_id`` reads only the pages it needs, and a read of the metadata
columns touches no token page.  ``index`` derives every document's place in
the token stream from the metadata columns alone.

Tokenising.  A byte-level vocabulary splits before every space that follows a
non-space, so the ids of a text are the ids of its space-separated pieces.
Inside a piece of plain letters, digits, marks and line ends it splits again
where these meet.  The units so found repeat: Arrow tells the distinct ones of some
megabytes of text, each is looked up once, and Arrow puts their ids in the order of
the texts.  Unknown units are encoded by the tokenizers library, many in one
call, and remembered in two bounded generations.  Texts for which the rule of the spaces
does not hold (runs of white space) go through the library whole, and so do texts
with an added token (such as a literal end-of-text mark), which is one id.
Results equal the library's on whole texts (tested).

Defined results: null text is the empty text (its ids are the end id alone);
null doc_ids come first; rows with the same doc_id keep all their rows, in an
unspecified order among themselves; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metamart.llm.common import arrow_rows, file_place, materialize, remembered, remembering, small_batches

END_ID = 0
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
GENERATION = 400_000     # remembered pieces per generation
PIECES_AT_ONCE = 1000    # unknown pieces per call of the library
LONGEST = 100            # characters of a remembered piece
TEXT_BYTES = 4 << 20     # least text of one step
# kinds of bytes: what belongs to no other kind stays in one unit with its piece
OTHER, SPACE, LINE, MARK, DIGIT, LETTER = range(6)
KINDS = np.zeros(256, np.uint8)
KINDS[[i for i in range(33, 127) if i != ord("'")]] = MARK
KINDS[[*range(65, 91), *range(97, 123), *range(0xC3, 0xC9)]] = LETTER    # with the first bytes of U+00C0 to U+023F
KINDS[48:58], KINDS[32], KINDS[10] = DIGIT, SPACE, LINE
BLANK = np.array([chr(i).isspace() for i in range(128)] + [False] * 128)
WIDE_BLANKS = np.array([int.from_bytes(chr(i).encode(), "big") for i in range(128, 0x10000) if chr(i).isspace()])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def units(data: np.ndarray, ends: np.ndarray, whole: np.ndarray, words: bool) -> np.ndarray:
    """Where the units of texts begin, whose ids are those of the text: the bytes of all texts,
    their ends (from 0 on) and those to be one unit.  A piece is what a space begins; ``words``
    cuts it on where letters, digits, marks and line ends meet, if it holds nothing else."""
    size = len(data)
    first = np.zeros(size + 1, bool)
    first[ends] = True
    cut = data == 32
    # after white space a space begins no token: such texts are one unit
    before = np.flatnonzero(cut & ~first[:-1]) - 1
    wide = before[data[before] >= 0x80]
    two = data[wide - 1].astype(np.int64) << 8 | data[wide]
    three = data[wide - 2].astype(np.int64) << 16 | two
    wide = wide[np.isin(two, WIDE_BLANKS) | np.isin(three, WIDE_BLANKS)]
    whole = whole.copy()
    whole[np.searchsorted(ends, np.append(before[BLANK[data[before]]], wide), "right") - 1] = True
    if words:
        kind = KINDS[data]
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
        kind[lead + 1] = LETTER
        sign = lead[(data[lead] == 0xC3) & np.isin(data[lead + 1], (0x97, 0xB7))]    # times, divided by
        kind[sign] = kind[sign + 1] = OTHER
        line = kind == LINE
        odd = kind == OTHER
        odd[:-1] |= cut[:-1] & line[1:]
        pieces = np.flatnonzero(cut | first[:-1])
        sizes = np.diff(pieces, append=size)
        odd_piece = np.logical_or.reduceat(odd, pieces) | line[pieces + sizes - 1]
        inner = np.zeros(size, bool)
        inner[1:] = (kind[1:] != kind[:-1]) & ~cut[:-1]
        inner[1:-1] |= line[:-2] & line[1:-1] & ~line[2:]    # the last of several line ends
        cut |= inner & ~np.repeat(odd_piece, sizes)
    if whole.any():
        cut &= ~np.repeat(whole, np.diff(ends))
    return np.flatnonzero(cut | first[:-1])


class PieceEncoder:
    """ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content]
        # a token that begins with a space: in a byte-level vocabulary, with that byte's character
        space = "".join(chr(256 + i) for i, b in enumerate(
            b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)) if b == 32)
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(space)]] = True
        self.joined = not any(c.isspace() for x in self.added for c in x)
        # the splitting that ``units`` follows inside pieces, and a line end that is one id
        split, line = self.tok.pre_tokenizer, self._ids("\n")
        self.words = (self.joined and self.tok.normalizer is None and isinstance(split, pre_tokenizers.ByteLevel)
                      and split.use_regex and not split.add_prefix_space and len(line) == 4)
        self.line = int.from_bytes(line[:4], "little")
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        flat, counts = self.encode_column(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        return [flat[z - n:z].tobytes() for z, n in zip(ends.tolist(), counts.tolist(), strict=True)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (without nulls) one after the other, and how many each has."""
        texts = texts.cast(pa.string())
        whole = np.zeros(len(texts), bool)
        for x in self.added:
            whole |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        apart = set(texts.filter(pa.array(whole)).to_pylist())
        _, ends, raw = texts.buffers()
        ends = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(raw or b"", np.uint8)[ends[0]:ends[-1]]
        ends = ends - ends[0]
        if not len(data):
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        starts = units(data, ends, whole, self.words)
        offsets = np.append(starts, len(data)).astype(np.int32)
        cut = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = cut.dictionary_encode()
        found = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        pool = pa.array(self._ids_of(found, apart), pa.large_binary())
        taken = pool.take(coded.indices)
        _, at, raw = taken.buffers()
        at = np.frombuffer(at, np.int64)[:len(starts) + 1] // 4
        return np.frombuffer(raw or b"", "<u4")[:at[-1]], np.diff(at[np.searchsorted(starts, ends)])

    def _ids_of(self, found: list[str], apart: set[str]) -> list[bytes]:
        """The ids of distinct units, from memory or else by the library; those are remembered."""
        ids: list = list(map(self.now.get, found))
        new = list(compress(range(len(ids)), map(is_, ids, repeat(None))))
        after: list[int] = []
        inside: list[int] = []
        long: list[str] = []
        for k in new:
            u = found[k]
            if len(u) > LONGEST:
                long.append(u)
            if (i := self.old.get(u)) is not None:
                ids[k] = i
            elif not self.joined or u[-1].isspace() or u in apart:
                ids[k] = self._ids(u)
            elif u.rfind(" ") == 0:
                after.append(k)
            elif self.words and len(u.split(None, 1)) == 1 and not u[0].isspace():
                inside.append(k)
            else:
                ids[k] = self._ids(u)
        for places, encode in ((after, self._together), (inside, self._lines)):
            for at in range(0, len(places), PIECES_AT_ONCE):
                some = places[at:at + PIECES_AT_ONCE]
                for k, i in zip(some, encode([found[k] for k in some]), strict=True):
                    ids[k] = i
        self.now.update(zip(map(found.__getitem__, new), map(ids.__getitem__, new), strict=True))
        for u in long:
            del self.now[u]
        if len(self.now) > GENERATION:
            self.old, self.now = self.now, {}
        return ids

    def _call(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _together(self, pieces: list[str]) -> list[bytes]:
        """Pieces with the space before them: every space begins a token, and no piece has one inside."""
        ids = self._call("".join(pieces))
        starts = (np.flatnonzero(self.spaced[ids]) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:z] for a, z in zip(starts, [*starts[1:], len(raw)], strict=True)]

    def _lines(self, words: list[str]) -> list[bytes]:
        """Words without white space, one a line."""
        ids = self._call("\n".join(words))
        ends = (np.flatnonzero(ids == self.line) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:z] for a, z in zip([0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True)]


_ENCODERS: dict[str, PieceEncoder] = {}
remembered("pieces", _ENCODERS.clear)


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _by_bytes(batches, least: int):
    """Batches of at least ``least`` bytes of text, twice that besides one text at most: small
    ones put together, large ones cut between texts."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        sums = np.cumsum(pc.fill_null(pc.binary_length(b.column(b.num_columns - 1)), 0).to_numpy().astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(sums // least)) + 1).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if a < z:
                held.append(b.slice(a, z - a))
                size += int(sums[z - 1] - (sums[a - 1] if a else 0))
            if size >= least:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _tokenise(path: str, end_id: int):
    @remembering("pieces")
    def run(batches):
        enc = encoder(path)
        for b in _by_bytes(batches, TEXT_BYTES):
            ids, counts = enc.encode_column(pc.fill_null(b.column(b.num_columns - 1), ""))
            offsets = np.zeros(len(counts) + 1, np.int32)
            np.cumsum(counts + 1, out=offsets[1:])
            inner = np.ones(offsets[-1], bool)
            inner[offsets[1:] - 1] = False
            flat = np.full(offsets[-1], end_id, np.int32)
            flat[inner] = ids
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "n_tokens", "token_ids"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 order: tuple[str, ...] = ("doc_id",), encoding: str = "dictionary",
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Tokenise every whole text and write the token files in ``order``
    (columns of ``docs``).  One shuffle: texts are range partitioned by the
    order, then encoded where they are written."""
    keys = [f"_k{i}" for i in range(len(order))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)],
                       F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out = rows.mapInArrow(_tokenise(tokenizer or default_tokenizer(), end_id),
                          "doc_id long, n_tokens int, token_ids array<int>")
    dictionary = {"dictionary": "true", "delta": "false"}[encoding]
    with arrow_rows(docs.sparkSession):
        (out.write.option("compression", "zstd")
         .option("parquet.writer.version", "PARQUET_2_0")
         .option("parquet.block.size", row_group_bytes)
         .option("parquet.page.size", page_bytes)
         .option("parquet.enable.dictionary", "false")
         .option("parquet.enable.dictionary#token_ids.list.element", dictionary)
         .parquet(path))


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The token files; name columns and filter on doc_id to read selectively.
    ``part`` and ``row`` give the order of writing."""
    files = spark.read.schema("doc_id long, n_tokens int, token_ids array<int>").parquet(path)
    return files.select(file_place("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("row"),
                        *(columns or ("doc_id", "n_tokens", "token_ids")))


def with_start(rows: DataFrame) -> DataFrame:
    """Adds ``start`` (ids of all documents before) to rows of part, row and
    n_tokens.  Totals per file are summed over files; within a file a window
    adds the documents before, so no task sees more than one file's rows."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    files = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(files, "part")
            .withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .drop("before"))


def index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens) from the metadata columns alone."""
    return with_start(read_tokens(spark, path, "doc_id", "n_tokens")).select("doc_id", "start", "n_tokens")


@remembering("pieces")
def _digest(batches):
    for b in small_batches(batches, 1000):
        ids = b.column(3)
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:z]) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
            names=["part", "row", "doc_id", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its ids in the files."""
    rows = read_tokens(spark, path, "doc_id", "token_ids").mapInArrow(
        _digest, "part long, row long, doc_id long, n_tokens long, ids_crc32 long")
    with arrow_rows(spark):
        rows = materialize(rows, "token-digests")      # the token pages are read once
    return with_start(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
