"""Token ids in binary files of fixed-width numbers, with block offsets for random access.

A file holds the ids of a run of documents.  Ids take the fewest bits that hold the vocabulary and
are packed in blocks of BLOCK ids, each a whole number of 64-bit words, so that any block unpacks
by itself in numpy.  Layout, in little-endian 64-bit words:

    header: magic, width, ids a block, documents, ids, place of the tables
    blocks of packed ids
    tables: the place of each block; each document's id; whether it is null; its last id's end

Files of a run are listed in a manifest, which is what readers follow: a repeated task writes a
file under another name, and only the one that a finished task reported is in the manifest.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from daymark.llm.bits import pack, unpack
from daymark.llm.memo import Memo
from daymark.llm.shared import partitions, ship
from daymark.llm.words import split_words

BLOCK = 4096
_MAGIC = 0x314B4F544D594144
_HEADER = 6
_READ_IDS = 1 << 19
#: Stands between words that are encoded together: a control character, of one byte in UTF-8.
_MARK = "\x01"
_JOINED = 1024


def write_token_files(documents: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> list[Row]:
    """Encode all texts in ascending doc_id order into files below ``folder``; returns the manifest.

    The tokenizer must drop white space, as its words are encoded apart from each other.  Null
    texts are empty, each document ends with ``end_id``.  Null ids come first; rows with equal ids,
    of which any number may be, come in the order of a hash of their texts.  Manifest rows: part, path, n_docs, n_ids, in that order.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = (
        rows.withColumn("row", F.monotonically_increasing_id())  # equal rows may lie in several tasks
        .repartitionByRange(partitions(spark), *order, "row")
        .sortWithinPartitions(*order, "row")
        .select("doc_id", "text")
    )
    manifest = ordered.mapInArrow(
        lambda batches: _write(batches, tokenizer_path, end_id, folder), "part int, path string, n_docs long, n_ids long"
    )
    return sorted(manifest.collect(), key=lambda row: row.part)


def read_token_files(spark: SparkSession, manifest: list[Row]) -> DataFrame:
    """``doc_id``, ``start`` (ids before the document, over all files), ``ids`` (little-endian 32-bit)."""
    if not manifest:
        return spark.createDataFrame([], "doc_id long, start long, ids binary")
    base, rows = 0, []
    for at, row in enumerate(manifest):
        rows.append((at, row.path, base))
        base += row.n_ids
    files = spark.createDataFrame(rows, "at int, path string, base long")
    files = files.repartitionById(len(rows), F.col("at"))
    return files.mapInArrow(_read, "doc_id long, start long, ids binary")


def _write(batches: Iterator[pa.RecordBatch], tokenizer_path: str, end_id: int, folder: str) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    out = writer = None
    for batch in batches:
        if writer is None:
            memo, width = _word_memo(tokenizer_path)
            part = TaskContext.get().partitionId()
            uri = f"{folder}/tokens-{part:05d}-{uuid.uuid4().hex}.bin"
            fs, path = FileSystem.from_uri(uri)
            out = fs.open_output_stream(path)
            writer = TokenWriter(out, max(width, int(end_id).bit_length()))
        ids = batch.column(0)
        for w in split_words(batch.column(1)):
            flat, lengths = memo(w.data, w.begin, w.end)
            upto = np.concatenate([[0], np.cumsum(lengths)])[w.first]
            # the end id after each text
            flat = np.insert(flat, upto[1:], end_id)
            writer.add(ids.slice(w.lo, w.texts), np.diff(upto) + 1, flat)
    if writer is not None:
        writer.close()
        out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([uri]), pa.array([writer.n_docs]), pa.array([writer.n_ids])],
            ["part", "path", "n_docs", "n_ids"],
        )


@lru_cache(maxsize=1)
def _word_memo(path: str) -> tuple[Memo, int]:
    """What a worker process remembers of the words it encoded, and the width that holds the vocabulary."""
    encode, width = _word_encoder(path)
    return Memo(encode), width


def _word_encoder(path: str):
    """Encodes distinct words with the tokenizers library; the width that holds its vocabulary.

    Words go to the library many at a time, with a mark between each two, where the mark has an id that
    no other word can have; else one by one.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    mark = tokenizer.encode(_MARK, add_special_tokens=False).ids

    def encode(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        body = data.tobytes()
        words = [body[b:e].decode() for b, e in zip(begin.tolist(), end.tolist())]
        if len(mark) != 1 or _MARK.encode() in body:
            lists = [x.ids for x in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.fromiter((i for x in lists for i in x), np.int32, int(lengths.sum())), lengths
        between = f" {_MARK} "
        texts = [between.join(words[lo : lo + _JOINED]) + between for lo in range(0, len(words), _JOINED)]
        ids = np.concatenate([np.array(x.ids, np.int32) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(ids == mark[0])
        return ids[ids != mark[0]], np.diff(ends, prepend=-1) - 1

    return encode, max(1, (max(tokenizer.get_vocab(with_added_tokens=True).values())).bit_length())


class TokenWriter:
    """Writes one file to a binary stream, block by block."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_docs = 0
        self.at = _HEADER
        self.blocks: list[int] = []
        self.doc_ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        # where the tables begin is known at the end only: the last word of the file says so
        out.write(np.array([_MAGIC, width, BLOCK, 0, 0, 0], "<u8").tobytes())

    def add(self, doc_ids: pa.Array, lengths: np.ndarray, flat: np.ndarray) -> None:
        self.nulls.append(np.asarray(doc_ids.is_null().to_numpy(zero_copy_only=False)))
        self.doc_ids.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False))
        self.ends.append(self.n_ids + np.cumsum(lengths))
        self.n_docs += len(lengths)
        self.n_ids += len(flat)
        self.held.append(flat)
        self.n_held += len(flat)
        if self.n_held >= 64 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.int32)
        upto = len(ids) if last else len(ids) // BLOCK * BLOCK
        for lo in range(0, upto, BLOCK):
            words = pack(ids[lo : min(lo + BLOCK, upto)], self.width)[:-1]
            self.blocks.append(self.at)
            self.out.write(words.astype("<u8").tobytes())
            self.at += len(words)
        self.held, self.n_held = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._flush(True)
        none = [np.zeros(0, np.int64)]
        tables = np.concatenate(
            [
                np.array(self.blocks, np.int64), np.concatenate(self.doc_ids or none),
                np.concatenate(self.nulls or none).astype(np.int64), np.concatenate(self.ends or none),
                np.array([len(self.blocks), self.n_docs, self.n_ids, self.at], np.int64),
            ]
        )
        self.out.write(tables.astype("<i8").tobytes())


class TokenFile:
    """Random access to a file's ids; reads only the blocks that it needs."""

    def __init__(self, source):
        self.source = source
        head = np.frombuffer(self._words(0, _HEADER), "<u8")
        if head[0] != _MAGIC:
            raise ValueError("not a token file")
        self.width, self.block = int(head[1]), int(head[2])
        size = source.size() // 8
        n_blocks, self.n_docs, self.n_ids, at = (int(x) for x in np.frombuffer(self._words(size - 4, 4), "<i8"))
        tables = np.frombuffer(self._words(at, size - 4 - at), "<i8")
        self.blocks = np.append(tables[:n_blocks], at)
        self.doc_ids = tables[n_blocks : n_blocks + self.n_docs]
        self.nulls = tables[n_blocks + self.n_docs : n_blocks + 2 * self.n_docs].astype(bool)
        self.ends = tables[n_blocks + 2 * self.n_docs :]

    def _words(self, at: int, count: int) -> bytes:
        return self.source.read_at(count * 8, at * 8)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """The ids ``lo:hi`` of the file."""
        if lo >= hi:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block, (hi - 1) // self.block
        words = np.frombuffer(self._words(int(self.blocks[first]), int(self.blocks[last + 1] - self.blocks[first])), "<u8")
        words = np.append(words.astype(np.uint64), np.uint64(0))
        out = []
        for k in range(first, last + 1):
            count = min(self.block, self.n_ids - k * self.block)
            part = words[self.blocks[k] - self.blocks[first] :]
            out.append(unpack(part, self.width, count).astype(np.uint32))
        return np.concatenate(out)[lo - first * self.block : hi - first * self.block]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    for batch in batches:
        for row in batch.select(["path", "base"]).to_pylist():
            fs, path = FileSystem.from_uri(row["path"])
            with fs.open_input_file(path) as source:
                tokens = TokenFile(source)
                starts = np.concatenate([[0], tokens.ends[:-1]]).astype(np.int64)[: tokens.n_docs]
                lo = 0
                while lo < tokens.n_docs:
                    hi = max(lo + 1, int(np.searchsorted(tokens.ends, starts[lo] + _READ_IDS, "right")))
                    ids = tokens.ids(int(starts[lo]), int(tokens.ends[hi - 1])).astype("<u4")
                    cuts = ((np.append(starts[lo:hi], tokens.ends[hi - 1]) - starts[lo]) * 4).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(tokens.doc_ids[lo:hi], pa.int64(), mask=tokens.nulls[lo:hi]),
                            pa.array(starts[lo:hi] + row["base"]),
                            pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cuts), pa.py_buffer(ids.tobytes())]),
                        ],
                        ["doc_id", "start", "ids"],
                    )
                    lo = hi


