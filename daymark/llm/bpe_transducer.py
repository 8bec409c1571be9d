"""Byte-level BPE through a minimal acyclic transducer of frequent words.

The frequent words of the corpus are compiled into an acyclic automaton that shares suffixes
(minimal: no two states accept the same endings).  Arcs carry numbers whose sum along a path is
the word's place in a table of token ids, so the automaton is a transducer from words to ids.  It is
one flat file that every task maps into memory and walks for many words at a time.  Words that
it does not accept are merged exactly, pair by pair in rank order.
"""

from __future__ import annotations

import heapq
import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.memo import Memo
from daymark.llm.shared import most_frequent, send_files, shared_folder, ship, write_file
from daymark.llm.words import binary_column, chunks, gather, unique_spans

#: Frequent words in the lexicon; bounds its file and the driver's part.
LEXICON_WORDS = 30_000
_COUNT_BYTES = 8 << 20
_NO_RANK = np.int64(2**62)
_ROWS = 8192
_LONG = 128


class ByteBpe:
    """Vocabulary and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        to_byte = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for token, number in vocab.items():
            tokens[number] = bytes(to_byte[c] for c in token)
        for token, number in self.special.items():
            tokens[number] = token.encode()
        self.size = size
        self.token_ends = np.cumsum([len(t) for t in tokens])
        self.token_starts = self.token_ends - np.array([len(t) for t in tokens])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in to_byte.items():
            self.byte_ids[byte] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.pair_made = keys[order], order, made[order]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair; a negative id merges with nothing."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        found = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[at], _NO_RANK), self.pair_made[at]

    def merge(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct words, one after the other, and how many each has."""
        lengths = end - begin
        counts = np.zeros(len(begin), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        short = order[lengths[order] <= _LONG]
        for lo in range(0, len(short), _ROWS):
            rows = short[lo : lo + _ROWS]
            width = int(lengths[rows[-1]])
            place = np.minimum(begin[rows, None] + np.arange(width), len(data) - 1)
            ids = np.where(np.arange(width) < lengths[rows, None], self.byte_ids[data[place]], -1)
            ids = self._merge_rows(ids)
            counts[rows] = (ids >= 0).sum(axis=1)
            parts.append((rows, ids[ids >= 0]))
        for row in order[len(short) :]:
            ids = self._merge_one(self.byte_ids[data[begin[row] : end[row]]].tolist())
            counts[row] = len(ids)
            parts.append((np.array([row]), np.array(ids, np.int64)))
        starts = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int64)
        for rows, ids in parts:
            flat[gather(starts[rows], counts[rows])] = ids
        return flat, counts

    def _merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Merge the first of the lowest-ranked pairs of each row until there is none."""
        if ids.shape[1] < 2:
            return ids
        ranks, made = self._pairs(ids[:, :-1], ids[:, 1:])
        live = np.arange(len(ids))
        done = ids.copy()
        while True:
            at = ranks.argmin(axis=1)
            rows = np.arange(len(ids))
            more = ranks[rows, at] < _NO_RANK
            if not more.all():
                done[live[~more], : ids.shape[1]] = ids[~more]
                done[live[~more], ids.shape[1] :] = -1
                ids, ranks, made, live, at = ids[more], ranks[more], made[more], live[more], at[more]
                rows = np.arange(len(ids))
                if not len(ids):
                    return done
            new = made[rows, at]
            width = ids.shape[1]
            shift = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])
            ids = np.take_along_axis(ids, shift, axis=1)
            ids[rows, at] = new
            if width == 2:
                done[live, :1] = ids
                done[live, 1:] = -1
                return done
            shift = np.arange(width - 2) + (np.arange(width - 2) >= at[:, None])
            ranks, made = np.take_along_axis(ranks, shift, axis=1), np.take_along_axis(made, shift, axis=1)
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < width - 2))
                ranks[ok, side[ok]], made[ok, side[ok]] = self._pairs(ids[ok, side[ok]], ids[ok, side[ok] + 1])

    def _merge_one(self, ids: list[int]) -> list[int]:
        """The same for one long word, with a heap over its pairs."""
        keys, rank_of, made_of = self._table
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                k = keys.get(ids[i] * self.size + ids[j])
                if k is not None:
                    heapq.heappush(heap, (rank_of[k], i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = made_of[keys[left * self.size + right]], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    @property
    def _table(self):
        if not hasattr(self, "_found"):
            self._found = ({k: i for i, k in enumerate(self.pair_keys.tolist())}, self.pair_ranks.tolist(), self.pair_made.tolist())
        return self._found

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.token_ends[ids] - self.token_starts[ids]
        return self.token_bytes[gather(self.token_starts[ids], lengths)].tobytes()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it is printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


class Transducer:
    """The automaton over flat arrays; ``build`` makes them, ``walk`` follows many words at once."""

    def __init__(self, flat: np.ndarray):
        sizes = [int(x) for x in flat[:5]]
        parts, at = [], 5
        for size in sizes:
            parts.append(flat[at : at + size])
            at += size
        self.arc_keys, self.arc_targets, self.arc_skips, self.final, self.id_table = parts
        self.ids = self.id_table[int(self.id_table[0]) + 2 :]

    @staticmethod
    def build(words: list[bytes], id_lists: list[np.ndarray]) -> np.ndarray:
        """``words`` sorted and distinct, with the ids of each."""
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def settle(node: list) -> int:
            made = (node[0], tuple(node[1]))
            if made not in register:
                register[made] = len(states)
                states.append(made)
            return register[made]

        path: list[list] = [[False, []]]  # states of the last word that may still grow: final, arcs
        last = b""
        for word in words:
            same = len(os.path.commonprefix([word, last]))
            while len(path) > same + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], settle(node)))
            path.extend([False, []] for _ in word[same:])
            path[-1][0] = True
            last = word
        while len(path) > 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(node)))
        root = settle(path[0])

        accepted = np.zeros(len(states), np.int64)
        keys, targets, skips = [], [], []
        for number, (final, arcs) in enumerate(states):  # targets were settled before
            count = int(final)
            for byte, target in arcs:
                keys.append(number * 256 + byte)
                targets.append(target)
                skips.append(count)
                count += int(accepted[target])
            accepted[number] = count
        final = np.array([*(int(f) for f, _ in states), root], np.int64)
        ends = np.cumsum([len(x) for x in id_lists], dtype=np.int64) if id_lists else np.zeros(0, np.int64)
        table = np.concatenate([[len(id_lists)], [0], ends, *id_lists]).astype(np.int64)
        arrays = [np.array(keys, np.int64), np.array(targets, np.int64), np.array(skips, np.int64), final, table]
        return np.concatenate([np.array([len(x) for x in arrays], np.int64), *arrays])

    def walk(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of each word in the lexicon, or -1."""
        out = np.full(len(begin), -1, np.int64)
        if not len(self.arc_keys):
            return out
        live = np.arange(len(begin))
        state = np.full(len(begin), self.final[-1], np.int64)
        place = np.zeros(len(begin), np.int64)
        step = 0
        while len(live):
            over = end[live] - begin[live] == step
            arrived = over & (self.final[state] == 1)
            out[live[arrived]] = place[arrived]
            live, state, place = live[~over], state[~over], place[~over]
            key = state * 256 + data[begin[live] + step]
            arc = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
            there = self.arc_keys[arc] == key
            live, arc = live[there], arc[there]
            state, place = self.arc_targets[arc], place[there] + self.arc_skips[arc]
            step += 1
        return out

    def outputs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by place, one after the other, and how many each has."""
        starts, ends = self.id_table[1 + places], self.id_table[2 + places]
        return self.ids[gather(starts, ends - starts)], ends - starts


def build_lexicon(documents: DataFrame, tokenizer_path: str, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of all texts; returns the name of the file sent to all tasks.

    Counts are over all documents; ties go to the lesser word.  The driver gets ``words`` words.
    """
    spark = documents.sparkSession
    ship(spark)
    folder = shared_folder(spark, "lexicon")
    top = most_frequent(documents.select("text").mapInArrow(_span_counts, "word binary, n long"), words, folder)
    bpe = byte_bpe(tokenizer_path)
    pieces = {p for row in top for p in _pieces(bytes(row.word), bpe) if isinstance(p, bytes)}
    lexicon = sorted(pieces)
    flat, lengths = bpe.merge(*_spans(lexicon)) if lexicon else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    arrays = Transducer.build(lexicon, np.split(flat, np.cumsum(lengths)[:-1]) if lexicon else [])
    name = f"lexicon-{uuid.uuid4().hex}.i64"
    write_file(f"{folder}/{name}", arrays.tobytes())
    send_files(spark, [f"{folder}/{name}"])
    return name


def encode_documents(documents: DataFrame, tokenizer_path: str, lexicon: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit numbers); a null text is empty.

    The ids are those of the tokenizers library for the same file, without special tokens added.
    A special token's string within a text is that token.
    """
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        lambda batches: _encode(batches, tokenizer_path, lexicon), "doc_id long, n_tokens long, ids binary"
    )


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``; bytes that are not UTF-8 become U+FFFD."""
    ship(encoded.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(lambda batches: _decode(batches, tokenizer_path), f"{fields}, decoded string")


def round_trip(documents: DataFrame, tokenizer_path: str, lexicon: str) -> DataFrame:
    """``encode_documents`` and ``decode_documents`` of its ids, in one worker process for each task instead of two."""
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        lambda batches: _decode(_encode(batches, tokenizer_path, lexicon), tokenizer_path),
        "doc_id long, n_tokens long, ids binary, decoded string",
    )


def _decode(batches: Iterator[pa.RecordBatch], tokenizer_path: str) -> Iterator[pa.RecordBatch]:
    bpe = byte_bpe(tokenizer_path)
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            rows = batch.slice(lo, 512)
            ids = rows.column(rows.schema.get_field_index("ids"))
            texts = [bpe.decode(np.frombuffer(x.as_buffer(), "<u4")).decode("utf-8", "replace") for x in ids]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*rows.schema.names, "decoded"])


def _encode(batches: Iterator[pa.RecordBatch], tokenizer_path: str, lexicon: str) -> Iterator[pa.RecordBatch]:
    bpe = byte_bpe(tokenizer_path)
    path = SparkFiles.get(lexicon)
    memo = Memo(lambda *spans: _ids_of(*spans, bpe, transducer))
    transducer = Transducer(np.memmap(path, np.int64, "r"))
    for batch in batches:
        for lo, hi, edges, data in chunks(batch.column(1)):
            begin, end = text_spans(edges, data)
            flat, lengths = memo(data, begin, end)
            upto = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(begin, edges)]
            cuts = (upto * 4).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cuts), pa.py_buffer(flat.astype("<u4").tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(upto)), ids], ["doc_id", "n_tokens", "ids"]
            )


def text_spans(edges: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut texts before spaces where the pre-tokenizer surely cuts, whatever is on the other side.

    That is so before a space after a character that is not white space, and before the last space of a run
    that an ASCII character ends (other than '<', which may begin a special token).
    """
    n = len(data)
    padded = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(1, np.uint8)])
    at = np.flatnonzero(data == 0x20)
    prev, prev2, prev3, after = (padded[at + k] for k in (2, 1, 0, 4))
    visible = lambda b: (b < 0x80) & (b > 0x20)
    inside = np.zeros(n + 1, bool)
    inside[edges] = True
    first, last = inside[at], inside[at + 1]
    # characters of two bytes from C3 on, of three bytes outside E1-E3, or of four are not white space
    two = (prev >= 0x80) & (prev2 >= 0xC3) & (prev2 < 0xE0)
    more = (prev >= 0x80) & (prev2 >= 0x80) & (prev2 < 0xC0) & (prev3 >= 0x80) & ((prev3 < 0xE1) | (prev3 > 0xE3))
    safe = visible(prev) | two | more | (visible(after) & (after != 0x3C) & ~last)
    cut = np.zeros(n + 1, bool)
    cut[edges] = True
    cut[at[safe & ~first]] = True
    cut[n] = False
    begin = np.flatnonzero(cut)
    return begin, np.append(begin[1:], n) if len(begin) else begin


def _span_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, edges, data in chunks(batch.column(0), _COUNT_BYTES):
            begin, end = text_spans(edges, data)
            if len(begin):
                distinct, example, number = unique_spans(data, begin, end)
                for lo in range(0, len(example), 50_000):
                    part = example[lo : lo + 50_000]
                    counts = np.bincount(number, minlength=len(distinct))[lo : lo + 50_000]
                    yield pa.RecordBatch.from_arrays([binary_column(data, begin[part], end[part]), pa.array(counts)], ["word", "n"])


@lru_cache(maxsize=1)
def _pattern():
    import regex

    # fixed values: the pre-tokenizer's pattern
    return regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _pieces(span: bytes, bpe: ByteBpe) -> list[bytes | int]:
    """The words of a span as bytes; a special token as its id."""
    text = span.decode()
    if (text[1:] if text[:1] == " " else text).isalpha():
        return [span]
    out: list[bytes | int] = []
    for name, number in bpe.special.items():
        if name in text:
            for k, part in enumerate(text.split(name)):
                out += ([number] if k else []) + (_pieces(part.encode(), bpe) if part else [])
            return out
    return [p.encode() for p in _pattern().findall(text)]


def _spans(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    return np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends


def _ids_of(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, bpe: ByteBpe, transducer: Transducer
) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of distinct spans: by the lexicon, else merged."""
    body = data.tobytes()
    number: dict[bytes | int, int] = {}
    pieces: list[int] = []
    per_span = np.zeros(len(begin), np.int64)
    for i, (b, e) in enumerate(zip(begin.tolist(), end.tolist())):
        found = _pieces(body[b:e], bpe)
        per_span[i] = len(found)
        pieces += [number.setdefault(p, len(number)) for p in found]
    words = [p for p in number if isinstance(p, bytes)]
    of_word = np.array([number[p] for p in words], np.int64)
    counts = np.ones(len(number), np.int64)
    starts = np.zeros(len(number), np.int64)
    flat_parts = []
    size = 0

    def keep(which: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        nonlocal size
        counts[which] = lengths
        starts[which] = size + np.cumsum(lengths) - lengths
        flat_parts.append(np.asarray(flat, np.int64))
        size += len(flat)

    if words:
        wdata, wbegin, wend = _spans(words)
        place = transducer.walk(wdata, wbegin, wend)
        known = place >= 0
        if known.any():
            keep(of_word[known], *transducer.outputs(place[known]))
        if not known.all():
            keep(of_word[~known], *bpe.merge(wdata, wbegin[~known], wend[~known]))
    special = [(k, p) for p, k in number.items() if not isinstance(p, bytes)]
    if special:
        keep(np.array([k for k, _ in special]), np.array([p for _, p in special]), np.ones(len(special), np.int64))
    flat = np.concatenate(flat_parts) if flat_parts else np.zeros(0, np.int64)
    chosen = np.array(pieces, np.int64)
    ids = flat[gather(starts[chosen], counts[chosen])] if len(chosen) else flat[:0]
    owner = np.repeat(np.arange(len(begin)), per_span)
    return ids, np.bincount(owner, weights=counts[chosen], minlength=len(begin)).astype(np.int64) if len(chosen) else per_span
