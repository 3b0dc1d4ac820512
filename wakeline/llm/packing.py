"""Harmonic packing of tokenised documents into sequences without padding.

A document is cut into pieces whose lengths are the reciprocal classes capacity / k with k a power of two: as many whole
sequences as it fills, then the binary parts of the rest. Each class fills its own bins with exactly k pieces, so every
worker packs by itself and each full bin is a full sequence. When a worker ends, the pieces left in a class's last bin
are regrouped into bins of a power-of-two length, which need no padding either.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, span_hashes, trim, word_spans

SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Pieces of text that the pattern of the vocabulary file keeps; white space never occurs within one.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_LOADED: dict = {}


class Encoder:
    """Whole texts to ids, by the tokenizer file itself for each string of ink it has not seen lately.

    White space separates strings, so a text's ids are those of its strings in turn. Strings are told apart by 64-bit
    hashes of their bytes; their ids lie in one growing array. At `most` strings all are forgotten, which costs time only.
    """

    def __init__(self, path: str, most: int = 800_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same vocabulary for pieces that are lower-cased and cut already: many at a time, with spaces between
        self.bare = Tokenizer.from_str(json.dumps(json.loads(self.tokenizer.to_str()) | {"normalizer": None, "added_tokens": []}))
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        #: strings that the file takes out of a text before anything else
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.shortest = min(map(len, self.special), default=0)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.pieces = regex.compile(PATTERN).findall
        self.plain = regex.compile("[\x21-\x7eÀ-ɏ]+").fullmatch
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def lower(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for strings of common Latin letters, digits and marks, from lower-cased pieces; the last
        token of each piece carries the mark of a word's end."""
        flat, counts = [], []
        for s in strings:
            low = s.lower()
            if low.isalpha():
                flat.append(low)
                counts.append(1)
            else:
                pieces = self.pieces(low)
                flat += pieces
                counts.append(len(pieces))
        ids = np.array([i for k in range(0, len(flat), 4096) for i in self.bare.encode(" ".join(flat[k : k + 4096]), add_special_tokens=False).ids], "<u4")
        last = (np.flatnonzero(self.ends[ids]) + 1)[np.cumsum(counts) - 1] if flat else np.zeros(0, np.int64)
        return ids, np.diff(last, prepend=0)

    def learn(self, keys: list[int], strings: list[str]) -> None:
        easy = [bool(s.isascii() and s.isprintable() or self.plain(s)) and not (len(s) >= self.shortest and any(x in s for x in self.special)) for s in strings]
        ids, size = self.lower([s for s, ok in zip(strings, easy, strict=True) if ok])
        rest = self.whole([s for s, ok in zip(strings, easy, strict=True) if not ok])
        keys = [k for k, ok in zip(keys, easy, strict=True) if ok] + [k for k, ok in zip(keys, easy, strict=True) if not ok]
        ids, size = np.concatenate([ids, *rest]), np.concatenate([size, [len(r) for r in rest]]).astype(np.int64)
        n = len(self.slots)
        while len(self.begin) < n + len(keys):
            self.begin, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.begin, self.size))
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.begin[n : n + len(keys)] = self.used + np.cumsum(size) - size
        self.size[n : n + len(keys)] = size
        self.slots.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.used += len(ids)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of some rows, their offsets among these)."""
        for first, _, a, offsets in chunks(column, 4 << 20, lower=False):
            b, e, at = word_spans(a, offsets)
            keys, place, back = np.unique(span_hashes(a, b, e), return_index=True, return_inverse=True)
            keys = keys.tolist()
            slots = list(map(self.slots.get, keys))
            if len(self.slots) + slots.count(None) > self.most:
                self.forget()
                slots = [None] * len(keys)
            if None in slots:
                new = [k for k, s in enumerate(slots) if s is None]
                raw = a.tobytes()
                self.learn([keys[k] for k in new], [raw[i:j].decode() for i, j in zip(b[place[new]].tolist(), e[place[new]].tolist(), strict=True)])
                slots = list(map(self.slots.get, keys))
            slot = np.array(slots, np.int64)[back] if keys else np.zeros(0, np.int64)
            size = self.size[slot]
            until = np.concatenate(([0], np.cumsum(size)))
            ids = self.ids[np.arange(until[-1]) + np.repeat(self.begin[slot] - until[:-1], size)]
            yield first, ids, until[at]


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, then the binary parts of the rest, longest first."""
    full = n - n % capacity
    out = [(i, capacity) for i in range(0, full, capacity)]
    at, rest = full, n % capacity
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


class Bins:
    """Sequence ids and offsets by class; ids start at `first`."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next = capacity, first
        self.open: dict[int, list] = {}

    def add(self, piece: tuple) -> list[tuple]:
        """piece: (id, start, length, ids, doc_tokens). Gives the rows of a bin that it fills."""
        size = piece[2]
        held = self.open.setdefault(size, [])
        held.append(piece)
        if len(held) * size < self.capacity:
            return []
        self.open[size] = []
        return self.close(held)

    def close(self, held: list[tuple]) -> list[tuple]:
        self.next += 1
        return [(*p, self.next - 1, k * p[2]) for k, p in enumerate(held)]

    def rest(self) -> list[tuple]:
        """The last bins, in groups of as many pieces as the binary parts of their number."""
        out = []
        for held in self.open.values():
            for at, n in cuts(len(held), 1 << 62):
                out += self.close(held[at : at + n])
        return out


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Every document is its whole text's ids and then end_id; a null text is the end_id alone, and rows that repeat are
    packed each. capacity is a power of two. Sequence ids are unique over all workers. An empty table gives no rows.
    Without a path, the public word-level vocabulary of the machine is used.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path = tokenizer_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        enc, bins = encoder(path), Bins(capacity, TaskContext.get().partitionId() << 40)

        def rows(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [[]] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for first, flat, at in enc.encode(batch.column(1)):
                out, packed, at = [], flat.tobytes(), (4 * at).tolist()
                for key, i, j in zip(batch.column(0)[first : first + len(at) - 1].to_pylist(), at[:-1], at[1:], strict=True):
                    ids = packed[i:j] + end
                    n = len(ids) // 4
                    for start, length in cuts(n, capacity):
                        out += bins.add((key, start, length, ids[4 * start : 4 * (start + length)], n))
                yield rows(out, kind)
        if kind is not None:
            yield rows(bins.rest(), kind)
        trim()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def digests(packed: DataFrame) -> DataFrame:
    """packed with the CRC-32 of each piece's ids instead of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
