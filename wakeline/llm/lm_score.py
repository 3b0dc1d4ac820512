"""Scoring texts with a probabilistic suffix tree over words.

States are the empty context and the one- and two-word contexts that predict their next word better than the empty one
does: a context is retained when its leave-one-out log-likelihood ratio (its divergence, counted without the occurrence
at hand) is positive. Its distribution keeps the words seen at least three times, whatever the size of the corpus,
discounted, and leaves the rest of its mass to that of the next shorter retained suffix, at last to the smoothed word
distribution. A word is scored by the longest retained suffix of what precedes it that beats the next shorter one by that
measure.

Nothing of the corpus is held whole anywhere. Counts are packed arrays dealt into buckets of a key space, of 64 bits for
words and of 48 or more for pairs and triples; texts ask for the counts they need by block of input and get them back
aligned to their sorted keys. What is broadcast is small: bit maps of pairs seen so often and of kept triples
(2 ** pair_bits and 2 ** triple_bits bits), which only keep others from being sent and grow with the training text up to
MOST_BITS. Only a table of rounded word counts (2 ** count_bits bytes), which the retention test uses, grows with the
vocabulary: two to four bytes a word that is seen at least three times.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffers, chunks, cut, mix, partitions, small_batches, trim, word_hashes

_U = np.uint64
_K = _U(0x9E3779B97F4A7C15)
END = int(mix(np.array([0x2545F4914F6CDD1D], np.uint64))[0])
DISCOUNT = 0.75
#: How often a pair or triple must occur at least to be kept in a context's distribution, at any size of corpus.
LEAST = 3
#: Bits of the map of pairs, as a power of 2: from 4 bytes of training text for a bit, within these bounds.
LEAST_BITS, MOST_BITS = 26, 29
#: Bits of the keys of pairs and triples at least. From 64 GB of training text they grow with it, so that of the keys that
#: are looked up at most about one in 70,000 meets another one's counts (at 0.5 GB, one in 9 million).
LEAST_KEY_BITS = 48
#: Bytes of the table of word counts at least, as a power of 2.
LEAST_COUNTS = 23
PACKED = "bucket int, kind int, block long, k binary, v binary"
NAMES = ["bucket", "kind", "block", "k", "v"]
#: Next words of one context are told apart by the upper 40 bits of their hashes: two of 100,000 meet with a probability of 0.5 %.
_AFTER = ~_U((1 << 24) - 1)


def _free(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files of plans that are done."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    """Keys of which the upper bits stay: differences of sorted keys then end with zeros, which compression removes."""
    return keys & ~_U((1 << (64 - bits)) - 1)


def _triples(pair: np.ndarray, after: np.ndarray, q: int, key_bits: int) -> np.ndarray:
    """Keys of triples, which lie in the bucket of their context, a pair."""
    return _cut((pair & ~_U((1 << (64 - q)) - 1)) | (mix(pair * _K + after) >> _U(q)), key_bits)


class Keys:
    """Of a list of texts: words with the end mark, and the keys of pairs and triples that end at each of them."""

    def __init__(self, column: pa.Array, q: int, key_bits: int) -> None:
        words, sizes = [], []
        for _, _, a, offsets in chunks(column):
            h, at = word_hashes(a, offsets)
            words.append(np.insert(h, at[1:], _U(END)))
            sizes.append(np.diff(at) + 1)
        self.w = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        n = len(self.w)
        #: how many words of the same text precede each
        self.depth = np.arange(n) - np.repeat(self.starts, self.sizes)
        self.pair = np.zeros(n, np.uint64)
        self.triple = np.zeros(n, np.uint64)
        if n:
            self.pair[1:] = _cut(mix(self.w[:-1] * _K + self.w[1:]), key_bits)
            self.triple[1:] = _triples(self.pair[:-1], self.w[1:] & _AFTER, q, key_bits)

    def known(self, bits: np.ndarray, pair_bits: int, kept: np.ndarray | None = None, triple_bits: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Which positions end a pair, and a triple, of whose pairs the bit map has all; with the map of kept triples
        only those."""
        two = (self.depth >= 1) & _marked(bits, self.pair >> _U(64 - pair_bits))
        three = two & (self.depth >= 2)
        three[1:] &= two[:-1]
        if kept is not None:
            three &= _marked(kept, self.triple >> _U(64 - triple_bits))
        return two, three


def _marked(bits: np.ndarray, i: np.ndarray) -> np.ndarray:
    return ((bits[i >> _U(3)] >> (_U(7) - (i & _U(7))).astype(np.uint8)) & 1).astype(bool)


def _planes(x: np.ndarray) -> bytes:
    """First all lowest bytes, then all next ones: high bytes of small numbers make runs that compression removes."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplaned(data: bytes, dtype: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _zipped(data: bytes) -> bytes:
    """Compressed, after its size: bytes of small numbers take few bits, which the codec of shuffles doesn't reach."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if data else b""


def _unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True) if data else b""


def _thin(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, by planes."""
    return _zipped(_planes(np.diff(keys, prepend=keys.dtype.type(0))))


def _full(data: bytes, dtype: str = "<u8") -> np.ndarray:
    return np.cumsum(_unplaned(_unzipped(data), dtype), dtype=dtype)


def _values(*values: np.ndarray) -> bytes:
    """Arrays one after the other."""
    return _zipped(b"".join([_planes(v) for v in values]))


def _parts(data: bytes, *dtypes: str) -> list[np.ndarray]:
    """The arrays of _values, which are equally long."""
    data, at, out = _unzipped(data), 0, []
    n = len(data) // sum(np.dtype(t).itemsize for t in dtypes)
    for t in dtypes:
        out.append(_unplaned(data[at : at + n * np.dtype(t).itemsize], t))
        at += n * np.dtype(t).itemsize
    return out


def _dealt(kind: int, block: int, keys: np.ndarray, values: list[np.ndarray], q: int) -> Iterator[tuple]:
    """Rows by bucket, the top q bits, of sorted keys; several arrays of values follow each other."""
    at = np.searchsorted(keys >> _U(64 - q), np.arange((1 << q) + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(at)).tolist():
        i, j = at[b], at[b + 1]
        yield b, kind, block, _thin(keys[i:j]), _values(*[v[i:j] for v in values])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()], strict=True)], NAMES)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and how often each occurs."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return ordered[first], order[first], np.diff(np.append(first, len(keys))).astype("<u4")


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def _arrived(table: pa.Table, kind: int, keys: str, counts: str) -> tuple[np.ndarray, np.ndarray]:
    """All keys and counts of a kind that tasks have dealt."""
    found = [(_full(k, keys), *_parts(v, counts)) for x, k, v in zip(table["kind"].to_pylist(), table["k"].to_pylist(), table["v"].to_pylist(), strict=True) if x == kind]
    k, v = zip(*found, strict=True) if found else ([np.zeros(0, keys)], [np.zeros(0, counts)])
    return np.concatenate(k), np.concatenate(v).astype(np.int64)


def _joined(table: pa.Table, kind: int, column: str, dtype: str) -> np.ndarray:
    kinds = table["kind"].to_numpy()
    return np.frombuffer(b"".join([x for x, k in zip(table[column].to_pylist(), kinds, strict=True) if k == kind]), dtype)


# --- learning ------------------------------------------------------------------------------------------------------


#: Distinct keys that a task holds before it sends them on.
_HELD = 3_000_000


def _merged(parts: list[tuple[np.ndarray, ...]], counts: int) -> tuple[np.ndarray, ...]:
    """Arrays of parts one after the other, one row per key, the first array; the array at `counts` adds up. parts is
    emptied, column by column, so that little is held twice."""
    columns: list = [list(x) for x in zip(*parts, strict=True)]
    parts.clear()
    keys = np.concatenate(columns[0])
    columns[0] = None
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    keys = keys[first]
    out, place = [keys], order[first]
    for k in range(1, len(columns)):
        x = np.concatenate(columns[k])
        columns[k] = None
        out.append(np.add.reduceat(x[order], first) if k == counts and len(first) else x[place])
    return tuple(out)


def _by_portion(batches: Iterator[pa.RecordBatch], q: int, key_bits: int) -> Iterator[Keys]:
    for batch in batches:
        size = np.cumsum(np.diff(buffers(batch.column(0))[1]))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + (1 << 20), "right")))
            yield Keys(batch.column(0).slice(at, to - at), q, key_bits)
            at = to


def _count_words(q: int, key_bits: int):
    def sent(words: list, pairs: list) -> pa.RecordBatch:
        k, n = _merged(words, 1)
        rows = list(_dealt(0, 0, k, [n.astype("<u4")], q))
        # the 32 bits that follow the bucket's are enough to fill a bit map
        k, n = _merged(pairs, 1)
        at = np.searchsorted(k >> _U(32), np.arange((1 << q) + 1, dtype=np.uint64))
        # cut at LEAST, which is all that a bit map asks: a sum of cut counts reaches it just when the sum of counts does
        low, n = k.astype("<u4"), np.minimum(n, LEAST).astype("<u2")
        rows += [(b, 1, 0, _thin(low[at[b] : at[b + 1]]), _values(n[at[b] : at[b + 1]])) for b in np.flatnonzero(np.diff(at)).tolist()]
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = [], []
        for t in _by_portion(batches, q, key_bits):
            words.append(np.unique(t.w, return_counts=True))
            pairs.append(np.unique(t.pair[t.depth > 0] >> _U(32 - q), return_counts=True))
            if sum(len(k) for k, _ in pairs) > _HELD:
                yield sent(words, pairs)
                words, pairs = [], []
        if words:
            yield sent(words, pairs)
        trim()

    return run


def _sum_words(q: int, pair_bits: int):
    """Of a bucket: its words and counts (kind 0, block: their sum) and its part of the bit map (1, block: its words that
    are seen at least LEAST times)."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        words, n = _summed(*_arrived(table, 0, "<u8", "<u4"))
        pairs, m = _summed(*_arrived(table, 1, "<u4", "<u2"))
        bits = np.zeros(1 << (pair_bits - q), np.uint8)
        bits[pairs[m >= LEAST] >> (32 - (pair_bits - q))] = 1
        rows = [(bucket, 0, int(n.sum()), words.tobytes(), n.tobytes()), (bucket, 1, int((n >= LEAST).sum()), np.packbits(bits).tobytes(), b"")]
        return pa.Table.from_batches([_rows(rows)])

    return run


def _count_bits(words: int) -> int:
    return max(LEAST_COUNTS, words.bit_length() + 1)


def _cells(words: np.ndarray, n: np.ndarray, q: int, count_bits: int) -> np.ndarray:
    """A bucket's part of the count table. Rarer words than LEAST are no next words of a context and take no cell."""
    words, n = words[n >= LEAST], n[n >= LEAST]
    cells = np.zeros(1 << (count_bits - q), np.uint8)
    np.maximum.at(cells, (words >> _U(64 - count_bits)) & _U((1 << (count_bits - q)) - 1), np.minimum(255, np.ceil(6 * np.log2(n + 1))).astype(np.uint8))
    return cells


def _count_table(q: int, count_bits: int):
    """From words of buckets, kind 0: parts of the count table, kind 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, k, v in zip(*(batch.column(c).to_pylist() for c in (0, 3, 4)), strict=True):
                yield _rows([(bucket, 2, 0, _cells(np.frombuffer(k, "<u8"), np.frombuffer(v, "<i8"), q, count_bits).tobytes(), b"")])
        trim()

    return run


def _count_contexts(q: int, sent, key_bits: int, pair_bits: int):
    """kind 1: word contexts and next words; 2: pair contexts and next words; 3: pairs."""

    def ready(held: dict[int, list]) -> pa.RecordBatch:
        rows = []
        for kind in (1, 2):
            keys, context, after, n = _merged(held[kind], 3)
            if kind == 1:
                rows += _dealt(3, 0, keys, [n.astype("<u4")], q)
            del keys
            order = np.argsort(context)
            rows += _dealt(kind, 0, context[order], [after[order], n[order].astype("<u4")], q)
            del context, after, n, order
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {1: [], 2: []}
        for t in _by_portion(batches, q, key_bits):
            two, three = t.known(sent.value[0], pair_bits)
            for kind, keys, where, context in ((1, t.pair, two, t.w), (2, t.triple, three, t.pair)):
                at = np.flatnonzero(where)
                found, first, n = _distinct(keys[at])
                at = at[first]
                held[kind].append((found, context[at - 1], t.w[at] & _AFTER, n))
            if sum(len(x[0]) for kind in held for x in held[kind]) > _HELD:
                yield ready(held)
                held = {1: [], 2: []}
        if held[1]:
            yield ready(held)
        trim()

    return run


def _contexts(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, next) and their counts."""
    ks, vs = [], []
    for k, v in ((k.as_py(), v.as_py()) for k, v, x in zip(table["k"], table["v"], table["kind"].to_pylist(), strict=True) if x == kind):
        after, n = _parts(v, "<u8", "<u4")
        ks.append(np.stack((_full(k), after), 1))
        vs.append(n)
    if not ks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, n = np.concatenate(ks), np.concatenate(vs).astype(np.int64)
    order = np.lexsort((k[:, 1], k[:, 0]))
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(1))))
    return k[first, 0], k[first, 1], np.add.reduceat(n, first)


def _find(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The values at wanted in sorted keys, 0 where absent."""
    if not len(keys):
        return [np.zeros(len(wanted), v.dtype) for v in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return [np.where(hit, v[at], v.dtype.type(0)) for v in values]


def _states(context: np.ndarray, n: np.ndarray, share: np.ndarray, total_of: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Retained contexts, the mass they leave to the shorter suffix, and their gain per occurrence. n is at least LEAST
    for each; share is the next word's share of all words."""
    if not len(context):
        return context, np.zeros(0), np.zeros(0, np.float32)
    first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
    states = context[first]
    (total,) = _find(*total_of[:1], states, total_of[1])
    kept, seen = np.diff(np.append(first, len(context))), np.add.reduceat(n, first)
    total = np.maximum(total, seen)
    rest = total - seen
    each = lambda x: np.repeat(x, kept)
    less = np.maximum(total - 1, 1)
    left = (DISCOUNT * kept + rest) / less
    seen_again = np.log10(np.maximum((n - 1 - DISCOUNT) / each(less) / share + each(left), 1e-9))
    dropped = np.log10(np.maximum((DISCOUNT * (kept - 1) + rest + LEAST - 1) / less, 1e-9))
    gain = np.add.reduceat(n * np.where(n > LEAST, seen_again, each(dropped)), first)
    gain = (gain + rest * np.log10(np.maximum((DISCOUNT * kept + rest - 1) / less, 1e-9))) / total
    ok = gain > 0
    return states[ok], ((DISCOUNT * kept + rest) / total)[ok], gain[ok].astype("<f4")


def _learn(q: int, sent, key_bits: int, count_bits: int, triple_bits: int):
    """Of a bucket: word states (kind 3), pairs with counts (4), pair states (5), triples of pair states with counts (6),
    and its part of the bit map of these triples (7)."""

    def run(table: pa.Table, words: pa.Table) -> pa.Table:
        cells, all_words = sent.value[1], sent.value[2]
        bucket = (table if table.num_rows else words)["bucket"][0].as_py()
        vocabulary = (_joined(words, 0, "k", "<u8"), _joined(words, 0, "v", "<i8"))
        pairs, n = _summed(*_arrived(table, 3, "<u8", "<u4"))
        pairs, n = pairs[n >= LEAST], n[n >= LEAST]
        rows = [(bucket, 4, 0, _thin(pairs), _values(n.astype("<u4")))]
        for kind, totals in ((1, vocabulary), (2, (pairs, n))):
            context, after, m = _contexts(table, kind)
            context, after, m = context[m >= LEAST], after[m >= LEAST], m[m >= LEAST]
            share = 2.0 ** (cells[after >> _U(64 - count_bits)] / 6) / all_words
            states, left, gain = _states(context, m, share, totals)
            # four times the occurrences that the state doesn't leave: a small whole number, since discounts are quarters
            taken = np.rint(4 * (1 - left) * _find(*totals[:1], states, totals[1])[0]).astype("<i8")
            # gains are only compared with each other: 16 bits of their fractions are enough, and the last byte costs nothing
            gain = (gain.view("<u4") & np.uint32(0xFFFFFF00)).view("<f4")
            rows.append((bucket, 3 if kind == 1 else 5, 0, _thin(states), _values(taken, gain)))
            if kind == 2:
                (mine,) = _find(states, context, np.ones(len(states), bool))
                key = _triples(context[mine], after[mine], q, key_bits)
                order = np.argsort(key, kind="stable")
                rows.append((bucket, 6, 0, _thin(key[order]), _values(m[mine][order].astype("<u4"))))
                bits = np.zeros(1 << (triple_bits - q), np.uint8)
                bits[(key >> _U(64 - triple_bits)) & _U((1 << (triple_bits - q)) - 1)] = 1
                rows.append((bucket, 7, 0, np.packbits(bits).tobytes(), b""))
        return pa.Table.from_batches([_rows(rows)])

    return run


# --- scoring -------------------------------------------------------------------------------------------------------


def _portions(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(block, rows of it) of about `most` bytes of text; columns block, text and others."""
    blocks = batch.column(0).to_numpy()
    for block in np.unique(blocks).tolist():
        part = batch.filter(pa.array(blocks == block))
        size = np.cumsum(np.diff(buffers(part.column(1))[1]))
        at = 0
        while at < part.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            yield block, part.slice(at, to - at)
            at = to


def _union(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


class _Wanted:
    """The sorted distinct keys of a block, gathered by portions of its texts."""

    def __init__(self, q: int, sent, key_bits: int, pair_bits: int, triple_bits: int) -> None:
        self.q, self.key_bits, self.maps, self.parts = q, key_bits, (sent.value[0], pair_bits, sent.value[1], triple_bits), ([], [], [])

    def add(self, texts: pa.Array) -> tuple[Keys, np.ndarray, np.ndarray]:
        t = Keys(texts, self.q, self.key_bits)
        two, three = t.known(*self.maps)
        for part, k in zip(self.parts, (t.w, t.pair[two], t.triple[three]), strict=True):
            part.append(np.unique(k))
        return t, two, three

    def keys(self) -> list[np.ndarray]:
        return [_union(p) for p in self.parts]


def _ask(q: int, sent, key_bits: int, pair_bits: int, triple_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Wanted] = {}
        for batch in batches:
            for block, part in _portions(batch):
                held.setdefault(block, _Wanted(q, sent, key_bits, pair_bits, triple_bits)).add(part.column(1))
        for block in list(held):
            keys = held.pop(block).keys()
            yield _rows([r for kind, k in enumerate(keys) for r in _dealt(kind, block, k, [], q)])
            trim()

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block and its rows in portions, compressed: half of what shuffling plain rows takes."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        for block, part in _portions(batch):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "packed"])


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Aligned to the keys: counts, and for words and pairs what their state takes and its gain, 0 without one."""
    pieces = {0: (_joined(known, 0, "k", "<u8"), _joined(known, 0, "v", "<i8"))}
    for kind, values in ((3, ("<i8", "<f4")), (4, ("<u4",)), (5, ("<i8", "<f4")), (6, ("<u4",))):
        pieces[kind] = next(((_full(k), *_parts(v, *values)) for x, k, v in zip(*(known[c].to_pylist() for c in ("kind", "k", "v")), strict=True) if x == kind), tuple(np.zeros(0, t) for t in ("<u8", *values)))
    rows = []
    for bucket, kind, block, k in zip(*(asked[c].to_pylist() for c in ("bucket", "kind", "block", "k")), strict=True):
        wanted = _full(k)
        (n,) = _find(pieces[(0, 4, 6)[kind]][0], wanted, pieces[(0, 4, 6)[kind]][1])
        values = [n]
        if kind < 2:
            s = pieces[(3, 5)[kind]]
            values += _find(s[0], wanted, s[1], s[2])
        rows.append((bucket, kind, block, b"", _values(*values)))
    return pa.Table.from_batches([_rows(rows)])


def _aligned(answers: pa.Table, kind: int, count: str) -> list[np.ndarray]:
    found = sorted((b, v) for b, x, v in zip(answers["bucket"].to_pylist(), answers["kind"].to_pylist(), answers["v"].to_pylist(), strict=True) if x == kind)
    out = [_parts(v, *((count, "<i8", "<f4") if kind < 2 else (count,))) for _, v in found]
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, count), np.zeros(0, "<i8"), np.zeros(0, "<f4")]


def _score(q: int, sent, key_bits: int, pair_bits: int, triple_bits: int, n_train: int, n_vocabulary: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        wanted = _Wanted(q, sent, key_bits, pair_bits, triple_bits)
        portions = [(b, wanted.add(b.column(1))) for x in docs["packed"] for b in pa.ipc.open_stream(x.as_buffer())]
        known = list(zip(wanted.keys(), (_aligned(answers, kind, count) for kind, count in enumerate(("<i8", "<u4", "<u4"))), strict=True))
        out = pa.Table.from_batches([scored(*read, part, known) for part, read in portions])
        del wanted, known, portions
        trim()
        return out

    def scored(t: Keys, two: np.ndarray, three: np.ndarray, part: pa.RecordBatch, known: list) -> pa.RecordBatch:
        n_w, taken1, gain1 = (x[np.searchsorted(known[0][0], t.w)] for x in known[0][1])
        size = len(t.w)
        n2, taken2, gain2, n3 = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, "<f4"), np.zeros(size, np.int64)
        at = np.searchsorted(known[1][0], t.pair[two])
        n2[two], taken2[two], gain2[two] = (x[at] for x in known[1][1])
        n3[three] = known[2][1][0][np.searchsorted(known[2][0], t.triple[three])]
        share = (n_w + 1) / (n_train + n_vocabulary + 1)
        before = lambda x: np.concatenate((x[:1], x[:-1]))  # noqa: E731  what the preceding word or pair has
        one, pair = (t.depth >= 1) & (before(taken1) > 0), (t.depth >= 2) & (before(taken2) > 0)
        pair &= ~one | (before(gain2) > before(gain1))
        p = share.copy()
        left = lambda taken, n: 1 - taken / (4 * n)  # noqa: E731  the mass left to the shorter suffix
        p[one] = left(before(taken1)[one], before(n_w)[one]) * share[one] + np.maximum(n2[one] - DISCOUNT, 0) * (n2[one] >= LEAST) / before(n_w)[one]
        # what a pair leaves goes to its suffix, the word, where that is a state
        p[pair] = left(before(taken2)[pair], before(n2)[pair]) * p[pair] + np.maximum(n3[pair] - DISCOUNT, 0) / before(n2)[pair]
        total = lambda x: np.add.reduceat(x, t.starts) if size else x
        columns = {
            "doc_id": part.column(2), "held_out": part.column(3), "n_tokens": pa.array(t.sizes), "n_known": pa.array(total((n_w > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(t.sizes), n_train, np.int64)), "base_score": pa.array(total(np.log10(share))), "score": pa.array(total(np.log10(p))),
            "in_context": pa.array(total((one | pair).astype(np.int64))),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _in_blocks(docs: DataFrame, columns: list[Column], block_bytes: int) -> DataFrame:
    """columns and block: a key of the part of a file that a row lies in, in pieces of about block_bytes. Tables that
    are no files are written first."""

    def keyed(d: DataFrame, c: list) -> DataFrame:
        pieces = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_metadata.file_block_length") / block_bytes))
        return d.select(*c, F.xxhash64("_metadata.file_path", "_metadata.file_block_start", F.pmod(F.hash(c[0]), pieces)).alias("block"))

    try:
        d = keyed(docs, columns)
        d.schema  # noqa: B018
        return d
    except AnalysisException:
        written = cut(docs.select(*columns))
        return keyed(written, [F.col(c) for c in written.columns])


def score_texts(docs: DataFrame, folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text", pair_bits: int | None = None, count_bits: int | None = None, triple_bits: int | None = None, block_bytes: int = 4 << 20, key_bits: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and in_context (tokens scored in a context
    of one or two words) of each document.

    The model learns from the documents whose crc32 of the id as text is not `held_out` modulo `folds`. Words are ended
    by ASCII white space, A-Z lower-cased; each text ends with a token of its own, so null and empty texts have one
    token. Rows that repeat count again. A null id is learned from. An empty table gives no rows. pair_bits and
    triple_bits do not change the scores; by default they follow the size of the training text. key_bits is the width of
    the keys of pairs and triples: two that meet in one key share their counts.
    """
    spark = docs.sparkSession
    q = min(12, max(5, (2 * partitions(spark) - 1).bit_length()))
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held_out, F.lit(False))
    d = _in_blocks(docs, [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out")], block_bytes)
    train = d.where("NOT held_out").select("text")
    size = train.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    if key_bits is None:
        key_bits = min(64, max(LEAST_KEY_BITS, size.bit_length() + 12))
    if pair_bits is None:
        pair_bits = min(MOST_BITS, max(LEAST_BITS, (size // 4).bit_length()))
    triple_bits = pair_bits if triple_bits is None else triple_bits
    with small_batches(spark, 2500):
        words = cut(train.mapInArrow(_count_words(q, key_bits), PACKED).groupBy("bucket").applyInArrow(_sum_words(q, pair_bits), PACKED), light=True)
    _free(spark)
    n_train, n_vocabulary = words.where("kind = 0").agg(F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum(F.octet_length("k") / 8), F.lit(0)).cast("long")).head()
    vocabulary = words.where("kind = 0")
    if count_bits is None:
        count_bits = _count_bits(words.where("kind = 1").agg(F.coalesce(F.sum("block"), F.lit(0))).head()[0])
    bits, cells = np.zeros(1 << (pair_bits - 3), np.uint8), np.zeros(1 << count_bits, np.uint8)
    with small_batches(spark, 16):
        table = cut(vocabulary.mapInArrow(_count_table(q, count_bits), PACKED), light=True)
    for row in words.where("kind = 1").unionByName(table).select("bucket", "kind", "k").toLocalIterator():
        part = np.frombuffer(row["k"], np.uint8)
        (bits if row["kind"] == 1 else cells)[row["bucket"] * len(part) : (row["bucket"] + 1) * len(part)] = part
    sent = spark.sparkContext.broadcast((bits, cells, max(1, n_train)))
    contexts = train.mapInArrow(_count_contexts(q, sent, key_bits, pair_bits), PACKED)
    with small_batches(spark, 2500):
        model = cut(contexts.groupBy("bucket").cogroup(vocabulary.groupBy("bucket")).applyInArrow(_learn(q, sent, key_bits, count_bits, triple_bits), PACKED), light=True)
    _free(spark)
    kept = np.zeros(1 << (triple_bits - 3), np.uint8)
    for row in model.where("kind = 7").select("bucket", "k").toLocalIterator():
        part = np.frombuffer(row["k"], np.uint8)
        kept[row["bucket"] * len(part) : (row["bucket"] + 1) * len(part)] = part
    maps = spark.sparkContext.broadcast((bits, kept))
    asked = d.select("block", "text").mapInArrow(_ask(q, maps, key_bits, pair_bits, triple_bits), PACKED)
    known = vocabulary.unionByName(model.where("kind < 7"))
    with small_batches(spark, 2500):
        answers = cut(asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_answer, PACKED), light=True)
    _free(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, in_context long"
    texts = d.select("block", "text", "doc_id", "held_out").mapInArrow(_pack, "block long, packed binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(q, maps, key_bits, pair_bits, triple_bits, n_train, n_vocabulary), out)
