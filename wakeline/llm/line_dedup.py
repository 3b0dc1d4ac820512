"""Fuzzy deduplication of lines.

Lines are compared by their distinct character shingles. MinHash signatures in bands propose pairs (high recall: with
the defaults a pair just at the threshold is missed 5 times in 1000, one at 0.8 less than once in 1000), exact Jaccard
similarity verifies them, and a distributed union-find gives the components, of which the first line stays.

Band keys travel as packed arrays, dealt into buckets. Of the lines of a key the first is compared with each and each
with the next one, which joins most of them. Keys whose lines are then still in several components go on: all their
lines of different components are compared, in tiles of bounded numbers of components, so that every proposed pair is
either compared or within a component already. A very common line comes once from a batch and is no bottleneck.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _powers, components, cut, mix, partitions, small_batches, trim

_U = np.uint64


def normal_lines(text: str | None) -> list[str]:
    """Lines at \\n, lower-cased and stripped; blank ones are empty."""
    return [x.strip() for x in (text or "").lower().split("\n")]


def _portions(lines: list[str], most: int = 1 << 17) -> Iterator[list[str]]:
    held, size = [], 0
    for x in lines:
        held.append(x)
        size += len(x)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _coded(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash over all lines, the inverse powers, and each line's place, room and size. A line
    takes at least `width` places, filled up with zeros, so that every shingle lies within its line."""
    size = np.array([len(x) for x in lines], np.int64)
    room = np.maximum(size, width)
    if (size < width).any():
        lines = [x.ljust(width, "\0") for x in lines]
    c = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    up, down = _powers(len(c))
    c *= _U(0x9E3779B97F4A7C15)
    c *= up[: len(c)]
    total = np.zeros(len(c) + 1, np.uint64)
    np.cumsum(c, out=total[1:])
    return total, down, np.cumsum(room) - room, room, size


def _ids(total: np.ndarray, down: np.ndarray, begin: np.ndarray, room: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix((total[begin + room] - total[begin]) * down[begin] + size.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def line_ids(lines: list[str], width: int) -> np.ndarray:
    """A 64-bit hash of each whole line."""
    return _ids(*_coded(lines, width))


def line_shingles(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles of non-empty lines, where each line's begin, and line_ids. A line of fewer than `width`
    characters is one shingle."""
    coded = _coded(lines, width)
    total, down, begin, room, _ = coded
    n = room - width + 1
    g = total[width:] - total[:-width]
    g *= down[: len(g)]
    # those that begin in one line and end in the next one go
    whole = np.ones(len(g), bool)
    whole[((begin + n)[:-1, None] + np.arange(width - 1)).ravel()] = False
    return mix(g[whole]), np.cumsum(n) - n, _ids(*coded)


def _tokens(g: np.ndarray, first: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Of the shingles of lines, which may repeat: line and number of each that occurs again, how many of each line do
    not, how many numbers there are and how many go into a block of about `room` cells."""
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(g))))
    token = pa.array(g).dictionary_encode().indices.to_numpy()
    again = np.bincount(token) > 1
    some = again[token]
    single = np.bincount(owner[~some], minlength=len(first))
    owner, token, n, step = owner[some], (np.cumsum(again) - 1)[token[some]], int(again.sum()), max(64, room // len(first) // 64 * 64)
    if n > step:
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
    return owner, token, single, n, step


def _blocks(owner: np.ndarray, token: np.ndarray, lines: int, n: int, step: int, kind: type) -> Iterator[np.ndarray]:
    """Matrices of lines and at most `step` tokens, 1 where the line has the token; widths are multiples of 64."""
    for at in range(0, n, step):
        i, j = np.searchsorted(token, (at, at + step)) if n > step else (0, len(token))
        has = np.zeros((lines, min(step, (n - at + 63) // 64 * 64)), kind)
        has[owner[i:j], token[i:j] - at] = 1
        yield has


def common_shingles(texts: list[str], left: np.ndarray, right: np.ndarray, width: int, room: int = 1 << 23) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct shingles each text has, and how many the texts left[k] and right[k] have in common."""
    g, first, _ = line_shingles(texts, width)
    owner, token, size, n, step = _tokens(g, first, room)
    common = np.zeros(len(left), np.int64)
    for has in _blocks(owner, token, len(texts), n, step, bool):
        bits = np.packbits(has, axis=1).view(np.uint64)
        size += np.bitwise_count(bits).sum(1, dtype=np.int64)
        common += np.bitwise_count(bits[left] & bits[right]).sum(1, dtype=np.int64)
    return size, np.where(left == right, size[left], common)


def signatures(g: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """count x lines minima of count hash functions."""
    h, out = (g >> _U(32)).astype(np.uint32), np.empty((count, len(first)), np.uint32)
    odd = (mix(np.arange(1, count + 1, dtype=np.uint64)) >> _U(32)).astype(np.uint32) | np.uint32(1)
    for k in range(count):
        np.minimum.reduceat(h * odd[k], first, out=out[k])
    return out


#: Lines of a key that its links, of each to the first and to the next one, compare completely.
_FEW = 3
#: Components of a key that one side of a tile holds, about.
_SIDE = 128


def _stars(keys: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of (key, line): links (a, b) of each key's lines to its first and to the next one, and the distinct (key, line)
    of keys with more lines than these links compare."""
    order = np.lexsort((lines, keys))
    keys, lines = keys[order], lines[order]
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1]))) if len(keys) else np.zeros(0, bool)
    keys, lines = keys[new], lines[new]
    head = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, len(keys)))
    leader, many = np.repeat(lines[at], size), np.repeat(size > _FEW, size)
    tail = np.flatnonzero(~head)
    a, b = np.concatenate((leader[tail], lines[tail - 1])), np.concatenate((lines[tail], lines[tail]))
    links = np.unique(np.stack((a, b), 1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
    return links[:, 0], links[:, 1], keys[many], lines[many]


def _bands(width: int, bands: int, rows: int, buckets: int):
    """bucket, a, b: packed keys and lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = [], []
            lines = list({x for t in batch.column(0).to_pylist() for x in normal_lines(t) if x})
            for some in _portions(lines):
                g, first, line = line_shingles(some, width)
                s = signatures(g, first, bands * rows).astype(np.uint64).reshape(bands, rows, -1)
                key = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[:, None], len(some), axis=1)
                for r in range(rows):
                    key = mix(key * _U(0x9E3779B97F4A7C15) + s[:, r])
                keys.append(key.ravel())
                ids.append(np.tile(line, bands))
            if not keys:
                continue
            key, line = np.concatenate(keys), np.concatenate(ids)
            to = (key % _U(buckets)).astype(np.int16 if buckets < 1 << 15 else np.int32)
            order = np.argsort(to, kind="stable")  # by radix where 16 bits hold the buckets
            key, line, to = key[order], line[order], to[order]
            at = np.searchsorted(to, np.arange(buckets + 1))
            out = [(int(x), key[at[x] : at[x + 1]].tobytes(), line[at[x] : at[x + 1]].tobytes()) for x in np.flatnonzero(np.diff(at))]
            kinds = (pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["bucket", "a", "b"])
        trim()

    return run


def _met(table: pa.Table) -> pa.Table:
    """Of a bucket: links among the lines of each key, and members, the key as a and the line as b."""
    keys, lines = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint64) for c in ("a", "b"))
    a, b, key, line = _stars(keys, lines)
    member = np.arange(len(a) + len(key)) >= len(a)
    return pa.table({"member": member, "a": np.concatenate((a, key)).view(np.int64), "b": np.concatenate((b, line)).view(np.int64)})


def _verified(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(k).to_numpy() for k in (0, 1)]
            texts = [batch.column(k).to_pylist() for k in (2, 3)]
            ok = np.zeros(batch.num_rows, bool)
            # links come sorted by one of their lines, so the same texts recur
            chars, at = np.cumsum([len(t) + len(u) for t, u in zip(*texts, strict=True)]), 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(chars, (chars[at - 1] if at else 0) + (1 << 15), "right")))
                own = {t: k for k, t in enumerate(dict.fromkeys(t for side in texts for t in side[at:to]))}
                x, y = (np.array([own[t] for t in side[at:to]]) for side in texts)
                size, common = common_shingles(list(own), x, y, width)
                ok[at:to] = 100 * common >= percent * (size[x] + size[y] - common)
                at = to
            yield pa.RecordBatch.from_arrays([pa.array(ids[0][ok]), pa.array(ids[1][ok])], ["a", "b"])

    return run


def candidate_links(docs: DataFrame, width: int, bands: int, rows: int, text_col: str) -> DataFrame:
    """member, a, b: links of lines, which may repeat, and the keys and lines of larger keys."""
    buckets = 4 * partitions(docs.sparkSession)
    packed = docs.select(text_col).mapInArrow(_bands(width, bands, rows, buckets), "bucket int, a binary, b binary")
    return packed.groupBy("bucket").applyInArrow(_met, "member boolean, a long, b long")


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of pairs those that join what earlier ones have not."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    out = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            up[x] = y
            out.append((a, b))
    return out


def similar_components(texts: list[str], comp: np.ndarray, side: np.ndarray, width: int, percent: int) -> list[tuple[int, int]]:
    """Pairs of components that lines of theirs join: all lines of different components are compared, or only those of
    different sides where there are two sides."""
    g, first, _ = line_shingles(texts, width)
    n = len(texts)
    kind = np.float32 if len(g) < 1 << 17 else np.float64
    # a shingle that occurs once is in no intersection
    owner, token, size, tokens, step = _tokens(g, first, 1 << 22)
    size = size.astype(kind)
    held = list(_blocks(owner, token, n, tokens, step, kind)) if tokens <= step else None
    for has in _blocks(owner, token, n, tokens, step, kind) if held is None else held:
        size += has.sum(1)
    if side.any() and not side.all():
        rows, every = sorted((np.flatnonzero(side), np.flatnonzero(~side)), key=len)
        before = len(every)
    else:
        # a pair has at least one line outside the largest component; these meet it and the rows up to their own
        _, which, count = np.unique(comp, return_inverse=True, return_counts=True)
        rows, largest = np.flatnonzero(which != count.argmax()), np.flatnonzero(which == count.argmax())
        every, before = np.concatenate((largest, rows)), len(largest)
    found = []
    for r in range(0, len(rows), 512):
        some = rows[r : r + 512]
        cols = every[: before + r + 512]
        common = np.zeros((len(some), len(cols)), kind)
        for has in _blocks(owner, token, n, tokens, step, kind) if held is None else held:
            common += has[some] @ has[cols].T
        near = 100 * common >= percent * (size[some][:, None] + size[cols] - common)
        near &= comp[some][:, None] != comp[cols]
        x, y = np.nonzero(near)
        if len(x):
            found.append(np.unique(np.stack((comp[some[x]], comp[cols[y]]), 1), axis=0))
    return _forest(np.concatenate(found)) if found else []


def _compared(width: int, percent: int):
    """a, b: components joined, from rows of tile, comp, side and text that come tile by tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def close() -> list[tuple[int, int]]:
            if not held:
                return []
            comp, side, texts = zip(*held, strict=True)
            held.clear()
            return similar_components([t for x in texts for t in x], np.concatenate(comp), np.concatenate(side), width, percent)

        for batch in batches:
            tile, comp, side = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            texts, out = batch.column(3).to_pylist(), []
            ends = [*(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)] if len(tile) else []
            for i, j in zip([0, *ends], ends, strict=False):
                if tile[i] != last:
                    out += close()
                    last = tile[i]
                held.append((comp[i:j], side[i:j], texts[i:j]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        out = close()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        trim()

    return run


def _joined(members: DataFrame, comp: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of components between which a key of `members` has a pair of similar lines."""
    m = members.join(comp.withColumnRenamed("node", "line"), "line", "left").select("key", "line", F.coalesce("component", "line").alias("comp"))
    by_comp = m.groupBy("key", "comp").agg(F.count("*").alias("n"), F.bit_xor("line").alias("lines"))
    keys = by_comp.groupBy("key").agg(F.count("*").alias("comps"), F.sum("n").alias("n"), F.bit_xor("lines").alias("lines")).where("comps > 1")
    # keys of several bands that have the same lines are compared once
    keys = keys.groupBy("lines", "n", "comps").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("comps") / _SIDE).cast("int").alias("units"))
    tiles = m.join(keys, "key").withColumn("u", F.pmod(F.xxhash64("comp"), "units").cast("int")).withColumn("v", F.explode(F.expr("sequence(0, units - 1)")))
    tiles = tiles.select("line", "comp", F.xxhash64("key", F.least("u", "v"), F.greatest("u", "v")).alias("tile"), F.expr("u > v").alias("side"))
    rows = tiles.join(texts, "line").select("tile", "comp", "side", "text").repartition("tile").sortWithinPartitions("tile")
    return rows.mapInArrow(_compared(width, percent), "a long, b long")


def line_components(docs: DataFrame, width: int = 8, percent: int = 75, bands: int = 14, rows: int = 4, text_col: str = "text", filter_bits: int = 23) -> DataFrame:
    """(node, component) of the lines, by 64-bit hash, that have a near copy. Only lines in a proposed pair are fetched:
    a bit map of 2 ** filter_bits bits leaves out most others before the join."""
    spark = docs.sparkSession
    with small_batches(spark, 2500):
        met = cut(candidate_links(docs, width, bands, rows, text_col), light=True)
    pairs = met.where("NOT member").select("a", "b").distinct()
    ends = met.where("NOT member").select(F.explode(F.array("a", "b")).alias("line")).distinct()
    spot = F.shiftrightunsigned("line", 64 - filter_bits)
    words = ends.groupBy(F.shiftright(spot, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(line, {64 - filter_bits}) & 63 AS int))")).alias("bits")).toArrow()
    filled = np.zeros(1 << (filter_bits - 6), np.int64)
    filled[words["w"].to_numpy()] = words["bits"].to_numpy()
    sent = spark.sparkContext.broadcast(filled.view(np.uint64))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _portions(list({x for t in batch.column(0).to_pylist() for x in normal_lines(t) if x})):
                line = line_ids(some, width)
                i = line >> _U(64 - filter_bits)
                at = np.flatnonzero((sent.value[i >> _U(6)] >> (i & _U(63))) & _U(1))
                yield pa.RecordBatch.from_arrays([pa.array(line[at].view(np.int64)), pa.array([some[k] for k in at.tolist()], pa.string())], ["line", "text"])
        trim()

    found = docs.select(text_col).mapInArrow(fetch, "line long, text string").join(ends, "line", "left_semi").groupBy("line").agg(F.min("text").alias("text"))
    texts = cut(found, light=True)
    one, two = (texts.select(F.col("line").alias(k), F.col("text").alias(f"t{k}")) for k in ("a", "b"))
    links = pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(_verified(width, percent), "a long, b long")
    comp = components(links)
    more = components(_joined(met.where("member").selectExpr("a AS key", "b AS line"), comp, texts, width, percent)).withColumnRenamed("component", "whole")
    moved = comp.join(more.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    return moved.unionByName(more.join(comp, "node", "left_anti").selectExpr("node", "whole AS component"))


def dedup_lines(docs: DataFrame, width: int = 8, percent: int = 75, bands: int = 14, rows: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text without the lines that are near copies of an earlier one, n_lines, n_kept of each document.

    Of each component of lines the first stays, in the order of doc_id and line. Blank lines stay. A null text stays
    null, with one line, which is blank. Rows that repeat an id and text keep the same lines. An empty table gives none.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    comp = line_components(plain, width, percent, bands, rows)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, owner, place, line = batch.column(0), [], [], []
            flat, where = [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                for p, x in enumerate(normal_lines(t)):
                    if x:
                        flat.append(x)
                        where.append((k, p))
            for some in _portions(flat):
                line.append(line_ids(some, width))
            owner, place = ([w[i] for w in where] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(owner, pa.int64())), pa.array(place, pa.int32()), pa.array(np.concatenate(line).view(np.int64) if line else np.zeros(0, np.int64))], ["doc_id", "place", "line"]
            )

    lines = plain.mapInArrow(number, f"doc_id {kind}, place int, line long")
    # the first place of each line before the join: a very common line is one row in it
    once = lines.groupBy("line").agg(F.min(F.struct("doc_id", "place")).alias("f"))
    first = once.join(comp.withColumnRenamed("node", "line"), "line", "left").groupBy(F.coalesce("component", "line").alias("c")).agg(F.min("f").alias("f"))
    kept = first.select("f.doc_id", "f.place").groupBy("doc_id").agg(F.collect_set("place").alias("kept"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, all_n, kept_n = [], [], []
            for t, keep in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                keep = set(keep or ())
                own = (t or "").split("\n")
                out = [x for k, x in enumerate(own) if k in keep or not x.lower().strip()]
                texts.append(None if t is None else "\n".join(out))
                all_n.append(len(own))
                kept_n.append(len(out))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(all_n, pa.int64()), pa.array(kept_n, pa.int64())], ["doc_id", "text", "n_lines", "n_kept"])

    joined = plain.join(cut(kept, light=True).select(F.col("doc_id").alias("_id"), "kept"), F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "kept")
    return joined.mapInArrow(rebuild, f"doc_id {kind}, text string, n_lines long, n_kept long")


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
