"""What several corpus operators share: lineage cuts in the shared folder, text hashing and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regex of the six ASCII white-space bytes that separate words.
SPACES = r"[\x20\x09-\x0D]+"
#: A-Z only: other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where that is unset (local runs, tests)."""
    sc = spark.sparkContext
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if (own := sc._jsc.sc().getCheckpointDir()).isDefined():
        return own.get()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wakeline-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, light: bool = False) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here and survives lost executors.

    light is for tables of keys and links, whose shuffle partitions are small: at most four files are written for each
    core of the cluster, rather than one for each partition.
    """
    spark = df.sparkSession
    if light:
        df = df.coalesce(4 * spark.sparkContext.defaultParallelism)
    path = f"{shared_dir(spark)}/wakeline-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 64) -> Iterator[None]:
    """For the jobs inside, Python gets at most so many rows at once: for rows that hold whole groups."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def trim() -> None:
    """Gives freed memory back to the system: a worker that is reused keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


# --- hashing of texts in numpy -------------------------------------------------------------------------------------

_U = np.uint64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection whose output bits all depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse modulo 2 ** 64 for i up to n. Those of very long texts are not kept."""
    if _POWERS and len(_POWERS[0]) > n:
        return _POWERS[0], _POWERS[1]
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(max(1 << 20, n) + 1, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= 1 << 20:
        _POWERS[:] = out
    return out[0], out[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, limit: int = 1 << 20, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, lower-cased if asked, and offsets from 0), each of about limit bytes or one row."""
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        part = data[offsets[first] : offsets[last]]
        yield first, last, _LOWERED[part] if lower else part, offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(a: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of the rows begin and end, and the offsets of each row's words among them."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    ink = ~_IS_SPACE[a]
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1]
    ends[:-1] &= ~ink[1:]
    inner = offsets[:-1][np.diff(offsets) > 0]
    begins[inner] = ink[inner]
    stops = offsets[1:][np.diff(offsets) > 0] - 1
    ends[stops] = ink[stops]
    b = np.flatnonzero(begins)
    return b, np.flatnonzero(ends) + 1, np.searchsorted(b, offsets)


def span_hashes(a: np.ndarray, b: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    up, down = _powers(len(a))
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=total[1:])
    h = (total[e] - total[b]) * down[b]
    return mix(h + (e - b).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def word_hashes(a: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the rows, and the offsets of each row's words among them."""
    b, e, at = word_spans(a, offsets)
    return span_hashes(a, b, e), at


_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | _U(1)


def shingles(words: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its width-word shingles; fewer words are one shingle, none are none."""
    n = max(0, len(words) - width + 1)
    g = np.zeros(n, np.uint64)
    for j in range(width if n else 0):
        g += words[j : n + j] * _PLACE[j]
    g = mix(g)
    out = []
    for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if j - i >= width:
            s = np.sort(g[i : j - width + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s)
        elif j > i:
            out.append(mix((words[i:j] * _PLACE[: j - i]).sum(keepdims=True) + _U(j - i)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


# --- bit maps ------------------------------------------------------------------------------------------------------


def bit_map(hashes: DataFrame, column: str, least: int = 23, most: int = 29) -> tuple[int, Broadcast]:
    """(bits, map) with a bit for each 64-bit hash in column, found by marked(): 2 ** bits bits, at least 8 for each hash
    from `least` to `most` bits (1 to 64 MB), beyond which it fills up and lets more through."""
    spark = hashes.sparkSession
    bits = min(most, max(least, (8 * hashes.count()).bit_length()))
    place = f"shiftrightunsigned({column}, {64 - bits})"
    words = hashes.groupBy(F.expr(f"shiftright({place}, 6)").alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({place} & 63 AS int))")).alias("b")).toArrow()
    filled = np.zeros(1 << (bits - 6), np.int64)
    filled[words["w"].to_numpy()] = words["b"].to_numpy()
    return bits, spark.sparkContext.broadcast(filled.view(np.uint64))


def marked(filled: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes have their bit in a map."""
    i = hashes >> _U(64 - bits)
    return ((filled[i >> _U(6)] >> (i & _U(63))) & _U(1)).astype(bool)


def split_by_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose id is surely not in ids, a written table of one column; the others, with few more than those in it):
    a join with ids need only shuffle the others. Texts do not leave the JVM."""
    bits, sent = bit_map(ids.select(F.xxhash64(ids.columns[0]).alias("h")), "h")

    @F.arrow_udf("boolean")
    def maybe(h: pa.Array) -> pa.Array:
        return pa.array(marked(sent.value, h.to_numpy(zero_copy_only=False).view(np.uint64), bits))

    found = maybe(F.xxhash64(F.col(f"`{id_col}`").cast(ids.schema[0].dataType)))
    return docs.where(~found), docs.where(found)


# --- connected components ------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b): component is the smallest node reachable.

    Union-find on the cluster by alternating large and small stars: each round hangs a node's neighbours on its
    smallest one, with partial minima before each shuffle, so a node with many links is no bottleneck. Each round is
    cut in the shared folder. Nodes without links and null ends do not occur in the result; no edges give no rows.
    """
    e = cut(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct(), light=True)
    before = None
    while True:
        both = e.unionByName(e.selectExpr("b AS a", "a AS b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = both.where("b > a").join(low, "a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        hung = e.join(low, "a").selectExpr("b AS a", "m AS b").where("a <> b").unionByName(low.selectExpr("a", "m AS b"))
        e = cut(hung.distinct(), light=True)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if now == before:
            break
        before = now
    return e.selectExpr("a AS node", "b AS component").unionByName(e.selectExpr("b AS node", "b AS component").distinct())
