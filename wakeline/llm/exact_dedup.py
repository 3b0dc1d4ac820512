"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries of every partition name the digests that may be frequent. Their exact winners, at most `heavy`
of them, are broadcast, and their copies are resolved where they lie; all other digests go through one shuffle in which
no key is frequent.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWERED, buffers, cut, split_by_ids


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the whole text in UTF-8 with A-Z lower-cased; a null text counts as empty."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            at = offsets.tolist()
            found = [hashlib.sha256(_LOWERED[data[i:j]]).digest() for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(digest, f"doc_id {kind}, digest binary")


def frequent(digests: DataFrame, heavy: int = 1024) -> DataFrame:
    """At most `heavy` digests, among them each that more than 1 in heavy + 1 rows carry (Misra and Gries)."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            held.update(batch.column(0).to_pylist())
            if len(held) > heavy:
                level = held.most_common(heavy + 1)[-1][1]
                held = Counter({k: n - level for k, n in held.items() if n > level})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["digest", "n"])

    found = digests.select("digest").mapInArrow(summary, "digest binary, n long")
    return found.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(heavy).select("digest")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = 1024) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays; of rows that repeat its id as well, exactly one. A null text is
    the empty text, a null id loses to any other, an empty table gives an empty result, and other columns are ignored.
    """
    d = cut(text_digests(docs, id_col, text_col))
    stats = d.join(F.broadcast(frequent(d, heavy)), "digest").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    hot = cut(stats, light=True)
    cold = d.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    # a join rather than windows: the rows of a digest are counted before the shuffle and never held together
    parts = d.join(F.broadcast(hot), "digest"), cold.join(cold.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "digest")
    first = Window.partitionBy("digest").orderBy(F.desc("doc_id"))
    out = []
    for part in parts:
        out.append(part.where("NOT doc_id <=> keep_id").withColumn("kept", F.lit(False)))
        out.append(part.where("doc_id <=> keep_id").withColumn("kept", F.row_number().over(first) == 1))
    return reduce(DataFrame.unionByName, out).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = 1024) -> DataFrame:
    """The documents that stay, with all their columns; ids must be unique but for rows that repeat whole."""
    losers = cut(exact_duplicates(docs, id_col, text_col, heavy).where("NOT kept AND NOT doc_id <=> keep_id").select(F.col("doc_id").alias("_lost")), light=True)
    again = cut(docs.groupBy(F.col(id_col).alias("_again")).count().where("count > 1").select("_again"), light=True)
    clear, rest = split_by_ids(docs, losers.unionByName(again.withColumnRenamed("_again", "_lost")).distinct(), id_col)
    kept = rest.join(losers, F.col(id_col).eqNullSafe(F.col("_lost")), "left_anti")
    same = F.col(id_col).eqNullSafe(F.col("_again"))
    return clear.unionByName(kept.join(again, same, "left_anti")).unionByName(kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))
