"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, trim

ORDERS = (1, 2, 3)
_SPACE = 32
_MARKS = np.array([not chr(i).isalpha() for i in range(128)] + [False], bool)


def features(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of lower-cased code points of all texts, and how many each text has. ASCII marks and digits count
    as spaces, and each text has spaces around it, so no n-gram crosses texts."""
    joined = np.frombuffer("".join([f" {t.lower()}  " for t in texts]).encode("utf-32-le"), np.uint32)
    c = np.where(_MARKS[np.minimum(joined, 128)], _SPACE, joined).astype(np.uint64)
    size = np.array([len(t.lower()) + 3 for t in texts], np.int64)
    keep = np.ones(len(c), bool)
    ends = np.cumsum(size)
    keep[ends - 1] = keep[ends - 2] = False
    at = np.flatnonzero(keep)
    out, h = [], np.zeros(len(at), np.uint64)
    for n in range(max(ORDERS)):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c[at + n] + np.uint64(1))
        if n + 1 in ORDERS:
            out.append((h >> np.uint64(64 - bits)).astype(np.int32))
    return np.stack(out, 1).ravel(), (size - 2) * len(ORDERS)


def _portions(texts: list[str | None], most: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1]) + 3
        if size >= most:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


class Model:
    """labels, and their log probabilities as a matrix of 2 ** bits rows; small enough to broadcast."""

    def __init__(self, labels: list[str], matrix: np.ndarray, prior: np.ndarray, bits: int) -> None:
        self.labels, self.matrix, self.prior, self.bits = labels, matrix, prior, bits


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", bits: int = 16, max_docs: int = 2000, alpha: float = 0.5) -> Model:
    """Learns from about max_docs documents of each label, chosen by a hash of their ids: the documented bound of the
    sample. Rows without text or label are left out. Labels are the classes, whose number the matrix's size must allow
    (2 ** bits floats each)."""
    usable = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}
    labels = sorted(counts)
    if not labels:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(0), bits)
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, max_docs / n)))))
    draw = F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = usable.where(draw < F.element_at(share, F.col(lang_col)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {k: i for i, k in enumerate(labels)}
        total = np.zeros((len(labels), 1 << bits), np.int64)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, texts in _portions(batch.column(1).to_pylist()):
                f, n = features(texts, bits)
                who = np.repeat([place[x] for x in langs[first : first + len(texts)]], n)
                for k in np.unique(who):
                    total[k] += np.bincount(f[who == k], minlength=1 << bits)
        k, f = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(f.astype(np.int32)), pa.array(total[k, f])], ["k", "f", "n"])

    sums = sample.select(lang_col, text_col).mapInArrow(count, "k int, f int, n long").groupBy("k", "f").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.full((1 << bits, len(labels)), alpha)
    matrix[sums["f"].to_numpy(), sums["k"].to_numpy()] += sums["n"].to_numpy()
    prior = np.log(np.array([counts[k] for k in labels], float) / sum(counts.values()))
    return Model(labels, np.log(matrix / matrix.sum(0)).astype(np.float32), prior, bits)


def predict(docs: DataFrame, model: Model, carry: list[Column], text_col: str = "text") -> DataFrame:
    """The columns `carry`, lang_pred and score (the posterior of the prediction). A text that is null or has no letter
    is `und` with score 0, and so is every text when the model has no labels."""
    sent = docs.sparkSession.sparkContext.broadcast((model.labels, model.matrix, model.prior, model.bits))
    names = [f"c{i}" for i in range(len(carry))]
    plain = docs.select(*(c.alias(n) for c, n in zip(carry, names, strict=True)), F.col(text_col).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, matrix, prior, bits = sent.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            lang, best = ["und"] * len(texts), np.zeros(len(texts))
            for first, some in _portions(texts) if labels else ():
                f, n = features(some, bits)
                logs = np.add.reduceat(matrix[f], np.concatenate(([0], np.cumsum(n)[:-1])), 0, np.float64) + prior
                top = logs.argmax(1)
                p = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                for i, t in enumerate(some):
                    if any(map(str.isalpha, t)):
                        lang[first + i], best[first + i] = labels[top[i]], p[i]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(best)], [*names, "lang_pred", "score"])
        trim()

    fields = [*(f"{n} {plain.schema[n].dataType.simpleString()}" for n in names), "lang_pred string", "score double"]
    return plain.mapInArrow(score, ", ".join(fields))


def identify(docs: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Documents whose crc32 of the id as text is a multiple of `folds` are held out;
    the model learns from the others alone. A null id is neither learned from nor held out. Empty tables give no rows."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    model = fit(docs.where(rest != 0), text_col, lang_col, id_col, **options)
    out = predict(docs, model, [F.col(id_col), F.coalesce(rest == 0, F.lit(False))], text_col)
    return out.withColumnsRenamed({"c0": "doc_id", "c1": "held_out"})
