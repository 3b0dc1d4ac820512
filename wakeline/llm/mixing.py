"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, cut

DIMENSIONS = ("source", "lang", "topic")


def n_tokens(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda x: x != "")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic by form, for tables without topics: tables, lists of markup, short, medium or long prose."""
    marks = F.size(F.split(F.coalesce(text, F.lit("")), "[#*$%&|<>]")) - 1
    return F.when(marks * 10 > tokens, "markup").when(tokens < 200, "short").when(tokens < 1000, "medium").otherwise("long")


def tempered(cells: DataFrame, column: str, power: float = 0.7) -> DataFrame:
    """(value, share): target shares that are the token shares raised to `power`, which lifts small values."""
    sums = cells.groupBy(F.col(column).alias("value")).agg(F.sum("tokens").alias("n")).where("n > 0")
    raised = sums.select("value", F.pow(F.col("n").cast("double"), F.lit(power)).alias("p"))
    return raised.select("value", (F.col("p") / F.sum("p").over(Window.partitionBy(F.lit(1)))).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 12, every: int = 4) -> DataFrame:
    """cells (the dimensions, tokens) with weight: after `rounds` of iterative proportional fitting the weighted tokens
    of each value of a dimension have its target share. Values without a target, and cells without tokens, get weight
    0 and 1. The plan is cut in the shared folder after every `every` rounds."""
    c = cells.withColumn("weight", F.lit(1.0))
    for k, t in targets.items():
        c = c.join(t.select(F.col("value").alias(f"_v_{k}"), F.col("share").alias(f"_t_{k}")), F.col(k).eqNullSafe(F.col(f"_v_{k}")), "left").drop(f"_v_{k}")
        c = c.withColumn(f"_t_{k}", F.coalesce(f"_t_{k}", F.when(F.col("tokens") > 0, 0.0).otherwise(1.0)))
    c = cut(c.withColumn("_all", F.sum("tokens").over(Window.partitionBy(F.lit(1))).cast("double")), light=True)
    for i in range(rounds):
        for k in targets:
            now = F.sum(F.col("tokens") * F.col("weight")).over(Window.partitionBy(k))
            c = c.withColumn("weight", F.when(now > 0, F.col("weight") * F.col(f"_t_{k}") * F.col("_all") / now).otherwise(F.col("weight")))
        if i % every == every - 1 and i + 1 < rounds:
            c = cut(c, light=True)
    return c.select(*cells.columns, "weight")


def uniform(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(seed))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def rates(raked: DataFrame, fraction: float) -> DataFrame:
    """raked with probability: min(1, scale * weight), with the scale at which the expected tokens are `fraction` of all.
    The heaviest cells are kept whole while their share exceeds 1, and the others share what is left. The windows run
    over the cells, one row for each combination of values, never over documents."""
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("weight"), *DIMENSIONS)
    above, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    c = raked.withColumn("_left", fraction * F.sum("tokens").over(every) - F.coalesce(F.sum("tokens").over(above), F.lit(0)))
    c = c.withColumn("_scale", F.try_divide("_left", F.sum(F.col("tokens") * F.col("weight")).over(rest)))
    fits = F.when(F.col("_scale") * F.col("weight") <= 1, F.col("_scale"))
    c = c.withColumn("_scale", F.max(fits).over(every))
    return c.withColumn("probability", F.least(F.coalesce(F.col("_scale") * F.col("weight"), F.lit(fraction)), F.lit(1.0))).drop("_left", "_scale")


def mixing(described: DataFrame, power: float = 0.7, rounds: int = 12, fraction: float = 0.5, seed: str = "mix", targets: dict[str, DataFrame] | None = None, id_col: str = "doc_id") -> DataFrame:
    """described (id, source, lang, topic, tokens and others) with weight, probability and sampled.

    Token weights are raked to the targets (tempered shares by default). A document is sampled with a probability in
    proportion to its weight, up to 1, so that about `fraction` of all tokens is sampled and their shares are the
    targets as far as no cell is used up; the draw is a hash of its id, alike at every run. Null values of a dimension
    are a value of their own; documents without tokens have their cell's rate; an empty table gives none. described
    should be a written table: it is read once for the cells and once for the result.
    """
    cells = cut(described.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), light=True)
    targets = targets or {k: tempered(cells, k, power) for k in DIMENSIONS}
    raked = cut(rates(rake(cells, targets, rounds), fraction), light=True).select(*(F.col(k).alias(f"_{k}") for k in DIMENSIONS), "weight", "probability")
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in DIMENSIONS]
    d = described.join(raked, on, "left").drop(*(f"_{k}" for k in DIMENSIONS))
    return d.withColumn("sampled", uniform(F.col(id_col), seed) < F.col("probability"))


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", carry: bool = False) -> DataFrame:
    """id, source, lang, topic and tokens of each document, and with `carry` all its columns as one struct, row."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.col(text_col).alias("_t"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    d = d.withColumn("tokens", n_tokens(F.col("_t"))).withColumn("topic", topic_of(F.col("_t"), F.col("tokens")))
    return d.select("doc_id", "source", "lang", "topic", "tokens", *(["row"] if carry else []))


def mix_documents(docs: DataFrame, power: float = 0.7, rounds: int = 12, fraction: float = 0.5, seed: str = "mix", **cols: str) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability, sampled of each document."""
    return mixing(cut(describe(docs, **cols)), power, rounds, fraction, seed)


def sample_documents(docs: DataFrame, power: float = 0.7, rounds: int = 12, fraction: float = 0.5, seed: str = "mix", **cols: str) -> DataFrame:
    """The documents that are sampled, with all their columns."""
    return mixing(cut(describe(docs, carry=True, **cols)), power, rounds, fraction, seed).where("sampled").select("row.*")
