"""Quality rules with adaptive thresholds, in DataFrame operations only.

Each document's counts are taken in one pass. A log-linear histogram per language, source and measure is a quantile
sketch that merges by adding counts (relative error 1/16 at most); sketches merge upwards from a source to its language
and to all rows, so that small groups borrow the thresholds of the next level. A join on language and source brings the
thresholds to the documents and the filter follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, cut

#: measure: (expression in per mille, slack per mille above the upper fence, below the lower fence or null)
MEASURES = {
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", 60, None),
    "word_length": ("1000 * word_chars div greatest(n_words, 1)", 2000, 1500),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", 300, None),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 200, None),
}
#: Fences lie this many interquartile ranges beyond the quartiles.
REACH = 4


def _repeat_words(windows: str, width: int) -> str:
    """Words covered by windows whose hash occurs at least twice; windows is an array of hashes by position."""
    return f"""
    CASE WHEN size(array_distinct({windows})) = size({windows}) THEN 0 ELSE
      transform(array(sort_array(transform({windows}, (x, i) -> named_struct('h', x, 'p', i)))), s ->
        aggregate(
          sort_array(transform(filter(sequence(0, size(s) - 1), k -> coalesce(get(s, k - 1).h = get(s, k).h, false) OR coalesce(get(s, k + 1).h = get(s, k).h, false)), k -> get(s, k).p)),
          named_struct('n', 0, 'e', 0),
          (a, p) -> named_struct('n', a.n + p + {width} - greatest(p, a.e), 'e', p + {width}),
          a -> a.n))[0]
    END"""


def measure(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, width: int = 8) -> DataFrame:
    """The columns `carry` (all by default) and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Whole texts are read; a null text has no words and every count 0. The new names must not be among `carry`.
    """
    carry = docs.columns if carry is None else carry
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.select(*(F.col(f"`{c}`") for c in carry), text.alias("_t"))
    d = d.withColumn("_w", F.filter(F.split("_t", SPACES), lambda x: x != ""))
    d = d.withColumn("_h", F.expr(f"CASE WHEN size(_w) < {width} THEN array() ELSE transform(sequence(1, size(_w) - {width - 1}), i -> xxhash64(slice(_w, i, {width}))) END"))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.regexp_replace("_t", SPACES, "")),
        "n_symbols": F.size(F.split("_t", "[#*$%&|<>]")) - 1,
        "n_lines": F.size("_l"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.expr(_repeat_words("_h", width)),
    }
    return d.select(*(F.col(f"`{c}`") for c in carry), *(v.cast("long").alias(k) for k, v in counts.items()))


def base_failed() -> Column:
    return F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")


def bucket(v: str) -> str:
    """The bucket of a count: itself below 32, else its exponent and four further bits."""
    shift = f"(length(bin({v})) - 5)"
    return f"CASE WHEN {v} < 32 THEN {v} ELSE {shift} * 16 + shiftright({v}, {shift}) END"


def top(b: str) -> str:
    """The largest count in bucket b."""
    s = f"({b} div 16 - 1)"
    return f"CASE WHEN {b} < 32 THEN {b} ELSE shiftleft({b} - {s} * 16 + 1, cast({s} AS int)) - 1 END"


def sketch(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, measure, bucket, n) over documents that the base rule passes; sums of n merge sketches."""
    values = ", ".join(f"'{k}', CAST({v} AS bigint)" for k, (v, _, _) in MEASURES.items())
    long = measured.where(~base_failed()).selectExpr(f"`{lang_col}` AS lang", f"`{source_col}` AS source", f"stack({len(MEASURES)}, {values}) AS (measure, v)")
    return long.groupBy("lang", "source", "measure", F.expr(bucket("v")).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """rows, q1 and q3 of each group and measure, from merged sketches."""
    merged = sketches.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    up = merged.select("*", F.sum("n").over(group.orderBy("bucket")).alias("upto"), F.sum("n").over(group).alias("all"))
    q = up.groupBy(*by, "measure").agg(
        F.max("all").alias("rows"), F.min(F.when(F.expr("4 * upto >= all"), F.col("bucket"))).alias("b1"), F.min(F.when(F.expr("4 * upto >= 3 * all"), F.col("bucket"))).alias("b3")
    )
    return q.select(*by, "measure", "rows", F.expr(top("cast(b1 AS bigint)")).alias("q1"), F.expr(top("cast(b3 AS bigint)")).alias("q3"))


def thresholds(sketches: DataFrame, min_rows: int = 100) -> DataFrame:
    """lang, source and for each measure lo_ and hi_: from the group's own sketch if it has min_rows, else its
    language's, else that of all rows. Null languages and sources are groups of their own."""
    sketches = cut(sketches, light=True)
    own, lang, every = quartiles(sketches, ["lang", "source"]), quartiles(sketches, ["lang"]), quartiles(sketches, [])
    names = [x.withColumnsRenamed({c: f"{p}_{c}" for c in ("rows", "q1", "q3")}) for x, p in ((own, "o"), (lang, "l"), (every, "e"))]
    lang = names[1].withColumnsRenamed({"lang": "l_lang", "measure": "l_measure"})
    every = names[2].withColumnRenamed("measure", "e_measure")
    joined = names[0].join(lang, F.expr("lang <=> l_lang AND measure = l_measure"), "left").join(F.broadcast(every), F.expr("measure = e_measure"), "left")
    pick = lambda q: F.expr(f"CASE WHEN o_rows >= {min_rows} THEN o_{q} WHEN l_rows >= {min_rows} THEN l_{q} ELSE e_{q} END")
    slack = lambda at: F.expr("CASE measure " + " ".join(f"WHEN '{k}' THEN {m[at]}" for k, m in MEASURES.items() if m[at] is not None) + " END")
    fences = joined.select("lang", "source", "measure", pick("q1").alias("q1"), pick("q3").alias("q3")).select(
        "lang", "source", "measure", (F.expr(f"q1 - {REACH} * (q3 - q1)") - slack(2)).alias("lo"), (F.expr(f"q3 + {REACH} * (q3 - q1)") + slack(1)).alias("hi")
    )
    return fences.groupBy("lang", "source").agg(*(F.max(F.when(F.col("measure") == k, F.col(b))).alias(f"{b}_{k}") for k in MEASURES for b in ("lo", "hi")))


def judge(measured: DataFrame, lang_col: str = "lang", source_col: str = "source", min_rows: int = 100) -> DataFrame:
    """measured with base_failed and kept, which is false if the base rule fails or a measure lies beyond its fence.
    measured should be a written table: it is read twice."""
    t = thresholds(sketch(measured, lang_col, source_col), min_rows).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    ok = " AND ".join(f"coalesce({v} <= hi_{k}, true)" + ("" if lo is None else f" AND coalesce({v} >= lo_{k}, true)") for k, (v, _, lo) in MEASURES.items())
    on = F.col(f"`{lang_col}`").eqNullSafe(F.col("_lang")) & F.col(f"`{source_col}`").eqNullSafe(F.col("_source"))
    d = measured.join(t, on, "left").withColumn("base_failed", base_failed()).withColumn("kept", F.expr(f"NOT base_failed AND {ok}"))
    return d.select(*(F.col(f"`{c}`") for c in measured.columns), "base_failed", "kept")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_rows: int = 100) -> DataFrame:
    """One row per document: id, lang, source, the counts of measure(), base_failed and kept. An empty table gives no
    rows; rows that repeat are judged alike; texts, languages and sources may be null; other columns are ignored."""
    named = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in ((id_col, "doc_id"), (lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    return judge(cut(measure(named, "text", ["doc_id", "lang", "source"])), min_rows=min_rows)


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_rows: int = 100) -> DataFrame:
    """The documents that are kept, with all their columns. Texts pass once: their counts are written beside them."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = {c: names[docs.columns.index(c)] for c in (text_col, lang_col, source_col)}
    judged = judge(cut(measure(plain, at[text_col])), at[lang_col], at[source_col], min_rows)
    return judged.where("kept").select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)))
