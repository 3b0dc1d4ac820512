"""The queries of the corpus operators, by name, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact_dedup, langid, line_dedup, lm_score, mixing, ngram_join, packing, quality, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op4_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, sha256({NORMAL}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def _mixing_sql(rounds: int = 12, power: float = 0.7) -> str:
    """The raking, a CTE for each margin of each round."""
    head = rf"""
    WITH t AS (SELECT doc_id, source, lang, coalesce(text, '') AS text, len({WORDS.format("text")})::BIGINT AS tokens FROM documents),
    d AS (SELECT doc_id, source, lang, tokens, CASE WHEN len(regexp_extract_all(text, '[#*$%&|<>]')) * 10 > tokens THEN 'markup'
      WHEN tokens < 200 THEN 'short' WHEN tokens < 1000 THEN 'medium' ELSE 'long' END AS topic FROM t),
    cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL)"""
    for k in mixing.DIMENSIONS:
        head += f""",
    p_{k} AS (SELECT {k} AS value, pow(sum(tokens)::DOUBLE, {power}) AS p FROM cells GROUP BY {k} HAVING sum(tokens) > 0),
    s_{k} AS (SELECT value, p / sum(p) OVER () AS share FROM p_{k})"""
    head += """,
    w0 AS (SELECT c.*, (sum(tokens) OVER ())::DOUBLE AS every, 1e0 AS weight, """ + ", ".join(f"coalesce(s_{k}.share, CASE WHEN tokens > 0 THEN 0e0 ELSE 1e0 END) AS t_{k}" for k in mixing.DIMENSIONS) + " FROM cells c " + " ".join(f"LEFT JOIN s_{k} ON c.{k} IS NOT DISTINCT FROM s_{k}.value" for k in mixing.DIMENSIONS) + ")"
    n = 0
    for _ in range(rounds):
        for k in mixing.DIMENSIONS:
            n += 1
            head += f""",
    w{n} AS (SELECT * REPLACE (CASE WHEN sum(tokens * weight) OVER m > 0 THEN weight * t_{k} * every / sum(tokens * weight) OVER m ELSE weight END AS weight) FROM w{n - 1} WINDOW m AS (PARTITION BY {k}))"""
    return head + f""",
    a AS (SELECT *, (0.5e0 * sum(tokens) OVER () - coalesce(sum(tokens) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / nullif(sum(tokens * weight) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS scale FROM w{n}),
    r AS (SELECT *, least(coalesce(max(CASE WHEN scale * weight <= 1 THEN scale END) OVER () * weight, 0.5e0), 1e0) AS probability FROM a)
    SELECT d.doc_id, d.topic, d.tokens, round(r.weight, 6) AS weight, round(r.probability, 6) AS probability,
      ('0x' || substr(md5(d.doc_id::VARCHAR || 'mix'), 1, 8))::BIGINT / 4294967296e0 < r.probability AS sampled
    FROM d LEFT JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang AND d.topic = r.topic"""


@query("op5_mixing", _mixing_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "topic", "tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "sampled")


def _quality_sql(min_rows: int = 100) -> str:
    ink = r"[^\x20\x09-\x0D]"
    measures = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS measure, ({v.replace(' div ', ' // ')})::BIGINT AS v FROM f WHERE NOT base_failed" for k, (v, _, _) in quality.MEASURES.items())
    shift = "(length(bin(v)) - 5)"
    top = lambda b: f"CASE WHEN {b} < 32 THEN {b} ELSE ((({b} - ({b} // 16 - 1) * 16 + 1)::BIGINT) << ({b} // 16 - 1)::INT) - 1 END"

    def quartiles(name: str, by: str) -> str:
        group = f"{by}, measure" if by else "measure"
        return f"""
    {name}_m AS (SELECT {group}, bucket, sum(n) AS n FROM sketch GROUP BY ALL),
    {name}_u AS (SELECT *, sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {group}) AS every FROM {name}_m),
    {name}_b AS (SELECT {group}, max(every) AS rows_, (min(bucket) FILTER (WHERE 4 * upto >= every))::BIGINT AS b1, (min(bucket) FILTER (WHERE 4 * upto >= 3 * every))::BIGINT AS b3 FROM {name}_u GROUP BY ALL),
    {name} AS (SELECT {group}, rows_, {top("b1")} AS q1, {top("b3")} AS q3 FROM {name}_b)"""

    pick = lambda q: f"CASE WHEN o.rows_ >= {min_rows} THEN o.{q} WHEN l.rows_ >= {min_rows} THEN l.{q} ELSE e.{q} END"
    slack = lambda at: "CASE o.measure " + " ".join(f"WHEN '{k}' THEN {m[at]}" for k, m in quality.MEASURES.items() if m[at] is not None) + " END"
    ok = " AND ".join(f"coalesce(({v.replace(' div ', ' // ')}) <= hi_{k}, true)" + ("" if lo is None else f" AND coalesce(({v.replace(' div ', ' // ')}) >= lo_{k}, true)") for k, (v, _, lo) in quality.MEASURES.items())
    wide = ", ".join(f"max(CASE WHEN measure = '{k}' THEN {b} END) AS {b}_{k}" for k in quality.MEASURES for b in ("lo", "hi"))
    return rf"""
    WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS.format("text")} AS w FROM documents),
    k AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, w FROM t WHERE len(w) >= 8),
    g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p:p + 7], ' ')) AS n FROM k),
    s AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM g WHERE n > 1),
    r AS (SELECT doc_id, sum(least(8, p - coalesce(before, p - 8)))::BIGINT AS n FROM s GROUP BY doc_id),
    f0 AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{ink}')) AS lines FROM t),
    f AS (SELECT doc_id, lang, source, n_words, word_chars, n_symbols, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
      coalesce(r.n, 0)::BIGINT AS n_repeat_words, n_words < 20 OR 100 * coalesce(r.n, 0) > 30 * n_words AS base_failed FROM f0 LEFT JOIN r USING (doc_id)),
    m AS ({measures}),
    sketch AS (SELECT lang, source, measure, (CASE WHEN v < 32 THEN v ELSE {shift} * 16 + (v >> {shift}::INT) END)::BIGINT AS bucket, count(*) AS n FROM m GROUP BY ALL),
    {quartiles("o", "lang, source")}, {quartiles("l", "lang")}, {quartiles("e", "")},
    q AS (SELECT o.lang, o.source, o.measure, {pick("q1")} AS q1, {pick("q3")} AS q3, {slack(2)} AS below, {slack(1)} AS above FROM o LEFT JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure LEFT JOIN e ON o.measure = e.measure),
    h AS (SELECT lang, source, measure, q1 - {quality.REACH} * (q3 - q1) - below AS lo, q3 + {quality.REACH} * (q3 - q1) + above AS hi FROM q),
    x AS (SELECT lang, source, {wide} FROM h GROUP BY lang, source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {ok} AS kept
    FROM f LEFT JOIN x ON f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source"""


@query("op6_quality_rules", _quality_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op9_harmonic_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


def _chat_sql() -> str:
    escaped, role = "text", "role"
    for plain, code in chat._CODES.items():
        escaped = f"replace({escaped}, '{plain}', '{code}')"
    for plain, code in chat._ROLE_CODES.items():
        role = f"replace({role}, {'chr(10)' if plain == chr(10) else repr(plain)}, '{code}')"
    hit = " OR ".join(f"contains(text, '{c}')" for c in chat.CONTROLS)
    extra = len(chat.START) + 1 + len(chat.END)
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    r AS (SELECT *, length({role}) + {extra} + CASE WHEN {hit} THEN length({escaped}) + {len(chat.MARK)} ELSE length(text) END AS n FROM c),
    g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' {order}) AS turns,
      coalesce(string_agg(text, '' {order}) FILTER (WHERE role = 'assistant'), '') AS loss, sum(n)::BIGINT AS formatted_chars FROM r GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""


@query("op7_chat_formatting", _chat_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_conversations(turns))


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query(
    "op10_warc",
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM m
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))
