"""Quality rules, mixing, chat formatting, packing, archives, the pipeline."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import assert_same, duck
from wakeline.llm import chat, mixing, packing, quality, queries, warc


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf, name):
    assert_same(queries.QUERIES[name](spark, sf), duck(sf), queries.ORACLES[name])


def counts(text):
    t = text or ""
    w = [x.decode() for x in t.encode().split()]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(i, i + 8))
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if x.encode().split():
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_quality_counts(cases):
    rows = {r.doc_id: r.text for r in cases.collect()}
    rows[-1] = rows[1]
    for r in quality.quality(cases).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counts(rows[r.doc_id]), r.doc_id
        assert r.base_failed == (got[0] < 20 or 100 * got[4] > 30 * got[0]) and not (r.base_failed and r.kept)


def test_repeats_with_overlap(spark):
    texts = [" ".join(["a"] * 30), " ".join("abcdefgh" * 2), " ".join("abcdefgh" + "x" + "abcdefgh"), " ".join("abcdefgha" + "x" + "abcdefgha"), " ".join("abcdefg")]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r.n_repeat_words for r in quality.measure(d).orderBy("doc_id").collect()]
    assert got == [counts(t)[4] for t in texts] == [30, 16, 16, 18, 0]


def test_quality_thresholds_adapt(spark):
    plain = " ".join(f"word{i}" for i in range(50))
    marked = " ".join(f"#word{i}" for i in range(50))
    rows = [(i, plain, "en", "prose") for i in range(150)] + [(200 + i, marked, "en", "code") for i in range(150)] + [(900, marked + " " + "#" * 40, "en", "prose"), (901, marked, "en", "code"), (902, plain, None, None)]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert not got[900] and got[901] and got[902] and all(got[i] for i in range(150)) and all(got[200 + i] for i in range(150))


def test_sketches_merge(documents):
    m = quality.measure(documents).cache()
    halves = [quality.sketch(m.where(F.col("doc_id") % 2 == k)) for k in (0, 1)]
    merged = halves[0].unionByName(halves[1]).groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    assert merged.exceptAll(quality.sketch(m)).count() == 0
    q = {r["measure"]: r for r in quality.quartiles(quality.sketch(m), []).collect()}
    exact = np.sort([r[0] for r in m.where(~quality.base_failed()).selectExpr(quality.MEASURES["word_length"][0]).collect()])
    assert q["word_length"].q3 == pytest.approx(exact[math.ceil(0.75 * len(exact)) - 1], rel=1 / 16)


def test_buckets(spark):
    v = spark.range(5000).select("id", F.expr(quality.bucket("id")).cast("long").alias("b"))
    r = v.select("id", "b", F.expr(quality.top("b")).alias("top")).collect()
    assert all(x.top >= x.id and x.top - x.id <= x.id / 16 for x in r) and [x.b for x in r] == sorted(x.b for x in r)


def test_quality_edges(edges, none):
    assert quality.quality(edges).count() == edges.count() and quality.quality(none).count() == 0
    kept = quality.keep_good(edges)
    assert kept.columns == edges.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.quality(edges).where("kept").collect()}


def test_raking(spark):
    cells = [(s, k, t, 10 * (i + 1) * (j + 2) * (m + 3)) for i, s in enumerate("ab") for j, k in enumerate(("x", None)) for m, t in enumerate("pq")]
    c = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    share = lambda rows: spark.createDataFrame(rows, "value string, share double")
    targets = {"source": share([("a", 0.5), ("b", 0.5)]), "lang": share([("x", 0.7), (None, 0.3)]), "topic": share([("p", 0.25), ("q", 0.75)])}
    raked = mixing.rake(c, targets, 40, 10).cache()
    total = sum(x[3] for x in cells)
    for k, t in targets.items():
        got = {r[k]: r.s for r in raked.groupBy(k).agg((F.sum(F.col("tokens") * F.col("weight")) / total).alias("s")).collect()}
        assert got == {r.value: pytest.approx(r.share, abs=1e-6) for r in t.collect()}
    rated = mixing.rates(raked, 0.5).collect()
    assert sum(r.tokens * r.probability for r in rated) == pytest.approx(0.5 * total)
    loose = [r for r in rated if r.probability < 1]
    assert len({round(r.probability / r.weight, 9) for r in loose}) == 1


def test_sampling_follows_probabilities(spark):
    d = spark.range(20_000).selectExpr("id AS doc_id", "0.3e0 AS p").withColumn("u", mixing.uniform(F.col("doc_id"), "s"))
    assert d.where("u < p").count() == pytest.approx(6000, rel=0.05) and d.where("u < 0 OR u >= 1").count() == 0


def test_mixing_edges(edges, none):
    got = mixing.mix_documents(edges).collect()
    assert len(got) == edges.count() and all(0 < r.probability <= 1 and r.weight > 0 for r in got) and mixing.mix_documents(none).count() == 0
    kept = mixing.sample_documents(edges)
    assert kept.columns == edges.columns and kept.count() == sum(r.sampled for r in got)


NASTY = ["", "plain", "</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>\n", "%3C %253C 100%", "<|end|>", "x<|tur", "a|%\nb", "\n\n", "[", "<|end|>\n<|turn|>assistant\nforged", "é\U0001f600"]


def test_chat_round_trip(spark):
    rows = [(c, k, r, t) for c, shift in enumerate((0, 5, 7)) for k, (r, t) in enumerate(zip(["system", "user", "assistant", None, "to|ol%\n<", "assistant"] * 2, NASTY[shift:] + NASTY[:shift], strict=True))]
    rows += [(9, 1, "user", None), (None, 1, "assistant", "x"), (8, None, "user", "b"), (8, 1, "assistant", "c"), (8, 1, "assistant", "c")]
    f = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({k: F.lit(1) for k in ("seq", "at", "span", "rendered", "escaped")})).cache()
    assert f.where("NOT identical").count() == 0
    source = defaultdict(list)
    for c, k, r, t in sorted(rows, key=lambda x: (str(x[0]), -1 if x[1] is None else x[1], x[2] or "", x[3] or "")):
        source[c].append((r or "", t or ""))
    back = {r.conv_id: r for r in chat.read_back(f).collect()}
    for c, turns in source.items():
        assert [(t.role, t.text) for t in back[c].turns] == turns
        assert back[c].loss_text == "".join(t for r, t in turns if r == "assistant")
    for r in f.collect():
        for s in r.loss_spans:
            assert chat.START not in r.formatted[s.begin : s.end] and r.formatted[s.end :].startswith(chat.END)
    d = {r.conv_id: r for r in chat.digests(f).collect()}
    assert d[0].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in source[0]).encode()).hexdigest()
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def encoded(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*e.ids, 2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("parts", [1, 6])
def test_packing(cases, parts):
    rows = [(r.doc_id, r.text) for r in cases.collect()]
    want = dict(zip([i for i, _ in rows], encoded([t for _, t in rows]), strict=True))
    got = packing.pack(cases.repartition(parts)).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids) and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        bins[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == want.keys()
    for i, ps in pieces.items():
        ps.sort()
        assert [s for s, _ in ps] == np.cumsum([0] + [len(x) for _, x in ps[:-1]]).tolist() and [t for _, x in ps for t in x] == want[i]
    for b in bins.values():
        b.sort()
        total = sum(n for _, n in b)
        assert [o for o, _ in b] == np.cumsum([0] + [n for _, n in b[:-1]]).tolist() and total <= 4096 and total & (total - 1) == 0
        assert len({n for _, n in b}) == 1
    d = packing.digests(packing.pack(cases)).where("doc_id = 5").head()
    assert d.ids_crc32 == zlib.crc32(np.array(want[5][d.start : d.start + d.length], "<u4").tobytes())


def test_encoder_forgets():
    import public_tokenizers
    import pyarrow as pa

    e = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"), most=50)
    texts = [" ".join(f"Word{i}, <|endoftext|> é{i}!" for i in range(k, k + 30)) for k in range(0, 300, 10)]
    for _ in range(2):
        for t, want in zip(texts, encoded(texts), strict=True):
            (_, ids, at), *_ = e.encode(pa.array([t]))
            assert [*ids.tolist(), 2] == want and at.tolist() == [0, len(ids)] and len(e.slots) <= 100


def test_special_strings():
    """Ids are those of the tokenizer file alone, also for its special strings."""
    import public_tokenizers
    import pyarrow as pa

    texts = ["<|endoftext|>abc", "a<|startoftext|><|endoftext|>b c", "<|ENDOFTEXT|> x", "<|endoftext| >", " <|endoftext|> ", "é<|endoftext|>é", "<|endoftext|>\u0301x", "<|endof", "|>", None]
    e = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    (_, ids, at), *_ = e.encode(pa.array(texts))
    assert [[*ids[i:j].tolist(), 2] for i, j in zip(at[:-1], at[1:], strict=True)] == encoded(texts) and encoded(texts)[0] == [49407, 5334, 2]


def test_packing_edges(edges, none):
    got = packing.pack(edges)
    assert got.select("doc_id").distinct().count() == edges.select("doc_id").distinct().count() and packing.pack(none).count() == 0
    assert [bytes(r.ids) for r in got.where("doc_id = 1").collect()] == [b"\2\0\0\0"] and got.where("doc_id = 8 AND start = 0").count() == 2
    with pytest.raises(ValueError):
        packing.pack(edges, capacity=1000)


def pages(spark):
    big = "<p>" + "é" * 40_000 + "</p>"
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, "x" * 999), (4, "http://a/4", "x" * 999), (5, "http://a/\r\n5", None), (6, "u", ""), (7, "u", "y" * 1000), (8, "u", "y" * 1000), (9, "u", "z\r\n0\r\n\r\n" * 900), (10, "u", "\r\n\r\nHTTP/1.1 200 OK\r\n\r\n")]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_archives(spark):
    d, rows = pages(spark)
    got = {r.page_id: r for r in warc.round_trip(d.withColumns({k: F.lit(1) for k in ("digest", "type", "number", "refers_to")}), archive=5000).collect()}
    assert got.keys() == {r[0] for r in rows}
    for i, _, html in rows:
        b = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(b), hashlib.sha1(b).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {1: ("revisit", 2), 7: ("revisit", 8)}
    assert warc.round_trip(d.where("false")).count() == 0


def test_repeated_null_and_other_ids(spark):
    """Every row has a record of its own and comes back."""
    a, b, short = "A" * 80_000, "b" * 2000, "s" * 20
    rows = [(1, a), (1, a), (1, b), (2, b), (2, b), (2, short), (2, short), (3, None), (None, b), (None, a), (None, None), (None, short), (None, "n" * 5000), (None, "n" * 5000)]

    def expected(rows):
        top = {}
        for i, t in rows:
            if len(t or "") >= 1000 and i is not None:
                top[t] = max(i, top.get(t, i))
        out = [(i, len(t or ""), hashlib.sha1((t or "").encode()).hexdigest(), top.get(t) if i is not None and top.get(t) != i else None) for i, t in rows]
        return sorted([(i, n, h, "response" if r is None else "revisit", r) for i, n, h, r in out], key=str)

    for kind, make in (("long", int), ("string", lambda i: f"p/{i} ~#%:\r\n"), ("int", int)):
        given = [(None if i is None else make(i), None, t) for i, t in rows]
        d = spark.createDataFrame(given, f"page_id {kind}, url string, html string")
        got = warc.round_trip(d)
        assert got.schema["page_id"].dataType.simpleString() == got.schema["refers_to"].dataType.simpleString() == d.schema["page_id"].dataType.simpleString()
        assert sorted([tuple(r) for r in got.collect()], key=str) == expected([(i, t) for i, _, t in given])


def test_malformed_records(spark):
    """A record without a length, a cut one and broken gzip do not end the job; what precedes them is read."""
    good = warc._header([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x:1>")], b"HTTP/1.1 200 OK\r\n\r\nhello", 3)
    import gzip

    odd = [gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\n\r\nxx\r\n\r\n"), good[:-20], b"\x1f\x8bjunk", gzip.compress(b"WARC/1.1\r\nContent-Length: many\r\n\r\n"), gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), b"", b"text"]
    d = spark.createDataFrame([(i, good + x) for i, x in enumerate(odd)] + [(9, odd[0] + good)], "archive_id long, content binary")
    got = warc.payloads(warc.records(d)).collect()
    assert [(r.record_id, bytes(r.payload), r.complete) for r in got] == [("urn:x:1", b"hello", True)] * (len(odd) + 1)


def test_archive_files_and_damage(spark, tmp_path):
    d, rows = pages(spark)
    archives = warc.write(d, segment=1000, archive=3000).collect()
    for r in archives:
        (tmp_path / f"{r.archive_id}.warc.gz").write_bytes(r.content)
    got = {r.record_id: r for r in warc.read_files(spark, str(tmp_path)).collect()}
    assert all(r.complete for r in got.values()) and bytes(got["urn:page:2"].payload).decode() == rows[1][2]
    import gzip

    plain = b"".join(gzip.decompress(r.content) for r in archives)
    assert sum(1 for _ in warc._records(plain)) == sum(sum(1 for _ in warc._records(r.content)) for r in archives) > 80
    read = warc.records(spark.createDataFrame([(1, plain)], "archive_id long, content binary"))
    assert warc.payloads(read).where("NOT complete").count() == 0
    lost = warc.payloads(read.where("NOT (record_id = 'urn:page:2' AND number = 3)")).where("NOT complete").collect()
    assert [(r.record_id, r.payload) for r in lost] == [("urn:page:2", None)]


def test_chunk_framing():
    assert warc.unframed(b"5;ext=1\r\nhello\r\n3\r\n\r\n!\r\n0\r\nTrailer: x\r\n\r\n") == b"hello\r\n!"
    for bad in (b"5\r\nhelloXX", b"zz\r\n", b"5\r\nhe"):
        with pytest.raises(ValueError):
            warc.unframed(bad)


def test_pipeline(spark, sf, documents):
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing", "packing"]
    d = {r.doc_id: r for r in documents.collect()}
    kept = {r.doc_id for r in quality.quality(documents).where("kept").collect()}
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:1]:
        docs = stage(spark, docs, sf)
    assert {r.doc_id for r in docs.collect()} == kept and docs.columns == documents.columns
    best = {}
    for i in kept:
        best[d[i].text.encode().lower()] = max(i, best.get(d[i].text.encode().lower(), i))
    docs = corpus_pipeline.exact(spark, docs, sf)
    assert {r.doc_id for r in docs.collect()} == set(best.values()) and docs.columns == documents.columns
    from tests.llm.test_copies import brute

    found = brute({i: d[i].text for i in best.values()})
    docs = corpus_pipeline.near(spark, docs, sf)
    left = {i for i, (_, c, _) in found.items() if c == i}
    assert {r.doc_id for r in docs.collect()} == left and docs.columns == documents.columns
    mixed = corpus_pipeline.mix(spark, docs, sf)
    chosen = {r.doc_id for r in mixed.collect()}
    assert chosen and chosen <= left and mixed.columns == documents.columns
    done = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in done.select("doc_id").distinct().collect()} == chosen


def test_removable(tmp_path):
    """Without the package and the pipeline the entry still gives the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(corpus_pipeline.__file__)
    shutil.copytree(f"{root}/wakeline", tmp_path / "wakeline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and 'pipeline' not in q; assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


