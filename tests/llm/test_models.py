"""Scoring and language identification."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from wakeline.llm import langid, lm_score


def words(text):
    return (text or "").encode().lower().split() + [None]


def test_base_scores(cases):
    rows = {r.doc_id: words(r.text) for r in cases.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    count = Counter(w for i, t in rows.items() if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    got = lm_score.score_texts(cases).collect()
    assert len(got) == len(rows)
    for r in got:
        t = rows[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(count[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert r.score < 0
    for side in (True, False):
        assert sum(r.score for r in got if r.held_out == side) > sum(r.base_score for r in got if r.held_out == side)


def test_blocks_do_not_matter(spark, documents, tmp_path):
    """The same scores from one file, from many small blocks and from a table that is no file."""
    one = {r.doc_id: (r.score, r.in_context) for r in lm_score.score_texts(documents).collect()}
    two = {r.doc_id: (r.score, r.in_context) for r in lm_score.score_texts(documents, block_bytes=20_000).collect()}
    documents.repartition(5).write.parquet(str(tmp_path / "d"))
    three = {r.doc_id: (r.score, r.in_context) for r in lm_score.score_texts(spark.createDataFrame(documents.collect())).collect()}
    four = {r.doc_id: (r.score, r.in_context) for r in lm_score.score_texts(spark.read.parquet(str(tmp_path / "d"))).collect()}
    for other in (two, three, four):
        assert other.keys() == one.keys() and all(other[i][1] == one[i][1] and other[i][0] == pytest.approx(one[i][0]) for i in one)


def test_scores_by_brute_force(spark, documents):
    """The model as its docstring has it, with dictionaries."""
    extra = [(10_000 + i, f"the cat sat on the mat number{i % 3} and the dog ran", None, None, 0) for i in range(60)]
    docs = documents.unionByName(spark.createDataFrame(extra, documents.schema))
    rows = {r.doc_id: words(r.text) for r in docs.collect()}
    train = [t for i, t in rows.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    total, after = {1: Counter(), 2: Counter()}, {1: {}, 2: {}}
    for t in train:
        for i in range(1, len(t)):
            for k in (1, 2):
                if i >= k:
                    c = tuple(t[i - k : i])
                    total[k][c] += 1
                    after[k].setdefault(c, Counter())[t[i]] += 1
    total[1] = Counter({(w,): m for w, m in count.items()})
    states = {}
    for k in (1, 2):
        for c, seen in after[k].items():
            kept = {w: m for w, m in seen.items() if m >= lm_score.LEAST}
            if not kept:
                continue
            size = total[k][c]
            rest, gain, d = size - sum(kept.values()), 0.0, lm_score.DISCOUNT
            for w, m in kept.items():
                share = 2 ** (math.ceil(6 * math.log2(count[w] + 1)) / 6) / n
                if m > lm_score.LEAST:
                    gain += m * math.log10((m - 1 - d) / (size - 1) / share + (d * len(kept) + rest) / (size - 1))
                else:
                    gain += m * math.log10((d * (len(kept) - 1) + rest + lm_score.LEAST - 1) / max(size - 1, 1))
            gain = (gain + rest * math.log10(max((d * len(kept) + rest - 1) / max(size - 1, 1), 1e-9))) / size
            if gain > 0:
                states[c] = (kept, size, (d * len(kept) + rest) / size, gain)
                assert sum((m - d) / size for m in kept.values()) + states[c][2] == pytest.approx(1.0)
    wrong, deep = 0, 0
    for r in lm_score.score_texts(docs).collect():
        t, want = rows[r.doc_id], 0.0
        for i, w in enumerate(t):
            q = (count[w] + 1) / (n + v + 1)
            one = states.get(tuple(t[i - 1 : i])) if i >= 1 else None
            two = states.get(tuple(t[i - 2 : i])) if i >= 2 else None
            s = two if two and (not one or two[3] > one[3]) else one
            deep += s is not None and s is two
            p = q
            for state in (one, two) if s is two else (one,):
                if state:
                    p = state[2] * p + (max(state[0][w] - lm_score.DISCOUNT, 0) / state[1] if w in state[0] else 0)
            want += math.log10(p)
        wrong += abs(r.score - want) > 1e-4 * abs(want)
    # a gain a hair from 0, or of two states alike, may fall the other way in 32-bit floats
    assert len(states) > 100 and deep > 100 and wrong <= 2


def test_suffixes_smooth_longer_contexts(spark, documents):
    """After a pair whose next words are all other ones, the last word's own next words are likelier than by chance."""
    ids = [i for i in range(20_000, 21_000) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = next(i for i in range(20_000, 21_000) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(i, "amber kestrel dives" if k % 2 else f"x{k % 7} kestrel glides", None, None, 0) for k, i in enumerate(ids)]
    got = {}
    for t in ("amber kestrel glides", "amber kestrel amber"):
        d = documents.unionByName(spark.createDataFrame([*rows, (held, t, None, None, 0)], documents.schema))
        r = lm_score.score_texts(d).where(f"doc_id = {held}").head()
        got[t] = r.score - r.base_score
    assert got["amber kestrel glides"] > got["amber kestrel amber"] + 0.2


def test_rare_contexts_stay_in_large_corpora(spark):
    """A pair seen four times is a context, also beside 600 MB of other training text (white space, to be quick)."""
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2][:4] + [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:1]
    few = spark.createDataFrame([(i, f"a{i} zebra quagga b{i}") for i in ids], "doc_id long, text string")
    blank = spark.range(300, numPartitions=32).selectExpr("cast(null AS long) AS doc_id", "repeat(' ', 2000000) AS text")
    for docs in (few, few.unionByName(blank)):
        got = {r.doc_id: r for r in lm_score.score_texts(docs).where("doc_id IS NOT NULL").collect()}
        assert [got[i].in_context for i in ids] == [1] * 5


@pytest.mark.parametrize("least", [3, 300])
def test_pairs_of_one_portion_reach_the_bit_map(monkeypatch, least):
    monkeypatch.setattr(lm_score, "LEAST", least)
    texts = pa.RecordBatch.from_arrays([pa.array(["zebra quagga " * 400])], ["text"])
    q, rows = 5, pa.Table.from_batches(lm_score._count_words(5, 48)(iter([texts])))
    n = 0
    for bucket in set(rows["bucket"].to_pylist()):
        found = lm_score._sum_words(q, 26)(rows.filter(pa.compute.equal(rows["bucket"], bucket)))
        n += sum(np.unpackbits(np.frombuffer(k, np.uint8)).sum() for x, k in zip(found["kind"].to_pylist(), found["k"].to_pylist(), strict=True) if x == 1)
    assert n == 2


def test_count_table_grows_with_the_vocabulary():
    """Of 16 million words, and as many that are too rare, the rare ones seldom share a cell with a frequent one."""
    q, size = 5, 1 << 19
    bits = lm_score._count_bits(size << q)
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(0, 1 << 59, 2 * size, np.uint64))
    n = rng.choice(np.array([3, 1000, 1, 2]), len(words))
    cells = lm_score._cells(words, n, q, bits)
    own = cells[words[n == 3] >> np.uint64(64 - bits)] == math.ceil(6 * math.log2(4))
    assert own.mean() > 0.75
    fixed = lm_score._cells(words, n, q, 23)
    assert (fixed[words[n == 3] >> np.uint64(64 - 23)] == math.ceil(6 * math.log2(4))).mean() < 0.5


def test_bit_maps_do_not_matter(spark, documents):
    scores = [{r.doc_id: (r.score, r.in_context) for r in lm_score.score_texts(documents, pair_bits=b, triple_bits=b).collect()} for b in (14, 27)]
    assert scores[0] == scores[1]


def test_state_masses():
    context = np.array([1, 1, 1, 2, 2], np.uint64)
    n = np.array([50, 30, 10, 3, 3], np.int64)
    share = np.full(5, 1e-3)
    states, left, gain = lm_score._states(context, n, share, (np.array([1, 2], np.uint64), np.array([100, 4000], np.int64)))
    assert states.tolist() == [1] and gain[0] > 0
    seen = ((n[:3] - lm_score.DISCOUNT) / 100).sum()
    assert left[0] + seen == pytest.approx(1.0)


def test_scores_edges(edges, none):
    got = lm_score.score_texts(edges).collect()
    assert len(got) == edges.count() and lm_score.score_texts(none).count() == 0
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1} and {r.held_out for r in got if r.doc_id is None} == {False}


def test_language_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == d.count()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98 and all(0 <= r.score <= 1 for r in got)


def test_language_scores_by_hand(spark):
    rows = [(i, t, k) for i, (t, k) in enumerate([("the cat and the hat", "en"), ("der hund und die katze", "de"), ("this and that", "en"), ("das ist gut", "de")] * 3)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_docs=10**6)
    f, n = langid.features(["the hund", "Ä 1"], 16)
    assert len(f) == n.sum() and n.tolist() == [27, 12]
    logs = model.matrix[f[: n[0]]].astype(float).sum(0) + model.prior
    want = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
    got = langid.predict(spark.createDataFrame([(1, "the hund")], "doc_id long, text string"), model, []).head()
    assert got.lang_pred == model.labels[int(want.argmax())] and got.score == pytest.approx(want.max(), rel=1e-5)


def test_no_gram_crosses_texts():
    alone = [langid.features([t], 16)[0] for t in ("abc", "", "x y")]
    assert np.array_equal(np.concatenate(alone), langid.features(["abc", "", "x y"], 16)[0])


def test_language_edges(edges, none):
    got = {r.doc_id: r for r in langid.identify(edges).collect()}
    assert {got[i].lang_pred for i in (1, 2, 3, 15)} == {"und"} and got[1].score == 0 and got[12].lang_pred != "und"
    assert langid.identify(edges).count() == edges.count() and langid.identify(none).count() == 0
    unlabelled = edges.withColumn("lang", edges["lang"].substr(9, 9).cast("int").cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled.where("doc_id = 6")).collect()} == {"und"}


def test_word_hashes_follow_bytes_split():
    from wakeline.llm.common import chunks, word_hashes

    texts = ["a  b\tc", "", None, "A b", " \n", "é a", "ab", "a b" * 1000]
    seen = {}
    for i, j, a, offsets in chunks(pa.array(texts), 100):
        h, at = word_hashes(a, offsets)
        for k in range(i, j):
            w = (texts[k] or "").encode().lower().split()
            own = h[at[k - i] : at[k - i + 1]].tolist()
            assert len(own) == len(w)
            for x, y in zip(w, own, strict=True):
                assert seen.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen)
