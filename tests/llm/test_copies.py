"""Exact, near and line duplicates against brute force."""

import hashlib
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wakeline.llm import common, exact_dedup, line_dedup, ngram_join


def lowered(text):
    return (text or "").encode().lower()


def test_exact_duplicates(cases):
    rows = {r.doc_id: r.text for r in cases.collect()}
    groups = defaultdict(list)
    for i, t in rows.items():
        groups[hashlib.sha256(lowered(t)).hexdigest()].append(i)
    for heavy in (1, 3, 1024):
        got = exact_dedup.exact_duplicates(cases, heavy=heavy).collect()
        assert len(got) == len(rows)
        for r in got:
            g = groups[r.text_sha256]
            assert r.doc_id in g and r.keep_id == max(g) and r.group_size == len(g) and r.kept == (r.doc_id == max(g))


def test_exact_duplicates_edges(edges, none):
    got = exact_dedup.exact_duplicates(edges).collect()
    assert len(got) == edges.count()
    eight = [r for r in got if r.keep_id == 8]
    assert len(eight) == 4 and sum(r.kept for r in eight) == 1 and {r.group_size for r in eight} == {4}
    assert [r.kept for r in got if r.doc_id is None] == [True] and {r.keep_id for r in got if r.doc_id in (1, 2)} == {2}
    assert exact_dedup.exact_duplicates(none).count() == 0
    kept = exact_dedup.drop_exact_duplicates(edges)
    assert kept.columns == edges.columns and sum(r.kept for r in got) == kept.count()


def test_misra_gries_names_every_frequent_digest(spark):
    random.seed(4)
    values = ["a"] * 400 + ["b"] * 300 + [f"x{i}" for i in range(300)]
    random.shuffle(values)
    d = exact_dedup.text_digests(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string").repartition(7))
    found = {r[0] for r in exact_dedup.frequent(d, 4).collect()}
    assert len(found) <= 4 and {hashlib.sha256(v.encode()).digest() for v in "ab"} <= {bytes(x) for x in found}


def shingle_set(text, width=5):
    w = lowered(text).split()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, percent=75):
    """doc_id: (set size, component, links of its class)."""
    sets = {i: shingle_set(t) for i, t in rows.items()}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    reps = {i: s for s, i in first.items() if s}
    up = {i: i for i in reps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    have, degree = defaultdict(list), Counter()
    for i, s in reps.items():
        for g in s:
            have[g].append(i)
    for i, s in reps.items():
        for j, n in Counter(j for g in s for j in have[g] if j > i).items():
            if 100 * n >= percent * (len(s) + len(reps[j]) - n):
                degree[i] += 1
                degree[j] += 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), root(first[s]), degree[first[s]]) if s else (0, i, 0) for i, s in sets.items()}


def near_copies(n=60, words=150, seed=1):
    """Copies of one text with a few changes each, many of them near the threshold, and short ones."""
    random.seed(seed)
    base, out = [f"b{k}" for k in range(words)], {}
    for i in range(n):
        w = list(base)
        for _ in range(random.randrange(9)):
            w[random.randrange(words)] = f"n{random.randrange(10**9)}"
        out[5000 + i] = " ".join(w)
    for i in range(n):
        w = [f"s{k}" for k in range(12 + i % 3)]
        if i % 4:
            w[i % len(w)] = f"t{i}"
        out[6000 + i] = " ".join(w)
    passage = [f"p{k}" for k in range(60)]
    for i in range(2 * n):
        out[7000 + i] = " ".join(passage + [f"q{i}_{k}" for k in range(i % 40)])
    return out


@pytest.mark.parametrize("options", [{}, {"group": 5, "hot": 3}, {"hot": 1, "group": 1000}])
def test_near_duplicates(spark, cases, options):
    rows = {r.doc_id: r.text for r in cases.collect()} | near_copies()
    d = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.links) for r in ngram_join.similar_documents(d, **options).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("options", [{}, {"group": 5, "hot": 3, "room": 500}])
def test_near_components_alone(spark, cases, options):
    """Without links within components the components are the same."""
    rows = {r.doc_id: r.text for r in cases.collect()} | near_copies() | {7000 + i: t for i, t in near_copies(seed=2).items()}
    d = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(d, within=False, **options).collect()}
    assert got == {i: x[:2] for i, x in brute(rows).items()}


def test_each_link(spark):
    rows = near_copies(30)
    d = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    members, links = ngram_join.similar_classes(d)
    got = {(r.a, r.b): (r.common, r.total) for r in links.collect()}
    sets = {i: shingle_set(rows[i]) for i in {r.rep for r in members.collect()}}
    want = {(a, b): (len(s & t), len(s | t)) for a, s in sets.items() for b, t in sets.items() if a < b and 100 * len(s & t) >= 75 * len(s | t)}
    assert got == want and len(want) > 100


def test_near_duplicates_edges(edges, none):
    got = ngram_join.similar_documents(edges).collect()
    assert len(got) == edges.count() and ngram_join.similar_documents(none).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[3].component_id == 3
    assert by[5].component_id == 4 and by[5].n_shingles == 1 and by[11].component_id == 10
    kept = ngram_join.drop_near_duplicates(edges)
    assert kept.columns == edges.columns and {1, 2, 3, 4, 6, 10} <= {r.doc_id for r in kept.collect()}


def test_components(spark):
    random.seed(3)
    pairs = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 160)] + [(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(150)] + [(7, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up if x in got} and {x for p in pairs for x in p if p[0] != p[1]} <= got.keys()
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines(spark, cases):
    rows = {r.doc_id: r.text for r in cases.collect()}
    rows[9000] = "The quick brown fox jumps over the lazy dog near the river bank today.\nshort\n\nab"
    rows[9001] = "the quick brown fox jumps over the lazy dog near the river bank today!\nSHORT \n\nabc"
    d = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    first = {}
    for i in sorted(rows):
        for p, x in enumerate(line_dedup.normal_lines(rows[i])):
            if x:
                first.setdefault(x, (i, p))
    sets = {x: frozenset(x[k : k + 8] for k in range(max(1, len(x) - 7))) for x in first}
    have, up = defaultdict(list), {x: x for x in sets}
    for x, s in sets.items():
        for g in s:
            have[g].append(x)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, s in sets.items():
        for y, n in Counter(y for g in s for y in have[g]).items():
            if 100 * n >= 75 * (len(s) + len(sets[y]) - n):
                a, b = sorted((root(x), root(y)), key=first.get)
                up[b] = a
    keep = defaultdict(set)
    for x in sets:
        if root(x) == x:
            keep[first[x][0]].add(first[x][1])
    wrong = 0
    for r in line_dedup.dedup_lines(d).collect():
        t = rows[r.doc_id]
        own = (t or "").split("\n")
        want = None if t is None else "\n".join(y for k, y in enumerate(own) if k in keep[r.doc_id] or not y.strip())
        assert r.n_lines == len(own)
        wrong += r.text != want
    # recall of the bands is high, not full
    assert wrong <= 0.005 * len(rows)


@pytest.mark.parametrize("families, copies", [(30, 4), (300, 2)])
def test_lines_of_a_template(spark, families, copies):
    """All similar lines of a key are joined, also where its first line and the next one are unlike them."""
    random.seed(5)
    lines = []
    for _ in range(families):
        tail = [random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(24)]
        for _ in range(copies):
            tail[random.randrange(3) * 11] = random.choice("0123456789")
            lines.append("this line is a template that very many pages have in their foot " + "".join(tail))
    lines = list(dict.fromkeys(lines))
    g, first, ids = line_dedup.line_shingles(lines, 8)
    sign, ids = line_dedup.signatures(g, first, 2), ids.view("int64").tolist()
    sets = [frozenset(x[k : k + 8] for k in range(len(x) - 7)) for x in lines]
    pairs = [(a, b) for a in range(len(lines)) for b in range(a) if (sign[:, a] == sign[:, b]).any()]
    links = [(ids[a], ids[b]) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").repartition(5)
    got = {r.node: r.component for r in line_dedup.line_components(docs, bands=2, rows=1).collect()}
    assert got == want and families / 3 < len(set(want.values())) and len(links) < len(pairs) / 5


def test_line_verification():
    """Exact overlaps whatever the blocks, short lines and repeated shingles included, without calls for each pair."""
    random.seed(6)
    base = "".join(random.choice("abcdef \u00e9\U0001f600") for _ in range(300))
    lines = ["a", "ab", "a" * 8, "a" * 40, "ab" * 30, base, base + base, base[:150] + base[10:]]
    for _ in range(60):
        x = list(base)
        for k in random.sample(range(300), random.randrange(25)):
            x[k] = random.choice("xyz")
        lines.append("".join(x))
    lines = list(dict.fromkeys(lines))
    sets = [frozenset(x[k : k + 8] for k in range(max(1, len(x) - 7))) for x in lines]
    pairs = [(a, b) for a in range(len(lines)) for b in range(len(lines))]
    left, right = np.array(pairs).T
    for room in (1, 1 << 13, 1 << 23):
        size, common = line_dedup.common_shingles(lines, left, right, 8, room)
        assert size.tolist() == [len(x) for x in sets]
        assert common.tolist() == [len(sets[a] & sets[b]) for a, b in pairs]
    near = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    rows = [pa.array(left), pa.array(right), pa.array([lines[a] for a in left]), pa.array([lines[b] for b in right])]
    batch, calls = pa.RecordBatch.from_arrays(rows, ["a", "b", "ta", "tb"]), Counter()
    sys.setprofile(lambda frame, event, of: calls.update([event]))
    try:
        (got,) = line_dedup._verified(8, 75)(iter([batch]))
    finally:
        sys.setprofile(None)
    assert set(zip(*(got.column(k).to_pylist() for k in (0, 1)), strict=True)) == near and len(lines) < len(near) < len(pairs)
    assert calls["call"] + calls["c_call"] < 15 * len(pairs)


def test_lines_edges(edges, none):
    got = line_dedup.dedup_lines(edges).collect()
    assert len(got) == edges.count() and line_dedup.dedup_lines(none).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[1].text is None and by[2].text == "" and by[5].text == "" and by[4].text == "one two three"
    assert line_dedup.digests(line_dedup.dedup_lines(edges)).where(F.col("text_sha256").isNull()).count() == 0
