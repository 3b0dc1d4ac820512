"""Self join of documents by Jaccard similarity of word shingles, with a token-group matrix.

1. Every text is read once: its shingle hashes, a digest of the set, and its lowest `sample` hashes.
2. Equal sets become one class. Document frequencies of the sampled tokens are counted over all classes.
3. Two sets that link have at least `need` sampled tokens in common. For sets whose partners have at most `sample` tokens
   this is exact; of larger ones the sample is a uniform draw from the union (lowest hashes), of which a pair just at the
   threshold has fewer than `least` in common with a probability of 2e-9, and far less often above it (a `sample` as
   large as the largest set makes it exact). Hence rarest-first prefixes: sets that link share a token of both prefixes.
4. Classes with a prefix are dealt into groups of similar ones, by the most frequent token of their prefix, in pieces of
   about `group` classes and `room` shingles. The matrix stores the sampled tokens of each group's members and their union.
5. Groups with a common prefix token meet once, however many tokens they share. A member is a query to the other group:
   only if its overlap with that group's union reaches its `need` can it link there, and a pair of groups is opened only
   if both sides have such members. These alone are fetched and compared, exactly, on whole sets.
6. Links feed a distributed union-find.

Without `within`, for components only, each class is first compared with one hub of each of its prefix tokens. Groups are
then pieces of the components so found, and no two pieces of one component meet: a large family of copies costs a
comparison for each member and token, not for each pair.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_map, chunks, components, cut, marked, mix, shingles, small_batches, split_by_ids, trim, word_hashes


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, kind))


def sketches(docs: DataFrame, sample: int, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, digest, tokens): size and 64-bit digest of the shingle set, and its lowest `sample` hashes."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, a, offsets in chunks(batch.column(1)):
                sets = shingles(*word_hashes(a, offsets), width)
                n = np.array([len(s) for s in sets], np.int64)
                digest = mix(np.array([(mix(s).sum(dtype=np.uint64) if len(s) else 0) for s in sets], np.uint64) + n.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(n), pa.array(digest), _lists([s[:sample].view(np.int64) for s in sets], pa.int64())],
                    ["doc_id", "n", "digest", "tokens"],
                )
        trim()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(sketch, f"doc_id {kind}, n long, digest long, tokens array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, grams): the sorted distinct shingle hashes, packed little-endian, of the documents whose doc_id is in
    wanted (distinct ids) and of few others: a bit map of the wanted ids leaves out most others."""
    bits, sent = bit_map(wanted.select(F.xxhash64("doc_id").alias("h")), "h")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(marked(sent.value, batch.column(1).to_numpy().view(np.uint64), bits)))
            for i, j, a, offsets in chunks(batch.column(2)):
                sets = shingles(*word_hashes(a, offsets), width)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "grams"])
        trim()

    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col).cast(wanted.schema["doc_id"].dataType)).alias("h"), F.col(text_col).alias("text"))
    return plain.mapInArrow(pack, f"doc_id {kind}, grams binary")


def _links(left: list, right: list, percent: int, same: bool) -> list[tuple]:
    """Links between members (id, set) of two groups: a member's overlap with the other group's token union is its bound."""
    union = np.unique(np.concatenate([s for _, s in right]))
    sizes = np.array([len(s) for _, s in right])
    owner = np.repeat(np.arange(len(right)), sizes)
    flat = np.concatenate([s for _, s in right])
    order = np.argsort(flat, kind="stable")
    owner, first = owner[order], np.searchsorted(flat[order], union)
    last = np.append(first[1:], len(flat))
    out = []
    for x, s in left:
        at = np.searchsorted(union, s)
        at = at[(at < len(union)) & (union[np.minimum(at, len(union) - 1)] == s)]
        if 100 * len(at) < percent * len(s):
            continue
        spans = [owner[i:j] for i, j in zip(first[at].tolist(), last[at].tolist(), strict=True)]
        common = np.bincount(np.concatenate(spans), minlength=len(right)) if spans else np.zeros(len(right), np.int64)
        for k in np.flatnonzero(100 * common >= percent * (len(s) + sizes - common)).tolist():
            if not same or x < right[k][0]:
                out.append((x, right[k][0], int(common[k]), int(len(s) + sizes[k] - common[k])))
    return out


def _stars(links: list[tuple]) -> list[tuple]:
    """(member, smallest member it reaches by these links, its number of links): a row per member, not per link."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    degree: Counter = Counter()
    for a, b, *_ in links:
        degree[a] += 1
        degree[b] += 1
        if (ra := root(a)) != (rb := root(b)):
            up[max(ra, rb)] = min(ra, rb)
    return [(x, root(x), n) for x, n in degree.items()]


def _opened(percent: int, each: bool):
    """Runs over opened pairs (reps1, grams1, reps2, grams2), with null on the right where a group meets itself. Gives
    each link, or else the stars of each pair of groups."""

    def sets(reps: list, grams: list) -> list[tuple]:
        return [(r, np.frombuffer(g, np.uint64)) for r, g in zip(reps, grams, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                reps1, grams1, reps2, grams2 = (c[row].as_py() for c in batch.columns)
                left = sets(reps1, grams1)
                links = _links(left, sets(reps2, grams2) if reps2 else left, percent, not reps2)
                out += links if each else _stars(links)
            cols = list(zip(*out, strict=True)) or [[]] * (4 if each else 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "common", "total"] if each else ["a", "b", "links"])
        trim()

    return run


def _hub_components(probes: DataFrame, sets_of, percent: int) -> DataFrame:
    """(node, component) by links of classes to the smallest class that has a prefix token of theirs."""
    entries = probes.select("rep", F.explode("tokens").alias("token"))
    hubs = entries.groupBy("token").agg(F.min("rep").alias("hub"))
    pairs = entries.join(hubs, "token").where("rep <> hub").select("rep", "hub").distinct()
    one, two = (probes.select(F.col("rep").alias(k), F.col("need").alias(f"need_{k}"), F.col("shared").alias(f"s_{k}")) for k in ("rep", "hub"))
    pairs = pairs.join(one.hint("merge"), "rep").join(two.hint("merge"), "hub").where("size(array_intersect(s_rep, s_hub)) >= greatest(need_rep, need_hub)")
    pairs = cut(pairs.select("rep", "hub"), light=True)
    sets = sets_of(pairs.select(F.explode(F.array("rep", "hub")).alias("doc_id")).distinct())
    one, two = (sets.select(F.col("doc_id").alias(k), F.array("doc_id").alias(f"ids_{k}"), F.array("grams").alias(f"grams_{k}")) for k in ("rep", "hub"))
    both = pairs.join(one.hint("merge"), "rep").join(two.hint("merge"), "hub").select("ids_rep", "grams_rep", "ids_hub", "grams_hub")
    return components(both.mapInArrow(_opened(percent, False), "a long, b long, links long"))


def similar_classes(docs: DataFrame, percent: int = 75, width: int = 5, sample: int = 64, least: int = 24, hot: int = 64, group: int = 64, room: int = 1 << 16, each: bool = True, within: bool = True, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links). members: doc_id, n, rep for each document, where rep is the smallest id with the same set and
    null for an empty set. links: a, b, common, total for each pair of classes that link, a < b; without `each`, rows a, b,
    links: in some part of the work class a has that many links and reaches b, which is enough for components and counts;
    without `within` as well, links of classes that others join already are left out, which is enough for components.

    A link is 100 * common >= percent * total. A document of fewer than `width` words is one shingle of all its words.
    Null and empty texts have no shingles and no links. Ids are integers; rows that repeat an id and text fall in one class, and a row without
    an id in the class of an equal set, if there is one.
    """
    if each and not within:
        raise ValueError("each link is only known with the links within components")
    base = cut(sketches(docs, sample, width, id_col, text_col))
    full = base.where("n > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy("digest", "n").agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"))
    reps = cut(reps, light=True)
    # tokens that at least two classes have, with their document frequency
    entries = reps.select("rep", "n", F.explode("tokens").alias("token"))
    shared = cut(entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), light=True)
    common = entries.join(shared, "token").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct(F.when(F.col("df") > hot, F.col("df")).otherwise(0).alias("hot"), "token", "df"))).alias("common"))
    common = common.withColumn("need", F.when(F.col("n") * 100 <= sample * percent, F.ceil(F.col("n") * percent / 100)).otherwise(least).cast("int"))
    prefix = F.slice("common", F.lit(1), F.greatest(F.size("common") - F.col("need") + 1, F.lit(0)))
    probes = common.select("rep", "n", "need", F.col("common.token").alias("shared"), prefix.alias("p")).where("size(p) > 0")
    probes = cut(probes.select("rep", "n", "need", "shared", F.col("p.token").alias("tokens"), F.expr("array_max(transform(p, x -> named_struct('df', x.df, 'token', x.token))).token AS key")), light=True)

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(doc_id, grams) of the wanted ids; merge joins at any size, so that disk grows evenly."""
        sets = shingle_sets(docs, wanted, width, id_col, text_col)
        return sets.join(wanted.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])

    # groups: classes with the same key, in pieces
    if within:
        keyed = probes.select("rep", "n", "key", F.lit(None).cast("long").alias("label"))
    else:
        comp = _hub_components(probes, sets_of, percent).withColumnsRenamed({"node": "rep", "component": "label"})
        keyed = probes.join(comp, "rep", "left").select("rep", "n", F.coalesce("label", "key").alias("key"), "label")
    keyed = cut(keyed.withColumn("own", F.col("label").isNotNull()), light=True)
    pieces = keyed.groupBy("own", "key").agg(F.ceil(F.greatest(F.count("*") / group, F.sum("n") / room)).alias("pieces"))
    grouped = cut(keyed.join(pieces, ["own", "key"]).select("rep", "label", F.xxhash64("own", "key", F.pmod(F.xxhash64("rep"), F.col("pieces"))).alias("gid")), light=True)
    # the matrix: members' tokens by group, their union, and the tokens that several members have
    stored = probes.join(grouped, "rep").groupBy("gid").agg(F.first("label").alias("label"), F.collect_list(F.struct("rep", "need", "shared")).alias("members"))
    stored = stored.withColumn("every", F.sort_array(F.flatten("members.shared")))
    stored = cut(stored.select("gid", "label", "members", F.array_distinct("every").alias("tokens"), F.expr("array_distinct(filter(every, (x, i) -> i > 0 AND x = every[greatest(i - 1, 0)])) AS several")), light=True)
    # groups meet at their common prefix tokens; of tokens with the same groups one is enough
    index = cut(probes.select("rep", F.explode("tokens").alias("token")).join(grouped, "rep").select("token", "gid", "label").distinct(), light=True)
    alike = index.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("gid")).alias("x"), (F.min(F.coalesce("label", "gid")) < F.max(F.coalesce("label", "gid"))).alias("differ"))
    tokens = alike.where("n > 1 AND differ").groupBy("n", "x").agg(F.min("token").alias("token")).select("token")
    index = cut(index.join(tokens.hint("merge"), "token", "left_semi"), light=True)
    met = index.selectExpr("token", "gid AS g1", "label AS l1").join(index.selectExpr("token", "gid AS g2", "label AS l2").hint("merge"), "token")
    met = met.where("g1 < g2 AND coalesce(l1 <> l2, true)").select("g1", "g2").distinct()
    # bounds: which members of each side reach their need in the other side's union
    one, two = (stored.select(F.col("gid").alias(f"g{k}"), F.col("members").alias(f"m{k}"), F.col("tokens").alias(f"u{k}")) for k in (1, 2))
    reach = lambda m, u: f"transform(filter({m}, x -> size(array_intersect(x.shared, {u})) >= x.need), x -> x.rep)"
    met = met.join(one.hint("merge"), "g1").join(two.hint("merge"), "g2").selectExpr("g1", "g2", f"{reach('m1', 'u2')} AS r1", f"{reach('m2', 'u1')} AS r2").where("size(r1) > 0 AND size(r2) > 0")
    alone = stored.where("label IS NULL AND size(members) > 1").selectExpr("gid AS g1", "gid AS g2", f"{reach('members', 'several')} AS r1", "CAST(NULL AS array<long>) AS r2").where("size(r1) > 1")
    pairs = cut(met.unionByName(alone), light=True)
    # whole sets of such members only, packed by group
    wanted = pairs.select(F.explode("r1").alias("doc_id")).unionByName(pairs.select(F.explode("r2").alias("doc_id"))).distinct()
    sets = sets_of(cut(wanted, light=True)).join(grouped.select(F.col("rep").alias("doc_id"), "gid").hint("merge"), "doc_id")
    sets = cut(sets.groupBy("gid").agg(F.collect_list(F.struct("doc_id", "grams")).alias("s")))
    one, two = (sets.select(F.col("gid").alias(f"g{k}"), F.col("s").alias(f"s{k}")) for k in (1, 2))
    met = pairs.where("g1 <> g2").join(one.hint("merge"), "g1").join(two.hint("merge"), "g2")
    own = pairs.where("g1 = g2").join(one.hint("merge"), "g1").withColumn("s2", F.lit(None).cast(sets.schema["s"].dataType))
    reached = lambda k: f"filter(s{k}, x -> array_contains(r{k}, x.doc_id)) AS s{k}"
    both = met.selectExpr(reached(1), reached(2)).unionByName(own.selectExpr(reached(1), "s2")).select("s1.doc_id", "s1.grams", F.col("s2.doc_id").alias("reps2"), F.col("s2.grams").alias("grams2"))
    links = both.mapInArrow(_opened(percent, each), "a long, b long, common long, total long" if each else "a long, b long, links long")
    if each:
        links = links.selectExpr("least(a, b) AS a", "greatest(a, b) AS b", "common", "total")
    elif not within:
        links = links.unionByName(grouped.where("label <> rep").selectExpr("rep AS a", "label AS b", "CAST(NULL AS long) AS links"))
    # both sides are written tables, so that a large class of copies can be split among tasks
    members = base.select("doc_id", "n", "digest").join(reps.select("digest", "n", "rep"), ["digest", "n"], "left").select("doc_id", "n", "rep")
    return members, links


def similar_documents(docs: DataFrame, percent: int = 75, width: int = 5, id_col: str = "doc_id", text_col: str = "text", within: bool = True, **more) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links, the document's own without any), links
    (of its class to other classes; null without `within`, which finds the components alone, at less cost in large
    families). Empty tables give no rows; see similar_classes for nulls and short texts."""
    members, links = similar_classes(docs, percent, width, each=False, within=within, id_col=id_col, text_col=text_col, **more)
    with small_batches(docs.sparkSession):
        links = cut(links, light=True)
    found = components(links.select("a", "b")).withColumnRenamed("node", "rep")
    if within:
        found = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links")).join(found, "rep", "left")
    count = F.coalesce("links", F.lit(0).cast("long")) if within else F.lit(None).cast("long")
    return members.join(found, "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"), count.alias("links"))


def drop_near_duplicates(docs: DataFrame, percent: int = 75, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns; of each group of linked ones that with the smallest id stays. Texts without
    words have no links and stay; ids must be unique."""
    lost = similar_documents(docs, percent, width, id_col, text_col, within=False).where("doc_id <> component_id").select(F.col("doc_id").alias("_lost"))
    lost = cut(lost, light=True)
    clear, rest = split_by_ids(docs, lost, id_col)
    return clear.unionByName(rest.join(lost, F.col(id_col) == F.col("_lost"), "left_anti"))
