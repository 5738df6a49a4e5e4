"""SimHash near-duplicates through vantage-point trees.

1. Fingerprints: a bit is 1 if set in over half of the XXH64 hashes of a text's 3-word
   shingles.  Copies share a fingerprint, so all later work is on distinct fingerprints.
2. A top tree of vantage points is fitted on a bounded sample (``SAMPLE``) and only cuts the
   space into shards: at a node, fingerprints at most ``mu`` bits from the vantage point go
   inside, others outside.  Every fingerprint has one home shard and also visits each later
   shard that the triangle bounds d - r <= mu and d + r > mu cannot exclude; so a pair of
   linked fingerprints meets in the home shard of one of them.  No pair is lost, whatever
   the sample is.
3. A shard grows its own vantage-point tree over its home fingerprints and searches it with
   all its fingerprints at once; links are merged into stars as they are found, so a shard
   sends at most one edge for each fingerprint, not all pairs of a group.
4. Connected components over the edges, and the smallest doc_id of each.

Defined cases: a null or empty text has fingerprint zero and links like any other; repeated
rows link; a null id belongs to its component, whose id is the smallest id that is not null
(null if there is none); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import bounds_of, documents, map_texts, stored
from shelfwise.llm.graph import components

SHINGLE, SEED, BITS = 3, 42, 2
#: Fingerprints that the top tree is fitted on, and distinct fingerprints for which a shard is wanted.
SAMPLE, SHARD = 1 << 15, 1 << 14
#: Points of a shard's tree below which all are compared.
LEAF = 96


def fingerprints_of(words: int = SHINGLE):
    """Task-side function from texts to fingerprints, as signed longs."""
    from xxhash import xxh64_intdigest as xxh

    def work(texts):
        hashes, counts = [], []
        for t in texts:
            parts = t.lower().split()
            if not parts:
                counts.append(0)
                continue
            line = b" ".join(parts)
            size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
            starts = bounds_of(size)
            n = max(1, len(parts) - words + 1)
            ends = (starts[min(words, len(parts)):] - 1).tolist()
            hashes += [xxh(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends)]
            counts.append(n)
        bounds = bounds_of(counts)
        out = np.zeros((len(texts), 64), np.int64)
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for k in np.nonzero(np.diff(bounds))[0]:      # one by one: sums of many rows at once would copy all bits eightfold
            out[k] = bits[bounds[k]:bounds[k + 1]].sum(axis=0)
        packed = np.packbits(2 * out > np.array(counts)[:, None], axis=1)
        return [packed.copy().view(">u8").ravel().astype(np.uint64).view(np.int64)]

    return work


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id and fp (64 bits as a signed long) of each document."""
    return map_texts(documents(docs), lambda: fingerprints_of(words), "fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int16)


def _vantage(points: np.ndarray, rng) -> tuple[np.int64, int]:
    """Of a few points, the one with the widest spread of distances, and the median distance from it."""
    some = points[rng.integers(0, len(points), 6)]
    probe = points if len(points) <= 512 else points[rng.integers(0, len(points), 512)]
    best = max(some, key=lambda p: float(np.var(distance(probe, p))))
    return best, int(np.median(distance(points, best)))


def top_tree(sample: np.ndarray, depth: int, seed: int = 5) -> list[tuple[int, int]]:
    """Vantage point and radius of each inner node, in heap order."""
    rng, nodes, groups = np.random.default_rng(seed), [], [sample]
    for _ in range(depth):
        below = []
        for g in groups:
            p, mu = _vantage(g, rng) if len(g) else (np.int64(0), 32)
            near = distance(g, p) <= mu
            nodes.append((int(p), mu))
            below += [g[near], g[~near]]
        groups = below
    return nodes


def route(fp: np.ndarray, nodes: list[tuple[int, int]], depth: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, shard, home) of the shards that each fingerprint lives in or visits; only shards after the home are visited."""
    at, node, home = np.arange(len(fp)), np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
    vantage, mu = np.array([n[0] for n in nodes], np.int64), np.array([n[1] for n in nodes], np.int16)
    for _ in range(depth):
        d, m = distance(fp[at], vantage[node]), mu[node]
        inside = d <= m
        go_in, go_out = d - radius <= m, d + radius > m
        # a visitor before its home shard is of no use: from a home node only the outer branch is visited
        left = np.where(home, inside, go_in)
        at = np.concatenate([at[left], at[go_out]])
        home_in, home_out = (home & inside)[left], (home & ~inside)[go_out]
        node = np.concatenate([2 * node[left] + 1, 2 * node[go_out] + 2])
        home = np.concatenate([home_in, home_out])
    return at, node - (2 ** depth - 1), home


def merged(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least reachable number of each of n points by links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


class Links:
    """Links found so far, held as stars."""

    def __init__(self, n: int, most: int = 1 << 20):
        self.n, self.most, self.a, self.b, self.held = n, most, [], [], 0

    def add(self, a, b):
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > self.most + self.n:
            self.shrink()

    def shrink(self):
        if self.held:
            label = merged(np.concatenate(self.a), np.concatenate(self.b), self.n)
            at = np.nonzero(label != np.arange(self.n))[0]
            self.a, self.b, self.held = [at], [label[at]], len(at)


def search(fp: np.ndarray, n_home: int, radius: int, links: Links, seed: int = 3) -> None:
    """Links of all fingerprints with the first ``n_home``: a vantage-point tree, grown and searched at once."""
    rng = np.random.default_rng(seed)
    todo = [(np.arange(n_home), np.arange(len(fp)))]
    while todo:
        points, asked = todo.pop()
        if not len(points) or not len(asked):
            continue
        if len(points) > LEAF:
            p, mu = _vantage(fp[points], rng)
            near = distance(fp[points], p) <= mu
            if near.any() and not near.all():
                d = distance(fp[asked], p)
                todo += [(points[near], asked[d - radius <= mu]), (points[~near], asked[d + radius > mu])]
                continue
        for at in range(0, len(points), LEAF):
            some = points[at:at + LEAF]
            for q in range(0, len(asked), 1 << 14):
                part = asked[q:q + (1 << 14)]
                a, b = np.nonzero(distance(fp[part][:, None], fp[some][None, :]) <= radius)
                other = part[a] != some[b]
                if other.any():
                    links.add(part[a][other], some[b][other])


def shard_edges(radius: int):
    def run(table: pa.Table) -> pa.Table:
        fp, home = table["fp"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
        order = np.argsort(~home, kind="stable")
        fp = fp[order]
        links = Links(len(fp))
        search(fp, int(home.sum()), radius, links)
        links.shrink()
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (links.a, links.b))
        return pa.table({"a": pa.array(fp[a], pa.int64()), "b": pa.array(fp[b], pa.int64())})

    return run


def linked(distinct: DataFrame, radius: int = BITS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Edges (a, b) that connect the same fingerprints as all links of distance at most ``radius`` do."""
    n = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n / shard)))))
    some = [r.fp for r in distinct.select("fp").orderBy(F.xxhash64("fp")).limit(sample).collect()] if depth else []
    nodes = top_tree(np.array(some, np.int64), depth)

    def spread(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            at, to, home = route(fp, nodes, depth, radius)
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(fp[at]), pa.array(home)], ["shard", "fp", "home"])

    return (distinct.select("fp").mapInArrow(spread, "shard long, fp long, home boolean")
            .groupBy("shard").applyInArrow(shard_edges(radius), "a long, b long"))


def grouped(distinct: DataFrame, radius: int, shard: int, sample: int) -> DataFrame:
    """distinct, with the root fingerprint of each row's component."""
    roots = components(linked(distinct, radius, shard, sample))
    return distinct.join(roots, distinct.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(docs: DataFrame, words: int = SHINGLE, radius: int = BITS, shard: int = SHARD,
                    sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links)."""
    seen = stored(fingerprints(docs, words))
    own = grouped(stored(seen.groupBy("fp").agg(F.min("doc_id").alias("first"))), radius, shard, sample)
    least = own.groupBy("root").agg(F.min("first").alias("component_id"))
    named = own.join(least, "root").select("fp", "component_id")
    return seen.join(named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = SHINGLE, radius: int = BITS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """docs, all columns as they are, with one row of each component: that of its smallest doc_id (a null one is
    largest; of texts with one doc_id, that with the least hash; of equal rows, one)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    last = F.lit((1 << 63) - 1)
    packed = docs.select(F.coalesce(F.col("doc_id").cast("long"), last).alias("doc"), F.xxhash64(text).alias("key"),
                         F.struct(*docs.columns).alias("row"))
    seen = map_texts(packed.select("doc", "key", F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text")),
                     lambda: fingerprints_of(words), "fp long", keep=("doc", "key"))
    distinct = stored(seen.groupBy("fp").agg(F.min(F.struct("doc", "key")).alias("first")))
    winners = (grouped(distinct, radius, shard, sample).groupBy("root").agg(F.min("first").alias("first"))
               .select("first.doc", "first.key"))
    nth = F.row_number().over(Window.partitionBy("doc", "key").orderBy(F.lit(0)))
    return (packed.join(winners, ["doc", "key"], "left_semi").withColumn("nth", nth).filter("nth = 1")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
