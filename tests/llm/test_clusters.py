"""ns-bounds clustering against plain Lloyd rounds."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, v string, c string, distance string, h string"


def brute(rows, k, rounds, dim, scale, seed):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector, in whole Python numbers."""
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    cents = [v for _, v in sorted(((sha(f"{seed}:{'null' if i is None else i}"), v) for i, v in kept))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        cents = [[sum(x) // len(x) for x in zip(*own)] if (own := [v for (_, v), j in zip(kept, of) if j == c]) else m for c, m in enumerate(cents)]
    last = [near(v) for _, v in kept]
    each = Counter()
    for d, j in last:
        each[j] += d
    return [(i, j, d, each[j], sum(each.values()), sha(",".join(map(str, cents[j])))) for (i, _), (d, j) in zip(kept, last)]


@pytest.fixture(scope="module")
def vectors(spark):
    """The smallest embeddings, cut to 8 components, with left-out, repeated, tied and empty-cluster cases and clashing names."""
    rows = [(r.vec_id, [float(x) for x in r.embedding[:8]]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    nan, inf = float("nan"), float("inf")
    rows += [(None, [0.5] * 8), (None, [0.25] * 8), (9001, None), (9002, [0.1] * 7), (9003, [nan] + [0.0] * 7), (9004, [inf] + [0.0] * 7), (9005, [None] + [0.0] * 7),
             (9006, []), (7, [0.125] * 8), (7, [0.125] * 8)] + [(10_000 + k, [0.1] * 8) for k in range(150)]
    return spark.createDataFrame([(i, e, 1, *["x"] * 5) for i, e in rows], SCHEMA).repartition(4).cache(), \
        [(r[0], r[1]) for r in spark.createDataFrame([(i, e) for i, e in rows], "i long, e array<float>").collect()]


@pytest.mark.parametrize("k, rounds", [(16, 3), (5, 8), (1, 2), (3, 0), (2000, 2)])
def test_clusters(vectors, k, rounds):
    from shelfwise.llm.clusters import clustered
    df, rows = vectors
    got = Counter(map(tuple, clustered(df, k, rounds, 8, 1000.0, 3).collect()))
    assert got == Counter(brute(rows, k, rounds, 8, 1000.0, 3))


def test_clusters_of_production_parameters(spark):
    from shelfwise.llm.clusters import clustered
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert Counter(map(tuple, clustered(df).collect())) == Counter(brute(rows, 16, 3, 64, 64, 1))


def test_clusters_edges(spark, vectors):
    from shelfwise.llm.clusters import LIMIT, cluster, clustered
    df, _ = vectors
    assert clustered(df.limit(0)).count() == 0 and clustered(df, dim=9).count() == 0
    big = spark.createDataFrame([(1, [3e38] * 8), (2, [-3e38] * 8), (3, [0.0] * 8)], "vec_id long, embedding array<float>")
    out = cluster(big, 2, 1, 8)
    assert {r.vec_id for r in out.vectors.collect()} == {1, 2, 3} and abs(out.centroids).max() == LIMIT


def test_bounds_save_work_and_are_tighter_than_summed_steps():
    """Far groups are settled without a look; a centroid that swings back costs nothing, which summed steps would."""
    from shelfwise.llm.clusters import History, settle, squared
    rng = np.random.default_rng(1)
    home = rng.integers(-1000, 1000, (8, 16))
    v = np.repeat(home, 200, 0) + rng.integers(-3, 4, (1600, 16))
    rounds, state = [home], {n: np.full(len(v), x, t) for n, x, t in (("cluster", 0, np.int32), ("seen", -1, np.int32), ("near", 0, np.int64), ("next", 0, np.int64))}
    assert settle(v, state, History(rounds)).all()
    for t in range(1, 7):
        rounds.append(home + 400 * (t % 2))             # there and back
        open_ = settle(v, state, History(rounds))
        d = squared(v, rounds[-1])
        assert (state["cluster"] == d.argmin(1)).all()
        assert t % 2 or not open_.any()                 # back home: displacement nought, although 400 * t was walked
    assert (np.sqrt(((rounds[-1] - rounds[0]) ** 2).sum(1)) == 0).all()


def test_squared_distances_are_exact_at_all_sizes():
    from shelfwise.llm.clusters import LIMIT, squared
    rng = np.random.default_rng(2)
    for most in (10, 1 << 20, LIMIT):
        a, b = rng.integers(-most, most, (20, 64)), rng.integers(-most, most, (5, 64))
        assert (squared(a, b) == ((a[:, None] - b[None]) ** 2).sum(2)).all()
