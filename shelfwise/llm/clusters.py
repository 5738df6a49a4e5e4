"""Exact Lloyd clustering with ns-bounds: the norm of the summed displacement loosens old distances.

Every vector keeps what its last full evaluation found: the round of it, its centroid, and its
squared distances to that centroid and to the nearest other one.  All centroids of all rounds
are kept (rounds * k * dim numbers), so a later round loosens both distances by how far each
centroid has come since that round, in a straight line: |c(now) - c(then)|, which is never more
than the sum of the steps between, and much less where centroids swing.

    upper = near + |c_a(now) - c_a(then)|        lower = next - max over j != a of |c_j(now) - c_j(then)|

A vector with upper < lower keeps its centroid unseen.  If not, the distance to its own centroid
is taken exactly; where that does not settle it either, all centroids are evaluated exactly
(ties: the smaller number) and the round is noted.  The state of a vector is four numbers,
whatever k is.

Numbers.  Components are whole (``floor(scale * x)``), so distances, sums and centroids are exact
integers and no result depends on the order of rows; square roots are taken of exact integers and
compared with a margin far wider than their rounding.

Data movement.  Vectors are never shuffled: each round reads the table of the round before and
writes the next one (whole components, which Parquet packs to a few bits) into the folder that
``spark.checkpoint.dir`` names.  Sums of a round are those of the round before plus what moved:
a task adds up the vectors that changed centroid, so one row for each task and centroid is
exchanged, and a centroid that holds any share of all vectors costs no more than another.  The
driver holds ``k`` rows of sums.

Defined cases: a vector is left out if it is null, has another number of components than ``dim``,
or a component that is null or not finite.  Components beyond +-2**26 after scaling count as that.
Repeated ids are rows of their own; the first centroids are told apart by components where hashes
tie; a null id is hashed as "null".  With fewer than ``k`` vectors there are fewer centroids, and
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored
from shelfwise.session import ensure_checkpoint_dir

K, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64.0, 1
#: Whole components lie within +-LIMIT, so a squared distance of DIM components fits 64 bits.
LIMIT = 1 << 26
#: Vectors that a task evaluates at once.
BLOCK = 1 << 14
#: Wider than any rounding of the square roots and their sums, as a share of the numbers compared.
MARGIN = 1e-12
STATE = "vec_id long, v array<int>, cluster int, before int, seen int, near long, next long, distance long"


@dataclass
class Clusters:
    vectors: DataFrame      # vec_id, cluster, distance (squared, to the final centroid)
    centroids: np.ndarray   # k x dim whole numbers


def whole(embedding: Column, dim: int = DIM, scale: float = SCALE) -> Column:
    """The scaled whole components; null where the vector is left out."""
    x = embedding.cast("array<double>")
    fit = (F.size(x) == dim) & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return F.when(fit, F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")))


def squared(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of v from all centroids."""
    most = int(max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)))
    if 4 * v.shape[1] * most * most < 1 << 53:          # whole numbers that doubles hold exactly: the fast product
        product = (v.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
    else:
        product = v @ centroids.T
    return (v * v).sum(1)[:, None] - 2 * product + (centroids * centroids).sum(1)[None, :]


def own_distance(v: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    d = v - centroids[cluster]
    return np.einsum("ij,ij->i", d, d)


class History:
    """All centroids of all rounds, and how far each has come from any round to the last."""

    def __init__(self, rounds: list[np.ndarray]):
        self.rounds, self.now = rounds, rounds[-1]
        self.moved = np.sqrt(np.array([((self.now - c) ** 2).sum(1) for c in rounds], np.float64))     # rounds x k
        k = self.moved.shape[1]
        top = np.argsort(self.moved, axis=1)[:, -2:]
        self.farthest = top[:, -1]
        self.most = np.take_along_axis(self.moved, top[:, -1:], 1)[:, 0]
        self.second = np.take_along_axis(self.moved, top[:, :1], 1)[:, 0] if k > 1 else np.zeros(len(rounds))

    def others(self, seen: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """The longest way from round ``seen`` among centroids other than ``cluster``."""
        return np.where(self.farthest[seen] == cluster, self.second[seen], self.most[seen])


def settle(v: np.ndarray, state: dict[str, np.ndarray], history: History) -> np.ndarray:
    """Bring a block's state to the last round; returns which rows were evaluated in full.

    ``state`` has cluster, seen, near and next; seen is -1 for rows never evaluated.
    """
    cluster, seen = state["cluster"], state["seen"]
    at = np.maximum(seen, 0)
    lower = np.sqrt(state["next"].astype(np.float64)) - history.others(at, cluster)
    way = history.moved[at, cluster]
    upper = np.sqrt(state["near"].astype(np.float64)) + way
    slack = MARGIN * (np.sqrt(state["next"].astype(np.float64)) + upper + history.most[at] + 1)
    if len(history.now) == 1:
        lower = np.full(len(v), np.inf)                 # no other centroid
    open_ = (seen < 0) | ~(upper + slack < lower)
    check = np.nonzero(open_ & (seen >= 0))[0]          # one exact distance first
    if len(check):
        exact = np.sqrt(own_distance(v[check], history.now, cluster[check]).astype(np.float64))
        open_[check[exact + slack[check] < lower[check]]] = False
    todo = np.nonzero(open_)[0]
    if len(todo):
        d = squared(v[todo], history.now)
        best = d.argmin(1)                              # the first of equals has the smallest number
        cluster[todo], seen[todo] = best, len(history.rounds) - 1
        rows = np.arange(len(todo))
        state["near"][todo] = d[rows, best]
        d[rows, best] = np.iinfo(np.int64).max
        state["next"][todo] = d.min(1) if d.shape[1] > 1 else 0
    return open_


def _advance(rounds: list[np.ndarray], last: bool):
    """Task-side step of a round over state rows; the last one adds exact distances in place of components."""

    def run(batches):
        history = History(rounds)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                col = {n: part.column(part.schema.get_field_index(n)) for n in part.schema.names}
                v = col["v"].flatten().to_numpy().reshape(part.num_rows, -1).astype(np.int64)
                state = {n: col[n].to_numpy().copy() for n in ("cluster", "seen", "near", "next")}
                before = state["cluster"].copy()
                settle(v, state, history)
                before[col["seen"].to_numpy() < 0] = -1
                far = own_distance(v, history.now, state["cluster"]) if last else np.zeros(len(v), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [col["vec_id"], pa.array([[]] * len(v), pa.list_(pa.int32())) if last else col["v"], pa.array(state["cluster"], pa.int32()),
                     pa.array(before, pa.int32()), pa.array(state["seen"], pa.int32()), pa.array(state["near"]), pa.array(state["next"]),
                     pa.array(far)], [x.split()[0] for x in STATE.split(", ")])

    return run


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hashes of ``seed:vec_id``."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return np.array([r.v for r in kept.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()], np.int64)


def moved_sums(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Change of each centroid's count and component sums by the vectors that changed centroid."""
    both = (state.filter("cluster <> before")
            .select("v", F.explode(F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).cast("long").alias("s")),
                                           F.struct(F.col("before").alias("c"), F.lit(-1).cast("long").alias("s")))).alias("m"))
            .filter("m.c >= 0").select("v", "m.c", "m.s"))
    got = both.groupBy("c").agg(F.sum("s").alias("n"), F.array(*[F.sum(F.col("v")[i].cast("long") * F.col("s")) for i in range(dim)]).alias("x"))
    count, total = np.zeros(k, object), np.zeros((k, dim), object)
    for r in got.collect():                             # k rows at most
        count[r.c], total[r.c] = r.n, r.x
    return count, total


def _delete(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: float = SCALE, seed: int = SEED) -> Clusters:
    """``rounds`` rounds of assignment and update, and a last assignment."""
    spark = vectors.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clusters-{uuid4().hex}"
    state = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding"), dim, scale).alias("v"))
             .filter(F.col("v").isNotNull())
             .select("vec_id", "v", *[F.lit(x).cast(t).alias(n) for n, t, x in
                                      (("cluster", "int", 0), ("before", "int", -1), ("seen", "int", -1), ("near", "long", 0), ("next", "long", 0),
                                       ("distance", "long", 0))]))
    start = first_centroids(state, k, seed)
    if not len(start):
        return Clusters(state.select("vec_id", "cluster", "distance"), np.zeros((0, dim), np.int64))
    path, history = None, [start]
    count, total = np.zeros(len(start), object), np.zeros(start.shape, object)
    for t in range(rounds):
        state.mapInArrow(_advance(history, False), STATE).write.parquet(f"{folder}/{t}")
        if path:
            _delete(spark, path)
        path = f"{folder}/{t}"
        state = spark.read.schema(STATE).parquet(path)
        more, sums = moved_sums(state, len(start), dim)
        count, total = count + more, total + sums
        history.append(np.array([x // n if n else c for c, n, x in zip(history[-1], count, total)], np.int64))
    done = stored(state.mapInArrow(_advance(history, True), STATE).select("vec_id", "cluster", "distance"))
    if path:
        _delete(spark, folder)
    return Clusters(done, history[-1])


def report(found: Clusters) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia (null where it exceeds 64 bits), centroid_sha256."""
    spark, each = found.vectors.sparkSession, {}
    for r in found.vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect():   # one row a centroid
        each[r.cluster] = int(r.d)
    fit = lambda x: x if x < 1 << 63 else None
    rows = [(c, fit(d), fit(sum(each.values())), hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest())
            for c, d in each.items()]
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.vectors.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clustered(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: float = SCALE, seed: int = SEED) -> DataFrame:
    return report(cluster(vectors, k, rounds, dim, scale, seed))
