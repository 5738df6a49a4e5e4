"""Importance resampling towards a target distribution of hashed word features.

1. Counts.  Each task counts the features of its texts in an array of ``buckets`` numbers;
   one row for each task and bucket at most is exchanged.  Both tables are counted whole.
2. Weights are scored from one array: a bucket's gain is the scaled logarithm of how much
   likelier the target makes it than the source, and a document's weight is the sum of the gains
   of its features.  A seeded hash of doc_id adds Gumbel noise, so that the highest scores are a
   draw without replacement in proportion to exp(weight).
3. The cutoff.  The scored rows (five numbers each) are stored once.  The least score of the draw
   is found by bisection of the range of scores: each job counts exactly how many rows reach each of
   ``CUTS`` thresholds, and the interval that holds the wanted count is cut again.  Rows tied at the
   cutoff are parted in the same way by doc_id.  Nothing is sorted, and no row reaches the driver.
4. Ranks.  Rows at or above the cutoff are range partitioned by score, doc_id and place in the
   stored table, which parts equal rows as well; a row's rank is its place in its partition after
   the rows of the partitions before it.  Rows of the cutoff's own score and doc_id that are beyond
   the draw lose their rank again, so the draw has exactly the wanted size.

Defined cases: a null or empty text has no features, weight 0 and no rank; a null doc_id is hashed
as "null" and is larger than any other in ties; repeated rows are drawn and ranked one by one, in the order of
their n_features and then of the stored table; an empty table gives an empty result, an empty
target weighs every bucket by the smoothing alone.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WordTable, bounds_of, documents, map_texts, parts_for, pieces, stored, sums, texts_of

BUCKETS, NGRAM, SEED, PERCENT, MIN_WORDS = 10_000, 1, 2024, 10, 20
#: Thresholds that one counting job tries: four halvings at once.
CUTS = 15
#: Ranked rows for each range partition.
RANK_ROWS = 1 << 20
#: A null doc_id is ordered last, as this number (which no document should have).
LAST = (1 << 63) - 1
#: Word bytes: digits, letters (A-Z lower-cased) and all bytes beyond ASCII; others part words.
FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


class Features:
    """Buckets of all runs of 1 to ``ngram`` words of texts; the buckets of single words are remembered."""

    def __init__(self, buckets: int, ngram: int):
        self.buckets, self.ngram = buckets, ngram
        self.reset()

    def reset(self):
        self.words, self.of_word = WordTable(), np.zeros(0, np.int64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(buckets of all features, bounds of each text)."""
        if self.words.full():
            self.reset()
        split = [t.translate(FOLD).split() for t in texts]
        counts = np.array([len(w) for w in split], np.int64)
        ids = self.words.ids([w for words in split for w in words])
        new, self.words.new = self.words.new, []
        self.of_word = np.concatenate([self.of_word, np.array([crc32(w) % self.buckets for w in new], np.int64)])
        one = self.of_word[ids]
        if self.ngram == 1:
            return one, bounds_of(counts)
        each = []
        bounds = bounds_of(counts)
        for words, a, b in zip(split, bounds[:-1], bounds[1:]):
            more = [crc32(b" ".join(words[k:k + n])) % self.buckets for n in range(2, self.ngram + 1) for k in range(len(words) - n + 1)]
            each.append(np.concatenate([one[a:b], np.array(more, np.int64)]))
        return np.concatenate(each) if each else one, bounds_of([len(x) for x in each])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, ngram: int = NGRAM) -> np.ndarray:
    """Features of a whole table of texts in each bucket; the driver holds ``buckets`` numbers."""

    def run(batches):
        features, total = Features(buckets, ngram), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                total += np.bincount(features(texts_of(part.column(0)))[0], minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = (texts.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():                             # buckets rows at most
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(p / q)) of each bucket, both smoothed by one."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(name: str) -> int:
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, ngram: int = NGRAM, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each document; no shuffle."""

    def make():
        features = Features(len(gain), ngram)

        def work(texts):
            bucket, bounds = features(texts)
            n = np.diff(bounds)
            # runs of n words are fewer by n - 1 than the words: with w words there are w * g - g * (g - 1) / 2 features
            return [n, sums(gain[bucket], bounds)]

        return work

    rows = map_texts(documents(docs), make, "n_features long, weight long")

    def noisy(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            x = np.array([noise(f"{seed}:{'null' if d is None else d}") for d in ids], np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(b.column(2).to_numpy() + x)], [*b.schema.names, "score"])

    return rows.mapInArrow(noisy, "doc_id long, n_features long, weight long, score long")


def _words_for(features: int, ngram: int) -> int:
    """The least number of features of a document with ``features`` words."""
    return sum(max(0, features - n + 1) for n in range(1, ngram + 1))


def threshold(rows: DataFrame, value: Column, wanted: int, lo: int, hi: int, larger: bool = True) -> tuple[int, int]:
    """(cutoff, rows strictly beyond it): the value of the wanted-th row from the top (or from the bottom).

    lo and hi bound the values.  Each job counts the rows that reach each of CUTS thresholds, and only
    those that lie in the interval that is left.
    """
    sign = 1 if larger else -1
    value = value * sign
    lo, hi = (lo, hi) if larger else (-hi, -lo)
    beyond = 0                                           # rows with value > hi
    while lo < hi:
        step = max(1, (hi - lo) // (CUTS + 1))
        cuts = [c for c in range(lo + step, hi + 1, step)][:CUTS]
        inside = rows.filter(value.between(F.lit(lo), F.lit(hi)))
        got = inside.agg(*[F.coalesce(F.sum(F.when(value >= F.lit(c), 1).otherwise(0)), F.lit(0)).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
        reach = [beyond + int(n) for n in got]
        best = max((i for i, n in enumerate(reach) if n >= wanted), default=-1)
        if best + 1 < len(cuts):
            beyond, hi = reach[best + 1], cuts[best + 1] - 1
        if best >= 0:
            lo = cuts[best]
    return sign * lo, beyond


def ranked(top: DataFrame, order: list, parts: int) -> DataFrame:
    """top with rank 1, 2, ... in the given order: range partitions, and the places before each."""
    placed = stored(top.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()))
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}   # a row for each partition
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    starts = F.array(*[F.lit(b).cast("long") for b in before]) if before else F.array(F.lit(0).cast("long"))
    return placed.withColumn("rank", F.get(starts, part.cast("int")) + place + 1).drop("at")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, ngram: int = NGRAM, seed: int = SEED,
             percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (null where it is not drawn)."""
    gain = gains(bucket_counts(docs, buckets, ngram), bucket_counts(target, buckets, ngram))
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    rows = stored(scored(docs, gain, ngram, seed).withColumn("doc", F.coalesce("doc_id", F.lit(LAST)))
                  .withColumn("row", F.monotonically_increasing_id()))
    long_enough = F.col("n_features") >= _words_for(min_words, ngram)
    seen = rows.filter(long_enough).agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    draw = percent * seen.n // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not draw:
        return rows.select(*names[:4], unranked)
    pool = rows.filter(long_enough)
    cut, above = threshold(pool, F.col("score"), draw, seen.lo, seen.hi)
    ties = pool.filter(F.col("score") == cut)
    ends = ties.agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).first()
    last, _ = threshold(ties, F.col("doc"), draw - above, ends.lo, ends.hi, larger=False)
    taken = long_enough & ((F.col("score") > cut) | ((F.col("score") == cut) & (F.col("doc") <= last)))
    order = [F.col("score").desc(), F.col("doc"), F.col("n_features"), F.col("row")]
    parts = max(parts_for(draw, RANK_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    top = ranked(rows.filter(taken), order, parts)
    return (top.select(*names[:4], F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
            .unionByName(rows.filter(~taken).select(*names[:4], unranked)))
