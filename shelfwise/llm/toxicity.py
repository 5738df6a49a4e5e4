"""Toxicity: bags of subword embeddings averaged into a linear softmax.

A word is lower-cased and stripped of outer punctuation; its subwords are its character
3- to 5-grams with edge marks and the whole word, hashed into ``BUCKETS``.  Embeddings and
softmax are trained jointly (Adam, numpy) on at most ``PER_CLASS`` labelled documents of
each class, so an unseen misspelling shares the vectors of its character n-grams.  Class
counts of all training labels correct the intercept for the balanced sample.

The average is weighted: a subword counts by the square of its standardised log odds, which
compare the toxic and the clean documents of the sample that hold it.  A subword that is as
frequent in both, or that one document alone has, weighs little against one that marks several
toxic documents and no clean one, whatever the size of the table; none is left out, and a
subword that the sample lacks weighs nothing.

The score is linear in the mean embedding, so a word adds two numbers (the weight of its
subwords, and the sum of their weighted embeddings times the softmax weights), computed once
per distinct word and task.

Defined cases: null and empty texts get the intercept's score; labels that are null or
not 0 or 1 are left out, of repeated labels the largest counts; without both classes in
the training labels every score is the share of toxic ones (0 without labels).
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import (WordTable, bounds_of, documents, filter_texts, held_out, labelled_sample, map_texts,
                                  sigmoid, sums)

BUCKETS, DIM, SIZES = 1 << 16, 4, (3, 4, 5)
#: Bound of the training sample, for each class.
PER_CLASS = 2000
EPOCHS, BATCH, RATE = 12, 128, 0.05
#: Documents added to either class before log odds are taken, and the weight that every subword of the sample has besides.
PRIOR, LEAST_WEIGHT = 1.0, 1e-3
MOD, REST, THRESHOLD = 4, 2, 0.3
#: Documents are long and the words that matter few, so means are small: they are scaled before the softmax.
SCALE = 100.0
#: Words whose subwords are taken at once.
NEW_WORDS = 1 << 14
EDGES = ".,;:!?\"'()[]{}<>*#$%&|_-~`"


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bounds, and the hashed subwords of each word between them."""
    plain = ["<" + w.decode("utf-8", "replace").lower().strip(EDGES) + ">" for w in words]
    size = np.array([len(w) for w in plain], np.int64)
    ends = np.cumsum(size)
    points = np.frombuffer("".join(plain).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(plain)), size)
    left = ends[word] - np.arange(len(points))              # code points from here to the word's end
    whole = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points * (np.uint64(0x9E3779B97F4A7C15) ** (size[word] - left).astype(np.uint64)), out=whole[1:])
    hashes, of = [whole[ends] - whole[ends - size]], [np.arange(len(plain))]
    for n in SIZES:
        h = np.zeros(max(0, len(points) - n + 1), np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + points[k:k + len(h)]
        ok = left[:len(h)] >= n
        hashes.append(h[ok] + np.uint64(n))
        of.append(word[:len(h)][ok])
    of = np.concatenate(of)
    h = np.concatenate(hashes)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(of, kind="stable")
    return bounds_of(np.bincount(of, minlength=len(plain))), (h >> np.uint64(40))[order].astype(np.int64) % BUCKETS


def bags():
    """Task-side function from texts to their subword buckets and counts."""
    def work(texts):
        split = [t.split() for t in texts]
        found = []
        for words in split:                              # one text at a time: a word has some twenty subwords
            known = WordTable()
            times = np.bincount(known.ids(words), minlength=len(known))
            buckets, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for at in range(0, len(known.new), NEW_WORDS):
                start, flat = subwords(known.new[at:at + NEW_WORDS])
                of = np.bincount(flat, weights=np.repeat(times[at:at + NEW_WORDS], np.diff(start)), minlength=BUCKETS)
                some = np.nonzero(of)[0]
                buckets, counts = np.concatenate([buckets, some]), np.concatenate([counts, of[some].astype(np.int64)])
            x, where = np.unique(buckets, return_inverse=True)
            found.append((x, np.bincount(where, weights=counts, minlength=len(x)).astype(np.int64)))
        return [[x.astype(np.int32) for x, _ in found], [x.astype(np.int32) for _, x in found]]

    return work


def _adam(params: list[np.ndarray]):
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0

    def step(grads, rate):
        nonlocal t
        t += 1
        for p, g, a, b in zip(params, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)

    return step


class Model(NamedTuple):
    embed: np.ndarray        # buckets x DIM
    soft: np.ndarray         # DIM x 2
    bias: np.ndarray         # 2
    weight: np.ndarray       # of each bucket in the average

    def values(self) -> np.ndarray:
        """What a subword adds to the score before it is divided by the weights."""
        return SCALE * self.weight * (self.embed @ (self.soft[:, 1] - self.soft[:, 0]))

    def intercept(self) -> float:
        return float(self.bias[1] - self.bias[0])


def subword_weights(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Squared standardised log odds of each bucket's documents among toxic and clean ones; 0 for buckets of no document."""
    docs = np.zeros((2, BUCKETS))
    for buckets, _, label in rows:
        docs[label][buckets] += 1
    clean, toxic = docs + PRIOR
    n0, n1 = (sum(r[2] == v for r in rows) + 2 * PRIOR for v in (0, 1))
    z = np.log((toxic / n1) / (clean / n0)) / np.sqrt(1 / toxic + 1 / clean)
    return np.where(docs.sum(0) > 0, z * z + LEAST_WEIGHT, 0.0)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Joint training of embeddings and softmax on (buckets, counts, label)."""
    weight = subword_weights(rows)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft, bias = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    step = _adam([embed, soft, bias])
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            some = [rows[i] for i in order[at:at + BATCH]]
            y = np.array([r[2] for r in some])
            idx, doc = np.concatenate([r[0] for r in some]), np.repeat(np.arange(len(some)), [len(r[0]) for r in some])
            part = [weight[r[0]] * r[1] for r in some]
            share = np.concatenate([x / max(x.sum(), 1e-9) for x in part]).astype(np.float32)
            mean = np.stack([np.bincount(doc, weights=embed[idx, k] * share, minlength=len(some)) for k in range(DIM)], 1)
            logit = SCALE * mean @ soft + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = SCALE * (p @ soft.T)
            grad = np.stack([np.bincount(idx, weights=back[doc, k] * share, minlength=BUCKETS) for k in range(DIM)], 1)
            step([grad, SCALE * mean.T @ p, p.sum(0)], RATE * (1 - epoch / EPOCHS))
    return Model(embed, soft, bias, weight)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = MOD, rest: int = REST,
        per_class: int = PER_CLASS) -> tuple[np.ndarray, np.ndarray, float]:
    """(value and weight of each subword, intercept) learnt from labelled rows outside the held-out fold."""
    nothing = np.zeros(BUCKETS), np.zeros(BUCKETS)
    counts = {r.y: r["count"] for r in labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(mod, rest))
              .groupBy(F.col(label).cast("int").alias("y")).count().collect()}
    if len(counts) < 2:
        p = min(max(counts.get(1, 0) / max(1, sum(counts.values())), 1e-9), 1 - 1e-9)
        return *nothing, math.log(p / (1 - p))
    sample = labelled_sample(docs, labels, label, mod, rest, per_class)
    got = map_texts(sample, bags, "buckets array<int>, counts array<int>", keep=("doc_id", "label")).toArrow()
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")          # the order of rows is not fixed, their set is
    columns = [got["buckets"].to_numpy(), got["counts"].to_numpy(), got["label"].to_numpy()]
    del got
    rows = [(np.array(columns[0][k], np.int32), np.array(columns[1][k], np.int32), int(columns[2][k])) for k in order]
    del columns
    n = np.bincount([r[2] for r in rows], minlength=2)
    if not n.all():
        return *nothing, math.log(counts[1] / counts[0])
    model = train(rows)
    return model.values(), model.weight, model.intercept() + math.log(counts[1] / counts[0]) - math.log(n[1] / n[0])


def scorer(values: np.ndarray, weights: np.ndarray, intercept: float):
    """Factory of the task-side function from texts to scores."""
    def make():
        known, value, mass = WordTable(), [np.zeros(0)], [np.zeros(0)]

        def work(texts):
            if known.full():
                known.clear()
                value[0], mass[0] = np.zeros(0), np.zeros(0)
            split = [t.split() for t in texts]
            bounds = bounds_of([len(w) for w in split])
            ids = known.ids([w for words in split for w in words])
            new = [(np.zeros(0), np.zeros(0))]
            for at in range(0, len(known.new), NEW_WORDS):
                start, flat = subwords(known.new[at:at + NEW_WORDS])
                new.append((sums(values[flat], start), sums(weights[flat], start)))
            known.new.clear()
            value[0], mass[0] = (np.concatenate([old, *some]) for old, some in zip((value[0], mass[0]), zip(*new)))
            total, share = (np.add.reduceat(np.append(x[ids], 0.0), bounds[:-1]) * (np.diff(bounds) > 0) for x in (value[0], mass[0]))
            return [sigmoid(np.where(share > 0, total / np.maximum(share, 1e-9), 0.0) + intercept)]

        return work

    return make


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, mod: int = MOD, rest: int = REST,
             per_class: int = PER_CLASS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= threshold)."""
    return (map_texts(documents(docs), scorer(*fit(docs, labels, "toxic", mod, rest, per_class)), "score double")
            .select("doc_id", held_out(mod, rest).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, mod: int = MOD, rest: int = REST,
                  per_class: int = PER_CLASS) -> DataFrame:
    """The rows of docs, all columns as they are, whose score is below the threshold."""
    score = scorer(*fit(docs, labels, "toxic", mod, rest, per_class))

    def make():
        work = score()
        return lambda texts: work(texts)[0] < threshold

    return filter_texts(docs, make)
