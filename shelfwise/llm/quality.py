"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a document: its distinct lower-cased words hashed into ``BUCKETS`` (log counts,
scaled to unit length), and one of ``BINS`` bins for each structure statistic of the text and
for the metadata column ``n_chars``.  The model is
    w0 + sum w_i x_i + 1/2 sum_k ((sum_i v_ik x_i)^2 - sum_i v_ik^2 x_i^2),
so scoring is linear in the features present.  It is trained by Adam in numpy on at most
``PER_CLASS`` labelled documents of each class; class counts of all training labels correct
the intercept for the sample.  Labels, lang, source and doc_id are never inputs.

Defined cases: null and empty texts have no words and the bins of zeros; a null or absent
n_chars has a bin of its own; labels that are null or not 0 or 1 are left out, of repeated
labels the largest counts; without both classes every score is the share of good ones.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WordTable, bounds_of, held_out, labelled_sample, pieces, sigmoid, sums, texts_of
from shelfwise.llm.fertility import SYMBOLS, repeated_lines, repeated_words
from shelfwise.llm.toxicity import _adam

BUCKETS, RANK, BINS = 1 << 14, 8, 12
#: Bound of the training sample, for each class.
PER_CLASS = 3000
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.01, 1e-4
MOD, REST, THRESHOLD = 3, 1, 0.5
STATS = ["words", "word_chars", "symbols", "upper", "digits", "marks", "bangs", "bars", "lines", "line_repeats",
         "window_repeats", "distinct", "short", "top", "n_chars"]
WIDTH = BUCKETS + len(STATS) * (BINS + 1)


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


CLASSES = {"symbols": SYMBOLS, "upper": _class(bytes(range(65, 91))), "digits": _class(b"0123456789"),
           "marks": _class(b".,;:?"), "bangs": _class(b"!"), "bars": _class(b"|"), "lines": _class(b"\n")}


def word_bucket(words: list[bytes]) -> np.ndarray:
    from zlib import crc32
    return np.fromiter((crc32(w.lower()) % BUCKETS for w in words), np.int64, len(words))


def featurise(texts: list[bytes], n_chars: list, known: WordTable, buckets: list) -> tuple:
    """(bounds, hashed words, values, statistics) of texts."""
    if known.full():
        known.clear()
        buckets[0] = np.zeros(0, np.int64)
    split = [t.split() for t in texts]
    bounds = bounds_of([len(w) for w in split])
    ids = known.ids([w for words in split for w in words])
    if known.new:
        buckets[0] = np.concatenate([buckets[0], word_bucket(known.new)])
        known.new.clear()
    count = np.diff(bounds)
    doc = np.repeat(np.arange(len(texts)), count)
    key = np.sort(doc * BUCKETS + buckets[0][ids])
    at = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(at, len(key)))
    distinct_doc, hashed = key[at] // BUCKETS, key[at] % BUCKETS
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(distinct_doc, weights=value * value, minlength=len(texts)))
    value = value / np.maximum(norm, 1e-9)[distinct_doc]
    feature_bounds = bounds_of(np.bincount(distinct_doc, minlength=len(texts)))

    joined = np.frombuffer(b"".join(texts), np.uint8)
    tb = bounds_of([len(t) for t in texts])
    size = np.maximum(np.diff(tb), 1)
    share = {k: sums(c[joined].astype(np.int64), tb) / size for k, c in CLASSES.items()}
    n = np.maximum(count, 1)
    lengths = np.fromiter((len(w) for words in split for w in words), np.int64, len(ids))
    top = np.zeros(len(texts))
    np.maximum.at(top, distinct_doc, times)
    stats = {"words": np.log1p(count), "word_chars": sums(lengths, bounds) / n, **share,
             "line_repeats": np.array([repeated_lines(t) for t in texts]) / np.maximum(1, share["lines"] * size + 1),
             "window_repeats": repeated_words(ids, bounds) / n, "distinct": np.diff(feature_bounds) / n,
             "short": sums((lengths <= 3).astype(np.int64), bounds) / n, "top": top / n,
             "n_chars": np.array([math.nan if x is None else math.log1p(max(0, x)) for x in n_chars])}
    return feature_bounds, hashed, value, np.stack([stats[s] for s in STATS], 1)


def binned(stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Feature number of each statistic's bin; the last bin of a statistic is for what is missing."""
    bins = np.stack([np.searchsorted(edges[k], stats[:, k], "right") for k in range(len(STATS))], 1)
    bins[np.isnan(stats)] = BINS
    return BUCKETS + np.arange(len(STATS)) * (BINS + 1) + bins


def collected():
    """Task-side function from texts to hashed words, values and statistics."""
    known, buckets = WordTable(), [np.zeros(0, np.int64)]

    def work(texts, n_chars):
        bounds, hashed, value, stats = featurise(texts, n_chars, known, buckets)
        cut = list(zip(bounds[:-1], bounds[1:]))
        return [[hashed[a:b].astype(np.int32) for a, b in cut], [value[a:b] for a, b in cut], list(stats)]

    return work


def _design(idx: list[np.ndarray], val: list[np.ndarray], bins: np.ndarray):
    """Features and values of rows, with their bins as features of value 1 / sqrt(number of statistics)."""
    one = np.full(bins.shape[1], bins.shape[1] ** -0.5)
    return [np.concatenate([i, b]) for i, b in zip(idx, bins)], [np.concatenate([v, one]) for v in val]


def train(idx, val, y, seed: int = 11):
    """(w0, w, v) by Adam on the logistic loss."""
    rng = np.random.default_rng(seed)
    w0, w, v = np.zeros(1), np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, RANK))
    step = _adam([w0, w, v])
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            i, x = np.concatenate([idx[k] for k in some]), np.concatenate([val[k] for k in some])
            row = np.repeat(np.arange(len(some)), [len(idx[k]) for k in some])
            vx = v[i] * x[:, None]
            s = np.stack([np.bincount(row, weights=vx[:, k], minlength=len(some)) for k in range(RANK)], 1)
            square = np.bincount(row, weights=(vx * vx).sum(1), minlength=len(some))
            g = (sigmoid(w0[0] + np.bincount(row, weights=w[i] * x, minlength=len(some)) + 0.5 * ((s * s).sum(1) - square)) - y[some]) / len(some)
            back = g[row] * x
            grad = np.stack([np.bincount(i, weights=back * (s[row, k] - vx[:, k]), minlength=WIDTH) for k in range(RANK)], 1)
            step([np.array([g.sum()]), np.bincount(i, weights=back, minlength=WIDTH) + DECAY * w, grad + DECAY * v], RATE * (1 - epoch / EPOCHS))
    return float(w0[0]), w, v


def _with_size(docs: DataFrame) -> DataFrame:
    size = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_chars"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def map_sized(docs: DataFrame, make, schema: str, keep: tuple = ("doc_id",)) -> DataFrame:
    """``map_texts`` for a function of texts and their n_chars column."""
    names, kinds = [*keep, "text", "n_chars"], dict(docs.dtypes)
    out = [*keep, *[x.split()[0] for x in schema.split(", ")]]

    def run(batches):
        work = make()
        for batch in batches:
            for part in pieces(batch, "text"):
                new = work(texts_of(part.column(len(keep))), part.column(len(keep) + 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(len(keep))], *[pa.array(x) for x in new]], out)

    return docs.select(*names).mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in keep], schema]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = MOD, rest: int = REST, per_class: int = PER_CLASS):
    """(edges, w0, w, v) learnt from labelled rows outside the held-out fold."""
    counts = {r.y: r["count"] for r in labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(mod, rest))
              .groupBy(F.col(label).cast("int").alias("y")).count().collect()}
    edges = np.zeros((len(STATS), BINS - 1))
    p = min(max(counts.get(1, 0) / max(1, sum(counts.values())), 1e-9), 1 - 1e-9)
    none = edges, math.log(p / (1 - p)), np.zeros(WIDTH), np.zeros((WIDTH, RANK))
    if len(counts) < 2:
        return none
    rows = labelled_sample(docs, labels, label, mod, rest, per_class, extra=("n_chars",))
    got = map_sized(rows, collected, "hashed array<int>, weight array<double>, stats array<double>",
                    keep=("doc_id", "label")).toArrow().sort_by("doc_id")
    y = np.array(got["label"].to_pylist())
    n = np.bincount(y, minlength=2) if len(y) else np.zeros(2)
    if not n.all():
        return none
    stats = np.stack(got["stats"].to_numpy())
    edges = np.stack([np.quantile(c[~np.isnan(c)], np.arange(1, BINS) / BINS) if (~np.isnan(c)).any() else np.zeros(BINS - 1) for c in stats.T])
    idx, val = _design([np.array(x, np.int64) for x in got["hashed"].to_numpy()], [np.array(x, float) for x in got["weight"].to_numpy()], binned(stats, edges))
    w0, w, v = train(idx, val, y)
    return edges, w0 + math.log(counts[1] / counts[0]) - math.log(n[1] / n[0]), w, v


def scorer(edges, w0, w, v):
    """Factory of the task-side function from texts and n_chars to scores."""
    def make():
        known, buckets = WordTable(), [np.zeros(0, np.int64)]
        own = (v * v).sum(1)

        def work(texts, n_chars):
            bounds, hashed, value, stats = featurise(texts, n_chars, known, buckets)
            bins, one = binned(stats, edges), len(STATS) ** -0.5

            def total(per_feature, by):   # sums of a word part, cut at bounds, and of the bins
                return np.add.reduceat(np.append(per_feature[hashed] * by, 0.0), bounds[:-1]) * (np.diff(bounds) > 0)

            linear = total(w, value) + w[bins].sum(1) * one
            square = total(own, value * value) + own[bins].sum(1) * one * one
            cross = sum((total(v[:, k], value) + v[:, k][bins].sum(1) * one) ** 2 for k in range(RANK))
            return [sigmoid(w0 + linear + 0.5 * (cross - square))]

        return work

    return make


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, mod: int = MOD, rest: int = REST,
            per_class: int = PER_CLASS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if score >= threshold)."""
    model = fit(docs, labels, "quality", mod, rest, per_class)
    return (map_sized(_with_size(docs), scorer(*model), "score double")
            .select("doc_id", held_out(mod, rest).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
