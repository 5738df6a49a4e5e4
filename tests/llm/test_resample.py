"""Importance resampling against the definition."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

import brute

COLS = ["doc_id", "n_features", "weight", "score", "rank"]


def features(text, ngram):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[k:k + n]) for n in range(1, ngram + 1) for k in range(len(w) - n + 1)], len(w)


def by_definition(docs, target, buckets=10_000, ngram=1, percent=10, least=20):
    bucket = lambda f: crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, ngram)[0])
    t = Counter(bucket(f) for x in target for f in features(x, ngram)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for d, x in docs:
        f, n = features(x, ngram)
        h = int(hashlib.sha256(f"2024:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain(bucket(y)) for y in f)
        out.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    pool = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], brute.order(r[0]), r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(pool[:percent * len(pool) // 100])}
    return Counter((*r[:4], rank.get(id(r))) for r in out)


@pytest.mark.parametrize("how", [{}, {"buckets": 50, "percent": 60}, {"ngram": 2, "buckets": 300, "percent": 35}, {"percent": 100, "min_words": 0}, {"percent": 0}])
def test_resample(corpus, rows, benchmark, how):
    from shelfwise.llm.resample import resample
    want = by_definition(rows, [r.text for r in benchmark.collect()], **{"least" if k == "min_words" else k: v for k, v in how.items()})
    assert Counter(map(tuple, resample(corpus, benchmark, **how).select(*COLS).collect())) == want


def test_draw_size_is_exact_where_rows_tie(spark, benchmark):
    """Many rows of one doc_id and score: the draw and its ranks stay exact."""
    from shelfwise.llm.resample import resample
    text = "word " * 30
    docs = spark.createDataFrame([(5, text)] * 300 + [(k, text + str(k)) for k in range(10, 110)], "doc_id long, text string").repartition(7)
    for percent in (10, 50, 90):
        out = resample(docs, benchmark, percent=percent).collect()
        ranks = sorted(r.rank for r in out if r.rank is not None)
        assert len(out) == 400 and ranks == list(range(1, 4 * percent + 1))
        by_rank = sorted((r for r in out if r.rank), key=lambda r: r.rank)
        assert all((-a.score, a.doc_id) <= (-b.score, b.doc_id) for a, b in zip(by_rank, by_rank[1:]))
        worst = max((-r.score, r.doc_id) for r in by_rank)
        assert all((-r.score, r.doc_id) >= worst for r in out if r.rank is None)


def test_threshold(spark):
    from pyspark.sql import functions as F

    from shelfwise.llm.resample import threshold
    values = sorted([3] * 50 + [7] * 20 + [-1000, 10**15, 4, 5, 6] + list(range(100, 400, 3)))
    df = spark.createDataFrame([(v,) for v in values], "x long")
    for wanted in (1, 2, 60, 101, 120, 121, 150, len(values)):
        high, low = values[-wanted], values[wanted - 1]
        assert threshold(df, F.col("x"), wanted, values[0], values[-1]) == (high, sum(v > high for v in values))
        assert threshold(df, F.col("x"), wanted, values[0], values[-1], larger=False) == (low, sum(v < low for v in values))


def test_resample_of_empty_tables(spark, nothing, corpus, benchmark):
    from shelfwise.llm.resample import resample
    assert resample(nothing, benchmark).count() == 0
    out = resample(corpus, benchmark.limit(0))
    assert out.count() == corpus.count() and out.filter("rank is not null").count() > 0
    assert resample(spark.createDataFrame([(1, None), (2, "one two")], "doc_id long, text string"), benchmark).filter("rank is null").count() == 2
