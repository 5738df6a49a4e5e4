"""Exact duplicates against the definition, and the arithmetic of fingerprints."""

import random
import re
from collections import Counter, defaultdict

import pytest

import brute

COLS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def by_definition(rows):
    """Rows of one group and doc_id are told apart by number alone: one of them is kept."""
    group = defaultdict(list)
    for d, t in rows:
        group[norm(t)].append(d)
    out = Counter()
    for t, ids in group.items():
        least = min(ids, key=brute.order)
        for k, d in enumerate(sorted(ids, key=brute.order)):
            out[d, least, len(ids), k == 0, brute.sha(t)] += 1
    return out


@pytest.fixture(scope="module")
def copies(spark, corpus, rows):
    from pyspark.sql import functions as F
    rng = random.Random(4)
    long = " ".join(rng.choice(["alpha", "beta\t", "gamma \n", "délta", "\r\n", " "]) for _ in range(3000))
    more = [(8_000_000 + k, t) for k, t in enumerate([long, long, re.sub(r"[\x20\x09-\x0D]+", "\n\n", long), long + "x", long[:-1] + "y", " " + long, " ", "\t\n", "", None,
                                                     "a b", "a  b", "a\xa0b", "a\x1cb"])]
    extra = [c for c in corpus.columns if c not in ("doc_id", "text")]
    df = spark.createDataFrame(more, "doc_id long, text string").withColumns({c: F.lit(None).cast(dict(corpus.dtypes)[c]) for c in extra}).select(corpus.columns)
    return corpus.unionByName(df).repartition(5).cache(), rows + more


@pytest.mark.parametrize("how", [{}, {"large": 200, "chunk": 64}, {"prime": 13}, {"prime": 1009, "large": 500, "chunk": 100, "bits": 64}, {"bits": 32}])
def test_duplicates(copies, how):
    """Also with chunks of a few bytes dealt out, primes so small that different texts collide, and a full bitmap."""
    from shelfwise.llm.exactdedup import duplicates
    df, rows = copies
    assert Counter(map(tuple, duplicates(df, **how).select(*COLS).collect())) == by_definition(rows)


def test_collisions_are_found(copies):
    from shelfwise.llm.exactdedup import KEY, _shared, fingerprints, unequal
    from pyspark.sql import functions as F
    df, _ = copies
    for prime, some in ((13, True), (2**61 - 1, False)):
        rows = fingerprints(df, prime).withColumn("row", F.monotonically_increasing_id()).withColumnRenamed("doc_id", "doc").cache()
        assert unequal(df, _shared(rows, KEY), prime).isEmpty() != some


def test_fingerprints_do_not_depend_on_the_cuts(copies):
    from shelfwise.llm.exactdedup import fingerprints
    df, _ = copies
    want = Counter(map(tuple, fingerprints(df).collect()))
    assert Counter(map(tuple, fingerprints(df, large=0, chunk=7).collect())) == want
    assert Counter(map(tuple, fingerprints(df, large=100, chunk=1000).collect())) == want


def test_combined_fingerprints():
    from shelfwise.llm.exactdedup import BASES, PIECE, PRIME, Hasher, combined, normalised
    rng = random.Random(1)
    data, h = rng.randbytes(3 * PIECE + 77), Hasher()
    want = tuple(sum(x * pow(b, i, PRIME) for i, x in enumerate(data[:500])) % PRIME for b in BASES)
    assert h.many([data[:500]])[0] == want and h.many([b""])[0] == (0, 0)
    cuts = [0, 5, 5, 1000, PIECE + 1, len(data)]
    assert combined([(b - a, *h.many([data[a:b]])[0]) for a, b in zip(cuts, cuts[1:])]) == (len(data), *h.many([data])[0])
    assert h.many([data, b"ab", b"", data]) == [h.many([x])[0] for x in (data, b"ab", b"", data)]
    text = b"a \t b\n\n  c d\x0b"
    for cut in range(1, len(text)):
        assert normalised(text[:cut]) + normalised(text[cut:], text[cut - 1:cut] in b" \t\n\v\f\r") == b"a b c d "


def test_without_copies(copies):
    from shelfwise.llm.exactdedup import without_copies
    df, rows = copies
    out = without_copies(df)
    assert out.columns == df.columns
    kept = Counter((r.doc_id, norm(r.text)) for r in out.select("doc_id", "text").collect())
    assert kept == Counter({(d, norm(t)): 1 for (d, t) in {(min((e for e, u in rows if norm(u) == norm(t)), key=brute.order), t) for _, t in rows}})


def test_no_documents(nothing):
    from shelfwise.llm.exactdedup import duplicates, without_copies
    assert duplicates(nothing).count() == 0 and without_copies(nothing).count() == 0
