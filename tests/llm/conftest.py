import random

import pytest

SF = "/root/testdata/sf0.001"
EXTRA = ["score", "fp", "doc", "key", "row", "marks", "lines", "gone", "n_words", "band", "shard", "kind", "label", "held_out", "root"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows, one id with two texts."""
    rng = random.Random(3)
    prose = " ".join(rng.choice(["the", "of", "and", "river", "stone", "lamp", "Éclair", "über"]) + rng.choice(["", ".", ","]) for _ in range(400))
    page = "\n".join(f"line number {k} of a page that is copied" for k in range(12))
    texts = [(None, prose), (None, None), (7_000_001, None), (7_000_002, ""), (7_000_003, " \n\t\n "), (7_000_004, prose), (7_000_005, prose),
             (7_000_005, prose), (7_000_006, page), (7_000_007, "intro\n" + page + "\n\n" + page), (7_000_007, "another text of the same id, " + prose[:300]),
             (7_000_008, "x" * 60_000), (7_000_009, "ab " * 20_000), (7_000_010, "a\n" * 3000), (7_000_011, "é" * 40 + "ü" * 40), (7_000_012, "é" * 40 + "ü" * 40),
             (7_000_013, 'token = "abcdefghij0123456789" AKIA' + "Q" * 20 + " 0123456789abcdef0123 ſecret: abcdefghijklmnop é API_KEY='aaaabbbbccccdddd'"),
             (7_000_014, "mail a@b.c%d@e.f.g..h@i.j é +1 (555) 123-4567 4111 1111 1111 1111 10.0.0.256 1.2.3.4.5.6.7.8 001.02.3.4"),
             (7_000_015, "one two"), (7_000_016, "<|endoftext|> İſ don't 12.5 x y 中文 😀"), (7_000_017, "\x00\x1c odd\x85blanks " * 30),
             (-5, prose + " tail"), (7_000_018, "ONE two")]
    return [(d, t, None if k % 3 else "en", "s", None if k % 4 == 0 else len(t or "")) + ("x",) * len(EXTRA) for k, (d, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def corpus(spark):
    """The smallest documents table, with the edge cases and columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    plain = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit("x") for c in EXTRA})
    out = plain.select([f.split()[0] for f in SCHEMA.split(", ")]).unionByName(spark.createDataFrame(edge_rows(), SCHEMA)).repartition(3)
    return out.cache()


@pytest.fixture(scope="session")
def rows(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    base = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic")
    odd = spark.createDataFrame([(None, 1, 1), (7_000_004, None, None), (7_000_005, 1, 0), (7_000_005, 0, 1), (7_000_006, 5, 5), (99_999_999, 1, 0)],
                                base.schema)
    return base.unionByName(odd)


@pytest.fixture(scope="session")
def benchmark(spark):
    base = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    odd = spark.createDataFrame([(None, "one two"), (9001, None), (9002, ""), (9003, "...!"), (9004, "ab " * 10), (9004, "ab " * 10), (9005, "One TWO"),
                                 (9006, "of the same id the of")], base.schema)
    return base.unionByName(odd)
