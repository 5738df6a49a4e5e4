"""Operators against their definitions, where an earlier version did less."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute


def dedup(docs, *limits):
    from shelfwise.llm.linededup import dedup_lines
    return sorted((tuple(r) for r in dedup_lines(docs, *limits).collect()), key=str)


@pytest.mark.parametrize("min_lines, min_chars", [(2, 250), (3, 40), (1, 250)])
def test_line_runs_by_definition(corpus, rows, min_lines, min_chars):
    assert dedup(corpus, min_lines, min_chars) == sorted(((*r[:4], brute.sha(r[4])) for r in brute.op5(rows, min_lines, min_chars)), key=str)


def test_short_line_after_a_long_one(spark):
    """[long paragraph, short line] is a run of two lines: its later copy goes whole."""
    long = "a paragraph of many words " * 12
    docs = spark.createDataFrame([(k, f"{long}\nshort tail\nown line {k}") for k in (1, 2)], "doc_id long, text string")
    assert [r[1:4] for r in dedup(docs)] == [(3, 0, 0), (3, 2, 1)]


def test_runs_of_bytes_are_told_apart_by_64_bits():
    """Runs of one anchor whose hashes agree in the lowest 40 bits alone are not equal."""
    from shelfwise.llm import radix
    column = lambda *x: np.array(x, np.uint64)
    blocks = [b for doc, other in ((1, 5), (2, 5 + (1 << 40)), (3, 5))
              for b in radix._emit(1, column(doc), column(0), column(9), column(other), column(0), column(4))]
    table = pa.Table.from_batches(list(radix._blocks(blocks)))
    got = {(r["doc"], r["kind"]) for r in radix.equal_runs(50)(table).to_pylist()}
    assert got == {(1, 1), (2, 1), (3, 0)}           # 1 and 2 go on, 3 repeats 1


def run_blocks(radix, runs, many):
    """(doc, kind, marks) that the group of one anchor gives for runs (doc, other, rest, span)."""
    column = lambda *x: np.array(x, np.uint64)
    blocks = [b for doc, other, rest, span in runs
              for b in radix._emit(1, column(doc), column(0), column(9), column(other), column(0), column(span), column(rest))]
    table = radix.equal_runs(50, many)(pa.Table.from_batches(list(radix._blocks(blocks))))
    return {(r["doc"], r["kind"], tuple(np.frombuffer(r["marks"], "<u4").tolist())) for r in table.to_pylist()}


def test_runs_that_agree_in_64_bits_are_told_apart():
    from shelfwise.llm import radix
    got = run_blocks(radix, [(1, 5, 1, 4), (2, 5, 2, 4), (3, 5, 1, 4), (4, 5, 2, 4)], 32)
    assert got == {(1, 1, (0, 4)), (2, 1, (0, 4)), (3, 0, (0, 53)), (4, 0, (0, 53))}


def test_hot_anchors():
    """A notice (no span) makes an anchor hot, also for a run that is alone beside it; so do 64 times ``many`` kinds."""
    from shelfwise.llm import radix
    assert run_blocks(radix, [(7, 0, 0, 0), (1, 5, 1, 4)], 32) == {(1, 2, (0, 4))}
    assert run_blocks(radix, [(7, 0, 0, 0), (8, 0, 0, 0)], 32) == set()
    assert run_blocks(radix, [(1, 5, 1, 4)], 32) == set()
    kinds = [(k, k + 1, 0, 4) for k in range(64)]
    assert {k for _, k, _ in run_blocks(radix, kinds, 1)} == {2} and {k for _, k, _ in run_blocks(radix, kinds, 2)} == {1}


def test_windows_of_one_hash_are_compared_by_bytes(monkeypatch):
    import zstandard

    from shelfwise.llm import radix
    texts = [b"a" * 52, b"b" * 52, b"a" * 51 + b"c", b"c" + b"b" * 51]
    rows = [(0, radix._pack((np.array([k], np.uint64), 8), (np.zeros(1, np.uint64), 8), (np.zeros(1, np.uint64), 4), (np.array([3], np.uint64), 1)),
             zstandard.compress(t, 1)) for k, t in enumerate(texts)]
    table = pa.Table.from_batches(list(radix._blocks(rows)))
    want = radix.equal_windows(50)(table).to_pylist()
    monkeypatch.setattr(radix.Hasher, "of", lambda self, start, end: np.zeros(len(start), np.uint64))
    assert sorted(map(str, radix.equal_windows(50)(table).to_pylist())) == sorted(map(str, want))
    assert {r["doc"]: np.frombuffer(r["marks"], "<u4").tolist() for r in want} == {2: [0, 51], 3: [1, 51]}


def kept_by_fertility(spark, extra):
    """doc_id: kept of 80 good English texts and the given (doc_id, text, lang)."""
    from shelfwise.llm.fertility import quality_rules
    rng = random.Random(5)
    word = lambda: rng.choice("the and of river stone light winter morning garden window letter house".split())
    good = [(k, " ".join(f"{word()} {word()}{100 + (7 * k + j) % 800}" for j in range(60)), "en") for k in range(80)]
    out = quality_rules(spark.createDataFrame(good + extra, "doc_id long, text string, lang string"))
    return {r.doc_id: r.kept for r in out.collect()}


def junk(n_words, rng=random.Random(6)):
    return " ".join("".join(rng.choice("qxzj~^{}☃ก") for _ in range(9)) for _ in range(n_words))


def test_fertility_judges_short_texts(spark):
    out = kept_by_fertility(spark, [(1000 + n, junk(n), "en") for n in (20, 25, 39)])
    assert all(out[k] for k in range(80)) and not any(out[1000 + n] for n in (20, 25, 39))


def test_fertility_judges_small_groups(spark):
    """A language or script of few documents is held against wider groups."""
    out = kept_by_fertility(spark, [(1000, junk(60), "xx"), (1001, junk(60), None), (1002, "☃ก" * 9 + (" " + "ก☃ก^~" * 2) * 40, "yy")])
    assert all(out[k] for k in range(80)) and not any(out[1000 + k] for k in range(3))


def test_rare_subwords_are_learnt():
    """A subword that marks 4 toxic documents has a weight, one that no document has does not."""
    from shelfwise.llm.toxicity import train
    rows = [(np.array([1, 2, *([5] if k < 4 else [])], np.int32), np.ones(3 if k < 4 else 2, np.int32), int(k < 4)) for k in range(40)]
    model = train(rows)
    assert model.values()[5] > 0 and model.values()[6] == 0 and model.weight[5] > model.weight[1] > 0


def test_toxicity_scores_by_a_slow_forward_pass(corpus, rows, labels):
    """Weighted mean of all subword vectors of a document, then the softmax, against the scored column."""
    from shelfwise.llm import toxicity as T
    known = [(r.doc_id, r.toxic) for r in labels.collect() if r.toxic in (0, 1) and r.doc_id is not None and brute.fold(r.doc_id, 4) != 2]
    lab = {d: max(y for e, y in known if e == d) for d, _ in known}
    bags = []
    for _, t in rows:
        buckets, counts = T.bags()([(t or "").encode()])
        bags.append(dict(zip(buckets[0].tolist(), counts[0].tolist())))
    train = sorted(((d, b) for (d, _), b in zip(rows, bags) if d in lab), key=lambda x: x[0])
    model = T.train([(np.array(list(b), np.int32), np.array(list(b.values()), np.int32), lab[d]) for d, b in train])
    counts = np.bincount([y for _, y in known])
    n = np.bincount([lab[d] for d, _ in train])
    shift = np.log(counts[1] / counts[0]) - np.log(n[1] / n[0])
    want = {}
    for (d, _), b in zip(rows, bags):
        w = [model.weight[k] * c for k, c in b.items()]
        mean = sum((x * model.embed[k].astype(float) for x, k in zip(w, b)), np.zeros(T.DIM)) / sum(w) if sum(w) else np.zeros(T.DIM)
        logit = T.SCALE * mean @ model.soft.astype(float) + model.bias
        want.setdefault(d, []).append(1 / (1 + np.exp(-(logit[1] - logit[0] + shift))))
    got = {}
    for r in T.toxicity(corpus, labels).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert all(np.allclose(sorted(got[d]), sorted(want[d]), atol=2e-3) for d in want)


def test_quality_scores_by_explicit_pairs():
    """The sum-of-squares identity against the sum over all pairs of features."""
    from shelfwise.llm import quality as Q
    from shelfwise.llm.common import WordTable
    rng = np.random.default_rng(8)
    edges = np.sort(rng.random((len(Q.STATS), Q.BINS - 1)), axis=1)
    w, v = rng.normal(0, 1, Q.WIDTH), rng.normal(0, 0.5, (Q.WIDTH, Q.RANK))
    texts, sizes = [b"one two two three.\n\none", b"", "é ☃ word ".encode() * 9, b"%%% ###"], [22, None, 5, 0]
    got = Q.scorer(edges, 0.1, w, v)()(texts, sizes)[0]
    bounds, hashed, value, stats = Q.featurise(texts, sizes, WordTable(), [np.zeros(0, np.int64)])
    idx, val = Q._design([hashed[a:b] for a, b in zip(bounds[:-1], bounds[1:])], [value[a:b] for a, b in zip(bounds[:-1], bounds[1:])], Q.binned(stats, edges))
    for score, i, x in zip(got, idx, val):
        s = 0.1 + sum(w[a] * p for a, p in zip(i, x))
        s += sum((v[i[a]] @ v[i[b]]) * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert score == pytest.approx(1 / (1 + np.exp(-s)), abs=1e-9)


def test_bands_do_not_depend_on_the_order_of_rows(spark):
    from pyspark.sql import functions as F

    from shelfwise.llm.fertility import MEASURES, bands
    rng = random.Random(9)
    rows = [(rng.choice(["en", "de", "xx"]), "latin", *[rng.gauss(3, 1) for _ in MEASURES]) for _ in range(700)]
    df = spark.createDataFrame(rows, "band string, script string, " + ", ".join(f"{m} double" for m in MEASURES))
    out = [sorted(map(tuple, bands(x).collect())) for x in (df.repartition(7), df.orderBy(F.rand(3)).coalesce(1))]
    assert out[0] == out[1] and {r[0] for r in out[0]} == {"en", "de", "xx"}


def test_personal_data_finds_masked_forms(spark):
    """Of phones without their plus sign nearly all are found, of plain numbers hardly any."""
    from shelfwise.llm.pii import personal_data
    rng = random.Random(2)
    phone = lambda: f"1 ({rng.randint(200, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
    number = lambda a, b: str(rng.randint(10 ** a, 10 ** b))
    texts = [f"some words here call +{phone()} today" for _ in range(200)] + [f"we said call {phone()} at noon" for _ in range(200)]
    texts += [f"item {number(3, 4)}.{number(3, 4)}.{number(3, 4)} of {number(7, 9)} pieces" for _ in range(400)]
    out = {r.doc_id: r.spans for r in personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(out[k].startswith("digits:") for k in range(200, 400)) >= 180
    assert sum(bool(out[k]) for k in range(400, 800)) <= 2


def test_personal_data_learns_from_every_candidate(spark):
    """All documents and all their candidates are examples: no sample of 2000 documents, no 200 candidates of each."""
    from pyspark.sql import functions as F
    from shelfwise.llm.pii import examples
    rows = [(k, f"number {10 ** 9 + k} here") for k in range(2100)] + [(2100, " ".join(f"no {10 ** 9 + k} x" for k in range(250)))]
    out = examples(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.agg(F.sum("n")).first()[0] == 2100 + 250


def test_token_ids_of_new_words_in_later_texts():
    """Words learnt in many lots, alone or together, keep their ids."""
    import public_tokenizers
    from shelfwise.llm.packing import tokenizer
    from tokenizers import Tokenizer
    tok, encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), tokenizer(None)
    for lot in (1, 2, 1):
        texts = [" ".join(f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100]} {k * lot} don't." for k in range(700)), "", "Émile 東京 end."]
        bounds, flat = encode([t.encode() for t in texts])
        assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_line_runs_are_named_to_their_full_depth(spark):
    """Suffixes were named for the least run alone; now until no two have one name (against all pairs of suffixes)."""
    from shelfwise.llm.linededup import copies, later_runs
    rng = random.Random(5)
    page = [f"line {rng.randrange(30)}" for _ in range(43)]
    texts = [page, ["start"] + page + ["end"], page[:20] + ["own"] + page[7:40], ["x"] * 9, ["alone", "again"], page + page[:2], []]
    lines = dict(enumerate(texts))
    rows = (spark.createDataFrame([(k, "\n\n".join(t)) for k, t in lines.items()], "doc long, text string")
            .selectExpr("doc", "xxhash64(text) as key", "text"))
    want, suffixes = {}, sorted((k, p) for k, t in lines.items() for p in range(len(t)))
    for i, (d, p) in enumerate(suffixes):
        for e, q in suffixes[:i]:
            n = next((n for n, (x, y) in enumerate(zip(lines[d][p:], lines[e][q:])) if x != y), min(len(lines[d]) - p, len(lines[e]) - q))
            want[d, p] = max(want.get((d, p), 0), n)
    got = {}
    for r in copies(rows).collect():
        got.setdefault((r.doc, r.p), []).append(r.n)
    depths = lambda n: [h + 1 for h in (1, 2, 4, 8, 16, 32, 64) if h + 1 <= n]
    assert {k: sorted(v) for k, v in got.items()} == {k: depths(n) for k, n in want.items() if n > 1}
    assert {(r.doc, x.p, x.n) for r in later_runs(rows).collect() for x in r.runs} >= {(1, 1, 43), (3, 1, 8), (5, 0, 45)}


def test_fertility_of_broken_texts(spark):
    """Bytes that are no UTF-8 ended the job with an error: they were counted in two ways, and a text could take up the next one's first bytes."""
    from pyspark.sql import functions as F

    from shelfwise.llm.fertility import quality_rules
    texts = [b"\x80\x80 abc", b"ab \xe2\x82", b"\xac tail", "где".encode(), b"", b"\xff\xfe"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, raw binary").coalesce(1)
    out = quality_rules(rows.select("doc_id", F.col("raw").cast("string").alias("text")))
    got = {r.doc_id: (r.n_words, r.script) for r in out.collect()}
    assert got == {0: (2, "latin"), 1: (2, "latin"), 2: (2, "latin"), 3: (1, "cyrillic"), 4: (0, "none"), 5: (1, got[5][1])}


def test_fertility_of_a_text_without_words_in_a_band_without_letters(spark):
    """An empty text was divided by its number of words where texts without letters have a band: the job ended with an error."""
    from shelfwise.llm.fertility import quality_rules
    rng = random.Random(2)
    rows = [(k, " ".join(str(rng.randrange(10**6)) for _ in range(40)), "en") for k in range(60)] + [(100, "", "en"), (101, None, "en"), (102, " \n", "en")]
    out = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [out[k] for k in (100, 101, 102)] == [(0, True, False)] * 3
    assert all(out[k] == (40, False, True) for k in range(60))
