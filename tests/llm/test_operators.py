"""Each operator against brute force on the smallest documents with edge cases, and on empty tables."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute


def plain(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_fertility_base_columns(corpus, rows):
    from shelfwise.llm.fertility import quality_rules
    out = quality_rules(corpus)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert plain(out, *cols) == Counter((d, *brute.op1(t)) for d, t in rows)
    assert out.filter("base_failed and kept").count() == 0


def test_fertility_bands_reject_outliers_only(spark):
    from shelfwise.llm.fertility import quality_rules
    rng = random.Random(5)
    word = lambda: rng.choice("the and of river stone light winter morning garden window letter house".split())
    good = [(k, " ".join(f"{word()} {word()}{100 + (7 * k + j) % 800}" for j in range(60)), "en") for k in range(80)]
    bad = [(1000 + k, " ".join("".join(rng.choice("qxzj~^{}☃ก") for _ in range(9)) for _ in range(60)), "en") for k in range(4)]
    out = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(good + bad, "doc_id long, text string, lang string")).collect()}
    assert all(out[d] for d, _, _ in good) and not any(out[d] for d, _, _ in bad)


def test_decontaminate(corpus, rows, benchmark):
    from shelfwise.llm.decontaminate import decontaminate, without_contaminated
    items = [tuple(r) for r in benchmark.collect()]
    want = brute.op3(rows, items)
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert plain(decontaminate(corpus, benchmark), *cols) == Counter(want)
    assert plain(decontaminate(corpus, benchmark, block_words=100), *cols) == Counter(want)   # several passes
    kept = without_contaminated(corpus, benchmark, block_words=700)
    assert kept.columns == corpus.columns
    assert plain(kept, "doc_id", "text") == Counter(r for r, w in zip(rows, want) if not w[-1])


def test_stored_index_answers_other_test_sets(spark, corpus, rows, benchmark, tmp_path):
    """A second test set and proximity queries, from the index alone."""
    from shelfwise.llm.decontaminate import answers, near, store_index, words_of
    index = store_index(corpus, f"file://{tmp_path}/index")
    second = spark.createDataFrame([("x", "of a page that is copied"), ("y", "the river"), ("z", None)], "item_id string, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for items in (benchmark, second, second.limit(0)):
        assert plain(answers(index, items), *cols) == Counter(brute.op3(rows, [tuple(r) for r in items.collect()]))
    asked = [("a", "river stone lamp"), ("b", "copied page"), ("c", "one"), ("d", "nowhere-to-be-found river"), ("e", "ab ab"), ("f", "über the Éclair")]
    for within in (0, 1, 3, 8):
        got = plain(near(index, spark.createDataFrame(asked, "item_id string, text string"), within), "doc_id", "item", "start", "span")
        starts = Counter()
        for d, item, _, _ in got.elements():
            starts[d, item] += 1
        # which documents match does not depend on which term is rarest in a block
        want = Counter()
        for d, t in rows:
            w = words_of((t or "").encode())
            for name, text in asked:
                terms = set(words_of(text.encode()))
                where = {x: [i for i, y in enumerate(w) if y == x] for x in terms}
                if any(all(any(abs(q - p) <= within for q in where[o]) for o in terms) for x in terms for p in where[x]):
                    want[d, name] += 1
        assert {k for k in starts} <= {k for k in want} and all(s >= 0 and n <= 2 * within + 1 for _, _, s, n in got)
        if within:
            assert {k for k in starts if k[1] in "bc"} == {k for k in want if k[1] in "bc"}


def test_proximity():
    from shelfwise.llm.decontaminate import Postings
    texts, terms = [b"a x x b c".split(), b"c a".split(), b"b y y y a a".split()], {b"a": 0, b"b": 1, b"c": 2}
    index = Postings(texts, terms)
    assert index.phrase(np.array([1, 2])).tolist() == [3]
    found = lambda ts, k: list(zip(*(x.tolist() for x in index.near(np.array(ts), k))))
    assert found([0, 1], 3) == [(0, 3)] and found([0, 1], 4) == [(0, 3), (9, 13)]        # b is rarer than a: its nearest a
    assert found([0, 2], 1) == [(6, 7)]                       # not across texts
    assert found([0, 1, 2], 4) == [(0, 4)] and found([2], 0) == [(4, 4), (6, 6)]


def test_packed_numbers_and_stored_postings():
    from shelfwise.llm.decontaminate import Postings, packed, postings_of, unpacked
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**31, 5])
    data, size = packed(values)
    assert unpacked(data).tolist() == values.tolist() and size.tolist() == [1, 1, 1, 2, 2, 3, 3, 4, 5, 1]
    assert len(unpacked(packed(values[:0])[0])) == 0
    texts, terms = [b"a x x b c".split(), [], b"b y y y a a".split()], {b"y": 0, b"a": 1, b"none": 2, b"b": 3}
    head, rows = postings_of(7, [1, None, 3], texts)
    rows = [(r["term"], r["n"], r["places"]) for r in rows.to_pylist()]
    assert [t for t, _, _ in rows] == sorted(t for t, _, _ in rows)
    got, want = Postings.fetched(np.array(head["sizes"][0].as_py()), [r for r in rows if r[0] in terms], terms), Postings(texts, terms)
    for name in ("bounds", "positions", "count", "start"):
        assert getattr(got, name).tolist() == getattr(want, name).tolist()
    assert [len(list(postings_of(0, [1], [[]])))] == [1]


def test_simhash(corpus, rows):
    from shelfwise.llm.simhash import near_duplicates, one_of_each
    fps = [brute.fingerprint(t) for _, t in rows]
    comp = brute.components(fps, [d for d, _ in rows])
    want = Counter((d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, comp))
    assert plain(near_duplicates(corpus, shard=40, sample=60), "doc_id", "fingerprint", "component_id") == want
    out = one_of_each(corpus, shard=40, sample=60)
    assert out.columns == corpus.columns
    least = brute.least_ids(fps, [d for d, _ in rows])
    kept = [r.doc_id for r in out.select("doc_id").collect()]
    assert sorted(kept, key=brute.order) == sorted(least.values(), key=brute.order)


def test_simhash_search_is_exact():
    from shelfwise.llm.simhash import Links, distance, merged, route, search, top_tree
    rng = np.random.default_rng(2)
    centre = rng.integers(-2**63, 2**63 - 1, 40)
    fp = np.unique(np.concatenate([c ^ (np.int64(1) << rng.integers(0, 63, 30)) for c in centre] + [rng.integers(-2**63, 2**63 - 1, 3000)]))
    d = distance(fp[:, None], fp[None, :]) <= 2
    want = merged(*np.nonzero(d), len(fp))
    for depth in (0, 3):
        nodes = top_tree(fp[::7], depth)
        at, to, home = route(fp, nodes, depth, 2)
        assert np.bincount(at[home], minlength=len(fp)).tolist() == [1] * len(fp)
        a, b = [], []
        for s in range(2 ** depth):
            own = np.concatenate([at[(to == s) & home], at[(to == s) & ~home]])
            links = Links(len(own), most=50)
            search(fp[own], int(((to == s) & home).sum()), 2, links)
            links.shrink()
            a += [own[x] for x in links.a]
            b += [own[x] for x in links.b]
        assert (merged(np.concatenate(a), np.concatenate(b), len(fp)) == want).all()


@pytest.mark.parametrize("min_lines, min_chars", [(2, 250), (3, 40), (5, 10**6), (1, 250)])
def test_line_runs(corpus, rows, min_lines, min_chars):
    from shelfwise.llm.linededup import dedup_lines, without_repeats
    want = brute.op5(rows, min_lines, min_chars)
    got = plain(dedup_lines(corpus, min_lines, min_chars), "doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256")
    assert got == Counter((d, n, r, k, brute.sha(t)) for d, n, r, k, t in want)
    out = without_repeats(corpus, min_lines, min_chars)
    assert out.columns == corpus.columns
    assert plain(out, "doc_id", "text") == Counter((d, None if s is None else t) for (_, s), (d, _, _, _, t) in zip(rows, want))


def test_line_runs_plan_is_native(spark):
    from shelfwise.llm.linededup import dedup_lines
    plan = dedup_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_personal_data(corpus, rows):
    from shelfwise.llm.pii import personal_data
    out = personal_data(corpus)
    assert plain(out, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == Counter((d, *brute.spans(t, brute.OP6)) for d, t in rows)


def test_personal_data_plan_is_native(spark):
    from shelfwise.llm.pii import personal_data
    plan = personal_data(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_personal_data_adds_unseen_forms(spark):
    """Phone numbers without the plus sign of the base kind are learnt from those with it."""
    from shelfwise.llm.pii import personal_data
    rng = random.Random(1)
    phone = lambda: f"({rng.randint(200, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
    texts = [f"some words here call +1 {phone()} today" for _ in range(120)] + [f"item {rng.randint(1000, 9999)}.{rng.randint(1000, 9999)}.{rng.randint(1000, 9999)} of {rng.randint(10**6, 10**8)}" for _ in range(120)]
    texts += [f"my phone is 1 {phone()} now" for _ in range(5)]
    out = personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r.spans for r in out.collect()}
    assert all(got[k].startswith("phone:") for k in range(120))
    assert not any(got[k] for k in range(120, 240))
    assert all(got[k].startswith("digits:") for k in range(240, 245))


def test_packing(corpus, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    from shelfwise.llm.packing import pack
    tok, window = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 256
    out = [r.asDict() for r in pack(corpus, window).collect()]
    ids = {}
    for d, t in rows:
        ids[d, t] = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
    want = Counter((d, s, len(i[s:s + window]), brute.crc32(i[s:s + window].tobytes()), len(i)) for (d, t) in rows
                   for i in (ids[d, t],) for s in range(0, len(i), window))
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window
    total = sum(map(len, (ids[r] for r in rows)))
    assert len(sequences) * window < 1.03 * total


def test_patterns_use_the_histogram_exactly():
    from shelfwise.llm.packing import patterns, slots
    rng = np.random.default_rng(4)
    h = np.bincount(np.minimum(rng.geometric(0.004, 20_000), 512), minlength=513)
    h[0] = 0
    found = patterns(h, 512)
    used = np.zeros(513, np.int64)
    for lengths, n in found:
        assert 0 < sum(lengths) <= 512 and n > 0
        np.add.at(used, lengths, n)
    assert (used == h).all()
    assert sum(n * (512 - sum(x)) for x, n in found) < 0.005 * (h * np.arange(513)).sum()
    assert sum(len(v) for v in slots(found).values()) <= sum(len(x) for x, _ in found)


def test_secrets(corpus, rows):
    from shelfwise.llm.secrets import secret_scan
    out = secret_scan(corpus)
    assert plain(out, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == Counter((d, *brute.spans(t, brute.OP8)) for d, t in rows)


def test_trigram_queries_never_lose_a_match():
    import re

    from shelfwise.llm.secrets import RULES, Rule, needed_trigrams, scanner
    texts = [b"x sk_live_" + b"a1" * 12, b"ghp_" + b"Z" * 40, b"BEARER  " + b"t" * 30, b"-----BEGIN EC PRIVATE KEY-----", b"postgres://me:hunter22@db", b"", b"plain",
             b"xoxb-1234567890-abc", b"eyJabcdefgh.eyJabcdefgh.abcdefgh", b"AIza" + b"b" * 35]
    spans = scanner()()(texts)[-1].to_pylist()
    for t, s in zip(texts, spans):
        want = sorted((m.start(), k, m.end()) for k, r in enumerate(RULES) for m in re.finditer(r.pattern, t) if len(m[r.group]) >= r.least)
        assert s == ",".join(f"{RULES[k].name}:{a}:{b}" for a, k, b in want)
    assert needed_trigrams(b"ab[cd]") == ("or", (frozenset({b"abc"}), frozenset({b"abd"})))
    assert needed_trigrams(rb"[0-9a-f]{16,}") is True and needed_trigrams(b"a?b") is True
    assert needed_trigrams(b"abcd|wxyz") == ("or", (frozenset({b"abc", b"bcd"}), frozenset({b"wxy", b"xyz"})))
    assert Rule("r", b"x").least == 0


def test_repeated_bytes(corpus, rows):
    from shelfwise.llm.radix import repeated_bytes
    want = Counter(brute.op10(rows))
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert plain(repeated_bytes(corpus, shard_bytes=1 << 17, chunk=1 << 15, flush_bytes=1 << 16), *cols) == want
    assert plain(repeated_bytes(corpus), *cols) == want


def test_repeated_bytes_of_hot_anchors(spark, corpus, rows):
    """A passage in every document, each with a beginning and an end of its own, so that its outer anchors have many kinds of run."""
    from shelfwise.llm.radix import repeated_bytes
    rng = random.Random(11)
    word = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    passage, ends = word(30), [word(12) for _ in range(6)]
    docs = [(k, f"{word(rng.randrange(4, 14))} {passage} {rng.choice(ends) if k % 3 else word(12)}") for k in range(300)]
    docs += [(300, "ab" * 400), (301, "ba" * 300 + passage), (301, "x" * 49 + passage), (None, passage + word(9))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = Counter(brute.op10(docs))
    for many in (1, 2, 32):
        assert plain(repeated_bytes(df, shard_bytes=1 << 15, chunk=1 << 12, flush_bytes=1 << 13, many=many), *cols) == want
    assert plain(repeated_bytes(corpus, shard_bytes=1 << 17, chunk=1 << 15, flush_bytes=1 << 16, many=2), *cols) == Counter(brute.op10(rows))


def _auc(rows):
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))


def test_classifiers_on_held_out_rows(spark):
    from shelfwise.llm.quality import quality
    from shelfwise.llm.toxicity import toxicity
    sf = "/root/testdata/sf0.1"
    docs, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for f, label, mod, rest, least in ((toxicity, "toxic", 4, 2, 0.95), (quality, "quality", 3, 1, 0.97)):
        got = f(docs, lab).join(lab.select("doc_id", label), "doc_id").select("doc_id", "held_out", "score", label).collect()
        assert all(r.held_out == (brute.fold(r.doc_id, mod) == rest) for r in got)
        assert _auc([(r.score, r[label]) for r in got if r.held_out]) > least


@pytest.mark.parametrize("name, mod, rest", [("toxicity", 4, 2), ("quality", 3, 1)])
def test_classifier_edges(spark, corpus, rows, labels, nothing, name, mod, rest):
    import importlib
    f = getattr(importlib.import_module(f"shelfwise.llm.{name}"), name)
    out = f(corpus, labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(d for d, _ in rows)
    threshold = 0.3 if name == "toxicity" else 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in out)
    assert all(r.held_out == (r.doc_id is None or brute.fold(r.doc_id, mod) == rest) for r in out)
    none = f(corpus, labels.limit(0)).collect()
    assert len(none) == len(rows) and len({r.score for r in none}) == 1
    assert f(nothing, labels).count() == 0


def test_subwords_share_ngrams():
    from shelfwise.llm.toxicity import subwords
    start, flat = subwords([b"worthless", b"w0rthless", b"WORTHLESS!", b"caf\xc3\xa9", b""])
    bag = [set(flat[a:b].tolist()) for a, b in zip(start[:-1], start[1:])]
    assert bag[0] == bag[2] and len(bag[0] & bag[1]) > 8 and not bag[0] & bag[3]


def test_empty_tables(spark, nothing, labels, benchmark):
    from shelfwise.llm import decontaminate, fertility, linededup, packing, pii, radix, secrets, simhash
    for out in (fertility.quality_rules(nothing), decontaminate.decontaminate(nothing, benchmark), simhash.near_duplicates(nothing),
                linededup.dedup_lines(nothing), pii.personal_data(nothing), packing.pack(nothing), secrets.secret_scan(nothing),
                radix.repeated_bytes(nothing)):
        assert out.count() == 0
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    clean = decontaminate.decontaminate(docs, benchmark.limit(0)).first()
    assert (clean.n_words, clean.n_hit, clean.contaminated) == (3, 0, False)


def test_components_of_long_chains(spark):
    from shelfwise.llm.graph import components
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(201)) and all(got[1000 + k] == 1000 for k in range(300))
    assert 5000 not in got
