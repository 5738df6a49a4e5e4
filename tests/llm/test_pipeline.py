"""The pipeline's stages against brute force, each on its own input, and run() as a whole."""

from collections import Counter

import brute
import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_and_run(spark, corpus, tmp_path):
    from shelfwise.llm.toxicity import toxicity
    docs, step = corpus, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"file://{tmp_path}/{name}")
        step[name] = docs, spark.read.parquet(f"file://{tmp_path}/{name}")
        docs = step[name][1]

    before, after = step["toxicity"]
    scored = toxicity(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert Counter(r.doc_id for r in scored.filter("predicted = 0").collect()) == Counter(d for d, _ in _rows(after))

    before, after = step["line_dedup"]
    rows = _rows(before)
    assert Counter(_rows(after)) == Counter((d, None if t is None else k) for (_, t), (d, _, _, _, k) in zip(rows, brute.op5(rows, 2, 250)))
    assert after.filter("text is not null and n_chars is not null and n_chars <> length(text)").count() == 0

    before, after = step["near_dedup"]
    rows = _rows(before)
    least = brute.least_ids([brute.fingerprint(t) for _, t in rows], [d for d, _ in rows])
    assert sorted((d for d, _ in _rows(after)), key=brute.order) == sorted(least.values(), key=brute.order)

    before, after = step["decontaminate"]
    rows = _rows(before)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert Counter(_rows(after)) == Counter(r for r, w in zip(rows, brute.op3(rows, items)) if not w[-1])

    before, after = step["packing"]
    assert {r.doc_id for r in after.collect()} == {d for d, _ in _rows(before)}


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(map(tuple, P.run(spark, SF).select(*cols).collect())) == Counter(map(tuple, docs.select(*cols).collect()))


def test_empty_table(spark, nothing):
    docs = nothing
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
