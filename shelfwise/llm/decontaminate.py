"""Benchmark decontamination with a distributed positional inverted index.

Index.  ``store_index`` writes the postings of all words of the training texts as Parquet rows
(block, term, n, places): a block is a stretch of documents of one task, positions run through the
block with a gap after each document, so no match crosses documents, and places are the gaps
between a term's positions as bytes of variable length.  A row without a term holds the documents
of the block.  Texts are read once; later test sets are answered from the index alone.

Search.  The postings of the test set's terms are fetched by a filter on the term and brought
together by block, whose size is bounded, so a frequent term costs no more than its own postings
and hot terms need no salting.  In a block a phrase is found by taking the postings of its rarest
term, shifted back by the term's offset, and intersecting them with the shifted postings of the
other terms from rare to frequent.  ``near`` finds the terms of an item in any order within a
distance.

The test set is read in blocks of at most ``BLOCK_WORDS`` words, one at a time on the driver; each
further block is one more pass over the index.

``without_contaminated`` keeps the documents without a match.  It needs the texts at once, so its
tasks index the test set's terms in memory, block by block, and search in the same way.

Defined cases: null or empty texts have no words (0 words, 0 hits); items without words
have no windows; a null item_id is named "null"; repeated items and repeated documents
are handled row by row; an empty test set leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import WordTable, bounds_of, documents, filter_texts, pieces, stored, sums, texts_of
from shelfwise.session import ensure_checkpoint_dir

WINDOW = 10
#: Words of the test set that a task holds at once; beyond it, further passes.
BLOCK_WORDS = 2_000_000
#: Word bytes: digits, letters (A-Z lower-cased) and all bytes beyond ASCII; others part words.
FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
             for b in range(256))


INDEX = "block long, term binary, n int, places binary, doc_ids array<long>, sizes array<long>"
INDEX_TYPES = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("n", pa.int32()), ("places", pa.binary()),
                         ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])
RESULT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
RESULT_TYPES = ["long", "long", "long", "long", "string", "boolean"]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Phrases:
    """Windows of a block of test items as term ids."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.terms: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        seen: dict[tuple, list[int]] = {}
        for k, (_, words) in enumerate(items):
            ids = tuple(self.terms.setdefault(w, len(self.terms)) for w in words)
            for s in range(max(1, len(ids) - window + 1)):
                seen.setdefault(ids[s:s + window], []).append(k)
        self.windows = [np.array(w) for w in seen]
        self.items = list(seen.values())
        self.flat = np.concatenate(self.windows) if self.windows else np.zeros(0, np.int64)
        self.starts = bounds_of([len(w) for w in self.windows])[:-1]


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bytes of each value) of whole numbers, seven bits to a byte, low ones first."""
    size = 1 + sum((values >= 1 << (7 * k)).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        at = np.nonzero(size > k)[0]
        out[ends[at] - size[at] + k] = ((values[at] >> (7 * k)) & 127) | ((size[at] > k + 1) << 7)
    return out, size


def unpacked(data: np.ndarray) -> np.ndarray:
    last = np.nonzero(data < 128)[0]
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    out = np.zeros(len(last), np.int64)
    for k in range(int((last - first).max(initial=-1)) + 1):
        at = np.nonzero(first + k <= last)[0]
        out[at] |= (data[first[at] + k] & 127).astype(np.int64) << (7 * k)
    return out


def postings_of(block: int, doc_ids: list, words_by_text: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """The index rows of one block: its documents, then the postings of each of its terms in order of terms."""
    sizes = np.array([len(w) for w in words_by_text], np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([[block], [None], [None], [None], [doc_ids], [sizes]], INDEX_TYPES.types)],
                                     schema=INDEX_TYPES)
    known = WordTable()
    ids = known.ids([w for words in words_by_text for w in words])
    if not len(ids):
        return
    terms = known.new
    by_term = sorted(range(len(terms)), key=terms.__getitem__)
    rank = np.empty(len(terms), np.int64)
    rank[by_term] = np.arange(len(terms))
    ids = rank[ids]
    order = np.argsort(ids, kind="stable")
    place = (np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes))[order]      # a gap after each text
    count = np.bincount(ids, minlength=len(terms))
    first = bounds_of(count)
    gap = np.diff(place, prepend=0)
    gap[first[:-1]] = place[first[:-1]]
    data, size = packed(gap)
    ends = bounds_of(size)[first].astype(np.int32)
    places = pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])
    none = pa.nulls(len(terms), pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), block)), pa.array([terms[k] for k in by_term], pa.binary()),
                                      pa.array(count.astype(np.int32)), places, none, none], schema=INDEX_TYPES)


class Postings:
    """Positional inverted index of the test terms over one block of texts."""

    def __init__(self, words_by_text: list[list[bytes]], terms: dict[bytes, int]):
        n = len(terms)
        self.bounds = bounds_of([len(w) + 1 for w in words_by_text])   # a gap after each text
        ids = np.full(int(self.bounds[-1]), n, np.int32)
        get = terms.get
        for k, words in enumerate(words_by_text):
            if words:
                ids[self.bounds[k]:self.bounds[k] + len(words)] = [get(w, n) for w in words]
        at = np.nonzero(ids < n)[0]
        order = np.argsort(ids[at], kind="stable")
        self.positions = at[order]
        self.count = np.bincount(ids[at], minlength=n)
        self.start = bounds_of(self.count)

    @classmethod
    def fetched(cls, sizes: np.ndarray, rows: list[tuple[bytes, int, bytes]], terms: dict[bytes, int]) -> "Postings":
        """From a block's stored rows (term, n, places)."""
        self = cls.__new__(cls)
        self.bounds = bounds_of(sizes + 1)
        rows = sorted((terms[t], n, p) for t, n, p in rows)
        self.count = np.zeros(len(terms), np.int64)
        self.count[[t for t, _, _ in rows]] = [n for _, n, _ in rows]
        self.start = bounds_of(self.count)
        run = np.cumsum(unpacked(np.frombuffer(b"".join(p for _, _, p in rows), np.uint8)))
        first = self.start[[t for t, _, _ in rows]] if rows else np.zeros(0, np.int64)
        before = np.concatenate([[0], run])[first] if len(run) else first
        self.positions = run - np.repeat(before, [n for _, n, _ in rows]) if rows else run
        return self

    def of(self, term: int) -> np.ndarray:
        return self.positions[self.start[term]:self.start[term + 1]]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions at which the terms stand next to each other in this order."""
        order = np.argsort(self.count[terms], kind="stable")
        found = self.of(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            other = self.of(terms[k])
            at = np.searchsorted(other, found + k)
            found = found[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == found + k)]
        return found

    def near(self, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) position of each proximity match: an occurrence of the rarest of the (distinct) terms with the
        nearest one of every other term, all at most ``within`` words from it and in the same text (ties: the earlier)."""
        order = np.argsort(self.count[terms], kind="stable")
        found = self.of(terms[order[0]])
        low, high = found.copy(), found.copy()
        for k in order[1:]:
            other = self.of(terms[k])
            if not len(found) or not len(other):
                return found[:0], found[:0]
            text = np.searchsorted(self.bounds, found, "right") - 1
            at = np.searchsorted(other, found)
            left, right = other[np.maximum(at - 1, 0)], other[np.minimum(at, len(other) - 1)]
            far = np.iinfo(np.int64).max
            to_left = np.where((at > 0) & (left >= self.bounds[text]), found - left, far)
            to_right = np.where((at < len(other)) & (right < self.bounds[text + 1]), right - found, far)
            ok = np.minimum(to_left, to_right) <= within
            nearest = np.where(to_left <= to_right, left, right)[ok]
            found, low, high = found[ok], np.minimum(low[ok], nearest), np.maximum(high[ok], nearest)
        return low, high


def _search(index: Postings, phrases: Phrases, runs: list[list[int]], items: list[set[str]]) -> None:
    if not phrases.windows:
        return
    rarest = np.minimum.reduceat(index.count[phrases.flat], phrases.starts)
    for w in np.nonzero(rarest)[0]:
        found = index.phrase(phrases.windows[w])
        if not len(found):
            continue
        text = np.searchsorted(index.bounds, found, "right") - 1
        first = found - index.bounds[text]
        for t, s in zip(text.tolist(), first.tolist()):
            runs[t] += (s, s + len(phrases.windows[w]))
            items[t].update(phrases.names[k] for k in phrases.items[w])


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_WORDS) -> Iterator[list]:
    """The test set as (item id as a string, words), in blocks of at most ``limit`` words (one item at least).

    Rows come to the driver one partition at a time, and one block is held at once.
    """
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
                            F.col("text").cast("string").alias("t")).filter("t is not null").distinct()
    block, size = [], 0
    for r in rows.toLocalIterator():
        words = words_of(r.t.encode())
        if not words:
            continue
        if size and size + len(words) > limit:
            yield block
            block, size = [], 0
        block.append((r.i, words))
        size += len(words)
    if block:
        yield block


def _digest(counts: list[int], runs: list[list[int]], items: list[set[str]]) -> list[pa.Array]:
    bounds = bounds_of([c + 1 for c in counts])
    step = np.zeros(int(bounds[-1]) + 1, np.int64)
    for k, run in enumerate(runs):
        if run:
            np.add.at(step, np.array(run[::2]) + bounds[k], 1)
            np.add.at(step, np.array(run[1::2]) + bounds[k], -1)
    hit = sums((np.cumsum(step[:-1]) > 0).astype(np.int64), bounds)
    sha = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
    return [pa.array(counts, pa.int64()), pa.array(hit), pa.array([len(x) for x in items], pa.int64()),
            pa.array(sha), pa.array(hit > 0)]


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        return self.spark.read.schema(INDEX).parquet(self.path)

    def delete(self) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def blocks(self, terms: dict[bytes, int]) -> DataFrame:
        """The documents of every block and the postings of the given terms, whose number the caller bounds."""
        asked = self.spark.createDataFrame([(t,) for t in terms], "term binary")
        rows = self.rows()
        return rows.filter("term is null").unionByName(rows.filter("term is not null").join(F.broadcast(asked), "term", "left_semi")
                                                       .select(*rows.columns))


def store_index(docs: DataFrame, path: str) -> Index:
    """Write the positional index of all words of all texts to ``path``, a folder that the cluster shares."""
    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in pieces(batch, "text"):
                yield from postings_of(number, part.column(0).to_pylist(), [words_of(t) for t in texts_of(part.column(1))])
                number += 1

    documents(docs).mapInArrow(run, INDEX).write.parquet(path)
    return Index(docs.sparkSession, path)


def _block(table: pa.Table, terms: dict[bytes, int]) -> tuple[list, Postings]:
    """(doc_ids, postings of the asked terms) of one block's rows."""
    term = table["term"].to_pylist()
    head = term.index(None)
    rows = [(t, n, p) for t, n, p in zip(term, table["n"].to_pylist(), table["places"].to_pylist()) if t is not None]
    return table["doc_ids"][head].as_py(), Postings.fetched(np.array(table["sizes"][head].as_py(), np.int64), rows, terms)


FOUND = "block long, nth int, doc_id long, n_words long, runs array<long>, items array<string>"


def search(index: Index, block: list, window: int = WINDOW) -> DataFrame:
    """Per document (block, nth): the runs of words (start, end, ...) inside windows of a block of items, and these items."""
    phrases = Phrases(block, window)

    def run(table: pa.Table) -> pa.Table:
        ids, postings = _block(table, phrases.terms)
        runs, items = [[] for _ in ids], [set() for _ in ids]
        _search(postings, phrases, runs, items)
        number = table["block"][0].as_py()
        return pa.table([pa.array([number] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int32()), pa.array(ids, pa.int64()),
                         pa.array(np.diff(postings.bounds) - 1), pa.array(runs, pa.list_(pa.int64())),
                         pa.array([sorted(x) for x in items], pa.list_(pa.string()))], [x.split()[0] for x in FOUND.split(", ")])

    return index.blocks(phrases.terms).groupBy("block").applyInArrow(run, FOUND)


def near(index: Index, items: DataFrame, within: int) -> DataFrame:
    """doc_id, item, start and span (in words of the document) of the proximity matches of each item's distinct terms.

    A match is an occurrence of the item's term that is rarest in the block of documents, with the nearest occurrence of each
    other term, none more than ``within`` words from it; documents are searched whole, and no match crosses two.
    """
    def finder(block: list):
        terms: dict[bytes, int] = {}
        asked = [(name, np.array(sorted({terms.setdefault(w, len(terms)) for w in words}))) for name, words in block]

        def run(table: pa.Table) -> pa.Table:
            ids, postings = _block(table, terms)
            rows = []
            for name, own in asked:
                low, high = postings.near(own, within)
                text = np.searchsorted(postings.bounds, low, "right") - 1
                rows += [(ids[t], name, a - int(postings.bounds[t]), b - a + 1) for t, a, b in zip(text.tolist(), low.tolist(), high.tolist())]
            cols = list(zip(*rows)) if rows else [()] * 4
            return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["doc_id", "item", "start", "span"])

        return index.blocks(terms).groupBy("block").applyInArrow(run, "doc_id long, item string, start long, span long")

    out = None
    for block in item_blocks(items):
        out = finder(block) if out is None else stored(out).unionByName(finder(block))
    return out if out is not None else index.spark.createDataFrame([], "doc_id long, item string, start long, span long")


def _result(batches):
    for batch in batches:
        col = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("n_words", "runs", "items")}
        digest = _digest(col["n_words"], [x or [] for x in col["runs"]], [set(x or ()) for x in col["items"]])
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), *digest], RESULT)


def answers(index: Index, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The result of ``decontaminate`` for a test set, from the index."""
    found = []
    for block in item_blocks(benchmark, block_words):
        if found:
            found[-1] = stored(found[-1])                # a pass is written before the next one; its block of items goes
        found.append(search(index, block, window))
    if not found:
        found = [search(index, [], window)]
    rows = found[0]
    if len(found) > 1:
        for x in found[1:]:
            rows = rows.unionByName(x)
        rows = rows.groupBy("block", "nth", "doc_id", "n_words").agg(F.flatten(F.collect_list("runs")).alias("runs"),
                                                                     F.flatten(F.collect_list("items")).alias("items"))
    return rows.mapInArrow(_result, ", ".join(map(" ".join, zip(RESULT, RESULT_TYPES))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a found window), n_items (items with a found
    window), items_sha256 (of their ids, sorted as strings and comma-joined), contaminated (n_hit > 0).

    Through an index that is stored for this call alone; ``store_index`` and ``answers`` keep one.
    """
    spark = docs.sparkSession
    index = store_index(docs, f"{ensure_checkpoint_dir(spark).rstrip('/')}/index-{uuid4().hex}")
    try:
        return stored(answers(index, benchmark, window, block_words))
    finally:
        index.delete()


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs, all columns as they are, in which no window of the test set occurs."""
    for block in item_blocks(benchmark, block_words):
        def make(block=block):
            phrases = Phrases(block, window)

            def clean(texts):
                items = [set() for _ in texts]
                _search(Postings([words_of(t) for t in texts], phrases.terms), phrases, [[] for _ in texts], items)
                return [not x for x in items]

            return clean

        docs = filter_texts(docs, make)
    return docs
