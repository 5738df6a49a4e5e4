"""Helpers shared by the operators of this package.

Documents are read as ``doc_id`` (long) and ``text`` (string); other columns never
reach an operator, so extra columns may have any name.  A null text is treated as
the empty text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.semantics import materialize

#: Bytes of text handled at once inside a task.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, a null text as the empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (one row at least)."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    size = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_string(col.type) or
                         pa.types.is_large_binary(col.type) else np.int32)
    ends = size[col.offset:col.offset + len(col) + 1].astype(np.int64)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(col: pa.Array) -> list[bytes]:
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [t or b"" for t in col.cast(kind).to_pylist()]


def map_texts(docs: DataFrame, make: Callable, schema: str, keep: tuple = ("doc_id",)) -> DataFrame:
    """A row of ``keep`` columns and new columns for each document; no shuffle.

    ``make()`` runs once in a task and returns a function from a list of texts (UTF-8
    bytes) to a list of arrays, one for each new column.
    """
    names = [*keep, "text"]

    def run(batches):
        work, out = make(), None
        for batch in batches:
            for part in pieces(batch, "text"):
                if out is None:
                    out = [*keep, *[x.split()[0] for x in schema.split(", ")]]
                new = [x if isinstance(x, pa.Array) else pa.array(x) for x in work(texts_of(part.column(len(keep))))]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], *new], out)

    kinds = dict(docs.dtypes)
    return docs.select(*names).mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in keep], schema]))


def filter_texts(docs: DataFrame, make: Callable) -> DataFrame:
    """The rows, all columns as they are, whose text passes; no shuffle.

    ``make()`` runs once in a task and returns a function from a list of texts (UTF-8
    bytes) to a list of booleans.
    """
    at = docs.columns.index("text")

    def run(batches):
        work = make()
        for batch in batches:
            for part in pieces(batch, "text"):
                yield part.filter(pa.array(work(texts_of(part.column(at))), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


class WordTable(dict):
    """Ids of words by order of arrival; new words wait in ``new`` until the caller has their values.

    The table is emptied between chunks when it has ``limit`` words, which bounds
    memory and changes no result.
    """

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit, self.new = limit, []

    def __missing__(self, word):
        self[word] = i = len(self)
        self.new.append(word)
        return i

    def ids(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def full(self) -> bool:
        return len(self) > self.limit


def bounds_of(counts) -> np.ndarray:
    """0 and the running sums of counts."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds; empty ranges are 0."""
    run = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=run[1:])
    return run[bounds[1:]] - run[bounds[:-1]]


def held_out(mod: int, rest: int):
    """crc32(doc_id as text) mod ``mod`` is ``rest``; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, per_class: int,
                    extra: tuple = ()) -> DataFrame:
    """doc_id, text, label (and long columns ``extra``, null where absent) of at most ``per_class`` training rows of each class.

    The rows are those with the smallest hashes of doc_id, so the sample depends on
    the tables alone.  The side that is broadcast has 2 * per_class rows at most.
    """
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
           .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(mod, rest))
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    one, two = (lab.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1))
    more = [(F.col(c).cast("long") if c in docs.columns else F.lit(None).cast("long")).alias(c) for c in extra]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)
    return rows.join(F.broadcast(one.unionByName(two)), "doc_id").select("doc_id", "text", "label", *extra)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def stored(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared folder that spark.checkpoint.dir names."""
    return materialize(df)


def parts_for(n: int, each: int) -> int:
    return max(1, math.ceil(n / each))
