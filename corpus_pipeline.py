"""Cleaning pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs.  All but the last return the columns of docs.

1. toxicity      documents that the classifier rejects go
2. line_dedup    later copies of repeated line runs are deleted from the texts (n_chars follows)
3. near_dedup    one document of each SimHash group stays: the one with the smallest doc_id
4. decontaminate documents that hold a window of a benchmark item go
5. packing       the texts that are left, as pieces in sequences

Defined cases: null texts stay null through the filters and count as empty; a document whose lines
are all deleted keeps an empty text and is near-deduplicated with other empty ones; an empty
table gives empty results; columns beside doc_id, text and n_chars pass through untouched.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import table
from shelfwise.llm.decontaminate import without_contaminated
from shelfwise.llm.linededup import without_repeats
from shelfwise.llm.packing import pack
from shelfwise.llm.simhash import one_of_each
from shelfwise.llm.toxicity import without_toxic
from shelfwise.session import ensure_checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = without_repeats(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = dict(docs.dtypes)["n_chars"]
    size = F.when(F.col("n_chars").isNotNull() & F.col("text").isNotNull(), F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

#: The classifier and the tokeniser have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between two stages is a table in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid4().hex}"
    docs, read = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return docs
        path = f"{folder}/{k}-{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if read:
            _delete(spark, read)
        read = path
    return docs
