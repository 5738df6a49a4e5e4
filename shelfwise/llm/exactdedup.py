"""Exact duplicates by composable polynomial fingerprints, confirmed by comparing their bytes.

A text is normalised (each run of blanks becomes one space) and read as bytes x_0, x_1, ...; its
fingerprint in base B is the sum of x_i * B**i modulo the prime 2**61 - 1, in two bases.  The
fingerprint of a text in two parts a, b is

    H(ab) = H(a) + B**|a| * H(b)

so chunks are hashed by themselves, in any order and place, and combined by their lengths.

1. Texts of at most ``large`` bytes are hashed where they lie, many at once.  Larger ones are cut
   into chunks of ``chunk`` bytes that are dealt out over all tasks, hashed there, and combined
   from one short row for each chunk.  A chunk knows whether a blank precedes it, so runs of blanks
   that cross a cut count once.
2. Documents are grouped by both fingerprints and the length: a row of numbers for each document
   is exchanged, pre-aggregated in each task.
3. Equal fingerprints are not believed.  The fingerprints that several documents share set the bits
   of one bitmap of ``BITMAP`` bits; texts that hit it are sent as chunks, and all texts of one
   fingerprint are equal if and only if the least and the greatest of their chunks agree at every place.
   The aggregation keeps two chunks for each place and combines them in each task first, so of a
   group that holds a third of all rows a task sends one text.  A full bitmap lets more texts through
   than needed and changes no result.
4. Where the texts of one fingerprint differ, that group is parted by the SHA-256 of its texts.

Defined cases: a null text counts as empty; blank texts are one space; of equal texts the smallest
doc_id stays, and of rows that share it one; a null doc_id is larger than any other, and the id of a
group of null ids alone is null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import bounds_of, documents, pieces, stored, texts_of

PRIME = (1 << 61) - 1
BASES = (0x1B873593CC9E2D51 % PRIME, 0x0E6546B64AC4CEB9 % PRIME)
#: Bytes of a chunk, and of a text beyond which its chunks are dealt out.
CHUNK, LARGE = 1 << 20, 4 << 20
#: Bytes for which powers are at hand, and that a task hashes at once.
PIECE, BLOCK = 1 << 16, 2 << 20
#: Bits of the bitmap of shared fingerprints (8 MB).
BITMAP = 1 << 26
#: A null doc_id is ordered last, as this number (which no document should have).
LAST = (1 << 63) - 1
ODD = re.compile(rb"[\x20\x09-\x0D]{2,}|[\x09-\x0D]")
BLANK, BLANKS = b" \t\n\v\f\r", "[\\x20\\x09-\\x0D]+"
KEY = ["a", "b", "n"]
RECORD = "doc_id long, a long, b long, n long, sha string"


def normalised(data: bytes, after_blank: bool = False) -> bytes:
    """Each run of blanks as one space; none for the run that goes on from the part before."""
    out = ODD.sub(b" ", data)
    return out[1:] if after_blank and out[:1] == b" " else out


class Hasher:
    """Fingerprints of byte strings modulo ``prime``, which a test may choose small."""

    def __init__(self, prime: int = PRIME):
        self.prime, self.powers = prime, []
        for base in BASES:
            power, p = [], 1
            for _ in range(PIECE):
                power.append(p)
                p = p * base % prime
            power = np.array(power, np.uint64)
            self.powers.append((power >> np.uint64(31), power & np.uint64((1 << 31) - 1)))

    def many(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(a, b) of each text, from pieces of the length that the powers at hand reach."""
        pieces = [t[at:at + PIECE] for t in texts for at in range(0, max(1, len(t)), PIECE)]
        h, at = [], 0
        while at < len(pieces):
            room, stop = BLOCK, at
            while stop < len(pieces) and (stop == at or room >= len(pieces[stop])):
                room -= len(pieces[stop])
                stop += 1
            h += self._pieces(pieces[at:stop])
            at = stop
        out, at = [], 0
        for t in texts:
            n = max(1, -(-len(t) // PIECE))
            out.append(h[at] if n == 1 else combined([(min(PIECE, len(t) - k * PIECE), *h[at + k]) for k in range(n)], self.prime)[1:])
            at += n
        return out

    def _pieces(self, pieces: list[bytes]) -> list[tuple[int, int]]:
        size = np.array([len(t) for t in pieces], np.int64)
        bounds, some = bounds_of(size), np.nonzero(size)[0]
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64)
        place = np.arange(len(data)) - np.repeat(bounds[:-1], size)
        out = []
        for halves in self.powers:
            h = [0] * len(pieces)
            if len(some):
                # a byte times 31 bits, added up over a piece of 2**16 bytes, stays below 2**55
                up, down = (np.add.reduceat(data * x[place], bounds[some]).tolist() for x in halves)
                for k, u, d in zip(some.tolist(), up, down):
                    h[k] = ((u << 31) + d) % self.prime
            out.append(h)
        return list(zip(*out))


def combined(chunks: list[tuple[int, int, int]], prime: int = PRIME) -> tuple[int, int, int]:
    """(length, a, b) of a text from those of its chunks in order: each is shifted by the lengths before it."""
    n, h, shift = 0, [0, 0], [1, 1]
    for size, *part in chunks:
        for k, base in enumerate(BASES):
            h[k] = (h[k] + shift[k] * part[k]) % prime
            shift[k] = shift[k] * pow(base, size, prime) % prime
        n += size
    return n, h[0], h[1]


def _small(prime: int):
    def run(batches):
        hasher = Hasher(prime)
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = [normalised(t) for t in texts_of(part.column(1))]
                a, b = zip(*hasher.many(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                                                  pa.array([hashlib.sha256(t).hexdigest() for t in texts])], ["doc_id", "a", "b", "n", "sha"])

    return run


def _chunk_hashes(prime: int):
    """(row, at, n, a, b) of each chunk; ``part`` starts with the byte before the chunk (none for the first)."""

    def run(batches):
        hasher = Hasher(prime)
        for batch in batches:
            col = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            parts = [normalised(p if at == 0 else p[1:], at > 0 and p[:1] in BLANK) for at, p in zip(col["at"].to_pylist(), col["part"].to_pylist())]
            h = [hasher.many([p])[0] for p in parts]
            yield pa.RecordBatch.from_arrays([col["row"], col["at"], pa.array([len(p) for p in parts], pa.int64()), pa.array([x[0] for x in h], pa.int64()),
                                              pa.array([x[1] for x in h], pa.int64())], ["row", "at", "n", "a", "b"])

    return run


def _combine(prime: int):
    def run(batches):
        for batch in batches:
            ids, shas, lists = (batch.column(k).to_pylist() for k in range(3))
            whole = [combined([(c["n"], c["a"], c["b"]) for c in x], prime) for x in lists]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array([w[k] for w in whole], pa.int64()) for k in (1, 2, 0)], pa.array(shas, pa.string())],
                                             ["doc_id", "a", "b", "n", "sha"])

    return run


def fingerprints(docs: DataFrame, prime: int = PRIME, chunk: int = CHUNK, large: int = LARGE) -> DataFrame:
    """doc_id, fingerprints a and b, length n and SHA-256 of each normalised text."""
    d = documents(docs)
    size = F.octet_length("text")
    small = d.filter(size <= large).mapInArrow(_small(prime), RECORD)
    # few rows, kept once: their numbers name them in both branches
    big = stored(d.filter(size > large).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    data = F.col("text").cast("binary")
    cut = (big.select("row", data.alias("data"), F.explode(F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))).alias("at"))
           .select("row", "at", F.when(F.col("at") == 0, F.substring("data", 1, chunk))
                   .otherwise(F.substring(F.col("data"), F.col("at") * chunk, F.lit(chunk + 1))).alias("part"))
           .repartition("row", "at"))
    hashed = cut.mapInArrow(_chunk_hashes(prime), "row long, at int, n long, a long, b long")
    lists = hashed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "n", "a", "b"))).alias("chunks"))   # size / chunk numbers
    sha = F.sha2(F.regexp_replace("text", BLANKS, " "), 256)
    whole = big.select("row", "doc_id", sha.alias("sha")).join(lists, "row").select("doc_id", "sha", "chunks").mapInArrow(_combine(prime), RECORD)
    return small.unionByName(whole)


def bitmap(shared: DataFrame, bits: int = BITMAP) -> np.ndarray:
    """One bit for each fingerprint (its remainder) that several documents share; bits / 32 numbers at most reach the driver."""
    words = (shared.select(F.pmod("a", F.lit(bits)).alias("at")).groupBy(F.shiftright("at", 5).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("v")))
    got, out = words.toArrow(), np.zeros(bits >> 5, np.uint32)
    out[got["w"].to_numpy()] = got["v"].to_numpy().astype(np.uint32)
    return out


def _candidates(prime: int, chunk: int, marks: bytes, bits: int):
    """Normalised chunks of the texts whose fingerprint hits the bitmap."""

    def run(batches):
        hasher, mark = Hasher(prime), np.frombuffer(zstandard.decompress(marks), np.uint32)
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = [normalised(t) for t in texts_of(part.column(0))]
                h = np.array(hasher.many(texts), np.int64).reshape(-1, 2)
                at = h[:, 0] % bits
                hit = np.nonzero(mark[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1))[0].tolist()
                for few in range(0, len(hit), 256):
                    rows = [(*h[k].tolist(), len(texts[k]), no, texts[k][s:s + chunk]) for k in hit[few:few + 256]
                            for no, s in enumerate(range(0, max(1, len(texts[k])), chunk))]
                    a, b, n, no, data = zip(*rows)
                    yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in (a, b, n)], pa.array(no, pa.int32()), pa.array(data, pa.binary())],
                                                     ["a", "b", "n", "at", "bytes"])

    return run


def unequal(docs: DataFrame, shared: DataFrame, prime: int = PRIME, chunk: int = CHUNK, bits: int = BITMAP) -> DataFrame:
    """(a, b, n) of the fingerprints whose texts are not all equal, found chunk by chunk."""
    marks = zstandard.compress(bitmap(shared, bits).tobytes(), 1)
    return (documents(docs).select("text").mapInArrow(_candidates(prime, chunk, marks, bits), "a long, b long, n long, at int, bytes binary")
            .groupBy(*KEY, "at").agg(F.min("bytes").alias("least"), F.max("bytes").alias("most"))
            .filter("least <> most").select(*KEY).distinct())


def _shared(rows: DataFrame, key: list) -> DataFrame:
    return (rows.groupBy(*key).agg(F.min(F.struct("doc", "row")).alias("lead"), F.count("*").alias("size")).filter("size > 1"))


def duplicates(docs: DataFrame, prime: int = PRIME, chunk: int = CHUNK, large: int = LARGE, bits: int = BITMAP) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = stored(fingerprints(docs, prime, chunk, large).select(
        F.coalesce("doc_id", F.lit(LAST)).alias("doc"), *KEY, "sha", F.lit("").alias("part"), F.monotonically_increasing_id().alias("row")))
    shared, key = stored(_shared(rows, KEY)), KEY
    odd = stored(unequal(docs, shared, prime, chunk, bits))
    if not odd.isEmpty():
        key = [*KEY, "part"]
        rows = rows.drop("part").join(odd.withColumn("odd", F.lit(True)), KEY, "left").withColumn("part", F.when(F.col("odd"), F.col("sha")).otherwise(""))
        shared = stored(_shared(rows, key))
    lead = F.coalesce(F.col("lead.doc"), F.col("doc"))
    return rows.join(shared, key, "left").select(
        F.nullif("doc", F.lit(LAST)).alias("doc_id"), F.nullif(lead, F.lit(LAST)).alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("lead").isNull() | (F.col("lead.row") == F.col("row"))).alias("kept"), F.col("sha").alias("text_sha256"))


def without_copies(docs: DataFrame, **how) -> DataFrame:
    """docs, all columns as they are, with one row of each group of equal texts."""
    stay = duplicates(docs, **how).filter("kept").select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.col("text_sha256").alias("sha"))
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANKS, " "), 256)
    packed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), sha.alias("sha"), F.struct(*docs.columns).alias("row"))
    return (packed.join(stay, ["doc", "sha"], "left_semi").groupBy("doc", "sha").agg(F.first("row").alias("row"))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
