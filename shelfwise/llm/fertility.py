"""Quality rules from tokeniser fertility.

Base rules look at words and lines.  The method's verdict tokenises every word with
public vocabularies and measures per document
- ``chars_per_token``  code points of words per token of the piece vocabulary,
- ``byte_share``       share of its tokens that are byte fallbacks,
- ``entropy``          entropy in bits of its token distribution in the document, over the
                       log2 of the number of tokens (1: all tokens differ),
- ``bytes_per_token``  UTF-8 bytes of words per token of the byte-level vocabulary.

Each language (the ``lang`` column; without one, the script of most letters) has a
rejection band for each measure: the median of all its documents, less or more ``WIDTH``
times the distance from the median to the lower or upper quartile, and never tighter
than ``FLOOR`` around the median.  Measures of short texts scatter, so the band of a text
of n < ``STEADY_WORDS`` words is wider by sqrt(STEADY_WORDS / n).  Bands are aggregates over
all documents.  A language with fewer than ``LEAST`` measured documents takes the bands of
all documents of the text's script, and a script with fewer those of all documents, so that
every document that passes the base rules is held against some band.  A document outside any
band is rejected.

Defined cases: null and empty texts have no words, fail the base rules, carry measures
0 and leave the bands alone; a null lang uses the script.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WordTable, bounds_of, pieces, stored, sums, texts_of

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
MEASURES = ["chars_per_token", "byte_share", "entropy", "bytes_per_token"]
#: Least distance of a band's edge from the median, by measure.
FLOOR = {"chars_per_token": 0.05, "byte_share": 0.05, "entropy": 0.2, "bytes_per_token": 0.05}
WIDTH, LEAST = 6.0, 50
#: Documents with fewer words than this have wider bands: their measures scatter.
STEADY_WORDS = 200
#: Measures are rounded to this step before their quartiles are taken.
STEP = 1 / 4096
#: Bands up to this number are broadcast.
FEW_BANDS = 10_000
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, script string, "
          "chars_per_token double, byte_share double, entropy double, bytes_per_token double")
#: First code point of each script's block, and its name; ASCII letters are Latin.
SCRIPTS = [(0x0, "none"), (0xC0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x590, "hebrew"), (0x600, "arabic"),
           (0x900, "indic"), (0xE00, "other"), (0x2000, "none"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"),
           (0xD7B0, "other")]


def script_table() -> tuple[list[str], np.ndarray]:
    """Names, and the number of a name for each code point."""
    names = list(dict.fromkeys(n for _, n in SCRIPTS))
    of = np.array([names.index(n) for _, n in SCRIPTS], np.uint8)
    out = of[np.searchsorted([s for s, _ in SCRIPTS], np.arange(0x110000), "right") - 1]
    out[0x41:0x5B] = out[0x61:0x7B] = names.index("latin")
    return names, out


def scripts_of(texts: list[bytes], names: list[str], by_point: np.ndarray) -> list[str]:
    """Script of most letters of each text ("none" without letters); bytes that are no UTF-8 are no letters."""
    decoded = [t.decode("utf-8", "replace") for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in decoded])
    kind = by_point[np.frombuffer("".join(decoded).encode("utf-32-le"), np.uint32)]
    count = np.bincount(doc * len(names) + kind, minlength=len(texts) * len(names)).reshape(len(texts), len(names))
    count[:, 0] = 0                                             # "none" wins only without letters
    return [names[k] for k in count.argmax(axis=1)]


def repeated_words(ids: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text inside windows that occur twice or more in it (64-bit window hashes)."""
    n, counts = len(ids), np.diff(bounds)
    if n < window:
        return np.zeros(len(counts), np.int64)
    # each word id is spread over 64 bits, then mixed with powers of an odd number
    h, word = np.zeros(n - window + 1, np.uint64), ids.astype(np.uint64)
    for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        word = (word ^ (word >> np.uint64(29))) * np.uint64(c) + np.uint64(0x165667B19E3779F9)
    for k in range(window):
        h = h * np.uint64(0xD6E8FEB86659FD93) + word[k:n - window + 1 + k]
    doc = np.repeat(np.arange(len(counts)), counts)[:n - window + 1]
    inside = np.arange(n - window + 1) + window <= bounds[doc + 1]
    at = np.nonzero(inside)[0]
    h ^= doc.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    order = at[np.argsort(h[at], kind="stable")]
    same = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, order[twice], 1)
    np.add.at(step, order[twice] + window, -1)
    return sums((np.cumsum(step[:-1]) > 0).astype(np.int64), bounds)


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


class Vocabularies:
    """Tokens of words in the piece vocabulary (ids) and in the byte-level vocabulary (counts)."""

    def __init__(self, folder: str | None):
        import public_tokenizers
        import sentencepiece

        path = public_tokenizers.path if folder is None else lambda name: os.path.join(folder, name)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.bytes = self._byte_level(path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

    @staticmethod
    def _byte_level(path: str, pattern: str):
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def measure(folder: str | None):
    """Task-side function from texts to the columns of SCHEMA."""
    voc, known = Vocabularies(folder), WordTable()
    names, by_point = script_table()
    state = {"start": np.zeros(1, np.int64), "flat": np.zeros(0, np.int32), "level": np.zeros(0, np.int64)}

    def learn():
        words = [w.decode("utf-8", "replace") for w in known.new]
        known.new.clear()
        if words:
            ids = voc.pieces.encode(words, num_threads=1)
            ends = state["start"][-1] + np.cumsum([len(x) for x in ids])
            state["start"] = np.concatenate([state["start"], ends])
            state["flat"] = np.concatenate([state["flat"], np.fromiter((i for x in ids for i in x), np.int32)])
            level = np.array([len(voc.bytes.encode_ordinary(" " + w)) for w in words])
            state["level"] = np.concatenate([state["level"], level])

    def work(texts):
        if known.full():
            known.clear()
            state.update(start=np.zeros(1, np.int64), flat=np.zeros(0, np.int32), level=np.zeros(0, np.int64))
        split = [t.split() for t in texts]
        bounds = bounds_of([len(w) for w in split])
        ids = known.ids([w for words in split for w in words])
        learn()
        start, flat = state["start"], state["flat"]
        n = start[ids + 1] - start[ids]
        first = bounds_of(n)
        tokens = flat[np.repeat(start[ids] - first[:-1], n) + np.arange(first[-1])]
        edges = first[bounds]                       # token bounds of texts
        total = np.diff(edges)
        doc = np.repeat(np.arange(len(texts)), total)
        key = np.sort(doc.astype(np.int64) * len(voc.is_byte) + tokens)
        at = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(at, len(key))).astype(float)
        clog = np.bincount(key[at] // len(voc.is_byte), weights=count * np.log2(count), minlength=len(texts))
        nz = np.maximum(total, 1)
        entropy = np.where(total > 1, (np.log2(nz) - clog / nz) / np.maximum(np.log2(nz), 1e-9), 0.0)
        raw = [np.frombuffer(t, np.uint8) for t in texts]
        joined = np.frombuffer(b"".join(texts), np.uint8)
        tb = bounds_of([len(t) for t in texts])
        points = sums(((joined & 0xC0) != 0x80).astype(np.int64), tb)
        blanks = sums(((joined == 32) | ((joined >= 9) & (joined <= 13))).astype(np.int64), tb)
        level = sums(state["level"][ids], bounds)
        word_chars = points - blanks
        word_bytes = np.array([len(r) for r in raw]) - blanks
        return [np.diff(bounds), word_chars, sums(SYMBOLS[joined].astype(np.int64), tb),
                np.array([repeated_lines(t) for t in texts]), repeated_words(ids, bounds),
                pa.array(scripts_of(texts, names, by_point)),
                np.where(total > 0, word_chars / nz, 0.0), sums(voc.is_byte[tokens].astype(np.int64), edges) / nz, entropy,
                np.where(level > 0, word_bytes / np.maximum(level, 1), 0.0)]

    return work


def bands(measured: DataFrame, width: float = WIDTH, least: int = LEAST) -> DataFrame:
    """n, and the median and both half widths of each measure, for each band (language or script of those without one) and script.

    They come from all measured documents of the band, or of the script where the band has fewer than ``least``, or from all.
    """
    wider = F.array(*[F.struct(F.lit(k).alias("level"), c.alias("group")) for k, c in enumerate((F.col("band"), F.col("script"), F.lit("")))])
    # counts of measures rounded to steps of STEP: their number is bounded, and quartiles of counts are exact in any order of rows
    cells = F.array(*[F.struct(F.lit(k).alias("m"), F.round(F.col(m) / STEP).cast("long").alias("v")) for k, m in enumerate(MEASURES)])
    counts = (measured.select(F.explode(wider).alias("of"), cells.alias("cells")).select("of", F.explode("cells").alias("c"))
              .groupBy("of", "c.m", "c.v").agg(F.count("*").alias("often")))
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    aggs = [F.sum(F.when(F.col("m") == 0, F.col("often"))).alias("n")]
    for k, m in enumerate(MEASURES):
        p = F.percentile(F.when(F.col("m") == k, F.col("v") * STEP), quarters, F.col("often"))
        aggs += [p[1].alias(f"{m}_mid"), F.greatest(F.lit(FLOOR[m]), width * (p[1] - p[0])).alias(f"{m}_less"),
                 F.greatest(F.lit(FLOOR[m]), width * (p[2] - p[1])).alias(f"{m}_more")]
    groups = counts.groupBy("of").agg(*aggs).filter((F.col("of.level") == 2) | (F.col("n") >= least))
    found = measured.select("band", "script").distinct().select("band", "script", F.explode(wider).alias("of")).join(groups, "of")
    edges = F.struct(*[c for c in groups.columns if c != "of"])
    return found.groupBy("band", "script").agg(F.min_by(edges, F.col("of.level")).alias("e")).select("band", "script", "e.*")


def quality_rules(docs: DataFrame, folder: str | None = None, width: float = WIDTH, least: int = LEAST) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and the measures.

    ``folder`` holds the vocabulary files; by default that of the installed public vocabularies.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        work = measure(folder)
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[x if isinstance(x, pa.Array) else pa.array(x) for x in work(texts_of(part.column(2)))]],
                    ["doc_id", "lang", *[x.split()[0] for x in SCHEMA.split(", ")]])

    seen = stored(src.mapInArrow(run, f"doc_id long, lang string, {SCHEMA}")
                  .withColumn("band", F.coalesce("lang", F.concat(F.lit("script:"), "script")))
                  .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) |
                              (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))
    edges = stored(bands(seen.filter(~F.col("base_failed")), width, least))
    if edges.count() <= FEW_BANDS:      # else a join that shuffles, with a language's rows split where they are skewed
        edges = F.broadcast(edges)
    scatter = F.greatest(F.lit(1.0), F.sqrt(STEADY_WORDS / F.greatest("n_words", F.lit(1))))      # a text may have no words
    outside = F.lit(False)
    for m in MEASURES:
        off = F.col(m) - F.col(f"{m}_mid")
        outside = outside | F.coalesce((-off > scatter * F.col(f"{m}_less")) | (off > scatter * F.col(f"{m}_more")), F.lit(False))
    return seen.join(edges, ["band", "script"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~outside).alias("kept"), "script", *MEASURES)
