"""Sequence packing by non-negative least squares over length combinations.

1. A document's token ids (its text's, then id 1) are cut into pieces of ``window`` ids and
   a remainder.  Each piece has a rank among the pieces of its length in its task; the
   pieces are stored, which freezes tasks and ranks.
2. The histogram of lengths (at most ``window`` rows) is gathered.  Shallow combinations
   that fill a window exactly (one piece, two, three and four with like shares) are
   enumerated, and repeat counts x >= 0 with least |A x - h| are solved by accelerated
   projected gradient.  Counts are rounded down to what the histogram holds.
3. The residual histogram is packed greedily, largest first, each window filled with the
   largest lengths that fit; a window's pattern repeats while lengths last.
4. Patterns become a table of slots per length.  A piece's global rank (its rank plus the
   counts of earlier tasks) picks its slot: sequence_id and offset.

All of 2 and 3 work on at most ``window`` counts, whatever the input's size; documents of
one length, however many, are ranked in the tasks that hold them.

Defined cases: a null or empty text is the single id 1; repeated rows are packed as rows of
their own; null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WordTable, bounds_of, documents, pieces, stored, texts_of

WINDOW, END = 2048, 1
#: Bytes of text tokenised at once: new words are encoded in large lots.
CHUNK = 4 << 20
#: Words of letters encoded as one text.
GROUP = 256
VOCABULARY = "word_bpe_49k.json"
#: Texts of these characters alone are lower-cased and parted at white space before the vocabulary sees them,
#: which changes no id: the vocabulary lower-cases and drops white space itself, and these characters are
#: normal forms with one lower-case character each.
PLAIN = re.compile(r"[^\x00-\x1b\x20-\x7f\xa1-įı-ɏ]")
#: A full stop or comma after a letter and before white space is a token run of its own.
STOP = re.compile(r"[.,](?!\S)(?<=[a-z\xdf-\xf6\xf8-ɏ][.,])")


def tokenizer(path: str | None, name: str = VOCABULARY):
    """Task-side function from texts to (bounds, token ids)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path or public_tokenizers.path(name))
    last = np.zeros(tok.get_vocab_size(with_added_tokens=True), bool)      # tokens that end a run of letters
    last[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True
    known = WordTable(600_000)
    empty = {"start": np.zeros(0, np.int64), "size": np.zeros(0, np.int64), "flat": np.zeros(0, np.int32)}
    state = dict(empty)

    def one_by_one(words: list[str]) -> list:
        return [x.ids for x in tok.encode_batch_fast(words, add_special_tokens=False)]

    def learn(words: list[str]) -> None:
        """Add the words' token ids to the state.  Words of letters alone are one run of letters each, so many are
        encoded as one text and parted after tokens that end a word, at a fraction of the cost of a call for each."""
        start, size, flat, at = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [state["flat"]], len(state["flat"])
        plain, rest = [], []
        for k, w in enumerate(words):
            (plain if w.isalpha() else rest).append(k)
        groups = [plain[a:a + GROUP] for a in range(0, len(plain), GROUP)]
        for group, x in zip(groups, tok.encode_batch_fast([" ".join([words[k] for k in g]) for g in groups], add_special_tokens=False)):
            ids = np.array(x.ids, np.int32)
            ends = np.nonzero(last[ids])[0] + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                n = np.diff(ends, prepend=0)
                size[group], start[group] = n, at + ends - n
                flat.append(ids)
                at += len(ids)
            else:
                rest += group
        found = one_by_one([words[k] for k in rest])
        n = np.fromiter(map(len, found), np.int64, len(found))
        size[rest], start[rest] = n, at + np.cumsum(n) - n
        flat.append(np.fromiter(chain.from_iterable(found), np.int32))
        state.update(start=np.concatenate([state["start"], start]), size=np.concatenate([state["size"], size]), flat=np.concatenate(flat))

    def encode(texts: list[bytes]):
        if known.full():
            known.clear()
            state.update(empty)
        split = []
        for t in texts:
            t = t.decode("utf-8", "replace")
            split.append([t] if PLAIN.search(t) else STOP.sub(r" \g<0>", t.lower()).split())
        bounds = bounds_of([len(w) for w in split])
        ids = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, bounds[-1])
        if known.new:
            learn(known.new)
            known.new.clear()
        start, n = state["start"][ids], state["size"][ids]
        first = bounds_of(n)
        return first[bounds], state["flat"][np.repeat(start - first[:-1], n) + np.arange(first[-1])]

    return encode


def cut_pieces(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, task and rank (among pieces of its length in the task)."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank"]

    def run(batches):
        from pyspark import TaskContext
        task, encode, seen = TaskContext.get().partitionId(), tokenizer(path), np.zeros(window + 1, np.int64)
        for batch in batches:
            for part in pieces(batch, "text", CHUNK):
                bounds, flat = encode(texts_of(part.column(1)))
                rows, start, length, crc, total, rank = [], [], [], [], [], []
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    ids = np.append(flat[a:b], END).astype("<u4")
                    for s in range(0, len(ids), window):
                        piece = ids[s:s + window]
                        rows.append(k)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(crc32(piece.tobytes()))
                        total.append(len(ids))
                        rank.append(seen[len(piece)])
                        seen[len(piece)] += 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)],
                     pa.array([task] * len(rows), pa.int64()), pa.array(rank, pa.int64())], names)

    return documents(docs).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """Rows of four lengths (0: none) that fill the window: pairs, and triples and fours with like shares of the rest."""
    rows = set()
    for a in present.tolist():
        rest = window - a
        rows.add((a, rest, 0, 0))
        for k in (2, 3, 4, 5):
            b = rest // k
            rows.add((a, b, rest - b, 0))
            rows.add((a, b, (rest - b) // 2, rest - b - (rest - b) // 2))
    rows = {tuple(sorted(r, reverse=True)) for r in rows}
    ok = np.zeros(window + 1, bool)
    ok[present] = ok[0] = True
    out = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return out[ok[out].all(1)]


def repeat_counts(combos: np.ndarray, h: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 with least |A x - h|, A the lengths of each combination (FISTA)."""
    part = combos.ravel()
    use = lambda x: np.bincount(part, weights=np.repeat(x, 4), minlength=len(h)) * (np.arange(len(h)) > 0)
    back = lambda r: r[combos].sum(1)
    v, norm = np.ones(len(combos)), 1.0
    for _ in range(20):
        v = back(use(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(use(y) - h) / (1.05 * norm))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def patterns(h: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, repeats): every length is used as often as the histogram has it."""
    left, out = h.astype(np.int64).copy(), []
    if left[window]:
        out.append(([window], int(left[window])))
        left[window] = 0
    present = np.nonzero(left)[0]
    combos = combinations(present, window) if len(present) else np.zeros((0, 4), np.int64)
    if len(combos):
        x = repeat_counts(combos, left.astype(float))
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 1:
                break
            lengths, times = np.unique(combos[k][combos[k] > 0], return_counts=True)
            n = min(int(x[k]), int((left[lengths] // times).min()))
            if n:
                left[lengths] -= n * times
                out.append((combos[k][combos[k] > 0].tolist(), n))
    while left.any():
        space, lengths, times = window, [], []
        have = np.nonzero(left)[0]
        while space:
            at = np.searchsorted(have, space, "right") - 1
            while at >= 0 and lengths and have[at] >= lengths[-1]:
                at -= 1
            if at < 0:
                break
            n = min(int(left[have[at]]), space // int(have[at]))
            lengths.append(int(have[at]))
            times.append(n)
            space -= n * lengths[-1]
        n = int((left[lengths] // np.array(times)).min())
        left[lengths] -= n * np.array(times)
        out.append((np.repeat(lengths, times).tolist(), n))
    return out


def slots(found: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, sequence, offset, pieces of this length side by side in a sequence)."""
    out, used, sequence = {}, {}, 0
    for lengths, repeats in found:
        offset = 0
        for length in dict.fromkeys(lengths):
            m = lengths.count(length)
            out.setdefault(length, []).append((used.get(length, 0), sequence, offset, m))
            used[length] = used.get(length, 0) + m * repeats
            offset += m * length
        sequence += repeats
    return {k: np.array(v) for k, v in out.items()}


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = stored(cut_pieces(docs, window, path))
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():    # at most ``window`` rows
        histogram[r.length] = r.n
    table = slots(patterns(histogram, window))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(batches):
        for batch in batches:
            length = batch.column(2).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for at in np.split(order, np.nonzero(np.diff(length[order]))[0] + 1) if len(order) else ():
                rows = table[int(length[at[0]])]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                own = rank[at] - row[:, 0]
                sequence[at] = row[:, 1] + own // row[:, 3]
                offset[at] = row[:, 2] + own % row[:, 3] * length[at[0]]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(5)], pa.array(sequence), pa.array(offset)], names)

    return (cut.join(base, ["length", "task"])
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("rank")).alias("rank"))
            .mapInArrow(place, ", ".join(f"{n} long" for n in names)))
