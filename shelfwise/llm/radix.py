"""Exact repeated byte strings by a depth-limited most-significant-digit radix sort of suffixes.

A suffix is ordered only through ``depth`` bytes, so the groups that are equal after the last
pass are exactly the repeated windows of ``depth`` bytes.

First digit.  The suffixes that start in one stretch of a text are kept together while they
cannot differ: in every window of ``depth`` bytes the least hashed ``GRAM``-byte string (the
leftmost of equals) is its anchor, and neighbouring windows with the same anchor form a run.
Equal windows have equal anchors at the same place, so windows are equal only inside one group
of anchors.  A task sends one record for each run: the anchor's hash (the digit), a hash of
all bytes that the run's windows cover, the document and the run's place.
    Runs with the same anchor and the same bytes are equal throughout: all but those of the
    smallest doc_id are removed whole.  An anchor with one kind of run is done; it leaves the
    sort.  Only runs of the smallest document of each kind, under anchors with several kinds,
    go on.
Second digit.  The bytes of these runs are fetched and sent by the anchor's hash; there each run
is spread into its windows, and of equal windows those that do not start in the group's smallest
document are removed.
Hot digits.  A passage that many documents share has an anchor near each of its ends under which
every document brings a run of its own.  A task that meets ``MANY`` kinds of run under one anchor
between two flushes keeps them back and sends the anchor's group one notice; the group then knows
that it is hot, as it does when it holds 64 times ``MANY`` kinds.  Runs of hot anchors take the
whole window as their next digit: they are spread where their text is, equal windows of a task
are merged (those of its later documents are removed at once), and the rest is sent by the
window's own hash, so neither digit has a group that holds more than about ``MANY`` records of
one anchor for each flush.

Records travel as packed columns, one block for each task and shard; a task merges equal texts
and equal runs of its own documents first, so a copied text or a common passage reaches a shard
once per flush at most.  Runs are compared by 80 bits of XXH3 of their bytes, and only runs with
one anchor are: of m kinds under an anchor m * m / 2**81 pairs are expected to pass as equal if
nobody has written texts against that hash (5e-9 in all for 3e9 anchors with 2,048 kinds each,
beyond which an anchor is hot; 7e-8 for a hot one with 4e8).  Windows are grouped by 64 bits and then compared byte by byte.  Texts
are joined by (doc_id, hash of the text), which no group of copies shares, and shuffled once.

Defined cases: a null or empty text has 0 bytes and nothing removed; texts shorter than
``depth`` keep all; rows with one doc_id never remove each other's bytes; repeated rows get the
same result; a null id counts as larger than any other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from shelfwise.llm.common import documents, parts_for, pieces, stored, texts_of

DEPTH, GRAM = 50, 20
#: Bytes of text for each shard of the sort, that a task hashes at once, and after which it sends its records.
SHARD_BYTES, CHUNK, FLUSH = 16 << 20, 1 << 20, 8 << 20
#: Shards of the second digit for each of the first: a run takes many times its room when it is spread.
SPREAD = 4
#: Kinds of run under one anchor between two flushes from which it is hot, and windows of hot anchors merged at once.
MANY, WINDOWS = 32, 1 << 18
#: Tasks of a digit at most; beyond it a task takes several shards, one after the other.
TASKS = 1 << 15
#: A null doc_id is ordered last, as this number (which no document should have).
LAST = (1 << 63) - 1
MULT = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(m: int, n: int) -> np.ndarray:
    out = np.full(n + 1, m, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


class Hasher:
    """64-bit hashes of substrings of one block of bytes, from prefix sums of random byte values."""

    def __init__(self, most: int = 0):
        rng = np.random.default_rng(97)
        self.value = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = self.inverse = np.ones(1, np.uint64)
        self._grow(most)

    def _grow(self, n: int):
        if n >= len(self.power):
            n += n // 4
            self.power, self.inverse = (_powers(m, n) for m in (MULT, pow(MULT, -1, 1 << 64)))

    def load(self, data: np.ndarray):
        self._grow(len(data))
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:len(data)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.prefix[end] - self.prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        k = max(0, len(self.prefix) - n)
        return _mix((self.prefix[n:] - self.prefix[:k]) * self.inverse[:k] + np.uint64(n))


def anchors_of(hasher: Hasher, texts: list[bytes], depth: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all grams, place of the anchor of the window at each start); hasher holds the joined texts afterwards."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    hasher.load(data)
    g = hasher.grams(gram)
    if len(data) < depth:
        return g, np.zeros(0, np.int64)
    # 32 bits of the hash order the grams; the place below them makes the leftmost of equals the least, and names it
    low = ((g >> np.uint64(32)) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
    width, span = depth - gram + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    return g, (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs_of(hasher: Hasher, texts: list[bytes], depth: int, gram: int):
    """(text, start, end, anchor hash) of each run of window starts with one anchor."""
    size = np.array([len(t) for t in texts], np.int64)
    g, place = anchors_of(hasher, texts, depth, gram)
    text = np.repeat(np.arange(len(texts)), size)[:len(place)]
    at = np.nonzero(np.arange(len(place)) + depth <= np.cumsum(size)[text])[0]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    new = np.nonzero(np.concatenate([[True], (place[at[1:]] != place[at[:-1]]) | (text[at[1:]] != text[at[:-1]])]))[0]
    start = at[new]
    return text[start], start, at[np.append(new[1:], len(at)) - 1] + 1, g[place[start]]


def _pack(*columns) -> bytes:
    """Columns (array, bytes of each value), byte plane after byte plane, compressed."""
    out = [np.uint32(len(columns[0][0])).tobytes()]
    for x, width in columns:
        out.append(np.ascontiguousarray(x).astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.compress(b"".join(out), 1)


def _unpack(blob: bytes, *widths) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.uint32, 1)[0]), 4, []
    for width in widths:
        full = np.zeros((n, 8), np.uint8)
        full[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(full.view(np.uint64).ravel())
        at += n * width
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences that a running sum undoes; neighbours are alike, so they pack well."""
    return np.diff(x.astype(np.uint64), prepend=np.uint64(0))


def _hashes(joined: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 16 more bits of the hash of each stretch of bytes."""
    raw = b"".join([xxh3_128_digest(joined[a:b]) for a, b in zip(start.tolist(), end.tolist())])
    both = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1] & np.uint64(0xFFFF)


def _emit(shards: int, doc, key, anchor, other, start, span, rest=None):
    """(shard, packed documents, packed runs) for each shard, in order of documents; a run of no span is a notice."""
    rest = np.zeros(len(doc), np.uint64) if rest is None else rest
    to = (anchor % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((start, key, doc, to))
    to, doc, key, anchor, other, start, span, rest = (x[order] for x in (to, doc, key, anchor, other, start, span, rest))
    cuts = np.searchsorted(to, np.arange(shards + 1))
    for s in range(shards):
        a, b = cuts[s], cuts[s + 1]
        if a == b:
            continue
        d, k = doc[a:b], key[a:b]
        first = np.nonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]))[0]
        heads = _pack((_steps(d[first]), 8), (k[first], 8), (np.diff(np.append(first, b - a)), 4))
        yield s, heads, _pack((anchor[a:b] // np.uint64(shards), 4), (other[a:b], 8), (_steps(start[a:b]), 4), (span[a:b], 1), (rest[a:b], 2))


def _heads(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents, keys, number of the document of each record) of blocks."""
    docs, keys, counts = [], [], []
    for b in blobs:
        d, k, c = _unpack(b, 8, 8, 4)
        docs.append(np.cumsum(d, dtype=np.uint64).view(np.int64))
        keys.append(k.view(np.int64))
        counts.append(c.astype(np.int64))
    docs, keys, counts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, keys, counts))
    return docs, keys, np.repeat(np.arange(len(docs), dtype=np.int32), counts)


def _runs(blobs: list[bytes]) -> list[np.ndarray]:
    """anchor, other, start, span, rest of the records of blocks."""
    parts = [_unpack(b, 4, 8, 4, 1, 2) for b in blobs]
    if not parts:
        return [np.zeros(0, np.int64)] * 5
    start = np.concatenate([np.cumsum(p[2], dtype=np.uint64).astype(np.uint32) for p in parts])
    return [np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), start.astype(np.int64),
            np.concatenate([p[3].astype(np.uint8) for p in parts]).astype(np.int64), np.concatenate([p[4].astype(np.uint16) for p in parts])]


#: Blocks hold runs; own blocks hold what a task finds by itself: heads a document, key and kind, body its marks.
BLOCK, BLOCK_SQL = ["shard", "heads", "body", "own"], "shard int, heads binary, body binary, own boolean"
#: What is removed or goes on: kind 0, bytes from start on are removed; kind 1, the run's windows are spread in
#: the anchor's group; kind 2, they are spread at once and sent one by one.
FOUND, FOUND_SQL = ["doc", "key", "kind", "marks"], "doc long, key long, kind int, marks binary"
FOUND_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def _blocks(rows, own: bool = False):
    rows = list(rows)
    for at in range(0, len(rows), 1000):
        cols = list(zip(*rows[at:at + 1000]))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary()),
                                           pa.array([own] * len(cols[0]))], BLOCK)


def _found(doc, key, kind, start, length) -> pa.Table:
    """One row for each document and kind, with its packed starts and lengths."""
    order = np.lexsort((start, kind, key, doc))
    doc, key, kind, start, length = (x[order] for x in (doc, key, kind, start, length))
    first = np.nonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])]))[0] if len(doc) else np.zeros(0, np.int64)
    if len(doc):     # removed stretches that touch or overlap become one
        reach = np.zeros(len(doc), np.int64)
        for a, b in zip(first, np.append(first[1:], len(doc))):
            reach[a:b] = np.maximum.accumulate(start[a:b] + length[a:b])
        new = np.ones(len(doc), bool)
        new[1:] = (kind[1:] > 0) | (start[1:] > reach[:-1])
        new[first] = True
        at = np.nonzero(new)[0]
        ends = reach[np.append(at[1:], len(doc)) - 1]
        length = np.where(kind[at] > 0, length[at], ends - start[at])
        doc, key, kind, start = doc[at], key[at], kind[at], start[at]
        first = np.searchsorted(at, first)
    marks = [np.stack([start[a:b], length[a:b]]).astype("<u4").tobytes() for a, b in zip(first, np.append(first[1:], len(doc)))]
    return pa.table([pa.array(doc[first], pa.int64()), pa.array(key[first], pa.int64()), pa.array(kind[first].astype(np.int32)),
                     pa.array(marks, pa.binary())], FOUND)


def _own(found: pa.Table, shards: int):
    """Own blocks of what a task has found, dealt out by document."""
    rows = zip(*(found[c].to_pylist() for c in FOUND))
    return _blocks((((d * 31 + k) % shards, np.array([d, k, kind], "<i8").tobytes(), m) for d, k, kind, m in rows), True)


def _handed_on(rows: list) -> pa.Table:
    """What own blocks among (heads, body, own) hold."""
    own = [(*np.frombuffer(h, "<i8").tolist(), b) for h, b, mine in rows if mine]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*own) if own else [()] * 4, FOUND_TYPES)], FOUND)


def _marks(blobs: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(b, "<u4").reshape(2, -1) for b in blobs or ()]
    both = np.concatenate(parts, axis=1).astype(np.int64) if parts else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def _equal_groups(*keys) -> tuple[np.ndarray, np.ndarray]:
    """(order, number of the group of equal keys in that order)."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new)


def _kinds(*keys) -> np.ndarray:
    """Number of each row's run of equal keys, for sorted keys."""
    out = np.zeros(len(keys[0]), np.int64)
    if len(out):
        out[1:] = np.cumsum(np.any([k[1:] != k[:-1] for k in keys], axis=0))
    return out


def _order(anchor, other, rest, doc) -> np.ndarray:
    """Order by anchor, bytes (their hash in two parts) and document."""
    order = np.lexsort((doc, other, anchor))
    a, o, r = anchor[order], other[order], rest[order]
    if np.any((a[1:] == a[:-1]) & (o[1:] == o[:-1]) & (r[1:] != r[:-1])):    # hardly ever: 64 bits agree, the rest does not
        order = np.lexsort((doc, rest, other, anchor))
    return order


def _kinds_under(anchor: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row of each anchor, number of its kinds, number of each row's anchor) of sorted rows."""
    group = _kinds(anchor)
    first = np.nonzero(np.diff(group, prepend=-1))[0]
    last = np.append(first[1:], len(group))[:len(first)] - 1
    return first, kind[last] - kind[first] + 1, group


def first_digit(depth: int, gram: int, shards: int, chunk: int, flush_bytes: int, many: int = MANY):
    """Task-side: documents (doc, key, text) to blocks of runs, and what the task finds by itself (own blocks)."""
    def send(held):
        columns = [np.concatenate(x) for x in zip(*held)]
        doc, key, anchor, other, start, span, rest = columns
        order = _order(anchor, other, rest, doc)
        doc, key, anchor, other, start, span, rest = (x[order] for x in columns)
        kind = _kinds(anchor, other, rest)
        later = doc > doc[np.searchsorted(kind, kind)]   # the first of a kind is in its smallest document
        first, kinds, group = _kinds_under(anchor, kind)
        hot = (kinds >= many)[group]
        told = first[kinds >= many]
        none = np.zeros(len(told), np.int64)
        stay = ~later & ~hot
        sent = [np.concatenate([x[stay], y]) for x, y in zip((doc, key, anchor, other, start, span, rest),
                                                              (doc[told], none, anchor[told], none.view(np.uint64), none, none, none.view(np.uint64)))]
        yield from _blocks(_emit(shards, *sent))
        out = later | hot
        if out.any():
            yield from _own(_found(doc[out], key[out], np.where(later, 0, 2)[out], start[out], np.where(later, span + depth - 1, span)[out]), shards)

    def run(batches):
        hasher, held, size, copies = Hasher(chunk), [], 0, []
        for batch in batches:
            for part in pieces(batch, "text", chunk):
                docs, keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist(), texts_of(part.column(2))
                least, take = {}, []
                for i in sorted(range(len(texts)), key=docs.__getitem__):
                    if len(texts[i]) < depth:
                        continue
                    if docs[i] > least.setdefault(texts[i], docs[i]):
                        copies.append((docs[i], keys[i], 0, 0, len(texts[i])))
                    elif least[texts[i]] == docs[i]:
                        take.append(i)
                some = [texts[i] for i in take]
                which, start, end, anchor = runs_of(hasher, some, depth, gram)
                if len(which):
                    base = np.cumsum([0] + [len(t) for t in some])
                    other, rest = _hashes(b"".join(some), start, end + depth - 1)
                    held.append([np.array([docs[i] for i in take], np.int64)[which], np.array([keys[i] for i in take], np.int64)[which],
                                 anchor, other, start - base[which], end - start, rest])
                size += sum(map(len, texts))
                if size > flush_bytes and held:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)
        if copies:
            yield from _own(_found(*(np.array(x, np.int64) for x in zip(*copies))), shards)

    return run


def equal_runs(depth: int, many: int = MANY):
    """Reducer of the first digit: blocks of a shard to what is removed and what goes on."""
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table[c].to_pylist() for c in BLOCK[1:])))
        docs, keys, of = _heads([h for h, _, mine in rows if not mine])
        anchor, other, start, span, rest = _runs([b for _, b, mine in rows if not mine])
        order = np.argsort(anchor, kind="stable")
        same = anchor[order[1:]] == anchor[order[:-1]]
        at = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
        told = np.unique(anchor[at][span[at] == 0])
        at = at[span[at] > 0]
        doc, anchor, other, start, span, rest, of = docs[of[at]], anchor[at], other[at], start[at], span[at], rest[at], of[at]
        order = _order(anchor, other, rest, doc)     # anchors that occur once have left the sort
        doc, anchor, other, start, span, rest, of = (x[order] for x in (doc, anchor, other, start, span, rest, of))
        kind = _kinds(anchor, other, rest)
        later = doc > doc[np.searchsorted(kind, kind)]
        first, kinds, group = _kinds_under(anchor, kind)
        hot = np.isin(anchor[first], told) | (kinds >= 64 * many)
        take = later | (hot | (kinds > 1))[group]
        what = np.where(later, 0, np.where(hot[group], 2, 1))
        return pa.concat_tables([_handed_on(rows), _found(doc[take], keys[of[take]], what[take], start[take],
                                                          np.where(later, span + depth - 1, span)[take])])

    return run


def second_digit(depth: int, gram: int, shards: int, chunk: int, most: int = WINDOWS):
    """Task-side: documents (doc, key, text, marks of runs, marks of hot runs) to blocks of the runs' bytes.

    Runs go by their anchor; windows of hot runs by their own hash, as runs of one window, after
    equal ones among ``most`` have been merged.
    """
    def by_shard(to, doc, key, start, span, bodies):
        order = np.lexsort((start, doc, to))
        rows = []
        for some in np.split(order, np.nonzero(np.diff(to[order]))[0] + 1):
            rows.append((int(to[some[0]]), _pack((doc[some], 8), (key[some], 8), (start[some], 4), (span[some], 1)), zstandard.compress(bodies(some), 1)))
        return _blocks(rows)

    def merged(held):
        doc, key, start, h, body = (np.concatenate(x) for x in zip(*held))
        order, later = _repeats(body.ravel(), np.arange(len(h)) * depth, h, doc, depth)
        gone, stay = order[later], order[~later]
        to, doc_, body_ = (h[stay] % np.uint64(shards)).astype(np.int64), doc[stay], body[stay]
        yield from by_shard(to, doc_, key[stay], start[stay], np.ones(len(stay), np.int64), lambda some: body_[some].tobytes())
        if len(gone):
            yield from _own(_found(doc[gone], key[gone], np.zeros(len(gone), np.int64), start[gone], np.full(len(gone), depth)), shards)

    def run(batches):
        hasher, held, size = Hasher(chunk), [], 0
        for batch in batches:
            for part in pieces(batch, "text", chunk):
                texts = texts_of(part.column(2))
                base = np.cumsum([0] + [len(t) for t in texts])
                joined = b"".join(texts)
                g, place = anchors_of(hasher, texts, depth, gram)
                docs, keys = (part.column(c).to_numpy() for c in (0, 1))
                for column in (3, 4):
                    marks = [_marks(b) for b in part.column(column).to_pylist()]
                    which = np.repeat(np.arange(len(texts)), [len(s) for s, _ in marks])
                    if not len(which):
                        continue
                    start, span = (np.concatenate(x) for x in zip(*marks))
                    first, doc, key = start + base[which], docs[which], keys[which]
                    if column == 3:
                        to = (g[place[first]] % np.uint64(shards)).astype(np.int64)
                        yield from by_shard(to, doc, key, start, span, lambda some: b"".join(
                            [joined[a:a + n] for a, n in zip(first[some].tolist(), (span[some] + depth - 1).tolist())]))
                        continue
                    every = np.lib.stride_tricks.sliding_window_view(np.frombuffer(joined, np.uint8), depth)
                    for some in np.split(np.arange(len(span)), np.nonzero(np.diff(np.cumsum(span) // most))[0] + 1):
                        run_of, inside = _spread(span[some])
                        at = first[some][run_of] + inside
                        held.append([doc[some][run_of], key[some][run_of], start[some][run_of] + inside, hasher.of(at, at + depth), every[at]])
                        size += len(at)
                        if size >= most:
                            yield from merged(held)
                            held, size = [], 0
        if held:
            yield from merged(held)

    return run


def _spread(span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the run, place in it) of each window of runs."""
    run_of = np.repeat(np.arange(len(span)), span)
    return run_of, np.arange(len(run_of)) - np.repeat(np.cumsum(span) - span, span)


def _by_bytes(data: np.ndarray, at: np.ndarray, kind: np.ndarray, depth: int, most: int = 1 << 20) -> np.ndarray:
    """Number of each window's group of equal bytes, from the sorted number of its group of equal hashes."""
    differ, n = [np.zeros(0, np.int64)], min(8, depth)
    eights = np.ndarray((max(0, len(data) - n + 1),), "<u8" if n == 8 else f"V{n}", data, 0, (1,)) if len(data) >= n else None
    for a in range(0, len(at) - 1, most):
        left = a + np.nonzero(kind[a + 1:a + 1 + most] == kind[a:a + most][:len(kind) - 1 - a])[0]
        same = np.ones(len(left), bool)
        for k in range(0, depth, 8):
            k = min(k, depth - n)       # the last eight bytes may overlap those before
            same &= eights[at[left] + k] == eights[at[left + 1] + k]
        differ.append(kind[left[~same]])
    bad = np.unique(np.concatenate(differ))
    if len(bad):        # different windows with one hash: their bytes name the groups
        kind, names = kind.copy(), {}
        for i in np.nonzero(np.isin(kind, bad))[0].tolist():
            kind[i] = names.setdefault(data[at[i]:at[i] + depth].tobytes(), len(at) + len(names))
    return kind


def _repeats(data: np.ndarray, at: np.ndarray, h: np.ndarray, doc: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether each window in that order also starts in a smaller document) of windows at places of data."""
    order, _ = _equal_groups(h, doc)
    kind, d = _by_bytes(data, at[order], _kinds(h[order]), depth), doc[order]
    if len(kind) and kind.max() >= len(kind):
        again, _ = _equal_groups(kind, d)
        order, kind, d = order[again], kind[again], d[again]
    return order, d > d[np.searchsorted(kind, kind)]


def equal_windows(depth: int):
    """Reducer of the second digit: windows that also start in a smaller document."""
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table[c].to_pylist() for c in BLOCK[1:])))
        sent = [(h, b) for h, b, mine in rows if not mine]
        if not sent:
            return _handed_on(rows)
        doc, key, start, span = (np.concatenate(x) for x in zip(*(_unpack(h, 8, 8, 4, 1) for h, _ in sent)))
        doc, key, start, span = doc.view(np.int64), key.view(np.int64), start.astype(np.int64), span.astype(np.int64)
        hasher, data = Hasher(), np.frombuffer(b"".join(zstandard.decompress(b) for _, b in sent), np.uint8)
        hasher.load(data)
        base = np.cumsum(span + depth - 1) - (span + depth - 1)
        run_of, inside = _spread(span)
        at = base[run_of] + inside
        order, later = _repeats(data, at, hasher.of(at, at + depth), doc[run_of], depth)
        r, inside = run_of[order[later]], inside[order[later]]
        return pa.concat_tables([_handed_on(rows), _found(doc[r], key[r], np.zeros(len(r), np.int64), start[r] + inside, np.full(len(r), depth, np.int64))])

    return run


RESULT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def cut_out(batches):
    """Task-side: documents (doc_id, text, marks of removed bytes) to the result."""
    for batch in batches:
        for part in pieces(batch, "text"):
            rows = []
            for text, blobs in zip(texts_of(part.column(1)), part.column(2).to_pylist()):
                if not blobs:
                    rows.append((len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                    continue
                s, n = _marks(blobs)
                step = np.zeros(len(text) + 1, np.int64)
                np.add.at(step, s, 1)
                np.add.at(step, s + n, -1)
                gone = np.cumsum(step[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3])], RESULT)


def repeated_bytes(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                   chunk: int = CHUNK, flush_bytes: int = FLUSH, many: int = MANY) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256."""
    src = documents(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("key"), "text")
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = parts_for(total, shard_bytes)
    tasks = min(shards, TASKS)
    found = stored(src.mapInArrow(first_digit(depth, gram, shards, chunk, flush_bytes, many), BLOCK_SQL)
                   .repartitionById(tasks, "shard").groupBy("shard").applyInArrow(equal_runs(depth, many), FOUND_SQL))
    more = found.filter("kind > 0").groupBy("doc", "key").agg(*[F.collect_list(F.when(F.col("kind") == k, F.col("marks"))).alias(f"marks{k}") for k in (1, 2)])
    # src is shuffled by document once: the second join reuses the exchange of the first
    spread = (src.join(more, ["doc", "key"])
              .mapInArrow(second_digit(depth, gram, SPREAD * shards, chunk), BLOCK_SQL)
              .repartitionById(tasks, "shard").groupBy("shard").applyInArrow(equal_windows(depth), FOUND_SQL))
    gone = (found.filter("kind = 0").unionByName(spread).groupBy("doc", "key").agg(F.collect_list("marks").alias("marks")))
    return (src.join(gone, ["doc", "key"], "left")
            .select(F.nullif("doc", F.lit(LAST)).alias("doc_id"), "text", "marks")
            .mapInArrow(cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
