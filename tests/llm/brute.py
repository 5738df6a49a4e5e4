"""Plain-Python versions of the operators, by their contracts."""

import hashlib
import re
from collections import Counter, defaultdict
from zlib import crc32

import xxhash


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def op1(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), failed)


def op3(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s:s + 10])].add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                k = tuple(w[s:s + n])
                if k in windows:
                    hit.update(range(s, s + n))
                    found |= windows[k]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0))
    return out


def fingerprint(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, bits=2):
    """Number of the component of each row."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                parent[find(a)] = find(b)
    return [find(k) for k in range(len(fps))]


def least_ids(fps, ids):
    """Smallest id of each component, by its number."""
    out = {}
    for g, i in zip(groups(fps), ids):
        out[g] = min(out.get(g, i), i, key=order)
    return out


def components(fps, ids):
    """Smallest id reachable, for each row."""
    least = least_ids(fps, ids)
    return [least[g] for g in groups(fps)]


def op5(docs, min_lines, min_chars):
    """(doc_id, lines, removed, runs, kept text) of each row; equal rows are one document.

    From the definition: every run of min_lines lines that are not blank, and besides it every
    line of min_chars characters alone; all occurrences but the first go.
    """
    filled = {d: [j for j, x in enumerate((d[1] or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for d in set(docs)}
    first, own = {}, {d: [] for d in filled}
    for d in sorted(filled, key=lambda r: (order(r[0]), r[1] or "")):
        text = (d[1] or "").split("\n")
        lines = [text[j] for j in filled[d]]
        for p in range(len(lines)):
            for n in {min_lines, *([1] if len(lines[p]) >= min_chars else [])}:
                if p + n <= len(lines):
                    own[d].append((p, tuple(lines[p:p + n])))
                    first.setdefault(own[d][-1][1], (d, p))
    out = []
    for d in docs:
        gone = {q for p, w in own[d] if first[w] != (d, p) for q in range(p, p + len(w))}
        cut = {filled[d][q] for q in gone}
        lines = (d[1] or "").split("\n")
        out.append((d[0], len(lines), len(gone), sum(q - 1 not in gone for q in gone), "\n".join(x for j, x in enumerate(lines) if j not in cut)))
    return out


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(digits))) % 10 == 0


def spans(text, kinds):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m)]
    counts = [sum(k == n for _, n, _ in found) for k in range(len(kinds))]
    return (*counts, sha(",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(found))))


def _digits(m):
    return re.sub("[^0-9]", "", m[0])


OP6 = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
       ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(len(p.lstrip("0")) < 4 and int(p[-9:]) <= 255 for p in m[0].split("."))),
       ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
       ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(_digits(m)) <= 15)]
OP8 = [("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
       ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
       ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16)]


def op10(docs, depth=50):
    first = {}
    for d, t in sorted(docs, key=lambda r: order(r[0])):
        t = (t or "").encode()
        for k in range(len(t) - depth + 1):
            first.setdefault(t[k:k + depth], order(d))
    out = []
    for d, t in docs:
        t = (t or "").encode()
        gone = bytearray(len(t))
        for k in range(len(t) - depth + 1):
            if first[t[k:k + depth]] < order(d):
                gone[k:k + depth] = b"\1" * depth
        out.append((d, len(t), sum(gone), sum(gone[j] > (gone[j - 1] if j else 0) for j in range(len(t))),
                    sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def fold(doc_id, mod):
    return None if doc_id is None else crc32(str(doc_id).encode()) % mod
