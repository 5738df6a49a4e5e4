"""Secret scan through a trigram inverted index.

Each rule's regular expression gives a Boolean query of trigrams that every match must
contain (``needed_trigrams``): literals give the AND of their trigrams, alternatives an OR,
and whatever is optional or a large class nothing.  A task builds, for its block of texts,
the postings (texts) of every trigram that some rule needs, evaluates each rule's query by
intersecting and uniting postings, and runs the expression on the candidates only.  A rule
without a mandatory trigram scans every text.

Expressions are ASCII over bytes; spans are in code points, end exclusive.  Per rule,
matches are leftmost and non-overlapping; one that fails the rule's check is dropped and
not retried.

Defined cases: null and empty texts have no spans; other inputs have no special cases, as
each text is judged by itself.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import bounds_of, documents, map_texts

# mandatory-trigram query: True (no trigram is needed), frozenset (all of them), or ("or" | "and", parts)
ANY = True
#: Most alternatives that a position may have while literals are strung together.
MOST = 16


@dataclass(frozen=True)
class Rule:
    """group: the group whose length is checked (0: the match); least: its least length."""
    name: str
    pattern: bytes
    group: int = 0
    least: int = 0
    base: bool = False


#: Base rules in the order in which spans with one start are listed, then the added ones.
RULES = (
    Rule("assign", rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", rb"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", rb"[0-9a-f]{16,}", 0, 16, True),   # the same matches as [0-9a-f]+ with 16 characters or more
    Rule("private_key", rb"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", rb"(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("google", rb"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", rb"[a-z][a-z0-9+.-]{1,20}://[^\s:@/]{1,64}:[^\s:@/]{3,64}@"),
    Rule("bearer", rb"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}=*"),
)


def _both(a, b):
    if a is ANY or b is ANY:
        return b if a is ANY else a
    return ("and", (a, b))


def _either(parts):
    return ANY if any(p is ANY for p in parts) or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _trigrams(strings: set[bytes]):
    """What text that holds one of the strings must contain."""
    return _either([frozenset(s[i:i + 3] for i in range(len(s) - 2)) or ANY for s in sorted(strings)])


def needed_trigrams(pattern: bytes):
    """Boolean query of lower-cased trigrams that any match of the expression contains."""
    from re import _constants as c
    from re import _parser

    def sequence(nodes):
        """Query of a sequence: runs of small sets of strings are strung together and give trigrams."""
        query, run = ANY, {b""}

        def flush():
            nonlocal query, run
            query, run = _both(query, _trigrams(run)), {b""}

        for op, arg in nodes:
            exact = strings(op, arg)
            if exact and len(exact) * len(run) <= MOST:
                run = {a + b for a in run for b in exact}
                continue
            flush()
            query = _both(query, general(op, arg))
        flush()
        return query

    def strings(op, arg):
        """All strings that the node matches, lower-cased, or None if too many."""
        if op is c.LITERAL:
            return {bytes([arg]).lower()}
        if op is c.IN and arg[0][0] is not c.NEGATE:
            found = set()
            for kind, x in arg:
                if kind is c.LITERAL:
                    found.add(bytes([x]).lower())
                elif kind is c.RANGE and x[1] - x[0] < MOST:
                    found.update(bytes([b]).lower() for b in range(x[0], x[1] + 1))
                else:
                    return None
            return found if len(found) <= MOST else None
        if op is c.SUBPATTERN:
            return product(arg[3])
        if op is c.BRANCH:
            each = [product(x) for x in arg[1]]
            return set().union(*each) if all(each) else None
        if op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[1] is not c.MAXREPEAT and arg[1] <= 4:
            one = product(arg[2])
            if one and len(one) ** int(arg[1]) <= MOST:
                out, some = set(), {b""}
                for k in range(int(arg[1]) + 1):
                    out |= some if k >= arg[0] else set()
                    some = {a + b for a in some for b in one}
                return out
        return None

    def product(nodes):
        out = {b""}
        for op, arg in nodes:
            exact = strings(op, arg)
            if not exact or len(exact) * len(out) > MOST:
                return None
            out = {a + b for a in out for b in exact}
        return out

    def general(op, arg):
        if op is c.SUBPATTERN:
            return sequence(arg[3])
        if op is c.BRANCH:
            return _either([sequence(x) for x in arg[1]])
        if op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[0] > 0:
            return sequence(arg[2])
        return ANY

    return sequence(_parser.parse(pattern))


def trigrams_in(query) -> set[bytes]:
    if query is ANY:
        return set()
    return set(query) if isinstance(query, frozenset) else set().union(*map(trigrams_in, query[1]))


class TrigramIndex:
    """Postings of the needed trigrams over a block of texts (lower-cased)."""

    def __init__(self, texts: list[bytes], slot: np.ndarray, wanted: list[bytes]):
        self.n = len(texts)
        joined = np.frombuffer(b"\x00\x00".join(texts).lower(), np.uint8)
        starts = bounds_of([len(t) + 2 for t in texts])
        code = slot[(joined[:-2].astype(np.int32) << 16) | (joined[1:-1].astype(np.int32) << 8) | joined[2:]] if len(joined) > 2 else np.zeros(0, slot.dtype)
        at = np.nonzero(code)[0]
        text = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique((code[at].astype(np.int64) - 1) * max(1, self.n) + text)
        which, text = pairs // max(1, self.n), pairs % max(1, self.n)
        cuts = np.searchsorted(which, np.arange(len(wanted) + 1))
        self.of = {t: text[cuts[k]:cuts[k + 1]] for k, t in enumerate(wanted)}

    def candidates(self, query) -> np.ndarray:
        """Texts that satisfy the query, in order."""
        if query is ANY:
            return np.arange(self.n)
        if isinstance(query, frozenset):
            lists = sorted((self.of[t] for t in query), key=len)
        else:
            lists = [self.candidates(q) for q in query[1]]
            if query[0] == "or":
                return np.unique(np.concatenate(lists))
            lists.sort(key=len)
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, assume_unique=True)
        return out


def scanner(rules: tuple = RULES):
    """Factory of the task-side function from texts to (counts of the base rules, base digest, spans)."""
    queries = [needed_trigrams(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams_in, queries)))

    def make():
        compiled = [re.compile(r.pattern) for r in rules]
        slot = np.zeros(1 << 24, np.uint16 if len(wanted) < 65_000 else np.int32)
        for k, t in enumerate(wanted):
            slot[int.from_bytes(t, "big")] = k + 1

        def work(texts):
            index = TrigramIndex(texts, slot, wanted)
            found: dict[int, list] = {}
            counts = np.zeros((len(rules), len(texts)), np.int64)
            for k, (rule, query, exp) in enumerate(zip(rules, queries, compiled)):
                for t in index.candidates(query).tolist():
                    for m in exp.finditer(texts[t]):
                        if len(m[rule.group]) >= rule.least:
                            found.setdefault(t, []).append((m.start(), k, m.end()))
                            counts[k, t] += 1
            none = hashlib.sha256(b"").hexdigest()
            base, spans = [none] * len(texts), [""] * len(texts)
            for t, hits in found.items():
                point = bounds_of((np.frombuffer(texts[t], np.uint8) & 0xC0) != 0x80)   # code points before each byte
                named = [(rules[k].base, f"{rules[k].name}:{point[a]}:{point[b]}") for a, k, b in sorted(hits)]
                base[t] = hashlib.sha256(",".join(s for own, s in named if own).encode()).hexdigest()
                spans[t] = ",".join(s for _, s in named)
            return [*[counts[k] for k, r in enumerate(rules) if r.base], pa.array(base), pa.array(spans)]

        return work

    return make


def secret_scan(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Per document: doc_id, n_<rule> of each base rule, base_sha256, spans (all rules, "rule:start:end" by start)."""
    counts = "".join(f"n_{r.name} long, " for r in rules if r.base)
    return map_texts(documents(docs), scanner(rules), f"{counts}base_sha256 string, spans string")
