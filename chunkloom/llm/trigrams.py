"""A trigram index over blocks of texts, and the trigrams that a regular expression requires.

required(pattern) walks the parsed expression and returns a conjunction of clauses; a clause is a set of
lower-case literals of which a match must contain at least one, and a literal stands for all of its
trigrams.  Block indexes the trigrams of a block of texts (those that some pattern requires), one posting
bitmap over the block's texts per trigram; candidates() intersects and unites the postings.  A block is an
Arrow batch, so the index never leaves the task and nothing is shuffled.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser

import numpy as np

#: A clause is given up if it would hold more alternatives.
MAX_ALTERNATIVES = 64
#: A class of more characters ends a literal.
MAX_CLASS = 16


def _times(left: frozenset[str], right: frozenset[str]) -> frozenset[str] | None:
    """All concatenations, or None if they are too many."""
    return frozenset(a + b for a in left for b in right) if len(left) * len(right) <= MAX_ALTERNATIVES else None


def _exact(tree) -> frozenset[str] | None:
    """All strings (in lower case) that a parsed expression matches, if they are few."""
    out: frozenset[str] | None = frozenset([""])
    for op, arg in tree:
        if op is sre.LITERAL:
            part = frozenset([chr(arg).lower()])
        elif op is sre.SUBPATTERN:
            part = _exact(arg[3])
        elif op is sre.BRANCH:
            parts = [_exact(x) for x in arg[1]]
            part = None if None in parts else frozenset().union(*parts)
        elif op is sre.IN and all(k in (sre.LITERAL, sre.RANGE) for k, _ in arg):
            spans = [(c, c) if k is sre.LITERAL else c for k, c in arg]
            few = sum(b - a + 1 for a, b in spans) <= MAX_CLASS
            part = frozenset(chr(c).lower() for a, b in spans for c in range(a, b + 1)) if few else None
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == 0 and arg[1] == 1:
            part = _exact(arg[2])
            part = None if part is None else part | {""}
        elif op is sre.AT:
            continue
        else:
            return None
        out = _times(out, part) if part is not None and len(part) <= MAX_ALTERNATIVES else None
        if out is None:
            return None
    return out


def _clauses(tree) -> list[frozenset[str]]:
    """The clauses of a sequence: neighbouring parts of few strings are multiplied out, other parts end the run."""
    clauses: list[frozenset[str]] = []
    run: frozenset[str] = frozenset([""])

    def close() -> None:
        nonlocal run
        if min(map(len, run)) >= 3:
            clauses.append(run)
        run = frozenset([""])

    for item in tree:
        op, arg = item
        if op in (sre.AT, sre.ASSERT_NOT):
            continue
        if op is sre.ASSERT:  # what is looked ahead for must be there, but what follows does not come behind it
            close()
            clauses += _clauses(arg[1])
            continue
        part = _exact([item])
        if part is not None:
            more = _times(run, part)
            if more is None:
                close()
                more = part
            run = more
            continue
        close()
        if op is sre.SUBPATTERN:
            clauses += _clauses(arg[3])
        elif op is sre.BRANCH:
            union: set[str] = set()
            for alternative in arg[1]:
                inner = _clauses(alternative)
                if not inner:
                    break
                union |= min(inner, key=lambda c: (len(c), -min(map(len, c))))
            else:
                if len(union) <= MAX_ALTERNATIVES:
                    clauses.append(frozenset(union))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and arg[0] > 0:
            clauses += _clauses(arg[2])
    close()
    return clauses


def required(pattern: str) -> list[frozenset[str]]:
    """Clauses that any text matched by the pattern fulfils; an empty list means that all texts are candidates."""
    return _clauses(parser.parse(pattern))


def trigrams(literal: str) -> list[int]:
    b = literal.encode()
    return [b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2)]


class Index:
    """What is needed to index blocks for a fixed set of patterns."""

    def __init__(self, patterns: list[str | tuple[str, ...]]):
        """Of several patterns in a tuple a text must hold all."""
        self.queries = [[c for x in ((p,) if isinstance(p, str) else p) for c in required(x)] for p in patterns]
        needed = sorted({t for q in self.queries for c in q for lit in c for t in trigrams(lit)})
        self.needed = np.array(needed, dtype=np.int64)
        self.number = {t: i for i, t in enumerate(needed)}
        self.sieve = np.zeros(1 << 16, dtype=bool)  # lossy first test by the last two bytes
        self.sieve[self.needed & 0xFFFF] = True

    def postings(self, texts: list[bytes]) -> np.ndarray:
        """bitmap[trigram, text] of a block of lower-cased texts."""
        bitmap = np.zeros((len(self.needed), len(texts)), dtype=bool)
        if not len(self.needed) or not texts:
            return bitmap
        ends = np.cumsum([len(t) + 2 for t in texts])
        data = np.frombuffer(b"\0\0".join(texts) + b"\0\0", dtype=np.uint8)
        low = data[:-1].astype(np.int64) << 8 | data[1:]
        at = np.flatnonzero(self.sieve[low[1:]])  # position of the trigram's first byte
        code = data[at].astype(np.int64) << 16 | low[at + 1]
        k = np.searchsorted(self.needed, code)
        k[k == len(self.needed)] = 0
        hit = self.needed[k] == code
        bitmap[k[hit], np.searchsorted(ends, at[hit], "right")] = True
        return bitmap

    def candidates(self, bitmap: np.ndarray) -> list[np.ndarray]:
        """For each pattern the texts of the block that can match it."""
        out = []
        n = bitmap.shape[1]
        for q in self.queries:
            texts = np.ones(n, dtype=bool)
            for clause in q:
                some = np.zeros(n, dtype=bool)
                for lit in clause:
                    some |= bitmap[[self.number[t] for t in trigrams(lit)]].all(axis=0)
                texts &= some
            out.append(np.flatnonzero(texts))
        return out
