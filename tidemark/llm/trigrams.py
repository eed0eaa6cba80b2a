"""Boolean trigram queries from regular expressions, and the postings they are asked of.

A query is a set of alternatives, each a set of trigrams that must all occur: a disjunction of
conjunctions. ``None`` is the query that every text answers, of an expression from which no trigram
follows. Trigrams are over bytes with A-Z lowered, so they serve either case.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from re import _constants as op
from re import _parser as parser

import numpy as np

from tidemark.llm.arrays import LOWER, slices

Query = frozenset[frozenset[bytes]] | None

# More strings than this for one stretch of an expression, or more characters in one class, and
# the stretch is closed; that makes the query weaker, never wrong.
_MOST = 64

_EVERYTHING: Query = None


def _and(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    if len(a) * len(b) > _MOST**2:
        return min(a, b, key=len)
    return _shortest(x | y for x in a for y in b)


def _or(queries: Iterable[Query]) -> Query:
    queries = list(queries)
    return None if None in queries else _shortest(x for q in queries for x in q)


def _shortest(alternatives: Iterable[frozenset[bytes]]) -> Query:
    """Without alternatives that ask for more than another one does."""
    kept: list[frozenset[bytes]] = []
    for one in sorted(set(alternatives), key=len):
        if not any(other <= one for other in kept):
            kept.append(one)
    return frozenset(kept)


def _of_strings(strings: set[bytes]) -> Query:
    return _or(
        frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]) if len(s) > 2 else None
        for s in strings
    )


def _lowered(code: int) -> bytes:
    return chr(code).encode().lower()


def _members(items: list) -> set[bytes] | None:
    """The characters of a class, or None if there are too many or it is open-ended."""
    found: set[bytes] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(_lowered(value))
        elif kind is op.RANGE and value[1] - value[0] < _MOST:
            found.update(_lowered(c) for c in range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= 8 else None


def _product(a: set[bytes], b: set[bytes]) -> set[bytes] | None:
    return {x + y for x in a for y in b} if len(a) * len(b) <= _MOST else None


def _read(nodes: Iterable) -> tuple[set[bytes] | None, Query]:
    """All strings a part of an expression stands for (None: not known), and its query."""
    stretch: set[bytes] = {b""}
    query, whole = _EVERYTHING, True

    def close() -> None:
        nonlocal stretch, query, whole
        query, stretch, whole = _and(query, _of_strings(stretch)), {b""}, False

    def add(strings: set[bytes] | None, other: Query) -> None:
        nonlocal stretch, query
        longer = _product(stretch, strings) if strings is not None else None
        if longer is not None:
            stretch = longer
            return
        close()
        if strings is not None:
            stretch = strings
        else:
            query = _and(query, other)

    for kind, value in nodes:
        if kind is op.LITERAL:
            add({_lowered(value)}, None)
        elif kind is op.IN:
            add(_members(value), None)
        elif kind is op.SUBPATTERN:
            add(*_read(value[-1]))
        elif kind is op.BRANCH:
            read = [_read(branch) for branch in value[1]]
            exact = [strings for strings, _ in read]
            if None in exact:
                add(None, _or(
                    _of_strings(strings) if strings is not None else q for strings, q in read
                ))
            else:
                add(set().union(*exact), None)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, inner = value
            strings, inner_query = _read(inner)
            if low == 0:
                add(strings | {b""} if high == 1 and strings is not None else None, None)
                continue
            for _ in range(min(low, _MOST)):
                add(strings, inner_query)
            if high != low or low > _MOST:
                close()
        elif kind is op.AT:
            pass
        else:
            close()  # anything else may stand for anything
    if whole:
        return stretch, _of_strings(stretch)
    return None, _and(query, _of_strings(stretch))


def trigram_query(pattern: str) -> Query:
    """What any match of the pattern must hold."""
    return _read(parser.parse(pattern, re.ASCII))[1]


def _spread(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(16)


class Postings:
    """For the trigrams of some queries, which texts of a batch hold them."""

    def __init__(self, queries: Iterable[Query]):
        asked = {t for query in queries if query for one in query for t in one}
        self._numbers = {trigram: i for i, trigram in enumerate(sorted(asked))}
        self._codes = np.array([int.from_bytes(t, "big") for t in sorted(asked)], np.uint32)
        # A small table tells most trigrams apart from those asked for; the codes tell the rest.
        self._likely = np.zeros(1 << 16, bool)
        self._likely[_spread(self._codes)] = True

    def index(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of flags per trigram, one flag per text."""
        held = np.zeros((len(self._numbers), len(offsets) - 1), bool)
        for first, last in slices(offsets):
            inner = offsets[first : last + 1]
            part = LOWER[data[inner[0] : inner[-1]]].astype(np.uint32)
            if len(part) < 3 or not len(self._codes):
                continue
            codes = (part[:-2] << np.uint32(16)) | (part[1:-1] << np.uint32(8)) | part[2:]
            at = np.flatnonzero(self._likely[_spread(codes)])
            number = np.searchsorted(self._codes, codes[at])
            number[number == len(self._codes)] = 0
            asked = self._codes[number] == codes[at]
            at, number = at[asked], number[asked]
            text = np.searchsorted(inner, at + inner[0], side="right") - 1
            inside = at + inner[0] + 3 <= inner[text + 1]
            held[number[inside], first + text[inside]] = True
        return held

    def answers(self, held: np.ndarray, query: Query) -> np.ndarray:
        """Flags of the texts that hold all trigrams of any alternative."""
        found = np.zeros(held.shape[1], bool)
        if query is None:
            return ~found
        for trigrams in query:
            found |= held[[self._numbers[t] for t in trigrams]].all(axis=0)
        return found
