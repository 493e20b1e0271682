"""Boolean trigram queries of regular expressions.

A query is a list of alternatives, each a set of trigrams that every match of that alternative holds (letters folded to
lower case). ``None``: the expression has no mandatory trigram, so it must be tried on every text.
"""

from __future__ import annotations

from itertools import product
from re import _constants as codes
from re import _parser as grammar

#: Most literal strings followed at once, and most alternatives kept; beyond, a part of the expression demands nothing.
MOST = 64


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _either(a: list | None, b: list | None) -> list | None:
    return None if a is None or b is None else list(dict.fromkeys([*a, *b]))


def _both(a: list | None, b: list | None) -> list | None:
    if a is None or b is None:
        return a if b is None else b
    if len(a) * len(b) > MOST:
        return min(a, b, key=len)
    return list(dict.fromkeys(x | y for x, y in product(a, b)))


def _of_words(words: set[str]) -> list | None:
    found = [trigrams(w) for w in words]
    return found if found and all(found) else None


def _literals(op, arg) -> set[str] | None:
    """All strings one item can match, folded; None if too many or unbounded."""
    if op is codes.LITERAL:
        return {chr(arg).lower()}
    if op is codes.IN:
        found = set()
        for kind, value in arg:
            if kind is codes.LITERAL:
                found.add(chr(value).lower())
            elif kind is codes.RANGE and value[1] - value[0] < 8:
                found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
            else:
                return None
        return found
    return None


def _walk(items) -> tuple[set[str] | None, list | None]:
    """(the strings a sequence can match, or None; its query besides those strings)."""
    query, run = None, {""}
    exact = True
    for op, arg in items:
        words, inner = _item(op, arg)
        if words is not None and len(run) * len(words) <= MOST:
            run = {a + b for a, b in product(run, words)}
            continue
        query, exact = _both(_both(query, _of_words(run)), inner), False
        run = words if words is not None else {""}
    if exact:
        return run, None
    return None, _both(query, _of_words(run))


def _item(op, arg) -> tuple[set[str] | None, list | None]:
    if op is codes.SUBPATTERN:
        return _walk(arg[-1])
    if op is codes.BRANCH:
        parts = [_walk(p) for p in arg[1]]
        if all(words is not None for words, _ in parts):
            return set().union(*(words for words, _ in parts)), None
        query: list | None = []
        for words, inner in parts:
            query = _either(query, _both(inner, _of_words(words) if words is not None else None))
        return None, query
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT):
        low, high, body = arg
        words, inner = _walk(body)
        if words is not None and high <= 1:
            return words | ({""} if low == 0 else set()), None
        if words is not None and low == high and low <= 4 and len(words) ** low <= MOST:
            return {"".join(p) for p in product(words, repeat=low)}, None
        return None, _both(inner, _of_words(words) if words is not None else None) if low else None
    if op is codes.AT:
        return {""}, None
    return _literals(op, arg), None


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of mandatory trigrams, shortest sufficient ones only; None if there is none."""
    words, query = _walk(grammar.parse(pattern))
    query = _both(query, _of_words(words) if words is not None else None)
    if query is None:
        return None
    return [a for a in query if not any(b < a for b in query)]
