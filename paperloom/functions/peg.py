"""A small parsing-expression-grammar kernel.

A parser is a function ``(text, at) -> (value, next) | None``. Alternatives are
ordered: the first that matches wins, and failing inside one of them backtracks to
the position where it began.
"""

from __future__ import annotations

import re
from collections.abc import Callable

Result = tuple[object, int] | None
Parser = Callable[[str, int], Result]


def term(pattern: str, flags: int = 0) -> Parser:
    """A terminal given as a regular expression; its value is the match's text."""
    rx = re.compile(pattern, flags)

    def run(text: str, at: int) -> Result:
        m = rx.match(text, at)
        return (m.group(0), m.end()) if m else None

    return run


def seq(*parts: Parser) -> Parser:
    def run(text: str, at: int) -> Result:
        values = []
        for p in parts:
            r = p(text, at)
            if r is None:
                return None
            values.append(r[0])
            at = r[1]
        return values, at

    return run


def choice(*parts: Parser) -> Parser:
    def run(text: str, at: int) -> Result:
        for p in parts:
            r = p(text, at)
            if r is not None:
                return r
        return None

    return run


def many(part: Parser) -> Parser:
    """Zero or more; stops when ``part`` fails or consumes nothing."""

    def run(text: str, at: int) -> Result:
        values = []
        while (r := part(text, at)) is not None and r[1] > at:
            values.append(r[0])
            at = r[1]
        return values, at

    return run


def some(part: Parser) -> Parser:
    """One or more."""
    return check(many(part), bool)


def check(part: Parser, test: Callable) -> Parser:
    """``part``, if its value passes ``test``."""

    def run(text: str, at: int) -> Result:
        r = part(text, at)
        return r if r is not None and test(r[0]) else None

    return run


def maybe(part: Parser) -> Parser:
    def run(text: str, at: int) -> Result:
        return part(text, at) or (None, at)

    return run


def ahead(part: Parser) -> Parser:
    """Succeeds without consuming if ``part`` matches here."""

    def run(text: str, at: int) -> Result:
        return (None, at) if part(text, at) is not None else None

    return run


def unless(part: Parser) -> Parser:
    def run(text: str, at: int) -> Result:
        return None if part(text, at) is not None else (None, at)

    return run


def apply(part: Parser, f: Callable) -> Parser:
    def run(text: str, at: int) -> Result:
        r = part(text, at)
        return None if r is None else (f(r[0]), r[1])

    return run


def end(text: str, at: int) -> Result:
    return ("", at) if at == len(text) else None
