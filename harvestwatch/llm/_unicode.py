"""Character classes by Unicode category, as text for Python's ``re``."""

from __future__ import annotations

import functools
import sys
import unicodedata


@functools.lru_cache(maxsize=None)
def category_class(prefix: str, last: int = sys.maxunicode) -> str:
    """The inside of a character class with all code points up to ``last`` whose
    general category starts with ``prefix`` (``L``: letters, ``N``: numbers)."""
    ranges, start, category = [], None, unicodedata.category
    for c in range(last + 2):
        inside = c <= last and category(chr(c))[0] == prefix
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            ranges.append((start, c - 1))
            start = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" if b > a else f"\\U{a:08x}" for a, b in ranges)


# Code points with the Unicode property White_Space.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"
