"""Texts as arrays of code points, so whole batches are classified and cut by array operations."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import regex

#: The characters with Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SIZE = 0x110000
#: Code points that are worked on together, about.
BLOCK = 1 << 20


def codes_of(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


@cache
def _alphabet() -> str:
    return "".join(chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(SIZE))


def members(pattern: str) -> np.ndarray:
    """Table over all code points: whether the one-character pattern matches."""
    table = np.zeros(SIZE, bool)
    for m in regex.finditer(f"(?:{pattern})+", _alphabet()):
        table[m.start() : m.end()] = True
    table[0xD800:0xE000] = False
    return table


def blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together have about BLOCK code points; a longer text is one of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > BLOCK:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
