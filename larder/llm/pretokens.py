"""Splitting texts before byte-pair merges, on whole arrays.

Gives the same pieces as ``public_tokenizers.PATTERN``: contractions, runs of
letters, digits or other marks with at most one leading blank, and white space.
Every text is split on its own.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
_ONE = [ord(c) for c in "stmd"]
_TWO = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[[ord(c) for c in m[0]]] = kind
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and the byte at which each begins."""
    if not (data >= 0x80).any():
        return data.astype(np.int32), np.arange(len(data))
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    out = lead.copy()
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for low, high, n, keep in ((0xC0, 0xE0, 1, 0x1F), (0xE0, 0xF0, 2, 0x0F), (0xF0, 0xF8, 3, 0x07)):
        where = np.flatnonzero((lead >= low) & (lead < high))
        if len(where):
            value = lead[where] & keep
            for k in range(1, n + 1):
                value = (value << 6) | (padded[at[where] + k] & 0x3F)
            out[where] = value
    return out, at


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start byte of every piece, in order (a piece ends where the next begins)."""
    if not len(data):
        return np.zeros(0, np.int64)
    points, at = code_points(data)
    n = len(points)
    kind = classes()[points]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[np.searchsorted(at, offsets)] = True
    new = np.ones(n, bool)
    new[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
    run = np.flatnonzero(new)
    last = np.append(run[1:], n) - 1
    starts = new.copy()
    spaces = kind[run] == SPACE
    # white space before something else in the same text: its last character goes on alone
    tail = last[spaces & ~edge[last + 1]]
    starts[tail] = True
    # ... and joins what follows if it is a blank
    blank = tail[points[tail] == 0x20]
    starts[blank + 1] = False
    # contractions: a lone ' that begins a piece, then letters
    quote = run[(points[run] == 0x27) & (last == run)]
    quote = quote[starts[quote] & (quote + 1 < n)]
    quote = quote[~edge[quote + 1]]
    if len(quote):
        ahead = np.concatenate([points, np.zeros(2, points.dtype)])
        inside = np.append(~edge[:n], [False, False])
        a, b = ahead[quote + 1], np.where(inside[quote + 2], ahead[quote + 2], 0)
        one = quote[np.isin(a, _ONE)]
        two = quote[np.logical_or.reduce([(a == x) & (b == y) for x, y in _TWO])]
        for found, size in ((one, 2), (two, 3)):
            starts[found + 1] = False
            after = found[found + size < n] + size
            starts[after] = True
    return at[starts]
