"""The words of many texts as byte spans in one array, with 64-bit hashes, without an object per word."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

CHUNK = 500_000  # characters handled at once; a longer text makes a chunk of its own

_U64 = np.uint64
_ODD = _U64(0x9E3779B97F4A7C15)
_ODD_INVERSE = _U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit changes about half of the output bits."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE = mix(np.arange(1, 257, dtype=_U64) * _ODD)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _ODD), np.full(size, _ODD_INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def chunks(texts: Sequence[str | None], limit: int = CHUNK) -> Iterator[slice]:
    """Runs of neighbouring texts of at most so many characters, or one longer text."""
    start = total = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > start and total + size > limit:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(texts):
        yield slice(start, len(texts))


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each span of bytes: a polynomial, from running sums, so no span is cut out."""
    size = 1 << max(20, int(len(buffer)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(buffer) + 1, dtype=_U64)
    np.cumsum(_BYTE[buffer] * up[: len(buffer)], out=sums[1:])
    starts = np.minimum(starts, size - 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U64))


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of bytes that end with white space."""
    edges = np.flatnonzero(np.diff(WHITE[buffer].view(np.int8), prepend=np.int8(1)))
    return edges[0::2], edges[1::2]


class Words:
    """Words are runs of bytes other than ASCII white space; a null text has none.

    starts, ends: of each word in ``buffer``; the words of text i are ``first[i]:first[i + 1]``.
    """

    def __init__(self, texts: Sequence[str | None], lower: bool = False):
        encoded = [text.encode("utf-8", "surrogatepass") if text else b"" for text in texts]
        self.buffer = np.frombuffer(b" ".join([*encoded, b""]) or b" ", dtype=np.uint8)
        if lower:
            self.buffer = LOWER[self.buffer]
        self.starts, self.ends = word_spans(self.buffer)
        offsets = np.cumsum([0, *(len(x) + 1 for x in encoded)])
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buffer, self.starts, self.ends)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of so many words, also across texts; callers keep the runs within a text."""
    count = max(0, len(hashes) - width + 1)
    out = np.full(count, _U64(width), dtype=_U64)
    for k in range(width):
        out = mix(out * _ODD + hashes[k : k + count])
    return out
