"""64-bit hashes of words and byte windows, for whole slices of texts at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Multiplier of the polynomial (odd, so it has an inverse modulo 2**64).
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)

_SPACES = b" \t\n\x0b\x0c\r"
#: Lower-cases A-Z and makes each of the six white-space bytes a space.
WORDS = bytes(0x20 if c in _SPACES else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The same, with every other ASCII character that is no letter or digit a space too.
ALNUM = bytes(c if c >= 128 or chr(c).isalnum() else 0x20 for c in WORDS)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeds(n: int, name: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1 + name * 1_000_003, 1 + n + name * 1_000_003, dtype=U) * U(BASE)) | U(1)


#: Powers by their base, as far as they were needed; those for very long texts are not kept.
_KNOWN: dict[int, np.ndarray] = {}
_KEEP = 1 << 20


def powers(n: int, base: int = BASE) -> np.ndarray:
    known = _KNOWN.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, min(_KEEP, 2 * n)), base, dtype=U)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if len(known) <= _KEEP:
            _KNOWN[base] = known
    return known[:n]


class Rolling:
    """Hash of any byte window of ``data`` in constant time: prefix sums of the
    polynomial, shifted back by the inverse power."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * powers(n + 1)[:n], out=self.prefix[1:])
        self.back = powers(n + 1, _INVERSE)

    def windows(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.back[start])


def words(texts: list[bytes], table: bytes = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text, and where each text's words begin
    (one more entry than texts)."""
    data = np.frombuffer((b" ".join(texts) + b" ").translate(table), dtype=np.uint8)
    space = data == 0x20
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(space & ~before)
    firsts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=firsts[1:])
    return Rolling(data).windows(start, end), np.searchsorted(start, firsts)
