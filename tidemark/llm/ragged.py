"""Lists of numbers for words, looked up once per distinct word of a slice."""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def gather(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs ``values[first:first + n]``, one after the other."""
    total = int(n.sum())
    return values[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(total)]


class Words:
    """Remembers the ids of words; forgets all when ``limit`` words are known, so a
    worker's memory is bounded."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.first = array("i"), array("q", [0])

    def find(self, words: list[str]) -> np.ndarray:
        """The place of each word."""
        if len(self.place) + len(words) > self.limit:
            self.clear()
        place = self.place
        new = [w for w in words if w not in place]
        if new:
            for w, ids in zip(new, self.encode(new), strict=True):
                place[w] = len(self.first) - 1
                self.ids.extend(ids)
                self.first.append(len(self.ids))
        return np.fromiter((place[w] for w in words), dtype=np.int64, count=len(words))

    def array(self, texts: list[bytes]) -> pa.Array:
        return pa.array(texts, type=pa.binary()).cast(pa.string())

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, cut into words at spaces, and how many each text has."""
        parts = pc.split_pattern(self.array(texts), " ")
        coded = parts.values.dictionary_encode()
        place = self.find(coded.dictionary.to_pylist())
        first = np.frombuffer(self.first, dtype=np.int64).copy()
        each = place[coded.indices.to_numpy()]
        n = first[each + 1] - first[each]
        ids = gather(np.frombuffer(self.ids, dtype=np.int32) if len(self.ids) else np.zeros(0, dtype=np.int32),
                     first[each], n)
        ends = np.concatenate([[0], np.cumsum(n)])
        offsets = parts.offsets.to_numpy()
        return ids, np.diff(ends[offsets - offsets[0]])
