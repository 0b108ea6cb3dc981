"""Benchmark decontamination by edit distance over words.

A benchmark item counts as found in a document if some stretch of the document
is within ``percent`` % of the item's words of it in edit distance.

* Every word of a document starts a window.  The CGK walk embeds it: at each
  step the current word is put out and a random bit of that word decides whether
  to move on, so two windows a few edits apart agree in most places and edit
  distance becomes Hamming distance.
* Bit sampling: each table's key is a few sampled places of the walk, within the
  words that an item of the class has.  Items are embedded from every word on,
  so whichever word of a passage a window starts with, it has its partner.
* Walks miss some pairs, of short items up to a quarter.  So an item is also cut
  into one piece more than it may have edits, of which one is left whole: each
  piece's first words are looked up at every word.  With them no item within the
  distance is missed, and the distance is the least there is.
* What shares a key is verified exactly by bit-parallel edit distance.

All of it is one pass over the documents; the items' keys are the only thing
that tasks share, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, filter_texts, id_text, slices
from tidemark.llm.hashing import ALNUM, Rolling, U, mix, seeds, words

PERCENT = 20
#: Items of fewer words are no evidence and are not searched for.
MIN_WORDS = 8
#: Starts next to each other that one exact test covers.
GROUP = 4
WALKS, TABLES, SAMPLED = 2, 4, 6
#: Walk lengths, and the item words each needs: a walk moves on at every second step.
CLASSES = ((8, 6), (16, 11), (32, 21))
#: Words of items that one pass searches for; a larger benchmark is searched in blocks.
BLOCK_WORDS = 1_000_000


@dataclass
class Index:
    """Sorted table keys of the items, where each comes from, and the items."""
    keys: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    seen: np.ndarray
    classes: set[int]
    lengths: set[int]
    ids: list[int]
    words: list[np.ndarray]


def _table_keys(h: np.ndarray, start: np.ndarray, classes: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """``(class, key per start)`` of every table: walks over the words from each start."""
    steps = CLASSES[max(classes)][0]
    sym = np.concatenate([h, np.zeros(steps + 1, dtype=U)])
    for w, seed in enumerate(seeds(WALKS, 11)):
        bits = mix(sym ^ seed)
        rng = np.random.default_rng(1000 + w)
        plan = [(c, [rng.choice(np.arange(0 if c == 0 else n // 4, n), SAMPLED, replace=False) for _ in range(TABLES)])
                for c, (n, _) in enumerate(CLASSES)]
        plan = [p for p in plan if p[0] in classes]
        salt = seeds(CLASSES[-1][0] * TABLES * len(CLASSES), 20 + w).reshape(len(CLASSES), TABLES, -1)
        key = np.zeros((len(CLASSES), TABLES, len(start)), dtype=U)
        at = start.copy()
        for j in range(steps):
            now = bits[at]
            for c, tables in plan:
                for t, places in enumerate(tables):
                    if j in places:
                        key[c, t] += now * salt[c, t, j]
            at += (now >> U(j)).astype(np.int64) & 1
        for c, _ in plan:
            for t in range(TABLES):
                yield c, mix(key[c, t] + U(1 + t + TABLES * (c + len(CLASSES) * w)))


def _piece_keys(rolling: Rolling, start: np.ndarray, length: int) -> np.ndarray:
    """Keys of the runs of ``length`` words from each start."""
    return rolling.windows(start, start + length) + U(length)


def pieces_of(n: int, percent: int) -> tuple[np.ndarray, int]:
    """Where the pieces of an item of ``n`` words start, and the words that each has at least."""
    count = min(n, n * percent // 100 + 1)
    return np.arange(count) * n // count, n // count


def build_index(items: list[tuple[int, str]], percent: int = PERCENT) -> Index:
    """Keys of every stretch of every item that is long enough for its class, and of its pieces."""
    h, first = words([t.encode() for _, t in items], ALNUM)
    size = np.diff(first)
    ids, parts, texts, classes, lengths = [], [], [], set(), set()
    for i, n in enumerate(size):
        if n < MIN_WORDS:
            continue
        own = h[first[i]:first[i + 1]]
        start = np.arange(n)
        for c, key in _table_keys(own, start, set(range(len(CLASSES)))):
            # the short walk tells little: it is for items that no longer one fits
            fits = (start + CLASSES[c][1] <= n) & ((c > 0) | (n < CLASSES[2][1]))
            classes |= {c} if fits.any() else set()
            parts.append((key[fits], np.full(fits.sum(), len(ids)), start[fits]))
        start, length = pieces_of(n, percent)
        lengths.add(length)
        parts.append((_piece_keys(Rolling(own), start, length), np.full(len(start), len(ids)), start))
        ids.append(items[i][0])
        texts.append(own)
    if not parts:
        z = np.zeros(0, dtype=np.int64)
        return Index(z.view(U), z, z, np.zeros(1 << 20, dtype=bool), set(), set(), [], [])
    key, item, offset = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    seen = np.zeros(1 << 20, dtype=bool)
    seen[key >> U(44)] = True
    return Index(key[order], item[order].astype(np.int32), offset[order].astype(np.int32), seen, classes, lengths, ids, texts)


def best_match(item: np.ndarray, region: np.ndarray) -> int:
    """Least edit distance between ``item`` and any stretch of ``region``, a column of the
    table at a time in two bit vectors."""
    n = len(item)
    place: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        place[x] = place.get(x, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, now = full, 0, n
    best = n
    for x in region.tolist():
        eq = place.get(x, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            now += 1
        elif down & top:
            now -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        best = min(best, now)
    return best


def _search(index: Index, percent: int):
    bags = [set(w.tolist()) for w in index.words]

    def search(texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """``(text, item, distance)`` of every item found."""
        h, first = words(texts, ALNUM)
        size = np.diff(first)
        text = np.repeat(np.arange(len(texts)), size)
        start = np.arange(len(h))
        left = first[1:][text] - start

        def keys() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if index.classes:
                for _, key in _table_keys(h, start, index.classes):
                    yield start, key
            rolling = Rolling(h)
            for n in sorted(index.lengths):
                at = start[left >= n]
                yield at, _piece_keys(rolling, at, n)

        # text, item and place of a candidate as one number
        before = max(map(len, index.words), default=0) // GROUP + 1
        span = before + size.max(initial=0) // GROUP + 1
        found = []
        for start_of, key in keys():
            at = np.flatnonzero(index.seen[key >> U(44)])
            lo = np.searchsorted(index.keys, key[at])
            hi = np.searchsorted(index.keys, key[at], side="right")
            at, lo, hi = start_of[at[hi > lo]], lo[hi > lo], hi[hi > lo]
            each = hi - lo
            slot = np.repeat(lo, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            at = np.repeat(at, each)
            # one test covers starts a few words apart
            begin = (at - index.offset[slot] - first[text[at]]) // GROUP
            found.append((text[at] * len(index.ids) + index.item[slot]) * span + begin + before)
        if not found:
            return
        best: dict[tuple[int, int], int] = {}
        pair, place = np.divmod(np.unique(np.concatenate(found)), span)
        for t, i, b in zip(*(x.tolist() for x in (pair // len(index.ids), pair % len(index.ids), place - before)), strict=True):
            item = index.words[i]
            slack = len(item) * percent // 100
            if best.get((t, i)) == 0:
                continue
            lo = max(0, b * GROUP - slack)
            region = h[first[t] + lo:min(first[t + 1], first[t] + b * GROUP + GROUP + len(item) + slack)]
            if sum(map(bags[i].__contains__, region.tolist())) < len(item) - slack:
                continue  # too few of its words are there at all
            distance = best_match(item, region)
            if distance <= slack:
                best[t, i] = min(distance, best.get((t, i), distance))
        for (t, i), distance in best.items():
            yield t, i, distance
    return search


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
           percent: int = PERCENT) -> Iterator[Index]:
    """The items in blocks of about ``BLOCK_WORDS`` words, fetched one partition at a time."""
    rows, size = [], 0
    for r in id_text(benchmark, id_col, text_col).where("doc_id IS NOT NULL").toLocalIterator():
        rows.append((r[0], r[1]))
        size += 1 + len(r[1].split())
        if size >= BLOCK_WORDS:
            yield build_index(rows, percent)
            rows, size = [], 0
    if rows:
        yield build_index(rows, percent)


def _share(docs: DataFrame, benchmark: DataFrame, percent: int) -> list:
    return [docs.sparkSession.sparkContext.broadcast(i) for i in blocks(benchmark, percent=percent) if i.ids]


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no benchmark item is found."""
    shared = _share(docs, benchmark, percent)

    def make():
        searches = [_search(i.value, percent) for i in shared]

        def decide(texts: list[bytes]) -> list[bool]:
            clean = [True] * len(texts)
            for search in searches:
                for t, _, _ in search(texts):
                    clean[t] = False
            return clean
        return decide

    return filter_texts(docs, make, text_col)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_words, item_ids, distances`` for each row of ``docs``.

    ``item_ids`` are the benchmark items found, sorted, each with its least edit
    distance in words.  Words are runs of letters and digits, A-Z lower-cased.
    Null text is empty and holds nothing; items that are null, or shorter than
    ``MIN_WORDS`` words, are not searched for; items without id are ignored, and
    items that share an id count as one.  Every row is on its own, whatever its
    id.  An empty benchmark finds nothing; other columns are ignored.
    """
    base = id_text(docs, id_col, text_col)
    shared = _share(docs, benchmark, percent)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("item_ids", pa.list_(pa.int64())),
                        ("distances", pa.list_(pa.int64()))])
    def run(batches):
        searches = [(i.value.ids, _search(i.value, percent)) for i in shared]
        for rows, texts in slices(batches):
            _, first = words(texts, ALNUM)
            found: list[dict[int, int]] = [{} for _ in texts]
            for ids, search in searches:
                for t, i, distance in search(texts):
                    item = ids[i]
                    found[t][item] = min(distance, found[t].get(item, distance))
            yield batch_of(schema, rows.column("doc_id"), np.diff(first).astype(np.int64),
                           [sorted(f) for f in found], [[f[i] for i in sorted(f)] for f in found])

    return base.mapInArrow(run, "doc_id long, n_words long, item_ids array<long>, distances array<long>")
