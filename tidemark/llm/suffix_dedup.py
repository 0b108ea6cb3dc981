"""Removal of repeated byte strings through sparse enhanced suffix arrays.

Every ``length``-byte window has an anchor: the place of the smallest hash among
its ``GRAM``-byte strings, the leftmost on ties.  Equal windows have equal
anchors, so only suffixes that start at anchors are compared, one in about 35:

1. Each anchor row carries its gram's hash and the hash of the bytes that the
   windows of this anchor cover.  Rows are dealt out and sorted by hash and
   scanned once.  Of identical rows all but the earliest are repeats as a whole.
   Where one gram stands in different surroundings, the earliest row of each
   goes on.
2. Those suffixes, sorted by (gram, bytes to the right), form a suffix array.  A
   stack scan over its common prefixes yields the tree of LCP intervals.  In
   each interval the members' left sides are sorted and scanned likewise; an
   interval of these whose members differ to the left is a maximal repeat, and
   all its members are occurrences: all but the earliest are cut.
3. A gram with more than ``large_group`` different surroundings is not brought to
   one task: its windows are grouped by content with a map-side combined ``min``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, id_text, slices, stage
from tidemark.llm.hashing import Rolling, U, mix
from tidemark.llm.spans import checksum, remove_spans

LENGTH = 100
GRAM = 32
LARGE_GROUP = 20_000
#: A text is scanned in pieces of this many windows.
PIECE = 1 << 22

_PLACE = 24  # bits of a place inside a piece, below the hash in one sort key
_FOUND = "repeat boolean, h long, doc_id long, at long, lo int, hi int"
_FOUND_ARROW = pa.schema([("repeat", pa.bool_()), ("h", pa.int64()), ("doc_id", pa.int64()),
                          ("at", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
_ROWS = pa.schema([("h", pa.int64()), ("ctx", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of ``x[i:i+w]`` for every i where it fits."""
    size, out = 1, x
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = w - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """``(text index, anchor, lo, hi, gram hash, context hash)``: the windows of
    the anchor at byte ``a`` cover the bytes ``a - lo`` to ``a + hi``."""
    parts = []
    whole = np.frombuffer(b"".join(texts), dtype=np.uint8)
    base = np.cumsum([0, *map(len, texts)])
    for lo in range(0, len(whole) - length + 1, PIECE):
        data = whole[lo:lo + PIECE + length - 1]
        roll = Rolling(data)
        at = np.arange(len(data) - gram + 1)
        h = roll.windows(at, at + gram)
        key = ((h >> U(_PLACE)) << U(_PLACE)) | at.astype(U)
        place = (_sliding_min(key, length - gram + 1) & U((1 << _PLACE) - 1)).astype(np.int64)
        p = np.arange(len(place))
        text = np.searchsorted(base, p + lo, side="right") - 1
        ok = p + lo + length <= base[text + 1]  # windows that end in their text
        p, place, text = p[ok], place[ok], text[ok]
        if not len(p):
            continue
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
        first = np.flatnonzero(new)
        a, t = place[first], text[first]
        p_lo, p_hi = p[first], p[np.append(first[1:], len(p)) - 1]
        parts.append((t, a + lo - base[t], a - p_lo, p_hi + length - a, h[a],
                      roll.windows(p_lo, p_hi + length)))
    if not parts:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z, z.view(U), z.view(U)
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _anchor_rows(length: int, gram: int):
    def run(batches):
        for rows, texts in slices(batches):
            t, a, lo, hi, h, ctx = anchors(texts, length, gram)
            if not len(t):
                continue
            k = np.array([checksum(x) for x in texts], dtype=np.int64)
            doc = rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[t]
            at = (k[t] << 32) | a
            size = ((lo << 8) | hi).astype(U)
            ctx = ((ctx | U(1 << 63)) & U(~0xFFFF & (1 << 64) - 1)) | size
            # what stands earlier in this slice is a repeat already: mark it with an empty
            # context and deal it out by place, so that a very common string is no hot key
            order = np.lexsort((at, doc, ctx, h))
            again = np.empty(len(t), dtype=bool)
            again[order] = _later(*(c[order] for c in (h, ctx, doc, at)))
            h = np.where(again, mix(at.view(U) ^ doc.view(U)), h)
            ctx = np.where(again, size, ctx)
            yield batch_of(_ROWS, h.view(np.int64), ctx.view(np.int64), doc, at)
    return run


def _later(h, ctx, doc, at) -> np.ndarray:
    """Of sorted rows, those that stand after the first place of their (h, ctx)."""
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])])
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return (doc != doc[first]) | (at != at[first])


def _scan(batches):
    """Rows sorted by ``(h, ctx, doc_id, at)``: repeats, and first rows of differing contexts.

    The last row of a batch waits for the next one, as what follows decides on it.
    """
    held = None  # h, ctx, doc, at of the first row of the last run, and whether its gram had another context
    for batch in batches:
        cols = [batch.column(c).to_numpy() for c in ("h", "ctx", "doc_id", "at")]
        if not len(cols[0]):
            continue
        seen = held is not None and held[4]
        if held is not None:
            cols = [np.concatenate([[x], c]) for x, c in zip(held[:4], cols, strict=True)]
        h, ctx, doc, at = cols
        marked = (ctx.view(U) >> U(63)) == 0
        new_run = np.concatenate([[True], (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])])
        repeat = _later(h, ctx, doc, at) | marked
        # firsts of runs; a gram has several contexts if one of its firsts is followed by another
        f = np.flatnonzero(new_run & ~marked)
        same = np.concatenate([h[f][1:] == h[f][:-1], [False]]) if len(f) else np.zeros(0, dtype=bool)
        several = same | np.concatenate([[seen], same[:-1]]) if len(f) else same
        out = np.flatnonzero(repeat)
        held = None
        if len(f):
            last = f[-1]
            held = (h[last], ctx[last], doc[last], at[last], bool(several[-1]))
            f, several = f[:-1], several[:-1]
        f = f[several]
        yield _found(True, h[out], doc[out], at[out], ctx[out])
        yield _found(False, h[f], doc[f], at[f], ctx[f])
    if held is not None and held[4]:
        yield _found(False, *(np.array([held[i]], dtype=np.int64) for i in (0, 2, 3, 1)))


def _found(repeat: bool, h, doc, at, ctx):
    size = ctx & 0xFFFF
    return batch_of(_FOUND_ARROW, np.full(len(h), repeat), h, doc, at,
                    (size >> 8).astype(np.int32), (size & 0xFF).astype(np.int32))


def _contexts(batches):
    """The bytes to the left (reversed) and right of each wanted anchor."""
    schema = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("left", pa.binary()), ("right", pa.binary())])
    for rows, texts in slices(batches):
        out = [[], [], [], [], []]
        wanted = rows.column("wanted").to_pylist()
        for doc, text, items in zip(rows.column("doc_id").to_pylist(), texts, wanted, strict=True):
            for x in items:
                a = x["at"] & 0xFFFFFFFF
                for c, v in zip(out, (x["h"], doc, x["at"], text[a - x["lo"]:a][::-1],
                                      text[a:a + x["hi"]]), strict=True):
                    c.append(v)
        yield batch_of(schema, *out)


def common_prefixes(rows: list[bytes]) -> list[int]:
    """Length of the common prefix of each row and the one before; 0 for the first."""
    if not rows:
        return []
    size = np.array([len(r) for r in rows])
    m = np.zeros((len(rows), int(size.max(initial=0)) + 1), dtype=np.uint8)
    for i, r in enumerate(rows):
        m[i, :len(r)] = np.frombuffer(r, dtype=np.uint8)
    differ = m[1:] != m[:-1]
    differ[:, -1] = True
    return [0, *np.minimum(differ.argmax(axis=1), np.minimum(size[1:], size[:-1])).tolist()]


def lcp_intervals(lcp: list[int], least: int = 1) -> Iterator[tuple[int, int, int]]:
    """``(depth, first, end)`` of every LCP interval of depth ``least`` or more,
    children before parents: one stack scan."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        begin = i - 1
        while stack and stack[-1][0] > now:
            depth, begin = stack.pop()
            if depth >= least:
                yield depth, begin, i
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, begin))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int
                    ) -> Iterator[tuple[int, int, list[int]]]:
    """``(left, right, members)``: the members of a group sorted by ``rights`` that
    agree on exactly ``left`` bytes before and ``right`` bytes from the anchor on,
    ``left + right >= length``.  ``lefts`` are reversed."""
    for depth, a, z in lcp_intervals(common_prefixes(rights)):
        least = length - depth
        order = sorted(range(a, z), key=lefts.__getitem__)
        agree = common_prefixes([lefts[i] for i in order])
        if min(agree[1:]) >= least:  # the whole interval; its members differ where the least agree
            yield min(agree[1:]), depth, order
        for left, x, y in lcp_intervals(agree, max(1, least)):
            if y - x < len(order):
                yield left, depth, order[x:y]


def _repeats(length: int):
    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])
        for group in _groups(batches):
            group = list({g[1:3]: g for g in group}.values())  # a repeated row is the same place
            out: dict[tuple[int, int, int], int] = {}
            for left, right, members in maximal_repeats([g[3] for g in group], [g[4] for g in group], length):
                first = min(members, key=lambda i: (group[i][1], group[i][2]))
                for i in members:
                    if i != first:
                        key = (group[i][1], group[i][2], right)
                        out[key] = max(out.get(key, 0), left)
            if out:
                yield batch_of(schema, [d for d, _, _ in out], [at - n for (_, at, _), n in out.items()],
                               [r + n for (_, _, r), n in out.items()])
    return run


def _groups(batches) -> Iterator[list[tuple]]:
    """The rows of each gram, from batches sorted by gram."""
    group: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if group and group[0][0] != row[0]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _windows(length: int):
    """Every window of each context, with the hash of its bytes."""
    schema = pa.schema([("w", pa.int64()), ("off", pa.int64()), ("h", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())])

    def run(batches):
        for b in batches:
            h, doc, at = (b.column(c).to_numpy() for c in ("h", "doc_id", "at"))
            both = [x[::-1] + y for x, y in zip(b.column("left").to_pylist(), b.column("right").to_pylist(), strict=True)]
            lefts = np.array([len(x) for x in b.column("left").to_pylist()])
            base = np.cumsum([0, *map(len, both)])
            n = np.maximum(np.diff(base) - length + 1, 0)
            row = np.repeat(np.arange(len(both)), n)
            off = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            p = base[row] + off
            w = Rolling(np.frombuffer(b"".join(both), dtype=np.uint8)).windows(p, p + length)
            yield batch_of(schema, w.view(np.int64), off - lefts[row], h[row], doc[row], at[row])
    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, gram: int = GRAM, large_group: int = LARGE_GROUP) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Earlier is a smaller ``doc_id``, or an earlier start in the same text;
    overlaps count and strings never cross texts.  Returns one row per input row:
    ``doc_id, n_bytes, n_removed, n_spans, kept``.  Null text is empty; texts
    shorter than ``length`` stay; a row without id stays and is not compared;
    rows repeating an id and text are one document and are treated alike, and
    texts that share an id come in the order of their CRC-32.  An empty table
    gives an empty result; other columns are ignored.
    """
    if not gram <= length < 256:
        raise ValueError("gram <= length < 256")
    base = id_text(docs, id_col, text_col)
    named = base.where("doc_id IS NOT NULL")
    rows = (named.mapInArrow(_anchor_rows(length, gram), "h long, ctx long, doc_id long, at long")
            .repartition(F.col("h")).sortWithinPartitions("h", "ctx", "doc_id", "at"))
    found = stage(rows.mapInArrow(_scan, _FOUND), "suffix-found")
    repeats = found.where("repeat").select(
        "doc_id", (F.col("at") - F.col("lo")).alias("at"), (F.col("lo") + F.col("hi")).cast("long").alias("n"))
    front = found.where("NOT repeat")
    wanted = (front.withColumn("k", F.shiftright("at", 32)).groupBy("doc_id", "k")
              .agg(F.collect_list(F.struct("h", "at", "lo", "hi")).alias("wanted")))
    k = F.crc32(F.col("text").cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF))
    contexts = stage(named.withColumn("k", k).join(wanted, ["doc_id", "k"])
                     .select("doc_id", "text", "wanted")
                     .mapInArrow(_contexts, "h long, doc_id long, at long, left binary, right binary"),
                     "suffix-contexts")
    large = stage(contexts.groupBy("h").count().where(F.col("count") > large_group).select("h"), "suffix-large")
    small, parts = contexts, [repeats]
    if not large.isEmpty():
        small = contexts.join(large, "h", "left_anti")
        windows = contexts.join(large, "h", "left_semi").select("h", "doc_id", "at", "left", "right").mapInArrow(
            _windows(length), "w long, off long, h long, doc_id long, at long")
        first = windows.groupBy("h", "off", "w").agg(F.min(F.struct("doc_id", "at")).alias("first"))
        parts.append(windows.join(first, ["h", "off", "w"]).where(F.struct("doc_id", "at") > F.col("first"))
                     .select("doc_id", (F.col("at") + F.col("off")).alias("at"),
                             F.lit(length).cast("long").alias("n")))
    parts.append(small.repartition(F.col("h")).sortWithinPartitions("h", "right")
                 .select("h", "doc_id", "at", "left", "right")
                 .mapInArrow(_repeats(length), "doc_id long, at long, n long"))
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    return remove_spans(base, spans)
