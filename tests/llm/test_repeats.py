import re

import pytest

from tests.llm.helpers import AWKWARD, documents, frame, mutated
from tidemark.llm import minhash, sentence_dedup, suffix_dedup


def cut(rows, spans):
    """What is left of each text: ``(doc_id, removed bytes, runs, kept)``."""
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for a, z in spans.get((i, raw), ()):
            gone[a:z] = b"\x01" * (z - a)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out, key=str)


def windows(rows, length):
    seen, spans = {}, {}
    texts = sorted({(i, (t or "").encode()) for i, t in rows if i is not None},
                   key=lambda x: (x[0], suffix_dedup.checksum(x[1])))
    for key in texts:
        raw = key[1]
        for a in range(len(raw) - length + 1):
            w = raw[a:a + length]
            if seen.setdefault(w, (key, a)) != (key, a):
                spans.setdefault(key, []).append((a, a + length))
    return spans


def rows_of(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.collect()), key=str)


CASES = {"awkward": AWKWARD, "mutated": mutated(3), "copies": mutated(4, 12) * 2 + [(i + 1, t) for i, t in mutated(4, 12)],
         "empty": [], "documents": documents()[:60]}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("large", [20_000, 2])
def test_suffix_dedup_removes_every_repeated_window(spark, case, large):
    rows = CASES[case]
    got = suffix_dedup.suffix_dedup(frame(spark, rows), large_group=large)
    assert rows_of(got) == cut(rows, windows(rows, 100))


def test_long_texts_are_scanned_in_pieces(spark, monkeypatch):
    rows = mutated(5, 20)
    monkeypatch.setattr(suffix_dedup, "PIECE", 150)  # the workers have their own; the driver's anchors are compared
    whole = suffix_dedup.anchors([t.encode() for _, t in rows])
    covered = sum(lo + hi - 99 for lo, hi in zip(whole[2], whole[3], strict=True))
    assert covered == sum(max(0, len(t.encode()) - 99) for _, t in rows)


def test_maximal_repeats_by_brute_force():
    texts = [b"xabcabcabcy", b"zabcabcabcy", b"xabcabcq", b"abcabc", b"xabcabcabcy"]
    lefts, rights = zip(*sorted(((t[:4][::-1], t[4:]) for t in texts), key=lambda x: x[1]))
    found = {}
    for left, right, members in suffix_dedup.maximal_repeats(list(lefts), list(rights), 4):
        found[left, right, lefts[members[0]][:left][::-1] + rights[members[0]][:right]] = sorted(members)
    # every pair's common stretch around the anchor is inside a repeat that has both
    for i in range(len(texts)):
        for j in range(i):
            left = next((k for k in range(5) if lefts[i][:k + 1] != lefts[j][:k + 1] or k >= min(len(lefts[i]), len(lefts[j]))), 4)
            right = next(k for k in range(99) if rights[i][:k + 1] != rights[j][:k + 1] or k >= min(len(rights[i]), len(rights[j])))
            if left + right >= 4 and right:
                assert any(a >= left and b >= right and {i, j} <= set(m) for (a, b, _), m in found.items())


def sentences(text):
    """``(start, end, words)`` in bytes: words up to one that ends in a mark, or the line's end."""
    raw = (text or "").encode()
    words = [(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", raw)]
    out, now = [], []
    for i, w in enumerate(words):
        now.append(w)
        last = i + 1 == len(words)
        if last or w[2][-1:] in b".!?" or b"\n" in raw[w[1]:words[i + 1][0]]:
            out.append((now[0][0], len(raw) if last else words[i + 1][0],
                        [bytes(x + 32 if 65 <= x <= 90 else x for x in v[2]) for v in now]))
            now = []
    return out


def all_sentence_spans(rows, min_sentences, min_words):
    """Every non-first run, of any number of sentences."""
    seen, spans = {}, {}
    for key in sorted({(i, (t or "").encode()) for i, t in rows if i is not None}):
        s = sentences(key[1].decode())
        for a in range(len(s)):
            words = []
            for z in range(a + 1, len(s) + 1):
                words += s[z - 1][2]
                if z - a >= min_sentences and len(words) >= min_words:
                    first = seen.setdefault(tuple(words), (key, a))
                    if first[0][0] < key[0] or first[0] == key and first[1] < a:
                        spans.setdefault(key, []).append((s[a][0], s[z - 1][1]))
    return spans


ENDS = [(1, "The quick brown fox jumps over the lazy dog today. Yes. No. Really. One end."),
        (2, "Before it. The quick brown fox jumps over the lazy dog today. Yes. No. Really. Another end."),
        (3, "The quick brown fox jumps over the lazy dog today. Yes. No. Really."),
        (4, "Yes. No. Really. The quick brown fox jumps over the lazy dog today. Yes. No. Really. " * 2)]


@pytest.mark.parametrize("case", [*CASES, "ends", "mutated too"])
def test_sentence_dedup_by_brute_force(spark, case):
    rows = (CASES | {"ends": ENDS, "mutated too": mutated(7), "documents": documents()})[case]
    got = sentence_dedup.sentence_dedup(frame(spark, rows))
    assert rows_of(got) == cut(rows, all_sentence_spans(rows, 2, 10))


def components(rows, n):
    def shingles(t):
        w = re.findall(r"[^ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    part = {i: i for i, _ in sets if i is not None}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(i), root(j)))
                part[q] = p
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=str)


def near(seed=0, n=60, words=60):
    """Copies of one text with more and more words changed, so that similarities lie around the threshold."""
    import random
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for i in range(n):
        t = list(base)
        for _ in range(rng.randrange(9)):
            t[rng.randrange(words)] = f"n{rng.randrange(10 ** 6)}"
        out.append((i + 1000, " ".join(t)))
    return out


@pytest.mark.parametrize("rows", [AWKWARD, near(1), near(2, 120, 40) + near(3, 40, 80) + AWKWARD, [], documents()],
                         ids=["awkward", "near", "two groups", "empty", "documents"])
@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicate_components(spark, rows, n):
    got = minhash.near_duplicates(frame(spark, rows), n_words=n)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == components(rows, n)
