"""Language identification by rank-order profiles.

A profile lists a language's most frequent n-grams of letters (one to three,
words padded with one space) by rank.  A document is compared with each profile
by the out-of-place distance: for each of its own most frequent n-grams, how
far its rank is from the profile's, or the profile's length if it is not there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, filter_texts, slices, text_of

#: N-grams in a profile, of a language or a document.
TOP = 300
#: Labelled documents that profiles are fitted on, about; chosen by a hash of the id.
TRAIN_DOCS = 50_000
UNKNOWN = "und"

_SHIFT = 21  # bits of a code point
_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text index, n-gram, count)`` of each text's distinct n-grams, sorted by
    text, then falling count, then n-gram.  An n-gram is up to three code points
    packed in one number, a space standing for a word's edge."""
    points = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    used = np.flatnonzero(np.bincount(points))
    lower = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in used.tolist()], dtype=np.int64)
    letters = np.unique(lower[lower > 0])
    n = len(letters) + 1
    if n ** 3 * 3 * len(texts) >= 1 << 62 and len(texts) > 1:  # keys would not fit 64 bits
        half = len(texts) // 2
        a, b = grams(texts[:half]), grams(texts[half:])
        return tuple(np.concatenate([x, y + half * (i == 0)]) for i, (x, y) in enumerate(zip(a, b, strict=True)))
    number = np.zeros(int(used[-1]) + 1, dtype=np.int64)
    number[used] = np.where(lower > 0, np.searchsorted(letters, lower) + 1, 0)
    s = number[points]
    keep = s > 0
    keep[1:] |= s[:-1] > 0  # of a gap, the first place stays: one space between words
    keep[0] = True
    text = np.repeat(np.arange(len(texts) + 1) - 1, [1, *(len(t) + 1 for t in texts)])[keep]
    s = s[keep]
    letter = s > 0
    # an n-gram belongs to the text of its letters; no word spans two texts
    two = letter[1:] | letter[:-1]
    three = letter[1:-1]
    t2 = np.where(letter[1:], text[1:], text[:-1])
    cube = n ** 3
    found = np.sort(np.concatenate([
        (text[letter] * cube + s[letter]) * 3,
        (t2[two] * cube + (s[:-1] * n + s[1:])[two]) * 3 + 1,
        (text[1:-1][three] * cube + ((s[:-2] * n + s[1:-1]) * n + s[2:])[three]) * 3 + 2]))
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(first, len(found)))
    found = found[first]
    size, code, text = found % 3, found // 3 % cube, found // 3 // cube
    point = np.concatenate([[0x20], letters])
    gram = point[code % n]
    gram = np.where(size > 0, point[code // n % n] << _SHIFT | gram, gram)
    gram = np.where(size > 1, point[code // (n * n)] << 2 * _SHIFT | gram, gram)
    order = np.lexsort((gram, -count, text))
    return text[order], gram[order], count[order]


def _strings(texts: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace") for t in texts]


def _count(batches):
    """N-gram counts of each language, summed up over what a task has read."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for rows, texts in slices(batches):
        langs = np.array(rows.column("lang").to_pylist(), dtype=object)
        t, gram, n = grams(_strings(texts))
        for lang in dict.fromkeys(langs.tolist()):
            here = (langs == lang)[t]
            old = sums.get(lang, (np.zeros(0, dtype=np.int64),) * 2)
            g, place = np.unique(np.concatenate([old[0], gram[here]]), return_inverse=True)
            sums[lang] = (g, np.bincount(place, np.concatenate([old[1], n[here]]), len(g)).astype(np.int64))
        if sum(len(g) for g, _ in sums.values()) > 1_000_000:
            yield from _flush(sums)
            sums = {}
    yield from _flush(sums)


def _flush(sums):
    for lang, (g, n) in sums.items():
        yield batch_of(_COUNTS, [lang] * len(g), g, n)


def held_out(id_col: str = "doc_id") -> Column:
    """Every fourth document, by the CRC-32 of its id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             train_docs: int = TRAIN_DOCS, top: int = TOP) -> dict[str, list[int]]:
    """Each language's ``top`` n-grams by rank, from about ``train_docs`` labelled
    documents that are not held out: a few hundred numbers per language, so they
    come to the driver."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    share = min(1.0, train_docs / max(1, labelled.count()))
    chosen = labelled.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else labelled
    counts = (chosen.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
              .mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    out: dict[str, list[int]] = {}
    for row in counts.withColumn("r", rank).where(F.col("r") <= top).orderBy("lang", "r").collect():
        out.setdefault(row["lang"], []).append(row["gram"])
    return out


def _predict(model: dict[str, list[int]], top: int):
    langs = sorted(model)
    known = np.unique(np.array([g for x in langs for g in model[x]], dtype=np.int64))
    rank = np.full((len(known) + 1, len(langs)), -1, dtype=np.int64)
    for i, x in enumerate(langs):
        rank[np.searchsorted(known, model[x]), i] = np.arange(len(model[x]))

    def predict(texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        t, gram, _ = grams(_strings(texts))
        begin = np.searchsorted(t, np.arange(len(texts)))
        place = np.arange(len(t)) - begin[t]
        t, gram, place = t[place < top], gram[place < top], place[place < top]
        at = np.searchsorted(known, gram)
        at = np.where(known[np.minimum(at, len(known) - 1)] == gram, at, len(known)) if len(known) else at
        r = rank[at]
        apart = np.where(r < 0, top, np.minimum(np.abs(r - place[:, None]), top))
        total = np.stack([np.bincount(t, apart[:, i], len(texts)) for i in range(len(langs))], axis=1)
        n = np.bincount(t, minlength=len(texts))
        best = total.argmin(axis=1)
        score = np.where(n > 0, 1 - total[np.arange(len(texts)), best] / np.maximum(1, n * top), 0.0)
        return [langs[b] if k else UNKNOWN for b, k in zip(best, n, strict=True)], score

    def nothing(texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))

    return predict if langs else nothing


def identify(docs: DataFrame, model: dict[str, list[int]], id_col: str = "doc_id",
             text_col: str = "text", top: int = TOP) -> DataFrame:
    """The language of each whole text: ``doc_id, lang_pred, score`` for each row.

    ``score`` is 1 less the share of the largest possible distance, so 1 is a
    text whose ranks are the profile's own.  Ties go to the first language by
    name.  A text that is null or has no letter, and any text under an empty
    model, is ``und`` with score 0.  Ids may be null or repeat: every row has its
    own result.  Other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        predict = _predict(model, top)
        for rows, texts in slices(batches):
            lang, score = predict(texts)
            yield batch_of(schema, rows.column("doc_id"), lang, score)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict[str, list[int]], least: float,
                    text_col: str = "text", top: int = TOP) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a score of ``least`` or more."""
    def make():
        predict = _predict(model, top)

        def decide(texts: list[bytes]) -> list[bool]:
            return [x != UNKNOWN and s >= least for x, s in zip(*predict(texts), strict=True)]
        return decide

    return filter_texts(docs, make, text_col)
