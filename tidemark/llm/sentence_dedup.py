"""Removal of repeated sentence spans.

Runs of several consecutive sentences are hashed: from each sentence on, and up
to each sentence, the shortest run of at least ``min_sentences`` sentences and
``min_words`` words.  They cover every longer run that repeats with the same
sentences: a sentence too near its end to start a run lies in the one that ends
there.  The runs are joined globally on their hash, and the sentences covered
by a run that also begins earlier go.  The first document of each run is a
map-side combined ``min``; only runs that do repeat are joined back, in a join
whose hot keys Spark can split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, id_text, slices
from tidemark.llm.hashing import WORDS, Rolling, U, mix
from tidemark.llm.spans import checksum, remove_spans

MIN_SENTENCES = 2
MIN_WORDS = 10

_RUNS = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                   ("n", pa.int64()), ("again", pa.bool_())])
_END_MARK = np.isin(np.arange(256), list(b".!?"))


def sentence_runs(texts: list[bytes], min_sentences: int, min_words: int):
    """``(text index, start byte, bytes, hash)`` of every run of every text, each once.

    A sentence is a run of words that ends with a word ending in ``.``, ``!`` or
    ``?`` or with the line.  Its bytes reach up to the next sentence's first word.
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    data = np.frombuffer(raw.tobytes().translate(WORDS), dtype=np.uint8)
    space = data == 0x20
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    start, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    if not len(start):
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=U),)
    lines = np.cumsum(raw == 0x0A)
    breaks = _END_MARK[raw[end[:-1] - 1]] | (lines[start[1:]] > lines[end[:-1] - 1])
    first = np.concatenate([[0], np.flatnonzero(breaks) + 1])  # first word of each sentence
    offset = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
    text = np.searchsorted(offset, start[first], side="right") - 1
    last = np.searchsorted(text, text, side="right")  # one past the text's last sentence
    words_to = np.append(first, len(start))
    # the run from sentence i ends before sentence j: enough sentences, enough words
    i = np.arange(len(first))
    j = np.maximum(i + min_sentences, np.searchsorted(words_to, words_to[i] + min_words))
    ok = j <= last
    # the same from the end
    z = i + 1
    a = np.minimum(z - min_sentences, np.searchsorted(words_to, words_to[z] - min_words, side="right") - 1)
    own = a >= np.searchsorted(text, text)
    # a run may be the shortest both ways
    own[own] = ~ok[a[own]] | (j[a[own]] != z[own])
    i, j = np.concatenate([i[ok], a[own]]), np.concatenate([j[ok], z[own]])
    word = Rolling(data).windows(start, end)
    h = Rolling(word).windows(words_to[i], words_to[j])
    z = np.minimum(np.append(start[first], len(raw))[j], offset[text[i] + 1] - 1)
    a = start[first][i]
    return text[i], a - offset[text[i]], z - a, h


def _runs(min_sentences: int, min_words: int):
    def run(batches):
        for rows, texts in slices(batches):
            t, at, n, h = sentence_runs(texts, min_sentences, min_words)
            # a run that stands earlier in the same text needs no join
            order = np.lexsort((at, h, t))
            new = np.ones(len(t), dtype=bool)
            new[1:] = (h[order][1:] != h[order][:-1]) | (t[order][1:] != t[order][:-1])
            again = np.empty(len(t), dtype=bool)
            again[order] = ~new
            k = np.array([checksum(x) for x in texts], dtype=np.int64)
            doc = rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            # runs known to repeat are dealt out by place, not by hash: a hot run is no hot key
            place = mix(((k[t] << 32) | at).view(U) if len(t) else h)
            h = np.where(again, place, h)
            yield batch_of(_RUNS, h.view(np.int64), doc[t], (k[t] << 32) | at, n, again)
    return run


def sentence_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """Remove sentences covered by a run that is not the first of its kind.

    Runs are compared by their words with A-Z lower-cased; "first" is the
    smallest ``doc_id``, then the earliest place in the text.  Returns one row
    per input row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining
    UTF-8 bytes).  Null text is empty; a text of fewer sentences or words than a
    run has stays; a row without id stays and is not compared; texts that share
    an id are not compared with each other.  An empty table gives an empty
    result; other columns are ignored.
    """
    base = id_text(docs, id_col, text_col)
    runs = base.where("doc_id IS NOT NULL").mapInArrow(
        _runs(min_sentences, min_words), "h long, doc_id long, at long, n long, again boolean")
    first = (runs.where("NOT again").groupBy("h").agg(F.min("doc_id").alias("first"),
                                                      F.max("doc_id").alias("last"))
             .where("first < last").select("h", "first"))
    repeated = (runs.join(first, "h", "left")
                .where("again OR doc_id > first").select("doc_id", "at", "n"))
    return remove_spans(base, repeated)
