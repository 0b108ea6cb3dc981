"""Quality of texts by a regularised quadratic discriminant.

Each class has a mean and a covariance of document statistics.  A covariance is
shrunk twice: towards the covariance of all classes, by the class's size, and
towards a multiple of the identity.  A text's score compares the two normal
log-densities, with Mahalanobis distances from Cholesky factors made once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, id_text, slices
from tidemark.llm.hashing import Rolling, words
from tidemark.llm.language import held_out

#: Labelled documents that the classes are fitted on, about; chosen by a hash of the id.
TRAIN_DOCS = 50_000
#: A class of this many documents for each statistic takes half of its covariance from all classes'.
SHRINK_DOCS = 5.0
#: Share of the identity in a covariance of standardised statistics.
RIDGE = 0.02
#: Score from which a text is predicted to be of label 1.
THRESHOLD = 0.7

#: Bytes of a long word.
LONG_WORD = 12
#: What a byte is: 1 white space, 2 lower-case, 3 upper-case, 4 digit, 5 part of a
#: longer code point, 6 sentence mark, 7 other punctuation within prose, 8 anything else.
_KIND = np.full(256, 8, dtype=np.uint8)
for _kind, _bytes in ((1, b" \t\n\x0b\x0c\r"), (2, bytes(range(97, 123))), (3, bytes(range(65, 91))),
                      (4, b"0123456789"), (5, bytes(range(128, 256))), (6, b".!?"), (7, b",;:'\"()-")):
    _KIND[list(_bytes)] = _kind

#: Shares of a text's bytes in words, its words or its lines, and two logarithms.
STATISTICS = ("upper", "digits", "beyond_ascii", "ends", "marks", "symbols", "long_words", "capitals",
              "repeated_words", "repeated_lines", "top_word", "word_length", "line_length")


def _repeats(hashes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` texts: its distinct hashes, and how often the commonest occurs."""
    order = np.lexsort((hashes, of))
    h, t = hashes[order], of[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])) if len(h) else np.zeros(0, dtype=np.int64)
    top = np.zeros(n)
    np.maximum.at(top, t[first], np.diff(np.append(first, len(h))))
    return np.bincount(t[first], minlength=n), top


def statistics(texts: list[bytes]) -> np.ndarray:
    """The transformed statistics of each text: angles of shares, and logarithms of lengths.
    None says how long a text is, so a short one isn't bad for that."""
    n = len(texts)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    first = np.concatenate([[0], np.cumsum(size + 1)])
    kind = _KIND[data]
    text = np.repeat(np.arange(n), size + 1)
    of_kind = np.bincount(text * 9 + kind, minlength=9 * n).reshape(n, 9)
    line_end = np.flatnonzero(data == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1]) if len(line_end) else line_end
    line_text = text[line_end]
    lines = np.bincount(line_text, minlength=n)
    distinct_lines, _ = _repeats(Rolling(data).windows(line_start, line_end), line_text, n)
    word, begin = words(texts)
    each = np.diff(begin)
    word_text = np.repeat(np.arange(n), each)
    distinct_words, top = _repeats(word, word_text, n)
    space = kind == 1
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    long = np.bincount(text[start], weights=end - start >= LONG_WORD, minlength=n)
    capital = np.bincount(text[start], weights=kind[start] == 3, minlength=n)
    inside = size + 1 - of_kind[:, 1]  # bytes of words, as the added line end is white space

    def angle(part, whole):
        """A share with its variance made even; none of nothing."""
        return np.arcsin(np.sqrt(part / np.maximum(whole, 1)))

    return np.stack([
        *(angle(of_kind[:, k], inside) for k in (3, 4, 5, 6, 7, 8)), angle(long, each), angle(capital, each),
        angle(each - distinct_words, each), angle(lines - distinct_lines, lines), angle(top - (each > 0), each),
        np.log((inside + 1) / (each + 1)), np.log1p(each / lines)], axis=1)


@dataclass
class Model:
    """Two classes over standardised statistics; ``factors`` are inverse Cholesky factors."""

    prior: np.ndarray      # documents of class 0 and 1
    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.prior.all():  # one class, or none
            return np.full(len(x), 0.5 if not self.prior.any() else float(self.prior[1] > 0))
        z = (x - self.center) / self.scale
        log = [-0.5 * (np.square((z - m) @ f.T).sum(axis=1) + d) + np.log(p)
               for m, f, d, p in zip(self.means, self.factors, self.log_dets, self.prior, strict=True)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def discriminant(n: np.ndarray, total: np.ndarray, square: np.ndarray,
                 shrink_docs: float = SHRINK_DOCS, ridge: float = RIDGE) -> Model:
    """The model from each class's documents ``n``, sums and sums of products."""
    d = total.shape[1]
    k = np.maximum(n, 1)
    mean = total / k[:, None]
    cov = square / k[:, None, None] - mean[:, :, None] * mean[:, None, :]
    all_n = max(n.sum(), 1)
    pooled = (cov * n[:, None, None]).sum(axis=0) / all_n
    center = total.sum(axis=0) / all_n
    spread = np.diag(square.sum(axis=0) / all_n) - center ** 2
    scale = np.sqrt(np.where(spread > 1e-9, spread, 1.0))  # a statistic that never varies says nothing
    cov, pooled = cov / np.outer(scale, scale), pooled / np.outer(scale, scale)
    own = n / (n + shrink_docs * d)
    factors, dets = [], []
    for c, a in zip(cov, own, strict=True):
        c = a * c + (1 - a) * pooled
        c = (1 - ridge) * c + ridge * max(np.trace(c) / d, 1e-3) * np.eye(d)
        low = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(low))
        dets.append(2 * np.log(np.diag(low)).sum())
    return Model(n.astype(float), center, scale, (mean - center) / scale, np.array(factors), np.array(dets))


def _moments(batches):
    """Documents, sums and sums of products of each class, one row of numbers a class and task."""
    d = len(STATISTICS)
    sums = np.zeros((2, 1 + d + d * d))
    for rows, texts in slices(batches):
        x = statistics(texts)
        label = np.array(rows.column("label").to_pylist())
        for k in (0, 1):
            own = x[label == k]
            sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    schema = pa.schema([("label", pa.int32()), ("sums", pa.list_(pa.float64()))])
    yield batch_of(schema, [0, 1], sums.tolist())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on about ``train_docs`` rows of ``labels`` (ids and 0 or 1) that are not held out.

    The sample of the labels is bounded, so it is broadcast to the texts, and no text moves.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    share = min(1.0, train_docs / max(1, known.count()))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    d = len(STATISTICS)
    sums = np.zeros((2, 1 + d + d * d))
    found = (id_text(docs, id_col, text_col).join(F.broadcast(known), "doc_id").select("label", "text")
             .mapInArrow(_moments, "label int, sums array<double>")
             .select("label", F.posexplode("sums").alias("at", "x")).groupBy("label", "at").agg(F.sum("x").alias("x")))
    for row in found.collect():
        sums[row["label"], row["at"]] = row["x"]
    return discriminant(sums[:, 0], sums[:, 1:1 + d], sums[:, 1 + d:].reshape(2, d, d))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for each row of ``docs``: how likely the text has
    label 1 (0 to 1), and 1 if that is ``threshold`` or more, else 0.

    A null or empty text, like any other, has the statistics of its zero counts.
    Without labels for fitting every score is 0.5; with one class only it is that
    class.  Equal texts have equal scores; ids may be null or repeat, and
    every row has its own result.  A text is taken whole, however long.  An empty
    table gives an empty result; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for rows, texts in slices(batches):
            p = model.score(statistics(texts))
            yield batch_of(schema, rows.column("doc_id"), p, (p >= threshold).astype(np.int32))

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")
