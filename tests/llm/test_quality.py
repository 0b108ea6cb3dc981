import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, SF, documents, frame
from tidemark.llm import quality, queries

MID = "/root/testdata/sf0.01"


def brute_statistics(text):
    b = text.encode()
    white = b" \t\n\x0b\x0c\r"
    table = bytes(32 if c in white else c + 32 if 65 <= c <= 90 else c for c in range(256))
    raw = bytes(32 if c in white else c for c in b).split()
    words = b.translate(table).split()
    lines = (b + b"\n").split(b"\n")[:-1]
    inside = sum(c not in white for c in b)

    def angle(part, whole):
        return np.arcsin(np.sqrt(part / max(whole, 1)))

    def among(chars):
        return angle(sum(c in chars for c in b), inside)
    plain = set(white + bytes(range(97, 123)) + bytes(range(65, 91)) + b"0123456789.!?,;:'\"()-" + bytes(range(128, 256)))
    n, top = len(words), max(Counter(words).values(), default=1)
    return [among(bytes(range(65, 91))), among(b"0123456789"), among(bytes(range(128, 256))), among(b".!?"), among(b",;:'\"()-"),
            among(bytes(set(range(128)) - plain)), angle(sum(len(w) >= 12 for w in raw), n),
            angle(sum(65 <= w[0] <= 90 for w in raw), n), angle(n - len(set(words)), n),
            angle(len(lines) - len(set(lines)), len(lines)), angle(top - 1 if n else 0, n),
            np.log((inside + 1) / (n + 1)), np.log1p(n / len(lines))]


def test_statistics_by_brute_force():
    texts = [t or "" for _, t in AWKWARD] + [t or "" for _, t in documents()[:120]] + ["a | b\na | b\r\n", "X" * 13, "\n\n"]
    got = quality.statistics([t.encode() for t in texts])
    assert got.shape == (len(texts), len(quality.STATISTICS))
    np.testing.assert_allclose(got, [brute_statistics(t) for t in texts], atol=1e-9)


def plain_scores(rows, labels):
    """The discriminant by numpy's own covariance, inverse and determinant."""
    x = np.array([brute_statistics(t or "") for _, t in rows])
    y = np.array([labels.get(i, -1) if zlib.crc32(str(i).encode()) % 4 != 2 else -1 for i, _ in rows])
    train, d = x[y >= 0], x.shape[1]
    center, scale = train.mean(axis=0), train.std(axis=0)
    scale[scale < 1e-9 ** 0.5] = 1
    z = (x - center) / scale
    covs = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    n = [int((y == k).sum()) for k in (0, 1)]
    pooled = sum(c * k for c, k in zip(covs, n, strict=True)) / sum(n)
    logs = []
    for k in (0, 1):
        a = n[k] / (n[k] + quality.SHRINK_DOCS * d)
        c = a * covs[k] + (1 - a) * pooled
        c = (1 - quality.RIDGE) * c + quality.RIDGE * np.trace(c) / d * np.eye(d)
        apart = z - z[y == k].mean(axis=0)
        logs.append(np.log(n[k]) - 0.5 * (np.einsum("ij,jk,ik->i", apart, np.linalg.inv(c), apart) + np.linalg.slogdet(c)[1]))
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def test_op13_by_another_way(spark):
    rows = documents()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    want = dict(zip([i for i, _ in rows], plain_scores(rows, labels), strict=True))
    got = queries.op13_quality(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-6)
        assert r["predicted"] == (r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_op13_on_held_out_labels(spark):
    out = queries.op13_quality(spark, MID).where("held_out").join(
        spark.read.parquet(f"{MID}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    assert len(out) > 80
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.97 * len(out)
    good, bad = ([r["score"] for r in out if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    np.testing.assert_allclose(a.factors, b.factors)
    np.testing.assert_allclose(a.means, b.means)


def test_awkward_texts_and_labels(spark):
    docs = frame(spark, AWKWARD)
    some = [(5, 1), (5, 1), (6, 0), (7, 1), (8, 0), (9, 1), (11, 0), (None, 1), (10, None), (77, 1), (12, 7)]
    labels = spark.createDataFrame(some, "doc_id long, quality int").withColumn("text", F.lit("x")).withColumn("label", F.lit(3))
    out = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2, 12, 13)}) == 1
    assert len({r["score"] for r in out if r["doc_id"] == 5}) == 1
    for rows, want in (([], 0.5), ([(i, 1) for i in range(14)], 1.0), ([(i, 0) for i in range(14)], 0.0)):
        model = quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert {r["score"] for r in quality.score(docs, model).collect()} == {want}
    empty = frame(spark, [])
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0


def test_the_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    some = quality.fit(docs, labels, train_docs=100)
    assert 50 < some.prior.sum() < 160
