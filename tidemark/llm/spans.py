"""Byte spans of documents: naming a document's text, and cutting spans out."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A place in a text: the text's 31-bit checksum, then the byte offset in 32 bits.
SPANS = "doc_id long, at long, n long"
_MASK = 0x7FFFFFFF


def checksum(text: bytes) -> int:
    return zlib.crc32(text) & _MASK


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Cut ``spans`` (``doc_id, at, n``) out of ``docs`` (``doc_id, text``).

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept``.  Spans find their text
    by id and checksum, so rows that repeat an id with another text stay apart.
    """
    per_text = (spans.withColumn("k", F.shiftright("at", 32))
                .groupBy("doc_id", "k").agg(F.collect_list(F.struct(
                    F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), "n")).alias("spans")))
    k = F.crc32(F.col("text").cast("binary")).bitwiseAND(F.lit(_MASK))
    joined = docs.withColumn("k", k).join(per_text, ["doc_id", "k"], "left").select(
        "doc_id", F.col("text").cast("binary").alias("text"),
        F.transform("spans", lambda s: s["at"]).alias("at"),
        F.transform("spans", lambda s: s["n"]).alias("n"))
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def union_of(start: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint runs covered by the spans, in order; touching ones are one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate((start + n)[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    last = np.append(first[1:], len(start)) - 1
    return list(zip(start[first].tolist(), reach[last].tolist(), strict=True))


def _cut(batches):
    for b in batches:
        texts, at, n = b.column("text").to_pylist(), b.column("at"), b.column("n")
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for i, t in enumerate(texts):
            runs = union_of(at[i].values.to_numpy(), n[i].values.to_numpy()) if at[i].is_valid else []
            pieces, done = [], 0
            for a, z in runs:
                pieces.append(t[done:a])
                done = z
            kept = b"".join([*pieces, t[done:]])
            for key, value in (("n_bytes", len(t)), ("n_removed", len(t) - len(kept)),
                               ("n_spans", len(runs)), ("kept", kept)):
                out[key].append(value)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(out[c], type=pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
             pa.array(out["kept"], type=pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
