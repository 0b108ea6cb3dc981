"""Helpers shared by the operators: staging in the shared folder and
walking Arrow batches in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_dir

#: Bytes of text that one vectorised step works on; its arrays are a few dozen times this.
SLICE_BYTES = 1 << 19


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(col: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` whatever else the input carries; null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_of(text_col).alias("text"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back: later
    steps neither recompute it nor depend on the executors that made it."""
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows of each batch in runs of about ``size`` bytes of text (a longer
    text makes a run of its own), with the texts as UTF-8, null as empty."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(text).cast(pa.binary()).to_pylist()]
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, to - at), texts[at:to]
            at = to


def filter_texts(docs: DataFrame, make_decide, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is accepted: each task calls
    ``make_decide()`` and applies the result to lists of texts."""
    def run(batches):
        decide = make_decide()
        for rows, texts in slices(batches, text_col):
            yield rows.filter(pa.array(decide(texts), type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)
