"""A table's changes as a stream of published epochs.

The source's offset is the newest epoch up to which everything is published: an epoch
that another stream has begun and not finished holds it back, so no change of an epoch
that is published late is passed over.  A batch stands for the epochs in ``(after,
upto]``; its changes are read from storage by Spark, with the epochs pruned.  Once a
compaction has consumed changes that the consumer hasn't seen, the stream fails
with ``ResyncRequired``: the consumer takes the state (``consumer.as_of``) and
begins a new stream after its epoch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.consumer import ResyncRequired, changes_since
from tidemark.sources.log import open_path

NAME = "tidemark_epochs"


class Span(InputPartition):
    """The epochs in ``(after, upto]``."""

    def __init__(self, after: int, upto: int):
        self.after, self.upto = after, upto


class EpochReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root, self.after = options["root"], int(options.get("after", 0))
        self.at = self.after

    def _published(self) -> int:
        from pyarrow import fs as pafs
        system, root = open_path(f"{self.root.rstrip('/')}/_manifest")
        headers = {}
        for f in system.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if m := re.fullmatch(r"header-(\d+)\.json", f.path.rsplit("/", 1)[-1]):
                headers[int(m[1])] = f.path
        if not headers:
            return 0
        with system.open_input_stream(headers[max(headers)]) as s:
            return int(json.loads(s.read()).get("published_epoch") or 0)

    def initialOffset(self) -> dict:
        return {"epoch": self.after}

    def latestOffset(self) -> dict:
        self.at = max(self.at, self._published())
        return {"epoch": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end["epoch"])
        return [Span(start["epoch"], end["epoch"])] if end["epoch"] > start["epoch"] else []

    def read(self, partition: Span) -> Iterator[tuple]:
        yield partition.after, partition.upto


class EpochSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "after bigint, upto bigint"

    def streamReader(self, schema) -> EpochReader:
        return EpochReader(self.options)


def stream_changes(spark: SparkSession, root: str, table: str, handler: Callable[[DataFrame, int], None],
                   checkpoint: str, after: int = 0, net: bool = False, trigger: dict | None = None,
                   failed: list | None = None) -> StreamingQuery:
    """Hand each batch's changes of ``table`` and the batch's number to ``handler``.

    A stream without a checkpoint begins after epoch ``after``.  A batch that is repeated
    after a failure covers the same epochs under the same number.  ``failed`` gets the
    exception of a failed batch.
    """
    spark.dataSource.register(EpochSource)

    def batch(epochs: DataFrame, number: int) -> None:
        try:
            for r in epochs.collect():  # one row
                handler(changes_since(spark, root, table, r["after"], net=net, upto=r["upto"]), number)
        except Exception as e:
            if failed is not None:
                failed.append(e)
            raise
    clock = spark.readStream.format(NAME).option("root", root).option("after", after).load()
    return (clock.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
                 .trigger(**(trigger or {"availableNow": True})).start())


def drain_changes(spark: SparkSession, root: str, table: str, handler: Callable[[DataFrame, int], None],
                  checkpoint: str, after: int = 0, net: bool = False) -> None:
    """Deliver what is published and not delivered yet, and stop.  ``ResyncRequired`` if
    a compaction has passed the consumer."""
    failed: list[Exception] = []
    try:
        stream_changes(spark, root, table, handler, checkpoint, after, net, failed=failed).awaitTermination()
    except StreamingQueryException:
        for e in failed:
            if isinstance(e, ResyncRequired):
                raise e from None
        raise
