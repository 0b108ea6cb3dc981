"""A change log addressed by position, as a streaming source.

The log is a folder of Parquet segments of events in order of their place
(``seq``).  An offset is a place: a batch holds the events in ``(start, end]``.  A batch
ends at the row cap or, once its first event has waited for the interval, at the
newest event, whichever comes first; so a flush is never larger than asked for (but
for events that share the last place) and never later.  A stream starts after a given
place, and a restart goes on in the middle of a segment.

Each row group that a batch's places overlap is one partition, read by an executor.
The planning side reads footers, and the places of the row groups at a
batch's end.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.operators.events import EVENT_SCHEMA
from tidemark.sources import fs

NAME = "tidemark_log"
#: Rows of a batch, and seconds that an event waits for one, where none are given.
ROWS, INTERVAL = 1000, 10.0
PLACE = "seq"

_MAP = pa.map_(pa.string(), pa.string())
_ARROW = pa.schema([("table", pa.string()), ("op", pa.string()), ("row", _MAP), ("lsn", pa.string()),
                    ("ts", pa.timestamp("us")), (PLACE, pa.int64()), ("old_row", _MAP),
                    ("unchanged", pa.list_(pa.string()))])


@dataclass
class Group(InputPartition):
    """A row group of a segment, and the places wanted of it."""

    path: str
    number: int
    first: int
    last: int
    rows: int = 0


def open_path(path: str):
    """The file system of a path and its path there."""
    from pyarrow import fs as pafs
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split(":", 1)
    # Hadoop writes file:/x, and leaves characters as they are
    return pafs.FileSystem.from_uri(f"{scheme}:{'' if rest.startswith('//') else '//'}{quote(rest, safe='/:@')}")


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("rows", ROWS))
        self.interval = float(options.get("interval", INTERVAL))
        self.start = int(options.get("start", -1))
        self.at = int(options.get("resume", self.start))
        self.known: dict[str, list[Group]] = {}
        self.waiting: float | None = None

    def _groups(self) -> list[Group]:
        """All row groups by their first place.  A segment's footer is read once."""
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs
        system, root = open_path(self.path)
        for f in system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = f.path.rsplit("/", 1)[-1]
            if f.is_file and name.endswith(".parquet") and name[0] not in "._" and f.path not in self.known:
                meta = pq.read_metadata(f.path, filesystem=system)
                place = meta.schema.names.index(PLACE) if PLACE in meta.schema.names else None
                found = []
                for i in range(meta.num_row_groups):
                    column = next(c for c in map(meta.row_group(i).column, range(meta.num_columns)) if c.path_in_schema == PLACE) \
                        if place is not None else None
                    s = column.statistics if column is not None else None
                    if s is None or not s.has_min_max:
                        raise ValueError(f"{f.path}: no range of places in its footer")
                    found.append(Group(f.path, i, s.min, s.max, meta.row_group(i).num_rows))
                self.known[f.path] = found
        return sorted((g for gs in self.known.values() for g in gs), key=lambda g: (g.first, g.last, g.path, g.number))

    def _places(self, g: Group, after: int) -> np.ndarray:
        import pyarrow.parquet as pq
        system, _ = open_path(self.path)
        with system.open_input_file(g.path) as f:
            column = pq.ParquetFile(f).read_row_group(g.number, columns=[PLACE]).column(0)
        places = column.drop_null().to_numpy()
        return places[places > after]

    def _end(self) -> tuple[int, int]:
        """Where a batch after ``at`` of at most ``rows`` events ends, and how many it has."""
        places = np.zeros(0, dtype=np.int64)
        for g in self._groups():
            if g.last <= self.at:
                continue
            if len(places) >= self.rows and g.first > places[self.rows - 1]:
                break  # all of this group and of later ones is beyond the cap
            places = np.sort(np.concatenate([places, self._places(g, self.at)]))
            cap = places[min(self.rows, len(places)) - 1] if len(places) else None
            places = places[places <= cap] if cap is not None else places  # with those that share the last place
        return (int(places[-1]) if len(places) else self.at), len(places)

    def initialOffset(self) -> dict:
        return {"position": self.start}

    def latestOffset(self) -> dict:
        end, n = self._end()
        if n:
            now = time.monotonic()
            self.waiting = now if self.waiting is None else self.waiting
            if n >= self.rows or now - self.waiting >= self.interval:
                self.at, self.waiting = end, None
        return {"position": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, last = start["position"], end["position"]
        if last < first:
            raise RuntimeError(f"the log would be read backwards, from {first} to {last}")
        self.at = max(self.at, last)  # a batch that a restart repeats
        return [Group(g.path, g.number, first, last) for g in self._groups() if g.last > first and g.first <= last]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        system, _ = open_path(self.path)
        with system.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(row_groups=[partition.number], batch_size=8192):
                place = batch.column(batch.schema.get_field_index(PLACE))
                batch = batch.filter(pc.and_(pc.greater(place, partition.first), pc.less_equal(place, partition.last)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).cast(x.type) if (i := batch.schema.get_field_index(x.name)) >= 0
                     else pa.nulls(batch.num_rows, x.type) for x in _ARROW], schema=_ARROW)


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return EVENT_SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def last_position(spark: SparkSession, checkpoint: str) -> int | None:
    """The place that a stream's checkpoint has planned up to."""
    folder = f"{checkpoint.rstrip('/')}/offsets"
    numbers = sorted(int(x) for x in fs.list_files(spark, folder) if x.isdigit())
    if not numbers:
        return None
    # a version line, the batch's metadata, then the offset of each source
    return json.loads(fs.read_text(spark, f"{folder}/{numbers[-1]}").splitlines()[2])["position"]


def log_stream(spark: SparkSession, path: str, checkpoint: str, rows: int = ROWS, interval: float = INTERVAL,
               start: int | None = None) -> DataFrame:
    """Streaming events (``EVENT_SCHEMA``) of the log at ``path``, in batches of at most ``rows``
    or ``interval`` seconds.  ``start``: the place after which a stream without a checkpoint begins;
    one with a checkpoint goes on where that ends.  Trigger it by processing time."""
    spark.dataSource.register(LogSource)
    resume = last_position(spark, checkpoint)
    r = spark.readStream.format(NAME).option("path", path).option("rows", rows).option("interval", interval)
    if start is not None:
        r = r.option("start", start)
    if resume is not None:
        r = r.option("resume", resume)
    return r.load()
