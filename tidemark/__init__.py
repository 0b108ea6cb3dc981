"""tidemark: change-data-capture tables on Spark.

Snapshots and ordered I/U/D change events become epoch-partitioned Parquet
deltas; deltas are merged into compacted bases by primary key with soft
deletes; consumers read as-of an epoch, incrementally, or live.  Every
operator is a DataFrame transformation that Catalyst plans; the driver only
touches small metadata (manifest JSON, directory names, glob patterns).
"""

from tidemark.constants import DELETED_AT, EPOCH, LSN, OP, SEQ, TS

__all__ = ["DELETED_AT", "EPOCH", "LSN", "OP", "SEQ", "TS"]
