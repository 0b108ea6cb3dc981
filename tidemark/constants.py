"""Column names and defaults shared by every module."""

# Metadata columns of a delta row.
OP = "__op"            # 'I' | 'U' | 'D'
EPOCH = "__epoch"      # flush number, global over tables
SEQ = "__seq"          # total order of events inside one epoch
LSN = "__lsn"          # source log position, text 'X/Y'
TS = "__ts"            # source commit time
UNCHANGED = "__unchanged"   # columns an update did not send (partial images)
MOVED_FROM = "__moved_from"   # old key of a row that changed its key (on the change under the new key)
# Metadata column of a base row.
DELETED_AT = "__deleted_at"   # soft-delete time (UTC wall clock, timestamp_ntz)
BASE_EPOCH = "__base_epoch"   # directory partition of a compacted base

DELTA_META = (OP, EPOCH, SEQ, LSN, TS, UNCHANGED, MOVED_FROM)
ALL_META = DELTA_META + (DELETED_AT, BASE_EPOCH)

OPS = ("I", "U", "D")
LIVE_OPS = ("I", "U")

DEFAULT_RETENTION_DAYS = 30
# Upper bounds on what a merge may broadcast of its folded deltas (see merge.merge).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20
# Base rows per delta row from which "auto" spares the base its shuffle.
BROADCAST_BASE_RATIO = 16
