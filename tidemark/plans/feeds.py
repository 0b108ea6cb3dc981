"""Change feeds derived from the test tables (no live database here).

Each feed reads a whole table and maps every row to one change event, so
its size grows with the table.  The SQL twins of these frames live in
``tidemark.plans.oracle``; keep both in step.

Feed A (``events`` -> orders): one event per event row.
    key      user_id * 110 + (event_id % 10) * 11   (about 9% of the keys
             lie beyond the last order key, so deletes can miss the base)
    op       error -> D, signup -> I, anything else -> U
    image    (o_orderstatus, o_totalprice) = (event_type, value); NULL on D
    order    (__epoch, __seq) with __seq = event_id, __epoch = day of ts
Feed B (``lineitem`` -> orders): one event per line item.
    key      l_orderkey; op R -> D, A -> U, N -> I
    image    (l_linestatus, l_extendedprice); NULL on D
    order    (__epoch, ship date, line number, part, supplier, price):
             (l_orderkey, l_linenumber) alone is not unique
    epoch    month number of l_shipdate counted from 1995-01
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import DELETED_AT, EPOCH, LSN, MOVED_FROM, OP, SEQ, UNCHANGED
from tidemark.functions.lsn import long_to_lsn

# Fixed values of the fixtures.
EPOCH_ORIGIN = "2024-01-01"          # day 1 of the events table = epoch 1
MONTH_ORIGIN_YEAR = 1995             # feed B epoch 1 = January 1995
COMPACTED_AT = "2024-02-01 00:00:00"
ORDERS_PK = ["o_orderkey"]
ORDERS_TABLE = "public.orders"
ORDER_A = (EPOCH, SEQ)
ORDER_B = (EPOCH, "__shipdate", "__line", "__part", "__supp", "__price")
NOTE_FROM_EPOCH = 3                  # evolved feeds gain a column here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base snapshot of the orders table: every order, no tombstones."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.lit(None).cast("timestamp_ntz").alias(DELETED_AT))


def feed_a(spark: SparkSession, sf_dir: str, with_note: bool = False,
           partial: bool = False) -> DataFrame:
    """Feed A; ``with_note`` adds a nullable ``note`` (props) from epoch 3.

    ``partial``: every 3rd update does not send its price (NULL, listed in
    ``__unchanged``), as a source does for unchanged out-of-line values.
    """
    ev = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "error", "D")
           .when(F.col("event_type") == "signup", "I").otherwise("U"))
    live = op != "D"
    epoch = (F.datediff(F.to_date("ts"), F.lit(EPOCH_ORIGIN)) + 1).cast("bigint")
    extra = [F.when(epoch >= NOTE_FROM_EPOCH, F.col("props")).alias("note")] if with_note else []
    unsent = (op == "U") & ((F.col("event_id") % 3) == 0)
    if partial:
        extra.append(F.when(unsent, F.array(F.lit("o_totalprice")))
                     .otherwise(F.array().cast("array<string>")).alias(UNCHANGED))
    price = F.when(live & ~unsent, F.col("value")) if partial else F.when(live, F.col("value"))
    return ev.select(
        (F.col("user_id") * 110 + (F.col("event_id") % 10) * 11).alias("o_orderkey"),
        op.alias(OP),
        F.when(live, F.col("event_type")).alias("o_orderstatus"),
        price.alias("o_totalprice"),
        F.col("event_id").alias(SEQ),
        epoch.alias(EPOCH),
        *extra,
    )


def feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    op = (F.when(F.col("l_returnflag") == "R", "D")
           .when(F.col("l_returnflag") == "A", "U").otherwise("I"))
    live = op != "D"
    epoch = ((F.year("l_shipdate") - MONTH_ORIGIN_YEAR) * 12
             + F.month("l_shipdate")).cast("bigint")
    return li.select(
        F.col("l_orderkey").alias("o_orderkey"),
        op.alias(OP),
        F.when(live, F.col("l_linestatus")).alias("o_orderstatus"),
        F.when(live, F.col("l_extendedprice")).alias("o_totalprice"),
        epoch.alias(EPOCH),
        F.col("l_shipdate").alias("__shipdate"),
        F.col("l_linenumber").alias("__line"),
        F.col("l_partkey").alias("__part"),
        F.col("l_suppkey").alias("__supp"),
        F.col("l_extendedprice").alias("__price"),
    )


def feed_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed A's events on four keys per user, between which purchases move rows.

    The key is ``user_id * 110 + slot * 11`` with slot ``event_id // 10 % 4``.  A purchase
    moves the row there from the slot before (event_id % 7 < 5) or after it, and is
    ``D(old key)`` and ``U(new key)``; moves send the price where event_id % 4 = 0 and
    the status where event_id is odd.  Other updates don't send the price where
    event_id % 3 = 0.
    """
    ev = table(spark, sf_dir, "events")
    n, family = F.col("event_id"), F.col("user_id") * 110
    slot = F.floor(n / 10) % 4
    old = F.when(n % 7 < 5, slot + 3).otherwise(slot + 1) % 4
    move = F.col("event_type") == "purchase"
    op = (F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I").otherwise("U"))
    epoch = (F.datediff(F.to_date("ts"), F.lit(EPOCH_ORIGIN)) + 1).cast("bigint")
    unsent = F.when(move, F.concat(
        F.when(n % 4 != 0, F.array(F.lit("o_totalprice"))).otherwise(F.array().cast("array<string>")),
        F.when(n % 2 == 0, F.array(F.lit("o_orderstatus"))).otherwise(F.array().cast("array<string>")))) \
        .when((op == "U") & (n % 3 == 0), F.array(F.lit("o_totalprice"))).otherwise(F.array().cast("array<string>"))
    key, old_key = family + slot * 11, family + old * 11
    ev = ev.select("event_type", "value", n.alias(SEQ), epoch.alias(EPOCH), unsent.alias(UNCHANGED),
                   F.inline(F.when(move, F.array(
                       F.struct(old_key.alias("o_orderkey"), F.lit("D").alias(OP), F.lit(None).cast("bigint").alias("old")),
                       F.struct(key.alias("o_orderkey"), op.alias(OP), old_key.alias("old"))))
                       .otherwise(F.array(F.struct(key.alias("o_orderkey"), op.alias(OP),
                                                   F.lit(None).cast("bigint").alias("old"))))))

    def sent(name: str, value: str):
        return F.when((F.col(OP) != "D") & ~F.array_contains(UNCHANGED, name), F.col(value)).alias(name)
    return ev.select("o_orderkey", OP, sent("o_orderstatus", "event_type"), sent("o_totalprice", "value"), SEQ, EPOCH,
                     UNCHANGED, F.when(F.col("old").isNotNull(), F.struct(F.col("old").alias("o_orderkey"))).alias(MOVED_FROM))


def lsn_number(event_id) -> F.Column:
    """Feed A log position: starts below 0x10/0 and crosses it at any scale."""
    return (F.lit(16 * 4294967296 - 536870912)
            + event_id.cast("bigint") * F.lit(1048576))


def text_feed(spark: SparkSession, sf_dir: str, with_note: bool = False,
              with_key_change: bool = False) -> DataFrame:
    """Feed A as source text events: (table, op, row map, lsn, ts).

    Every 97th event carries the word ``bad`` in one typed field, cycling
    through price, date, flag and quantity, so decoding has rejects.
    ``with_note``: live row images gain a ``note`` key from epoch 3 on.
    ``with_key_change``: every 5th purchase moved its row from key + 1 to
    key; ``old_row`` then holds the old key image.
    """
    # a small file is one task, and making the texts takes long: spread them first
    ev = table(spark, sf_dir, "events").repartition("event_id")
    op = (F.when(F.col("event_type") == "error", "D")
           .when(F.col("event_type") == "signup", "I").otherwise("U"))
    key = F.col("user_id") * 110 + (F.col("event_id") % 10) * 11
    bad = (F.col("event_id") % 97) == 0
    slot = (F.col("event_id") / 97).cast("bigint") % 4

    def field(expr, which):
        return F.when(bad & (slot == which), F.lit("bad")).otherwise(expr)

    row = F.create_map(
        F.lit("o_orderkey"), key.cast("string"),
        F.lit("o_orderstatus"), F.col("event_type"),
        F.lit("o_totalprice"), field(F.format_string("%.2f", F.col("value")), 0),
        F.lit("o_orderdate"), field(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), 1),
        F.lit("o_urgent"), field(F.when(F.col("value") > 50, "t").otherwise("f"), 2),
        F.lit("o_quantity"), field(F.col("user_id").cast("string"), 3),
    )
    if with_note:
        epoch = F.datediff(F.to_date("ts"), F.lit(EPOCH_ORIGIN)) + 1
        row = F.when(epoch >= NOTE_FROM_EPOCH,
                     F.map_concat(row, F.create_map(F.lit("note"), F.col("props")))) \
               .otherwise(row)
    row = F.when(op == "D", F.create_map(F.lit("o_orderkey"), key.cast("string"))) \
        .otherwise(row)
    lsn = long_to_lsn(lsn_number(F.col("event_id")))
    extra = []
    if with_key_change:
        moved = (F.col("event_type") == "purchase") & ((F.col("event_id") % 5) == 0)
        extra = [F.when(moved, F.create_map(F.lit("o_orderkey"), (key + 1).cast("string")))
                 .alias("old_row")]
    return ev.select(
        F.lit(ORDERS_TABLE).alias("table"),
        op.alias("op"),
        row.alias("row"),
        lsn.alias("lsn"),
        F.col("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        *extra,
    )


def with_lsn(df: DataFrame) -> DataFrame:
    """Add the ``__lsn`` text of feed A (for ledgers and lag)."""
    return df.withColumn(LSN, long_to_lsn(lsn_number(F.col(SEQ))))


# The text feed's manifest columns.
ORDERS_TEXT_COLUMNS = [
    {"name": "o_orderkey", "pg_type": "bigint", "nullable": False},
    {"name": "o_orderstatus", "pg_type": "text", "nullable": True},
    {"name": "o_totalprice", "pg_type": "numeric(12,2)", "nullable": True},
    {"name": "o_orderdate", "pg_type": "timestamp without time zone", "nullable": True},
    {"name": "o_urgent", "pg_type": "boolean", "nullable": True},
    {"name": "o_quantity", "pg_type": "integer", "nullable": True},
]

# Routed stream: every event row goes to one source table; page views are
# not replicated (absent from the manifest) and must be skipped.
ACTIVE_TABLES = ["public.orders", "public.payments"]


def routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    t = (F.when(F.col("event_type").isin("view", "click"), "public.page_views")
          .when(F.col("event_type") == "purchase", "public.payments")
          .otherwise("public.orders"))
    return ev.select(
        t.alias("table"),
        (F.datediff(F.to_date("ts"), F.lit(EPOCH_ORIGIN)) + 1).cast("bigint").alias(EPOCH),
        F.col("event_id").alias(SEQ),
        long_to_lsn(lsn_number(F.col("event_id"))).alias(LSN))

