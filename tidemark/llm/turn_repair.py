"""Repair of the structure of conversations.

Faults and role classes are found by DataFrame functions.  Python sees one
character per turn and returns the cheapest edits (``glr``); the repaired turns
are then put together from the rows by DataFrame functions again.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import glr

#: White space, and the ends of a sentence.
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = ("su", "ua", "au")

_EDITS = "cost long, audit string, rows array<int>, roles array<string>"
_repairer: glr.Repairer | None = None


def _edits(kinds: pd.Series) -> pd.DataFrame:
    global _repairer  # one set of tables for each worker
    _repairer = _repairer or glr.Repairer()
    known = {k: _repairer.repair(k) for k in kinds.unique()}
    return pd.DataFrame([known[k] for k in kinds], columns=["cost", "audit", "rows", "roles"])


def _fault() -> Column:
    """A turn's first fault: ``b`` blank, ``d`` duplicate, ``t`` truncated, or empty."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    return (F.when(bare == "", "b").when(F.col("__nth") > 1, "d")
            .when(~F.right(bare, F.lit(1)).isin(*ENDS), "t").otherwise(""))


def _kind() -> Column:
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial"))
    return (F.when(F.col("fault").isin("b", "d"), glr.MUST_GO)
            .when(F.col("fault") == "t", F.coalesce(F.upper(role), F.lit(glr.OTHER_TRUNCATED)))
            .otherwise(F.coalesce(role, F.lit(glr.OTHER))))


def repair(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``turns`` (``conv_id, turn, role, text``):
    ``conv_id, n_turns, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired``, the last an array of ``(role, text)``.

    Turns are taken by ``turn`` (nulls first), equal ones by role, then text.
    ``gaps`` counts the numbers missing between the first and the last turn;
    each turn has at most one fault, blank before duplicate before truncated;
    ``illegal`` counts neighbours whose role initials don't follow each other.
    ``audit`` lists the cheapest edits that make the roles legal.

    A null role or text counts as one space (so a null text is blank).  A null
    ``conv_id`` is a conversation of its own.  A role whose initial is not s, u or
    a, the empty one too, can't be kept.  A row whose ``turn``, role and text are all null is one turn;
    a conversation with no other rows than ones marked ``__gone`` (a boolean column
    that may be missing) has no turns: zeros, an empty audit and no repaired
    turns.  An empty table gives an empty result; other columns are ignored.
    A conversation is one row here and has to fit a task.
    """
    gone = F.col("__gone") if "__gone" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("__gone"))
    # the window and the grouping both go by the conversation's partition: one shuffle
    seen = Window.partitionBy("conv_id", "__gone", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = (rows.repartition("conv_id").withColumn("__nth", F.row_number().over(seen))
            .withColumn("initial", F.substring("role", 1, 1)).withColumn("fault", _fault())
            # of equal turns the first occurrence comes first
            .withColumn("t", F.when(~F.col("__gone"), F.struct("turn", "role", "text", "__nth", "fault", "initial",
                                                               _kind().alias("kind")))))
    each = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    each = each.withColumn("e", F.pandas_udf(_edits, _EDITS)(F.array_join("t.kind", "")))
    n = F.size("t")
    numbers = F.filter("t.turn", lambda x: x.isNotNull())
    follow = F.zip_with(F.slice("t.initial", 1, F.greatest(n - 1, F.lit(0))), F.slice("t.initial", 2, n),
                        lambda a, b: F.concat(a, b))

    def faults(kind: str) -> Column:
        return F.size(F.filter("t.fault", lambda f: f == kind)).cast("long")

    steps = F.arrays_zip(F.col("e.rows").alias("row"), F.col("e.roles").alias("role"))
    repaired = F.transform(steps, lambda s: F.struct(
        F.coalesce(s["role"], F.get(F.col("t.role"), s["row"])).alias("role"),
        F.when(s["row"] < 0, "").otherwise(F.get(F.col("t.text"), s["row"])).alias("text")))
    return each.select(
        "conv_id", n.cast("long").alias("n_turns"),
        F.coalesce(F.array_max(numbers) - F.array_min(numbers) + 1 - F.size(F.array_distinct(numbers)),
                   F.lit(0).cast("long")).cast("long").alias("gaps"),
        faults("b").alias("blank"), faults("d").alias("duplicate"), faults("t").alias("truncated"),
        F.size(F.filter(follow, lambda p: ~p.isin(*LEGAL))).cast("long").alias("illegal"),
        F.col("e.cost").alias("cost"), F.col("e.audit").alias("audit"), repaired.alias("repaired"))


def damage(turns: DataFrame) -> DataFrame:
    """The turns with a fault in every fourth, chosen by ``crc32('conv_id:turn') % 20``:
    0 drops a turn (it stays as a row marked ``__gone``), 1 empties its text, 2
    takes the sentence ends out, 3 repeats it, 4 makes its role ``user``.  Nulls
    count as one space."""
    def text(col: str) -> Column:
        return F.coalesce(F.col(col).cast("string"), F.lit(" "))

    turns = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                         (F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20).alias("__how"))
    how = F.col("__how")
    return turns.select(
        "conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(how == 1, "").when(how == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        (how == 0).alias("__gone"),
        F.explode(F.when(how == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy")).drop("__copy")
