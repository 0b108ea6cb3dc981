"""Register the current base of every active table as an external table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.constants import BASE_EPOCH, DELETED_AT, EPOCH, OP, SEQ
from tidemark.functions.types import struct_for
from tidemark.plans.consumer import published_bases
from tidemark.sources import catalog, manifest, storage


def live_sql(base: str, deltas: str, pk: list[str], cols: list[str], after: int, upto: int) -> str:
    """The live rows of a table at epoch ``upto`` as SQL over its catalog tables: the newest base
    and the changes after it, folded per key (``operators.merge``)."""
    def q(name: str) -> str:
        return f"`{name}`"
    at, live = f"struct(`{EPOCH}`, `{SEQ}`)", f"`{OP}` IN ('I', 'U')"
    keys = ", ".join(q(k) for k in pk)
    data = ", ".join(f"IF(z.n > 0, z.img.{q(c)}, b.{q(c)}) AS {q(c)}" for c in cols)
    img = f"max_by(struct({', '.join(q(c) for c in cols)}), CASE WHEN {live} THEN {at} END) AS img, " if cols else ""
    return f"""SELECT {', '.join(f'coalesce(b.{q(k)}, z.{q(k)}) AS {q(k)}' for k in pk)}{', ' + data if data else ''}
FROM (SELECT *, TRUE AS __in_base FROM {base}) b FULL OUTER JOIN (
  SELECT {keys}, max_by(`{OP}`, {at}) AS last_op, {img}count_if({live}) AS n
  FROM {deltas} WHERE `{EPOCH}` > {after} AND `{EPOCH}` <= {upto} AND `{OP}` IN ('I', 'U', 'D') GROUP BY {keys}) z
ON {' AND '.join(f'b.{q(k)} = z.{q(k)}' for k in pk)}
WHERE CASE WHEN z.last_op = 'D' THEN FALSE WHEN z.n > 0 THEN TRUE ELSE b.__in_base AND b.`{DELETED_AT}` IS NULL END"""


def publish_live_view(spark: SparkSession, root: str, table: str, db: str, view: str | None = None) -> str:
    """Publish the table's live rows as a view in the catalog, for every session to read by name.

    The view names a base and an epoch, so all it reads is published; publishing again
    (with each epoch: ``EpochWriter(published=...)``, and after a compaction) replaces its text in
    one step.  Each base has a catalog table of its own, so a view in use keeps its base.
    Tables with updates that don't send every column, and bucket directories, are not
    plain SQL: use ``consumer.live_view`` there.
    """
    e = manifest.entry(spark, root, table)
    if e is None:
        raise KeyError(table)
    if e.get("partial_images") or e.get("bucket_epochs") is not None:
        raise ValueError(f"{table}: partial images or bucket directories can't be a view in SQL")
    schema, _, name = table.rpartition(".")
    flat = name if schema in ("", "public") else f"{schema}_{name}"
    view, base, upto = view or f"{flat}_live", published_bases(e)[-1], int(e.get("latest_delta_epoch") or 0)
    cols = [c if isinstance(c, dict) else c.asDict() for c in e["columns"]]
    data = struct_for([{"name": c["name"], "pg_type": c["pg_type"]} for c in cols])
    base_table, delta_table = f"{flat}__base_{base}", f"{flat}__deltas"
    catalog.register_table(spark, db, base_table, [*cols, {"name": DELETED_AT, "pg_type": "timestamp"}],
                           f"{storage.table_root(root, table)}/base/{BASE_EPOCH}={base}", {"cdc.base_epoch": str(base)})
    epochs = [x for x in storage.delta_epochs(spark, root, table) if base < x <= upto]
    catalog.register_deltas(spark, db, delta_table, storage.delta_schema(data),
                            f"{storage.table_root(root, table)}/deltas", epochs)
    keys = list(e["primary_key"])
    text = live_sql(f"`{db}`.`{base_table}`", f"`{db}`.`{delta_table}`", keys,
                    [f.name for f in data.fields if f.name not in keys], base, upto)
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{view}` AS {text}")
    return f"{db}.{view}"


def register_all(spark: SparkSession, root: str, db: str) -> list[dict]:
    """Upsert one catalog table per active table, pointing at its newest
    base (never at the table root, which also holds deltas: D4).  Tables
    without a schema are reported, not registered.  Returns one result per
    table; the driver holds the names and one entry at a time."""
    names = manifest.read_tables(spark, root).filter(F.col("status") == "active").select("table").collect()
    out = []
    for t in sorted(r["table"] for r in names):
        r = manifest.entry(spark, root, t)
        if r["bucket_epochs"] is not None:
            # buckets live under different epochs: no single location to name
            out.append({"table": t, "status": "skipped (bucket directories: use live_view)"})
            continue
        if not r["columns"]:
            out.append({"table": t, "status": "skipped (no schema)"})
            continue
        schema, _, name = t.partition(".")
        flat = name if schema in ("", "public") else f"{schema}_{name}"
        eps = [e for e in storage.base_epochs(spark, root, t) if e in published_bases(r)]
        if not eps:
            out.append({"table": t, "status": "skipped (no base)"})
            continue
        cols = r["columns"] + \
            [{"name": "__deleted_at", "pg_type": "timestamp"}]
        catalog.register_table(
            spark, db, flat, cols, f"{storage.table_root(root, t)}/base/__base_epoch={eps[-1]}",
            {"classification": "parquet", "cdc.source_schema": schema, "cdc.source_table": name,
             "cdc.schema_version": str(r["schema_version"]), "cdc.base_epoch": str(eps[-1])})
        out.append({"table": t, "status": "registered", "name": f"{db}.{flat}",
                    "base_epoch": eps[-1]})
    return out
