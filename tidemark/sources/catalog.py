"""Source catalog frames and external-table registration.

Catalog frames mirror the source's information schema: ``tables``
(schema_name, table_name, table_type), ``columns`` (table, ordinal,
column_name, pg_type, nullable) and ``indexes`` (table, indkey = primary-key
attribute numbers in index order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import EPOCH
from tidemark.functions.names import flat_name, location, schema_of, table_of
from tidemark.functions.types import CATALOG_TYPE, PG_CATEGORY, spark_type


def list_tables(tables: DataFrame, schemas: list[str] | None = None) -> DataFrame:
    """Base tables of the given schemas (default ``public``), ordered."""
    schemas = schemas or ["public"]
    return (tables.filter((F.col("table_type") == "BASE TABLE")
                          & F.col("schema_name").isin(*schemas))
                  .select(F.concat_ws(".", "schema_name", "table_name").alias("table"))
                  .orderBy("table"))


def _lookup(names: dict[str, str], key: Column, default: str) -> Column:
    found = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[key]
    return F.coalesce(found, F.lit(default))


def _category_col(pg_type: F.Column) -> F.Column:
    """Column form of ``types.category`` (arrays and unknown -> UTF8)."""
    return _lookup(PG_CATEGORY, F.trim(F.regexp_replace(F.lower(pg_type), r"\(.*\)", "")), "UTF8")


def typed_columns(columns: DataFrame) -> DataFrame:
    """Adds category, catalog type, precision and scale to a columns frame."""
    decimal = F.col("category") == "DECIMAL"

    def number(of: str) -> Column:
        found = F.regexp_extract("pg_type", of, 1)
        return F.when(decimal & (found != ""), found.cast("int"))
    p, s = F.col("precision"), F.col("scale")
    # each step is a projection of its own, so that a type is looked at once a row
    return (columns.withColumn("category", _category_col(F.col("pg_type")))
            .withColumn("precision", number(r"\((\d+)"))
            .withColumn("scale", number(r"\(\d+\s*,\s*(\d+)\)"))
            .withColumn("catalog_type", F.when(decimal, F.concat(
                F.lit("decimal("), F.when(p > 0, p).otherwise(F.lit(38)).cast("string"), F.lit(","),
                F.when(s > 0, s).otherwise(F.lit(0)).cast("string"), F.lit(")")))
                .otherwise(_lookup(CATALOG_TYPE, F.col("category"), "string"))))


def primary_keys(indexes: DataFrame, columns: DataFrame) -> DataFrame:
    """(table, primary_key array in index order); tables without a key drop out."""
    pos = indexes.select("table", F.posexplode("indkey").alias("pos", "ordinal"))
    named = pos.join(columns.select("table", "ordinal", "column_name"), ["table", "ordinal"])
    return (named.groupBy("table")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "column_name"))).alias("k"))
            .select("table", F.transform("k", lambda s: s["column_name"]).alias("primary_key"))
            .filter(F.size("primary_key") > 0))


def names(tables: DataFrame, root: str, table_col: str = "table",
          base_epoch: Column | None = None) -> DataFrame:
    """Split, flattened catalog name and location of the current base of each table."""
    q = F.col(table_col)
    return tables.select(q.alias("table"), schema_of(q).alias("schema_name"),
                         table_of(q).alias("table_name"),
                         flat_name(schema_of(q), table_of(q)).alias("catalog_name"),
                         location(F.lit(root), q, F.lit(0).cast("long") if base_epoch is None
                                  else base_epoch).alias("location"))


def register_table(spark: SparkSession, db: str, name: str, columns: list[dict],
                   path: str, properties: dict[str, str]) -> None:
    """Upsert one external Parquet table, in place: a reader never finds it missing.

    A table that is there gets its added columns, location and properties by
    ``ALTER TABLE``.  Columns are declared with their Spark types (``timestamp_ntz`` for
    timestamps without zone, exact decimals), so reads through the catalog
    equal reads of the files in any session time zone.  Only a column that changed its
    type or went away needs a new declaration: drop (metadata only) and create.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    full = f"`{db}`.`{name}`"
    wanted = [(c["name"], spark_type(c["pg_type"])) for c in columns]
    props = ", ".join(f"'{k}' = '{_quoted(v)}'" for k, v in sorted(properties.items()))
    if spark.catalog.tableExists(f"{db}.{name}"):
        known = {f.name: f.dataType for f in spark.table(full).schema.fields}
        if all(known.get(c, t) == t for c, t in wanted) and not known.keys() - {c for c, _ in wanted}:
            added = ", ".join(_declared(c, t) for c, t in wanted if c not in known)
            if added:
                spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({added})")
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{_quoted(path)}'")
            spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({props})")
            spark.catalog.refreshTable(full)
            return
        spark.sql(f"DROP TABLE {full}")
    spark.sql(f"CREATE TABLE {full} ({', '.join(_declared(c, t) for c, t in wanted)}) USING parquet "
              f"LOCATION '{_quoted(path)}' TBLPROPERTIES ({props})")


def _declared(name: str, dtype) -> str:
    return f"`{name}` {dtype.simpleString()}"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def register_deltas(spark: SparkSession, db: str, name: str, schema, path: str, epochs: list[int]) -> None:
    """Upsert an external table over a table's delta folder that has exactly ``epochs`` as partitions."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    full = f"`{db}`.`{name}`"
    fields = [f for f in schema.fields if f.name != EPOCH]
    if not spark.catalog.tableExists(f"{db}.{name}"):
        cols = ", ".join(_declared(f.name, f.dataType) for f in fields)
        spark.sql(f"CREATE TABLE {full} ({cols}, `{EPOCH}` bigint) USING parquet PARTITIONED BY (`{EPOCH}`) LOCATION '{_quoted(path)}'")
    known = set(spark.table(full).columns)
    added = ", ".join(_declared(f.name, f.dataType) for f in fields if f.name not in known)
    if added:
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({added})")
    have = {int(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
    for verb, some in (("ADD IF NOT EXISTS", sorted(set(epochs) - have)), ("DROP IF EXISTS", sorted(have - set(epochs)))):
        if some:
            sep = ", " if verb.startswith("DROP") else " "
            spark.sql(f"ALTER TABLE {full} {verb} " + sep.join(f"PARTITION (`{EPOCH}` = {e})" for e in some))
    spark.catalog.refreshTable(full)
