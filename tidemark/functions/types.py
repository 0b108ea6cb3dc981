"""Source (PostgreSQL) types -> categories -> Spark types; text coercion.

A category is the storage class of a column.  Coercion turns source text
into the Spark type with ``try_cast`` family functions (JVM-side, codegen):
bad text becomes NULL and is reported by ``rejects``; policy ``"zero"``
instead reproduces the source writer's zero / false fallback.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type name -> storage category.
PG_CATEGORY = {
    "smallint": "INT32", "int2": "INT32", "integer": "INT32", "int": "INT32",
    "int4": "INT32", "serial": "INT32", "smallserial": "INT32",
    "bigint": "INT64", "int8": "INT64", "bigserial": "INT64",
    "real": "FLOAT", "float4": "FLOAT",
    "double precision": "DOUBLE", "float8": "DOUBLE",
    "numeric": "DECIMAL", "decimal": "DECIMAL",
    "boolean": "BOOLEAN", "bool": "BOOLEAN",
    "text": "UTF8", "character varying": "UTF8", "varchar": "UTF8",
    "character": "UTF8", "char": "UTF8", "bpchar": "UTF8", "name": "UTF8",
    "citext": "UTF8",
    "json": "JSON", "jsonb": "JSON",
    "uuid": "UUID",
    "timestamp": "TIMESTAMP_MICROS", "timestamp without time zone": "TIMESTAMP_MICROS",
    "timestamptz": "TIMESTAMP_MICROS", "timestamp with time zone": "TIMESTAMP_MICROS",
    "date": "DATE",
    "time": "TIME_MICROS", "time without time zone": "TIME_MICROS",
    "timetz": "TIME_MICROS", "time with time zone": "TIME_MICROS",
    "bytea": "BYTE_ARRAY",
}

# Storage category -> catalog (Hive) type name.
CATALOG_TYPE = {
    "INT32": "int", "INT64": "bigint", "BOOLEAN": "boolean", "FLOAT": "float",
    "DOUBLE": "double", "UTF8": "string", "JSON": "string", "UUID": "string",
    "TIMESTAMP_MICROS": "timestamp", "DATE": "date", "TIME_MICROS": "string",
    "BYTE_ARRAY": "binary",
}

_DECIMAL_DEFAULT = (38, 18)
#: Name, precision and scale, the rest of the name ("timestamp(3) without time zone"), array mark.
_TYPE_ARGS = re.compile(r"^\s*([a-z ]+?)\s*(?:\((\d+)\s*(?:,\s*(-?\d+))?\))?((?:\s+[a-z]+)*)\s*(\[\])?\s*$")


def parse_pg_type(pg_type: str) -> tuple[str, int | None, int | None, bool]:
    """``numeric(10,2)`` -> ("numeric", 10, 2, False); arrays flagged."""
    m = _TYPE_ARGS.match(pg_type.lower())
    if not m:
        return pg_type.lower(), None, None, False
    p = int(m.group(2)) if m.group(2) else None
    s = int(m.group(3)) if m.group(3) else None
    return " ".join((m.group(1) + m.group(4)).split()), p, s, bool(m.group(5))


def category(pg_type: str) -> str:
    """Storage category; arrays, ranges, enums and the rest are UTF8."""
    name, _, _, is_array = parse_pg_type(pg_type)
    if is_array:
        return "UTF8"
    return PG_CATEGORY.get(name, "UTF8")


def catalog_type(cat: str, precision: int | None = None, scale: int | None = None) -> str:
    """Catalog type name; a decimal without precision is decimal(38,0)."""
    if cat == "DECIMAL":
        p = precision if precision and precision > 0 else 38
        s = scale if scale and scale > 0 else 0
        return f"decimal({p},{s})"
    return CATALOG_TYPE.get(cat, "string")


def catalog_type_col(cat: Column, precision: Column, scale: Column) -> Column:
    """Column form of ``catalog_type`` (for catalog frames)."""
    out = F.when(cat == "DECIMAL", F.format_string(
        "decimal(%d,%d)",
        F.when(precision > 0, precision).otherwise(F.lit(38)),
        F.when(scale > 0, scale).otherwise(F.lit(0))))
    for k, v in CATALOG_TYPE.items():
        out = out.when(cat == k, F.lit(v))
    return out.otherwise(F.lit("string"))


def spark_type(pg_type: str) -> T.DataType:
    """The Spark type a column of this source type is stored as."""
    name, p, s, _ = parse_pg_type(pg_type)
    cat = category(pg_type)
    if cat == "INT32":
        return T.IntegerType()
    if cat == "INT64":
        return T.LongType()
    if cat == "FLOAT":
        return T.FloatType()
    if cat == "DOUBLE":
        return T.DoubleType()
    if cat == "DECIMAL":
        if p is None:
            return T.DecimalType(*_DECIMAL_DEFAULT)
        s = s or 0          # a negative scale rounds to tens, hundreds ...: whole numbers, as many digits more
        return T.DecimalType(min(p - min(s, 0), 38), max(s, 0))
    if cat == "BOOLEAN":
        return T.BooleanType()
    if cat == "TIMESTAMP_MICROS":
        return T.TimestampType() if "tz" in name or "with time zone" in name \
            else T.TimestampNTZType()
    if cat == "DATE":
        return T.DateType()
    if cat == "BYTE_ARRAY":
        return T.BinaryType()
    return T.StringType()


def struct_for(columns: list[dict]) -> T.StructType:
    """Spark schema of a manifest column list ({name, pg_type, nullable})."""
    return T.StructType([T.StructField(c["name"], spark_type(c["pg_type"]),
                                       c.get("nullable", True)) for c in columns])


def coerce(raw: Column, pg_type: str, on_error: str = "null") -> Column:
    """Source text -> typed value.

    ``on_error="null"``: unparsable text is NULL (see ``rejects``).
    ``on_error="zero"``: numbers become 0 and booleans false, as the
    source writer did; an integer out of range becomes the nearest that is in
    range, and a text that is more than digits and a sign is none; other types stay NULL.
    """
    dt = spark_type(pg_type)
    cat = category(pg_type)
    if cat == "BYTE_ARRAY":
        typed = F.when(raw.startswith("\\x"), F.unhex(F.substr(raw, F.lit(3)))) \
                 .otherwise(F.encode(raw, "UTF-8"))
    else:
        typed = raw.try_cast(dt)
    if on_error == "zero" and cat in ("INT32", "INT64", "FLOAT", "DOUBLE", "DECIMAL", "BOOLEAN"):
        zero = F.lit(False) if cat == "BOOLEAN" else F.lit(0).cast(dt)
        if cat in ("INT32", "INT64"):
            top = (1 << (31 if cat == "INT32" else 63)) - 1
            # digits that don't parse are too many
            typed = F.when(raw.rlike("^[+-]?[0-9]+$"), F.coalesce(
                typed, F.when(raw.startswith("-"), F.lit(-top - 1)).otherwise(F.lit(top)).cast(dt)))
        typed = F.when(raw.isNotNull(), F.coalesce(typed, zero))
    return typed


def decode_row(row: Column, columns: list[dict], on_error: str = "null") -> list[Column]:
    """Typed columns from a ``map<string,string>`` row image."""
    return [coerce(F.element_at(row, c["name"]), c["pg_type"], on_error).alias(c["name"])
            for c in columns]


def rejects(events: DataFrame, columns: list[dict], row_col: str = "row",
            keep: tuple[str, ...] = (),
            required: tuple[str, ...] | list[str] = (),
            also: tuple[tuple[str, Column, Column], ...] = ()) -> DataFrame:
    """One row per (event, column) whose text did not parse, or is missing
    although ``required``.  ``also``: more checks, as (name, raw text, is it bad).

    Output: ``keep`` columns, ``column_name``, ``raw``.  Built with one
    ``inline`` of a filtered array, so the events are read once; it is made only
    of events that have something bad.
    """
    checks = []
    for c in columns:
        raw = F.element_at(F.col(row_col), c["name"])
        checks.append((c["name"], raw, raw.isNotNull() & coerce(raw, c["pg_type"]).isNull()
                       | F.lit(c["name"] in required) & raw.isNull()))
    checks += also
    if not checks:
        return events.select(*keep, F.lit("").alias("column_name"), F.lit("").alias("raw")).limit(0)
    found = F.array(*[F.struct(F.lit(name).alias("column_name"), raw.alias("raw"), bad.alias("bad"))
                      for name, raw, bad in checks])
    return (events.where(reduce(lambda a, b: a | b, [bad for _, _, bad in checks]))
                  .select(*keep, F.inline(F.filter(found, lambda s: s["bad"])))
                  .drop("bad"))
