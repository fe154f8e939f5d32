"""JSON columns (JSN1-JSN3, SRC11)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, NullType, StructType

from rowmill import schemas


def parse(value: Column, ddl: str) -> Column:
    """JSN1: text to struct; malformed text gives NULL fields."""
    return F.from_json(value, ddl)


def serialise(*columns: str) -> Column:
    """JSN2: the named columns as one JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def discover_ddl(df: DataFrame, column: str) -> str:
    """SRC11: the DDL of the JSON texts of ``column``, from every row.

    One distributed aggregate merges the rows' types, map-side first, so a field that turns up
    only in the last file is found too and just the merged type reaches the driver.  Fractional
    numbers become double, fields that are always null become string.  Without any JSON the type has
    no fields.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("t")).first()["t"]
    # A field name with "<" in it stands in backquotes: outside of them OBJECT< begins a type.
    plain = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda part: part[1] or "STRUCT<", found)
    kind = DataType.fromDDL(plain)
    return "STRUCT<>" if isinstance(kind, NullType) else _ddl(kind)


def _ddl(kind: DataType) -> str:
    if isinstance(kind, StructType):
        fields = ("`{}`: {}".format(field.name.replace("`", "``"), _ddl(field.dataType)) for field in kind.fields)
        return f"STRUCT<{', '.join(fields)}>"
    if isinstance(kind, ArrayType):
        return f"ARRAY<{_ddl(kind.elementType)}>"
    return {NullType: "STRING", DecimalType: "DOUBLE"}.get(type(kind), kind.simpleString())


def device_rows(df: DataFrame, value: str = "value") -> DataFrame:
    """JSN3: one row per device of each event; works on tables and streams alike."""
    event = df.select(parse(F.col(value).cast("string"), schemas.DEVICE_EVENT).alias("e")).select("e.*")
    return event.select(
        "customerId", "eventId", "eventOffset", "eventPublisher", "eventTime",
        F.explode("data.devices").alias("device"),
    ).select(
        "customerId", "eventId", "eventOffset", "eventPublisher", "eventTime",
        "device.deviceId", "device.measure", "device.status", "device.temperature",
    )
