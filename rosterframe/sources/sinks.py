"""Result sinks and the CSV-safe export form.

The source system notes that every boolean is turned into text for CSV
export.  ``csv_safe`` applies that rule to a whole result and extends it to
the other types CSV cannot hold: dates and timestamps as ISO text, arrays as
JSON text.  Numbers and strings pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _export(field: T.StructField):
    c, t = F.col(f"`{field.name}`"), field.dataType
    if isinstance(t, T.BooleanType):
        return c.cast("string").alias(field.name)
    if isinstance(t, T.DateType):
        return F.date_format(c, "yyyy-MM-dd").alias(field.name)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
    if isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c).alias(field.name)
    return c


def csv_safe(df: DataFrame) -> DataFrame:
    """Booleans to 'true'/'false', dates to text, arrays to JSON text."""
    return df.select(*[_export(f) for f in df.schema.fields])


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as JSON objects, one per line (the service answered with JSON rows)."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    csv_safe(df).write.mode(mode).option("header", True).csv(path)
