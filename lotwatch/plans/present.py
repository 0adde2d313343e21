"""Plain scalar columns at the edge of a registered query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Whole numbers as BIGINT, decimals rounded, dates and lists as text."""

    def shown(field: T.StructField) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        return c.alias(field.name)

    chosen = df.select(*columns) if columns else df
    return chosen.select(*[shown(f) for f in chosen.schema.fields])
