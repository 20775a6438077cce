"""Results in types that every engine prints alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text; nothing else changes."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[shown(f) for f in df.schema])
