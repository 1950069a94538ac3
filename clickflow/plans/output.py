"""Result shaping: typed columns → the text forms the reference stores.

Dates become ``yyyy-MM-dd``, times ``yyyy-MM-dd HH:mm:ss``, arrays a sorted
comma list, small integers ``bigint``.  Applied only at the end of a plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_output(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.array_sort(c), ",")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
