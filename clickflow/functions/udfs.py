"""The reference's UDF/UDAF trio, as built-in expressions.

* ``concat_long_string(a, b, sep)`` (U1) and ``json_field(json, field)`` (U2) are
  plain column expressions; :func:`register_sql_functions` also registers them as
  SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``), which Catalyst inlines.
* ``group_concat_distinct(x)`` (U3) is ``collect_set`` + sort + join: a partial
  aggregate (map-side combine of the distinct set), so it is safe on a hot group as
  long as the number of distinct values is small (cities per area/product).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.scalars import ColumnOrName, _c


def concat_long_string(a: ColumnOrName, b: ColumnOrName, sep: str = ":") -> Column:
    """``a‖sep‖b``; NULL prints as ``null`` like Java string concatenation."""
    return F.concat(
        F.coalesce(_c(a).cast("string"), F.lit("null")),
        F.lit(sep),
        F.coalesce(_c(b).cast("string"), F.lit("null")),
    )


def json_field(json: ColumnOrName, field: str) -> Column:
    """Top-level field of a JSON object by bare name (NULL if absent or invalid)."""
    return F.get_json_object(_c(json), "$." + field)


def group_concat_distinct(x: ColumnOrName, sep: str = ",") -> Column:
    """Distinct values, sorted ascending, joined by ``sep`` (exact-value set, D3)."""
    return F.array_join(F.array_sort(F.collect_set(_c(x))), sep)


def register_sql_functions(spark: SparkSession) -> None:
    """U4: make U1/U2 callable from SQL text.  U3 in SQL is
    ``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(a BIGINT, b STRING, sep STRING) "
        "RETURNS STRING RETURN concat(coalesce(CAST(a AS STRING), 'null'), sep, coalesce(b, 'null'))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION json_field(j STRING, f STRING) "
        "RETURNS STRING RETURN get_json_object(j, concat('$.', f))"
    )
