"""The area top-N job as Spark SQL text, for users who run the reference's SQL.

Same semantics as :func:`clickflow.operators.area.area_top_products`; Catalyst
produces the same kind of plan (partial aggregates, ``WindowGroupLimit``).  The
UDF pair is registered as SQL functions (U4) and the distinct concatenation is
``listagg(DISTINCT ...) WITHIN GROUP (ORDER BY ...)`` (U3).  Values are bound as
named parameters; the area → level mapping becomes a ``map`` parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.udfs import register_sql_functions
from clickflow.params import AreaParams

AREA_TOP_SQL = """
WITH basic AS (
  SELECT c.area, a.click_product_id AS product_id,
         concat_long_string(a.city_id, c.city_name, ':') AS city_info
  FROM {{user_visit_action}} a JOIN {{city_info}} c ON a.city_id = c.city_id
  WHERE a.click_product_id IS NOT NULL{date_range}
),
area_product AS (
  SELECT area, product_id, count(*) AS click_count,
         listagg(DISTINCT city_info, ',') WITHIN GROUP (ORDER BY city_info) AS city_infos
  FROM basic
  GROUP BY area, product_id
),
area_full_product AS (
  SELECT t.area, t.product_id, t.click_count, t.city_infos, p.product_name,
         IF(json_field(p.extend_info, 'product_status') = '0', 'self', 'third party') AS product_status
  FROM area_product t JOIN {{product_info}} p ON t.product_id = p.product_id
)
SELECT area,
       coalesce(element_at(:levels, area), :level_else) AS area_level,
       product_id, click_count, city_infos, product_name, product_status
FROM (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id ASC) AS rn
  FROM area_full_product
)
WHERE rn <= :top_n
"""


def area_top_products_sql(
    spark: SparkSession,
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    params: AreaParams = AreaParams(),
) -> DataFrame:
    """Run :data:`AREA_TOP_SQL` on the three inputs, which are passed to it as arguments: no
    view of the session is made or replaced."""
    register_sql_functions(spark)
    args = {
        "levels": F.create_map(*[F.lit(x) for kv in params.levels.items() for x in kv]),
        "level_else": params.level_else,
        "top_n": params.top_n,
    }
    date_range = ""
    if params.start_date is not None:
        date_range += "\n    AND a.date >= CAST(:start_date AS DATE)"
        args["start_date"] = params.start_date
    if params.end_date is not None:
        date_range += "\n    AND a.date <= CAST(:end_date AS DATE)"
        args["end_date"] = params.end_date
    text = AREA_TOP_SQL.format(date_range=date_range)
    return spark.sql(text, args=args, user_visit_action=actions, city_info=cities, product_info=products)
