"""The N most clicked products per area (S2, J-7, P2, A14, J-8, P6, W1, P5, P14).

Plan shape: click scan (date predicate pushed to the reader) → partial+final aggregate on
(city_id, product_id) → ⋈ city table → aggregate on (area, product_id) → ⋈ product table →
per-area
``row_number`` filtered by a constant, which Spark turns into a ``WindowGroupLimit``
before the shuffle, so a hot area sends at most N rows per task.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.udfs import concat_long_string, group_concat_distinct, json_field
from clickflow.params import AreaParams
from clickflow.sources.readers import scan_click_actions


def click_product_basic(actions: DataFrame, cities: DataFrame, params: AreaParams = AreaParams()) -> DataFrame:
    """(city_id, city_name, area, product_id) per click in the date range (J-7, P2).

    A row per click; the job itself joins counts (:func:`area_product_click_count`).
    """
    clicks = scan_click_actions(actions, params.start_date, params.end_date)
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id", "inner").select(
        "city_id", "city_name", "area", "product_id"
    )


def area_product_click_count(
    actions: DataFrame, cities: DataFrame, params: AreaParams = AreaParams()
) -> DataFrame:
    """J-7 + A14: clicks and distinct ``city_id:city_name`` list per (area, product).

    Clicks are counted per (city, product) before the city table is joined, so the
    raw clicks are never shuffled for the join and a hot city is combined in each
    task; a city id listed twice counts its clicks under each of its rows, as the
    row-wise join does.
    """
    per_city = scan_click_actions(actions, params.start_date, params.end_date).groupBy("city_id", "product_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    named = per_city.join(cities.select("city_id", "city_name", "area"), "city_id", "inner")
    return named.groupBy("area", "product_id").agg(
        F.sum("n").cast("bigint").alias("click_count"),
        group_concat_distinct(concat_long_string("city_id", "city_name", ":")).alias("city_infos"),
    )


def product_status(extend_info: Column) -> Column:
    """``'self'`` when ``extend_info.product_status = '0'``, else ``'third party'`` (NULL too)."""
    return F.when(json_field(extend_info, "product_status") == F.lit("0"), F.lit("self")).otherwise(
        F.lit("third party")
    )


def area_full_product_click_count(counts: DataFrame, products: DataFrame) -> DataFrame:
    """J-8: add product name and status; products missing from the catalogue drop out."""
    p = products.select("product_id", "product_name", product_status(F.col("extend_info")).alias("product_status"))
    return counts.join(p, "product_id", "inner").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status"
    )


def area_level(area: Column, levels: Mapping[str, str], otherwise: str) -> Column:
    """P5: CASE mapping area → level (the mapping is a parameter)."""
    expr = None
    for name, level in levels.items():
        expr = (F.when if expr is None else expr.when)(area == F.lit(name), F.lit(level))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def top_products(full: DataFrame, params: AreaParams = AreaParams()) -> DataFrame:
    """W1 + P14 + P5: top-N per area by clicks (ties: product_id ascending, D16)."""
    w = Window.partitionBy("area").orderBy(F.col("click_count").desc(), F.col("product_id").asc())
    ranked = full.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.lit(params.top_n))
    return ranked.select(
        "area",
        area_level(F.col("area"), params.levels, params.level_else).alias("area_level"),
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        "product_status",
    )


def area_top_products(
    actions: DataFrame, cities: DataFrame, products: DataFrame, params: AreaParams = AreaParams()
) -> DataFrame:
    """The whole J3 plan as one lazy DataFrame."""
    full = area_full_product_click_count(area_product_click_count(actions, cities, params), products)
    return top_products(full, params)
