"""Most clicked products per area."""

from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions import labels, text
from footfall.operators.ranking import top_n_per_group


def clicks_with_city(clicks, cities):
    """Each click with its city's name and area; clicks from unknown cities are dropped."""
    return clicks.join(cities, "city_id").select("city_id", "city_name", "area", "product_id")


def area_product_clicks(clicks, cities):
    """Clicks per (area, product) and the sorted list of the cities they came from.

    Clicks are counted per (city, product) first, so what is joined and regrouped is small and
    no product, however popular, brings more rows to a group than there are cities.
    """
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count("*").alias("_n"))
    # Partitioning by product serves both this grouping and a following join with the products.
    located = per_city.join(cities, "city_id").repartition("product_id")
    city = text.concat_long_string("city_id", "city_name", ":")
    return located.groupBy("area", "product_id").agg(
        F.sum("_n").alias("click_count"), text.group_concat_distinct(city).alias("city_infos")
    )


def _with_product(counts, products):
    return counts.join(products.select("product_id", "product_name", "extend_info"), "product_id")


def area_product_full(counts, products):
    """Add product name and status; products without a record are dropped."""
    return _with_product(counts, products).select(
        "area",
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        labels.product_status("extend_info").alias("product_status"),
    )


def area_top_products(clicks, cities, products, n=K.TOP_PRODUCTS, levels=None, other=K.OTHER_AREA_LEVEL):
    """The ``n`` most clicked products of each area; ties go to the smaller product id."""
    known = _with_product(area_product_clicks(clicks, cities), products)
    top = top_n_per_group(known, ["area"], [F.desc("click_count"), F.asc("product_id")], n)
    # Status and level are worked out for the few rows left after ranking.
    return top.select(
        "area",
        labels.area_level("area", levels, other).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        labels.product_status("extend_info").alias("product_status"),
    )
