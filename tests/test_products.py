import random
from collections import Counter

import pytest

from footfall import schemas
from footfall.operators import products as P
from footfall.operators.ranking import top_n_per_group
from footfall.params import TaskParams
from footfall.plans.product_job import area_product_report
from pyspark.sql import functions as F


@pytest.fixture
def cities(spark):
    rows = [(1, "a", "China North"), (11, "a", "China North"), (2, "b", "West South"), (3, "c", "Elsewhere")]
    return spark.createDataFrame(rows, schemas.CITY_INFO)


@pytest.fixture
def catalog(spark):
    rows = [(1, "p1", '{"product_status": 0}'), (2, "p2", '{"product_status": 1}'), (3, "p3", "{bad"),
            (4, "p4", '{"product_status": "own"}'), (5, "p5", None)]
    return spark.createDataFrame(rows, schemas.PRODUCT_INFO)


def clicks(spark, pairs):
    return spark.createDataFrame(pairs, "city_id long, product_id long")


def test_unknown_cities_and_products_are_dropped(spark, cities, catalog):
    df = clicks(spark, [(1, 1), (9, 1), (None, 1), (2, 77)])
    assert P.clicks_with_city(df, cities).count() == 2
    full = P.area_product_full(P.area_product_clicks(df, cities), catalog).collect()
    assert [(r["area"], r["product_id"], r["click_count"]) for r in full] == [("China North", 1, 1)]


def test_city_list_is_distinct_and_sorted(spark, cities):
    df = clicks(spark, [(11, 1), (1, 1), (11, 1), (1, 1), (1, 1)])
    row = P.area_product_clicks(df, cities).first()
    assert (row["click_count"], row["city_infos"]) == (5, "11:a,1:a")


def test_top_products_ties_levels_and_status(spark, cities, catalog):
    df = clicks(spark, [(1, p) for p in (5, 4, 3, 2)] + [(1, 2), (3, 1)])
    rows = P.area_top_products(df, cities, catalog).orderBy("area", F.desc("click_count"), "product_id").collect()
    assert [(r["area"], r["area_level"], r["product_id"], r["click_count"], r["product_status"]) for r in rows] == [
        ("China North", "A Level", 2, 2, "第三方商品"),
        ("China North", "A Level", 3, 1, "第三方商品"),
        ("China North", "A Level", 4, 1, "第三方商品"),
        ("Elsewhere", "D Level", 1, 1, "自营商品"),
    ]


def test_report_has_sink_columns(spark, cities, catalog):
    actions = spark.createDataFrame([], schemas.USER_VISIT_ACTION)
    report = area_product_report(actions, cities, catalog, TaskParams("2024-01-01", "2024-01-02"), 3)
    assert report.schema.names == schemas.AREA_TOP3_PRODUCT.names
    assert report.count() == 0


def test_hot_product_counts_match_brute_force(spark, cities, catalog):
    rng = random.Random(1)
    pairs = [(1, 1)] * 1500 + [(rng.choice([1, 11, 2, 3]), rng.randrange(1, 6)) for _ in range(3000)]
    area = {1: "China North", 11: "China North", 2: "West South", 3: "Elsewhere"}
    want = Counter((area[c], p) for c, p in pairs)
    got = {(r["area"], r["product_id"]): r["click_count"]
           for r in P.area_product_clicks(clicks(spark, pairs), cities).collect()}
    assert got == want


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = top_n_per_group(df, ["g"], [F.desc("v")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial
    assert sorted((r["g"], r["v"]) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
