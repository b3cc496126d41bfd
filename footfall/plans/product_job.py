"""Top products per area for one task."""

from pyspark.sql import functions as F

from footfall import schemas
from footfall.operators.products import area_top_products
from footfall.sources.tables import scan_clicks


def area_product_report(actions, cities, products, params, task_id, **options):
    clicks = scan_clicks(actions, params.start_date, params.end_date)
    top = area_top_products(clicks, cities, products, **options)
    return top.withColumn("task_id", F.lit(task_id).cast("bigint")).select(*schemas.AREA_TOP3_PRODUCT.names)


def run_product_job(actions, cities, products, params, task_id, write, **options):
    """Compute the report and hand it to ``write(table_name, frame)``."""
    write("area_top3_product", area_product_report(actions, cities, products, params, task_id, **options))
