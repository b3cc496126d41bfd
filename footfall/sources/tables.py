"""Batch sources and the scans the jobs start from."""

from pyspark.sql import functions as F


def load_table(spark, source, fmt="parquet", schema=None, **options):
    """A table by path, or by catalog name when ``fmt`` is ``"table"``."""
    if fmt == "table":
        return spark.table(source)
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(source)


def relation(spark, rows, schema, view=None):
    """A small in-memory relation, optionally registered under a view name."""
    df = spark.createDataFrame(rows, schema)
    if view:
        df.createOrReplaceTempView(view)
    return df


def scan_actions(actions, start_date, end_date, time_column=None):
    """User actions from ``start_date`` to ``end_date``, both included; a bound that is None is open.

    Dates are compared as ``yyyy-MM-dd`` text, which prunes folders when the table is partitioned by
    ``date``. Where ``date`` is only derived from a time column, name that column: the same range on
    it reaches the file scan. It must be the day of that column, in the same time zone.
    """
    kind = dict(actions.dtypes)[time_column] if time_column else None
    if start_date is not None:
        actions = actions.filter(F.col("date") >= start_date)
        if time_column:
            actions = actions.filter(F.col(time_column) >= F.lit(start_date).cast("date").cast(kind))
    if end_date is not None:
        actions = actions.filter(F.col("date") <= end_date)
        if time_column:
            actions = actions.filter(F.col(time_column) < F.date_add(F.lit(end_date).cast("date"), 1).cast(kind))
    return actions


def clicks(actions):
    """Product clicks among the actions as ``city_id, product_id``."""
    return actions.filter(F.col("click_product_id").isNotNull()).select(
        "city_id", F.col("click_product_id").alias("product_id")
    )


def scan_clicks(actions, start_date, end_date, time_column=None):
    """Product clicks in the date range as ``city_id, product_id``."""
    return clicks(scan_actions(actions, start_date, end_date, time_column))
