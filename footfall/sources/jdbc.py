"""Tables in an external database."""

from pyspark.sql import functions as F

from footfall.params import TaskParams


def jdbc_options(url, table, user=None, password=None, driver=None, split=None, fetch_size=10000):
    """Reader options. ``split=(column, lower, upper, parts)`` reads the table in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if split:
        column, lower, upper, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def read_jdbc(spark, url, table, **kwargs):
    """A database table; filters and column choices on the result are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def load_task_params(tasks, task_id, today=None):
    """Parameters of one task: a point lookup whose single row comes to the driver."""
    row = tasks.filter(F.col("task_id") == task_id).select("task_param").first()
    if row is None:
        raise LookupError(f"no task {task_id}")
    return TaskParams.from_json(row["task_param"], today)
