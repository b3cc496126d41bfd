"""Look back along an ordered sequence without holding a whole group in one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def with_previous(df, key, order, value, slot, alias):
    """Add ``alias``: ``value`` of the row before this one in ``order`` within ``key``.

    ``slot`` is an expression that never decreases along ``order``. Rows are ordered within
    (key, slot), and only the first row of each slot looks further back, to the last value of the
    slot before. A key that holds a large share of the rows is spread over as many tasks as it has
    slots; one task sees all rows of a slot or one row per slot of a key, never all rows of a key.
    """
    within = Window.partitionBy(key, "_slot").orderBy(order)
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.withColumn("_slot", slot).select(
        "*",
        F.lag(value).over(within).alias(alias),
        F.row_number().over(within).alias("_at"),
        F.last(value).over(whole).alias("_last"),
    )
    # Both halves read the same shuffle, which Spark runs once.
    inner = rows.filter(F.col("_at") > 1)
    first = rows.filter(F.col("_at") == 1).withColumn(
        alias, F.lag("_last").over(Window.partitionBy(key).orderBy("_slot"))
    )
    return inner.unionByName(first).drop("_slot", "_at", "_last")
