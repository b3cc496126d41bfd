"""Shards of near equal byte size, cut from global prefix sums.

Rows are ordered by (MD5 of the text, doc_id), so copies of a text stand together. A range exchange
deals the order out over partitions; each partition's total is summed, and the running total of the
partitions before it is added to the running sum inside it. No row is ever ordered in one task. A
row goes to the shard in which its first byte falls.

Nulls: a null text counts as empty; a null doc_id is ordered first. Repeated rows are kept and
placed one after the other. An empty table gives no rows.
"""

from pyspark.sql import Window, functions as F

from footfall.llm.common import shuffle_partitions, stage


def with_prefix_sums(df, order, size):
    """``df`` with ``before`` (sum of ``size`` over earlier rows) and ``place`` (number of earlier rows).

    ``order``: columns that sort the rows. The result is staged; equal keys keep the order they were
    staged in.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    # Part and line number are fixed by staging: a task that runs again later cannot deal them anew.
    dealt = stage(ranged.withColumn("line", F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn("part", F.shiftright("line", 33))
    totals = dealt.groupBy("part").agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
    # One row per partition, so this window is as small as the plan itself.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("part").orderBy("line")
    return (
        dealt.withColumn("running", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("number", F.row_number().over(inside))
        .join(totals, "part")
        .withColumn("before", F.col("bytes_before") + F.col("running") - F.col(size))
        .withColumn("place", F.col("rows_before") + F.col("number") - 1)
        .drop("part", "line", "running", "number", "bytes_before", "rows_before")
    )


def balanced_shards(docs, shards=16, id_col="doc_id", text_col="text"):
    """One row per document: its size, CRC-32, shard and slot (place inside the shard)."""
    data = F.coalesce(F.encode(text_col, "UTF-8"), F.lit(b""))
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.md5(data).alias("text_md5"),
    )
    placed = stage(with_prefix_sums(sized, ["text_md5", "doc_id"], "size"), "placed")
    total = placed.agg(F.max(F.col("before") + F.col("size")).alias("total"))
    shard = F.least(F.floor(F.col("before") * shards / F.col("total")), F.lit(shards - 1)).cast("int")
    # One row, and one row per shard: bounded by the number of shards, not by the table.
    sharded = placed.join(F.broadcast(total)).withColumn("shard", shard)
    first = sharded.groupBy("shard").agg(F.min("place").alias("first"))
    return sharded.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
