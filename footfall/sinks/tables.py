"""The ways results are written, as functions over plain Parquet tables.

A keyed table is partitioned by day. A write joins the rows it brings with the stored rows of the days it touches and
replaces those day folders alone (dynamic partition overwrite); other days are neither read nor written. The
joined rows are first written under the number of the write, beside the table. A write that is
sent again, or died while folders were being replaced, puts those same rows in place once more instead of joining
anew, so increments are added once. One writer at a time per table; numbers must not go back.
"""

import hashlib
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import functions as F

#: Column that tells the writes of a table of new keys apart.
BATCH = "batch_id"


def append_table(df, path, schema=None, partition_by=None):
    """Add the rows of ``df``; ``schema`` fixes the column order of the sink."""
    rows = df.select(*schema.names) if schema else df
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def store_bucketed(df, path, key, buckets, name=None):
    """Store ``df`` in buckets of ``key``, sorted by it, and return the stored table.

    Grouping the table by ``key`` or joining it on ``key`` needs no shuffle of its rows: the other side of a join is
    dealt into the same buckets. ``buckets`` should not lie below ``spark.sql.shuffle.partitions``, or Spark may
    rather shuffle both sides. The table is known to the catalog as ``name``, by default one made of the path.
    """
    name = name or "bucketed_" + hashlib.md5(path.encode()).hexdigest()
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path)
    writer.format("parquet").mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def read_table(spark, path, schema):
    """The stored rows; none if nothing was written yet."""
    return _stored(spark, path, schema).select(*schema.names)


def _stored(spark, path, schema):
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def upsert_table(df, path, keys, batch_id, how="replace", day="date"):
    """Insert new keys and update known ones: ``replace`` the values or ``add`` to them.

    ``df`` holds a key once (``replace``) or as often as it likes (``add``). ``day`` must be one of the keys.
    """
    if how not in ("replace", "add"):
        raise ValueError(f"unknown upsert {how!r}")
    values = [c for c in df.columns if c not in keys]

    def merge(stored, new):
        if how == "replace":
            return stored.join(new.select(*keys), keys, "left_anti").unionByName(new)
        return stored.unionByName(new).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])

    _rewrite_days(df, path, batch_id, day, merge)


def replace_groups(df, path, keys, batch_id, day="date"):
    """Replace all rows of every group that ``df`` has rows for; ``day`` must be one of the keys."""

    def merge(stored, new):
        return stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)

    _rewrite_days(df, path, batch_id, day, merge)


def _rewrite_days(df, path, batch_id, day, merge):
    spark, path = df.sparkSession, path.rstrip("/")
    merged = f"{path}.writes/{batch_id}"
    if not _exists(spark, f"{merged}/_SUCCESS"):
        # Days are folders of the table, which Spark lists on the driver anyway.
        days = [r[0] for r in df.select(day).distinct().collect()]
        stored = _stored(spark, path, df.schema).filter(F.col(day).isin(days))
        merge(stored.select(*df.columns), df).write.mode("overwrite").parquet(merged)
    rows = spark.read.schema(df.schema).parquet(merged)
    _overwrite_folders(rows.hint("rebalance", day), path, day)
    for name in _names(spark, f"{path}.writes"):
        if name.isdigit() and int(name) < batch_id:
            _remove(spark, f"{path}.writes/{name}")


def _overwrite_folders(rows, path, by):
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def insert_new(df, path, keys, batch_id):
    """Insert the rows whose key no earlier write brought; sent again, a write replaces its own rows."""
    spark = df.sparkSession
    known = _stored(spark, path, df.schema.add(BATCH, "long")).filter(F.col(BATCH) < batch_id)
    new = df.dropDuplicates(keys).join(known.select(*keys), keys, "left_anti")
    write_batch(new, path, batch_id)


def write_batch(df, path, batch_id):
    """Add the rows of ``df`` as those of write ``batch_id``; sent again, it replaces its own rows."""
    rows = df.withColumn(BATCH, F.lit(batch_id).cast("long"))
    _overwrite_folders(rows, path.rstrip("/"), BATCH)


@contextmanager
def computed(rows):
    """``rows`` of a micro-batch, computed once and kept while they are written.

    A batch that is sent again may find its merged rows in place and would not run; its state must be committed all the same.
    """
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows.count()
        yield rows
    finally:
        rows.unpersist()


# -- the file system of a table


def _hadoop(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _exists(spark, path):
    fs, path = _hadoop(spark, path)
    return fs.exists(path)


def make_folder(spark, path):
    fs, path = _hadoop(spark, path)
    fs.mkdirs(path)


def _names(spark, path):
    fs, path = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _remove(spark, path):
    fs, path = _hadoop(spark, path)
    fs.delete(path, True)
