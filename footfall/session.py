"""Session settings the jobs are tuned for. A caller may equally bring a session of its own."""

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Grouping by session keeps collect_set buffers for many keys; spill to sorting later than the default 128.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # A runtime Bloom filter is built from lists far over the default 10 MB: its own size is bounded by maxNumBits (8 MB).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name, master=None, hive=False, conf=None):
    """A session with the recommended settings; ``hive=True`` uses the cluster's Hive catalog."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
