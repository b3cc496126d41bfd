"""Live ad-click statistics with an automatic blacklist.

The first query keeps the blacklist in its state and writes an event table with Spark's own exactly-once file sink:
accepted clicks, running counts per user and users listed. The other queries read that table as a stream and
keep one result table each. Whatever is remembered from batch to batch is in state stores; result tables are only written.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall import constants as K
from footfall import schemas
from footfall.operators import ads
from footfall.sinks import tables
from footfall.sources.ad_log import parse_ad_log, rejected_lines
from footfall.streaming import counters, state


class AdStatsStore:
    """Where the live statistics are kept, and readers of their result tables."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name):
        return f"{self.root}/{name}"

    def prepare(self):
        """Make the folder of the event table, so that it can be read as a stream before its first batch."""
        tables.make_folder(self.spark, self.path("ad_events"))

    def _read(self, name, schema):
        return tables.read_table(self.spark, self.path(name), schema)

    def user_counts(self):
        return self._read("ad_user_click_count", schemas.AD_USER_CLICK_COUNT)

    def city_counts(self):
        return self._read("ad_stat", schemas.AD_STAT)

    def province_top(self):
        return self._read("ad_province_top3", schemas.AD_PROVINCE_TOP3)

    def trend(self):
        return self._read("ad_click_trend", schemas.AD_CLICK_TREND)

    def rejects(self):
        return self._read("ad_log_rejects", schemas.AD_LOG_REJECT)

    def events(self):
        return self._read("ad_events", StructType.fromDDL(state.EVENTS))

    def blacklist(self):
        """Users on the list with the micro-batch that put them there."""
        return self.events().filter(F.col("kind") == state.LISTED).select("user_id", "first_batch")

    def recent_trend(self, now=None, minutes=K.TREND_MINUTES):
        """Clicks per minute and ad over the last ``minutes`` minutes."""
        return ads.recent_trend(self.trend(), now, minutes)


class AdStatsRun:
    """The queries of one run."""

    def __init__(self, queries):
        self.queries = queries

    def awaitTermination(self, timeout=None):
        for query in self.queries:
            query.awaitTermination(timeout) if timeout else query.awaitTermination()

    def stop(self):
        for query in self.queries:
            query.stop()


def _started(spark, name, writer, checkpoint, interval, available_now):
    writer = writer.option("checkpointLocation", f"{checkpoint}/{name}")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    with state.state_stores(spark):
        return writer.start()


def start_events(stream, store, checkpoint, threshold=K.BLACKLIST_THRESHOLD, interval=K.BATCH_INTERVAL,
                 available_now=False, ttl_days=None):
    """Start the queries over a stream of log lines: the event table with the blacklist, and the rejected lines.

    Rejected lines have no user and go their own way, so they meet no state.
    """

    def files(name, frame, *partition_by):
        writer = frame.writeStream.outputMode("append").format("parquet").option("path", store.path(name))
        writer = writer.partitionBy(*partition_by) if partition_by else writer
        return _started(frame.sparkSession, name, writer, checkpoint, interval, available_now)

    return AdStatsRun([
        files("ad_events", state.blacklist_events(parse_ad_log(stream), threshold, ttl_days), "kind"),
        files("ad_log_rejects", rejected_lines(stream)),
    ])


def start_tables(store, checkpoint, top_n=K.TOP_ADS, interval=K.BATCH_INTERVAL, available_now=False, publish=None,
                 lateness="1 day", ttl_days=None):
    """Start the queries that keep the result tables equal to the event table."""
    events = store.spark.readStream.schema(state.EVENTS).parquet(store.path("ad_events"))
    accepted = events.filter(F.col("kind") == state.ACCEPTED)
    totals = events.filter(F.col("kind") == state.TOTAL).select(*ads.USER_KEYS, "click_count")
    listed = events.filter(F.col("kind") == state.LISTED).select("user_id")

    def kept(name, frame, write, newest=lambda rows: rows):
        def of_batch(rows, batch_id):
            with tables.computed(newest(rows)) as rows:
                write(rows, store.path(name), batch_id)
                if publish:
                    publish(name, rows, batch_id)

        writer = frame.writeStream.outputMode("update").foreachBatch(of_batch)
        return _started(frame.sparkSession, name, writer, checkpoint, interval, available_now)

    def upsert(keys):
        return lambda rows, path, batch_id: tables.upsert_table(rows, path, keys, batch_id)

    def newest_totals(rows):
        # Several batches of the first query may come at once; running counts only grow.
        return rows.groupBy(*ads.USER_KEYS).agg(F.max("click_count").alias("click_count"))

    def groups(rows, path, batch_id):
        tables.replace_groups(rows, path, ["date", "province"], batch_id)

    queries = [
        kept("ad_user_click_count", totals, upsert(ads.USER_KEYS), newest_totals),
        kept("ad_stat", counters.running_city_counts(accepted, lateness), upsert(ads.CITY_KEYS)),
        kept("ad_province_top3", state.top_ads(accepted, top_n, ttl_days), groups),
        kept("ad_click_trend", counters.running_minute_counts(accepted, lateness), upsert(ads.TREND_KEYS)),
    ]
    if publish:
        queries.append(kept("ad_blacklist", listed, lambda rows, path, batch_id: None))
    return AdStatsRun(queries)


def run_ad_stats(stream, store, checkpoint, threshold=K.BLACKLIST_THRESHOLD, top_n=K.TOP_ADS, interval=K.BATCH_INTERVAL,
                 available_now=False, publish=None, lateness="1 day", ttl_days=None):
    """Start the statistics over a stream of log lines; returns the running queries.

    With ``available_now`` the queries that read the event table start when it has been brought up to date.
    ``publish(table_name, rows, batch_id)`` may pass each batch's changed rows to a database; batch numbers are those
    of the table's own query, so (table name, batch number) names a delivery. Clicks later than ``lateness`` change
    no city count and no trend. ``ttl_days`` forgets running counts that long after their last change.
    """
    store.prepare()
    events = start_events(stream, store, checkpoint, threshold, interval, available_now, ttl_days)
    if available_now:
        events.awaitTermination()
    kept = start_tables(store, checkpoint, top_n, interval, available_now, publish, lateness, ttl_days)
    return AdStatsRun([*events.queries, *kept.queries])
