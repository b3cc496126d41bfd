"""Running counts kept in Spark's own streaming state, for use without the blacklist.

A watermark bounds the state: once the newest click is ``lateness`` past the end of a day or
minute, that key is dropped from the state and still later clicks on it are ignored.
"""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from footfall import constants as K
from footfall import schemas
from footfall.functions.times import format_date
from footfall.operators import ads
from footfall.sinks import tables
from footfall.streaming import state


def _day_start(spark):
    """Where days of the session's zone start in UTC, as an offset for ``window``.

    Windows have one width and one offset, so a zone whose offset changes over the year is refused.
    """
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    offsets = {datetime(year, month, 1, tzinfo=zone).utcoffset() for year in (1995, 2024) for month in range(1, 13)}
    if len(offsets) > 1:
        raise ValueError(f"days in {zone.key} differ in length; use a session zone with a fixed offset")
    return f"{int(-offsets.pop().total_seconds()) % 86_400} seconds"


def _running(clicks, lateness, width, keys):
    """Counts per window and ``keys`` of clicks (event_time, ...) or of counted ones (minute, click_count, ...)."""
    counted = "click_count" in clicks.columns
    time = "minute" if counted else "event_time"
    start = _day_start(clicks.sparkSession) if width == "1 day" else None
    count = F.sum("click_count") if counted else F.count("*")
    return (
        clicks.withWatermark(time, lateness)
        .groupBy(F.window(time, width, startTime=start).alias("_w"), *keys)
        .agg(count.alias("click_count"))
        .withColumn("_start", F.col("_w.start"))
    )


def running_user_counts(clicks, lateness="1 day"):
    """Count per (date, user, ad) since the stream began; days are those of the session's time zone."""
    counts = _running(clicks, lateness, "1 day", ["user_id", "ad_id"])
    return counts.select(format_date("_start").alias("date"), "user_id", "ad_id", "click_count")


def running_city_counts(clicks, lateness="1 day"):
    """Count per (date, province, city, ad) since the stream began."""
    counts = _running(clicks, lateness, "1 day", ["province", "city", "ad_id"])
    return counts.select(format_date("_start").alias("date"), "province", "city", "ad_id", "click_count")


def running_minute_counts(clicks, lateness="2 hours"):
    """Count per minute and ad; a late click within ``lateness`` corrects its own minute."""
    counts = _running(clicks, lateness, "1 minute", ["ad_id"])
    return counts.select(*ads.minute_parts("_start"), "ad_id", "click_count")


def running_pane_counts(clicks, lateness="2 hours", seconds=K.SLIDE_SECONDS):
    """Count per pane of ``seconds`` and ad, from which sliding windows are summed (``operators.sliding``)."""
    counts = _running(clicks, lateness, f"{seconds} seconds", ["ad_id"])
    return counts.select(format_date("_start").alias("date"), F.col("_start").alias("pane"), "ad_id", "click_count")


PANE_KEYS = ["date", "pane", "ad_id"]
PANES = "date string, pane timestamp, ad_id bigint, click_count bigint"


def keep_counts(counts, path, keys, checkpoint, interval=K.BATCH_INTERVAL, available_now=False, partitions=None):
    """Start a query that keeps the table at ``path`` equal to the running counts; a batch replaces the keys it changed.

    ``partitions`` is the number of state partitions. It is fixed by the first run on a checkpoint
    and, unlike that of a batch shuffle, not adapted at run time, so size it for the full state;
    by default it is the session's ``spark.sql.shuffle.partitions``.
    """

    def write(rows, batch_id):
        with tables.computed(rows) as rows:
            tables.upsert_table(rows, path, keys, batch_id)

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return _start(counts.sparkSession, writer, interval, available_now, partitions)


def _start(spark, writer, interval, available_now, partitions):
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    conf, name = spark.conf, "spark.sql.shuffle.partitions"
    usual = conf.get(name)
    conf.set(name, str(partitions or usual))
    try:
        return writer.start()
    finally:
        conf.set(name, usual)


def keep_minutes_and_late(clicks, counts_path, late_path, checkpoint, lateness="2 hours", interval=K.BATCH_INTERVAL,
                          available_now=False, partitions=None):
    """Start a query that keeps minute counts at ``counts_path`` and clicks that came too late for them at ``late_path``.

    Every click ends in one of the two, so counts and late clicks add up to the input.
    """

    def write(rows, batch_id):
        with tables.computed(rows) as rows:
            minute = F.timestamp_millis("minute_ms")
            timed = rows.select("kind", *ads.minute_parts(minute), "ad_id", "click_count")
            counts = timed.filter(F.col("kind") == state.COUNT).drop("kind")
            tables.upsert_table(counts, counts_path, ads.TREND_KEYS, batch_id)
            tables.write_batch(timed.filter(F.col("kind") == state.LATE).drop("kind"), late_path, batch_id)

    out = state.minute_counts_with_late(clicks, lateness)
    writer = out.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    with state.state_stores(clicks.sparkSession):
        return _start(clicks.sparkSession, writer, interval, available_now, partitions)


def counts_in_state(spark, checkpoint, keys):
    """The running counts as the newest state of the native counter with ``checkpoint`` holds them."""
    rows = spark.read.format("statestore").load(checkpoint)
    start = F.col("key").getField("_w" if "_w" in rows.schema["key"].dataType.names else rows.schema["key"].dataType.names[0])
    count = F.col("value").getField(rows.schema["value"].dataType.names[0])
    return rows.select(start.getField("start").alias("_start"), *[F.col(f"key.{k}").alias(k) for k in keys], count.alias("click_count"))
