"""Ad-click statistics over a bounded log."""

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions.times import format_date
from footfall.operators.ranking import top_n_per_group

USER_KEYS = ["date", "user_id", "ad_id"]
CITY_KEYS = ["date", "province", "city", "ad_id"]
PROVINCE_KEYS = ["date", "province", "ad_id"]
TREND_KEYS = ["date", "hour", "minute", "ad_id"]


def _daily(clicks, *keys):
    """Count per day and keys; days are grouped as dates and written as text afterwards."""
    counts = clicks.groupBy(F.to_date("event_time").alias("_day"), *keys).agg(F.count("*").alias("click_count"))
    return counts.select(F.col("_day").cast("string").alias("date"), *keys, "click_count")


def user_click_counts(clicks):
    return _daily(clicks, "user_id", "ad_id")


def city_click_counts(clicks):
    return _daily(clicks, "province", "city", "ad_id")


def province_click_counts(city_counts):
    """Fold city counts into provinces."""
    return city_counts.groupBy(*PROVINCE_KEYS).agg(F.sum("click_count").alias("click_count"))


def blacklist(user_counts, threshold=K.BLACKLIST_THRESHOLD):
    """Users who clicked one ad more than ``threshold`` times on one day."""
    return user_counts.filter(F.col("click_count") > threshold).select("user_id").distinct()


def drop_blacklisted(clicks, listed):
    """Clicks of users that are not on the list.

    No hint: Spark broadcasts the list when its size allows, and otherwise joins by shuffle with
    skewed click partitions split.
    """
    return clicks.join(listed.select("user_id"), "user_id", "left_anti")


def province_top_ads(province_counts, n=K.TOP_ADS):
    """The ``n`` most clicked ads per day and province; ties go to the smaller ad id."""
    return top_n_per_group(province_counts, ["date", "province"], [F.desc("click_count"), F.asc("ad_id")], n)


def click_trend(clicks):
    """Clicks per minute and ad."""
    per_minute = clicks.groupBy(F.date_trunc("minute", "event_time").alias("_m"), "ad_id").agg(
        F.count("*").alias("click_count")
    )
    return per_minute.select(*minute_parts("_m"), "ad_id", "click_count")


def minute_parts(time):
    """``date``, ``hour`` and ``minute`` of a timestamp column."""
    return (
        format_date(time).alias("date"),
        F.date_format(time, "HH").alias("hour"),
        F.date_format(time, "mm").alias("minute"),
    )


def minute_of():
    """The minute a trend row stands for, as ``yyyy-MM-dd HH:mm`` text (sorts by time)."""
    return F.concat("date", F.lit(" "), "hour", F.lit(":"), "minute")


def recent_trend(trend, now=None, minutes=K.TREND_MINUTES):
    """Trend rows of the last ``minutes`` minutes up to and including ``now``.

    ``now`` is ``yyyy-MM-dd HH:mm`` text; by default the newest minute in the trend, which is
    looked up first. The day bound prunes the folders of a trend stored by date.
    """
    now = now or trend.agg(F.max(minute_of())).first()[0]
    if now is None:
        return trend
    first = datetime.datetime.strptime(now, "%Y-%m-%d %H:%M") - datetime.timedelta(minutes=minutes - 1)
    start = first.strftime("%Y-%m-%d %H:%M")
    return trend.filter(F.col("date").between(start[:10], now[:10]) & minute_of().between(start, now))


def batch_counts(clicks):
    """Clicks per batch, day, place, user and ad; ``clicks`` carries a batch number ``batch``.

    Both parts of a replay start from this frame, in which a busy user's clicks are few rows.
    """
    keys = ["province", "city", "user_id", "ad_id"]
    counts = clicks.groupBy("batch", F.to_date("event_time").alias("_day"), *keys).agg(
        F.count("*").alias("click_count")
    )
    return counts.select("batch", F.col("_day").cast("string").alias("date"), *keys, "click_count")


def first_offences(counts, threshold=K.BLACKLIST_THRESHOLD):
    """``user_id, first_batch``: the batch in which a user first exceeded the threshold.

    Clicks before the first offence are never dropped, so the running count of all clicks finds
    the same batch as a live run would.
    """
    # Partitioning without the batch serves this grouping and the window after it.
    per_key = counts.repartition(*USER_KEYS)
    per_batch = per_key.groupBy("batch", *USER_KEYS).agg(F.sum("click_count").alias("_n"))
    # One row per batch of one day: the window's groups stay short however busy the user.
    running = F.sum("_n").over(
        Window.partitionBy(*USER_KEYS).orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        per_batch.withColumn("_total", running)
        .filter(F.col("_total") > threshold)
        .groupBy("user_id")
        .agg(F.min("batch").alias("first_batch"))
    )


def accepted_counts(counts, offences):
    """Counts a live run would make: those up to and including a user's first offending batch."""
    in_time = F.col("first_batch").isNull() | (F.col("batch") <= F.col("first_batch"))
    return counts.join(offences, "user_id", "left").filter(in_time).drop("first_batch")
