"""Stateful processors of the ad log: what a stream must remember per user, province and ad.

State lives in the state store of the query (RocksDB), one store per shuffle partition. Clicks are counted
within every Arrow batch before they are shuffled to their key, so a flood from one user, province
or ad arrives as a few rows per task.
"""

from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from footfall.functions.times import format_date
from footfall.session import RECOMMENDED_CONF

DAY_MS = 86_400_000

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_stores(spark):
    """Within, queries with the processors of this module may be started, whatever store the session's queries have.

    A processor needs a store with several column families. Spark's default store has one, so RocksDB takes its place;
    any other store the session names is left. A query keeps the store of its first start.
    """
    conf, usual = spark.conf, spark.conf.get(_PROVIDER, None)
    if usual and not usual.endswith(".HDFSBackedStateStoreProvider"):
        yield
        return
    conf.set(_PROVIDER, RECOMMENDED_CONF[_PROVIDER])
    try:
        yield
    finally:
        conf.set(_PROVIDER, usual) if usual else conf.unset(_PROVIDER)


def precounted(clicks, *keys):
    """``clicks`` (event_time, ...) as (date, minute, *keys, click_count), counted batch by batch without a shuffle."""
    minute = F.date_trunc("minute", "event_time")
    rows = clicks.select(format_date("event_time").alias("date"), minute.alias("minute"), *keys)
    names = rows.columns

    def of_batches(batches):
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(names, use_threads=False).aggregate([([], "count_all")])
            yield from counted.select([*names, "count_all"]).rename_columns([*names, "click_count"]).to_batches()

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(of_batches, f"{schema}, click_count bigint")


def batch_id():
    """The number of the micro-batch a task works for."""
    return int(TaskContext.get().getLocalProperty("streaming.sql.batchId"))


# -- the blacklist

#: accepted: clicks of a user who was not on the list; total: a running count; listed: a user put on the list.
ACCEPTED, TOTAL, LISTED = "accepted", "total", "listed"
EVENTS = (
    "date string, minute timestamp, province string, city string, user_id bigint, ad_id bigint, click_count bigint, "
    "first_batch bigint, kind string"
)


class Blacklist(StatefulProcessor):
    """Per user: running counts per (day, ad), and the batch in which one first exceeded the threshold.

    A click is dropped if its user was on the list when its micro-batch started.
    """

    def __init__(self, threshold, ttl_days=None):
        self.threshold, self.ttl_ms = threshold, ttl_days and int(ttl_days * DAY_MS)

    def init(self, handle):
        self.counts = handle.getMapState("counts", "date string, ad_id bigint", "click_count bigint", self.ttl_ms)
        self.listed = handle.getValueState("listed", "first_batch bigint")

    def handleInputRows(self, key, rows, timerValues):
        if self.listed.exists():
            return
        (user,), touched, blank = key, {}, {"user_id": key[0], "minute": None, "province": None, "city": None, "first_batch": None}
        for r in rows:
            touched[r.date, r.ad_id] = touched.get((r.date, r.ad_id), 0) + r.click_count
            yield _event(r.asDict(), kind=ACCEPTED, first_batch=None)
        offends = False
        for (date, ad), n in touched.items():
            if self.counts.containsKey((date, ad)):
                n += self.counts.getValue((date, ad))[0]
            self.counts.updateValue((date, ad), (n,))
            offends = offends or n > self.threshold
            yield _event(blank, kind=TOTAL, date=date, ad_id=ad, click_count=n)
        if offends:
            self.listed.update((batch_id(),))
            self.counts.clear()  # nothing of a listed user is counted again
            yield _event(blank, kind=LISTED, date=None, ad_id=None, click_count=None, first_batch=batch_id())

    def close(self):
        pass


_EVENT_COLUMNS = [c.split(" ")[0] for c in EVENTS.split(", ")]


def _event(values, **changed):
    values = {**values, **changed}
    return Row(**{c: values[c] for c in _EVENT_COLUMNS})


def blacklist_events(clicks, threshold, ttl_days=None):
    """What the blacklist makes of a stream of clicks, as rows of ``EVENTS``.

    ``ttl_days`` drops a count that many days of processing time after its last change.
    """
    counted = precounted(clicks, "province", "city", "user_id", "ad_id")
    return counted.groupBy("user_id").transformWithState(
        Blacklist(threshold, ttl_days), outputStructType=EVENTS, outputMode="append",
        timeMode="processingTime" if ttl_days else "none",
    )


# -- the best ads per province


class TopAds(StatefulProcessor):
    """Per (day, province): running counts per ad and the best ``n`` ads.

    Counts only grow, so the new best are among the old best and the ads a batch touches: nothing
    else is read, however long the day. Rows come out only if the best have changed.
    """

    def __init__(self, n, ttl_days=None):
        self.n, self.ttl_ms = n, ttl_days and int(ttl_days * DAY_MS)

    def init(self, handle):
        self.counts = handle.getMapState("counts", "ad_id bigint", "click_count bigint", self.ttl_ms)
        self.best = handle.getMapState("best", "place int", "ad_id bigint, click_count bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        touched = {}
        for r in rows:
            touched[r.ad_id] = touched.get(r.ad_id, 0) + r.click_count
        for ad, n in touched.items():
            if self.counts.containsKey((ad,)):
                touched[ad] = n + self.counts.getValue((ad,))[0]
            self.counts.updateValue((ad,), (touched[ad],))
        before = []
        while len(before) < self.n and self.best.containsKey((len(before),)):
            before.append(tuple(self.best.getValue((len(before),))))
        after = sorted(({a: c for a, c in before} | touched).items(), key=lambda ad: (-ad[1], ad[0]))[: self.n]
        if after == before:
            return
        for place, (ad, n) in enumerate(after):
            self.best.updateValue((place,), (ad, n))
            yield Row(date=key[0], province=key[1], ad_id=ad, click_count=n)

    def close(self):
        pass


def top_ads(counted, n, ttl_days=None):
    """The best ``n`` ads of every (day, province) whose best changed, over rows (date, province, ad_id, click_count)."""
    return counted.select("date", "province", "ad_id", "click_count").groupBy("date", "province").transformWithState(
        TopAds(n, ttl_days), outputStructType="date string, province string, ad_id bigint, click_count bigint",
        outputMode="update", timeMode="processingTime" if ttl_days else "none",
    )


# -- counts with late clicks on the side

COUNT, LATE = "count", "late"


class MinuteCounts(StatefulProcessor):
    """Per (day, ad): running counts per minute; clicks on minutes the watermark has passed come out as late."""

    def init(self, handle):
        self.handle = handle
        self.counts = handle.getMapState("counts", "minute bigint", "click_count bigint")

    def handleInputRows(self, key, rows, timerValues):
        watermark, touched, late = timerValues.getCurrentWatermarkInMs(), {}, {}
        for r in rows:
            into = late if r.minute_ms + 60_000 <= watermark else touched
            into[r.minute_ms] = into.get(r.minute_ms, 0) + r.click_count
        for minute, n in touched.items():
            if self.counts.containsKey((minute,)):
                n += self.counts.getValue((minute,))[0]
            self.counts.updateValue((minute,), (n,))
            yield Row(kind=COUNT, minute_ms=minute, ad_id=key[1], click_count=n)
        for minute, n in late.items():
            yield Row(kind=LATE, minute_ms=minute, ad_id=key[1], click_count=n)
        if touched:
            # A day counts no more once its last minute has passed.
            self.handle.registerTimer(max(touched) // DAY_MS * DAY_MS + 2 * DAY_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.counts.clear()
        return iter([])

    def close(self):
        pass


def minute_counts_with_late(clicks, lateness):
    """(kind, minute_ms, ad_id, click_count): running counts per minute and ad, and late clicks as such.

    The watermark is kept on a column that is dropped, so that it moves on without late rows being removed.
    """
    marked = clicks.withWatermark("event_time", lateness).withColumn("click_time", F.expr("event_time + INTERVAL '0' SECOND"))
    counted = precounted(marked.drop("event_time").withColumnRenamed("click_time", "event_time"), "ad_id")
    rows = counted.select("date", "ad_id", F.unix_millis("minute").alias("minute_ms"), "click_count")
    return rows.groupBy("date", "ad_id").transformWithState(
        MinuteCounts(), outputStructType="kind string, minute_ms bigint, ad_id bigint, click_count bigint",
        outputMode="update", timeMode="eventTime",
    )
