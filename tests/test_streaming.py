import datetime
import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall import schemas
from footfall.operators import ads, sliding
from footfall.sinks import tables
from footfall.sources.ad_log import ad_log_stream, parse_ad_log
from footfall.streaming import counters, state
from footfall.streaming.ad_stats import AdStatsStore, run_ad_stats, start_events
from tests.test_ads import DAY, T0, line, micro_batches

MINUTE = 60_000


def arrive(spark, folder, lines):
    """One file of log lines."""
    spark.createDataFrame([(v,) for v in lines], schemas.AD_LOG).coalesce(1).write.mode("append").text(folder)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


class Live:
    """The statistics over a folder of log files; every ``send`` is one micro-batch of a restarted query."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        self.store = AdStatsStore(spark, f"{folder}/store")

    def send(self, *lines, events_only=False):
        arrive(self.spark, f"{self.folder}/log", lines)
        stream = ad_log_stream(self.spark, "text", f"{self.folder}/log")
        if events_only:
            self.store.prepare()
            kept = {k: v for k, v in self.options.items() if k in ("threshold", "ttl_days")}
            start_events(stream, self.store, f"{self.folder}/ck", available_now=True, **kept).awaitTermination()
        else:
            run_ad_stats(stream, self.store, f"{self.folder}/ck", available_now=True, **self.options).awaitTermination()


def test_live_statistics_over_restarts(spark, folder):
    seen = {}
    live = Live(spark, folder, threshold=3, publish=lambda name, df, batch: seen.setdefault(name, []).append(rows(df)))
    live.send(*[line()] * 3, "bad", line(T0 + DAY, user=8, ad=8), *[line(ad=a, user=a) for a in (2, 3, 4)])
    assert rows(live.store.blacklist()) == []
    # User 1 exceeds the limit in this batch: all its clicks still count.
    live.send(*[line()] * 4, line(user=2), line(ad=4, user=9), line(ad=4, user=6), line(ad=3, user=7))
    (listed,) = rows(live.store.blacklist())
    assert listed[0] == 1
    # From now on user 1 is dropped.
    live.send(*[line()] * 5, line(user=2), "bad")
    assert rows(live.store.blacklist()) == [listed]
    counts = {(u, a): n for d, u, a, n in rows(live.store.user_counts()) if d == "2024-01-01"}
    assert counts == {(1, 1): 7, (2, 1): 2, (2, 2): 1, (3, 3): 1, (4, 4): 1, (6, 4): 1, (7, 3): 1, (9, 4): 1}
    assert rows(live.store.city_counts()) == [
        ("2024-01-01", "p", "c", 1, 9), ("2024-01-01", "p", "c", 2, 1), ("2024-01-01", "p", "c", 3, 2), ("2024-01-01", "p", "c", 4, 3),
        ("2024-01-02", "p", "c", 8, 1),
    ]
    assert rows(live.store.province_top()) == [
        ("2024-01-01", "p", 1, 9), ("2024-01-01", "p", 3, 2), ("2024-01-01", "p", 4, 3), ("2024-01-02", "p", 8, 1),
    ]
    assert ("2024-01-01", "00", "00", 1, 9) in rows(live.store.trend())
    assert rows(live.store.rejects()) == [("bad", "field count")] * 2
    # Only what a batch changed is handed on; the best ads not at all if they are the same.
    assert seen["ad_blacklist"][1] == [(1,)]
    assert [("2024-01-01", 1, 1, 7)] == [r for r in seen["ad_user_click_count"][1] if r[1] == 1]
    assert ("2024-01-02", "p", 8, 1) in seen["ad_province_top3"][0]
    assert all(r[0] == "2024-01-01" for later in seen["ad_province_top3"][1:] for r in later)


def test_stream_equals_the_batch_model(spark, folder):
    """A hot user sends a third of the clicks; each file is one micro-batch after a restart."""
    rng = random.Random(11)
    clicks = []
    for _ in range(300):
        user = 1 if rng.random() < 0.35 else rng.randrange(2, 12)
        clicks.append((rng.randrange(4), rng.randrange(2), user, rng.randrange(3), rng.choice("ab")))
    listed, accepted = micro_batches(clicks, 5)
    live = Live(spark, folder, threshold=5)
    for batch in range(4):
        lines = [f"{T0 + d * DAY} p {c} {u} {a}" for b, d, u, a, c in clicks if b == batch]
        live.send(*lines, events_only=batch < 3)
    assert {r["user_id"] for r in live.store.blacklist().collect()} == set(listed)
    want = Counter((f"2024-01-0{d + 1}", u, a) for _, d, u, a, _ in accepted)
    got = {(r["date"], r["user_id"], r["ad_id"]): r["click_count"] for r in live.store.user_counts().collect()}
    assert got == want
    want = Counter((f"2024-01-0{d + 1}", c, a) for _, d, _, a, c in accepted)
    got = {(r["date"], r["city"], r["ad_id"]): r["click_count"] for r in live.store.city_counts().collect()}
    assert got == want


def test_a_failing_sink_fails_the_batch_and_is_sent_again(spark, folder):
    down = [True]

    def publish(name, df, batch):
        if name == "ad_stat" and down[0]:
            raise RuntimeError("sink is down")

    live = Live(spark, folder, publish=publish)
    with pytest.raises(Exception, match="sink is down"):
        live.send(line(), line())
    down[0] = False
    live.send()
    assert rows(live.store.city_counts()) == [("2024-01-01", "p", "c", 1, 2)]


def keep_minutes(spark, folder, lines):
    arrive(spark, f"{folder}/log", lines)
    counts = counters.running_minute_counts(parse_ad_log(ad_log_stream(spark, "text", f"{folder}/log")))
    counters.keep_counts(counts, f"{folder}/t", ads.TREND_KEYS, f"{folder}/ck", available_now=True).awaitTermination()


def test_late_clicks_correct_their_minute_until_the_watermark(spark, folder):
    for lines in (
        [line(T0 + 300 * MINUTE)],
        [line(T0 + 301 * MINUTE)],
        # The watermark now stands two hours before minute 301.
        [line(T0 + 300 * MINUTE), line(T0 + 200 * MINUTE), line(T0 + 100 * MINUTE)],
    ):
        keep_minutes(spark, folder, lines)
    assert rows(tables.read_table(spark, f"{folder}/t", schemas.AD_CLICK_TREND)) == [
        ("2024-01-01", "03", "20", 1, 1), ("2024-01-01", "05", "00", 1, 2), ("2024-01-01", "05", "01", 1, 1),
    ]
    # State holds what the watermark (05:01 less two hours) has not passed.
    held = counters.counts_in_state(spark, f"{folder}/ck", ["ad_id"]).select(F.date_format("_start", "HH:mm"), "click_count")
    assert rows(held) == [("03:20", 1), ("05:00", 2), ("05:01", 1)]


def test_late_clicks_come_out_on_the_side(spark, folder):
    sent = [
        [line(T0 + 300 * MINUTE), line(T0 + 300 * MINUTE, ad=2)],
        [line(T0 + 301 * MINUTE), line(T0 + 300 * MINUTE)],
        [line(T0 + 300 * MINUTE), line(T0 + 200 * MINUTE), line(T0 + 100 * MINUTE), line(T0 + 180 * MINUTE), line(T0 + 181 * MINUTE)],
        [line(T0 + 9 * DAY), line(T0 + 100 * MINUTE, ad=7)],
        [line(T0 + 300 * MINUTE)],
    ]
    for lines in sent:
        arrive(spark, f"{folder}/log", lines)
        clicks = parse_ad_log(ad_log_stream(spark, "text", f"{folder}/log"))
        counters.keep_minutes_and_late(clicks, f"{folder}/t", f"{folder}/late", f"{folder}/ck", available_now=True).awaitTermination()
    counts, late = (rows(tables.read_table(spark, f"{folder}/{n}", schemas.AD_CLICK_TREND)) for n in ("t", "late"))
    assert late == [
        ("2024-01-01", "01", "40", 1, 1), ("2024-01-01", "01", "40", 7, 1), ("2024-01-01", "03", "00", 1, 1), ("2024-01-01", "05", "00", 1, 1),
    ]
    assert ("2024-01-01", "05", "00", 1, 3) in counts and ("2024-01-01", "03", "01", 1, 1) in counts
    assert sum(r[-1] for r in counts + late) == sum(map(len, sent))


def test_running_counts_keep_days_and_cities_apart(spark, folder):
    batches = [[line(), line(user=2)], [line(), line(T0 + DAY), line(city="d")]]
    for lines in batches:
        arrive(spark, f"{folder}/log", lines)
        clicks = parse_ad_log(ad_log_stream(spark, "text", f"{folder}/log"))
        for counts, keys, name in (
            (counters.running_user_counts(clicks), ads.USER_KEYS, "u"),
            (counters.running_city_counts(clicks), ads.CITY_KEYS, "c"),
        ):
            counters.keep_counts(counts, f"{folder}/{name}", keys, f"{folder}/ck-{name}", available_now=True).awaitTermination()
    users = tables.read_table(spark, f"{folder}/u", schemas.AD_USER_CLICK_COUNT)
    places = tables.read_table(spark, f"{folder}/c", schemas.AD_STAT)
    assert rows(users) == [("2024-01-01", 1, 1, 3), ("2024-01-01", 2, 1, 1), ("2024-01-02", 1, 1, 1)]
    assert rows(places) == [
        ("2024-01-01", "p", "c", 1, 3), ("2024-01-01", "p", "d", 1, 1), ("2024-01-02", "p", "c", 1, 1),
    ]


def pane_table(spark, clicks, seconds):
    """Panes of (second, ad) clicks."""
    panes = Counter((s - s % seconds, a) for s, a in clicks)
    made = [(datetime.datetime.fromtimestamp(s, datetime.UTC), a, n) for (s, a), n in panes.items()]
    return spark.createDataFrame(made, StructType.fromDDL("pane timestamp, ad_id long, click_count long"))


@pytest.mark.parametrize("minutes, seconds", [(60, 10), (1, 10), (2, 60)])
def test_sliding_windows_at_every_slide(spark, minutes, seconds):
    rng, width = random.Random(minutes), minutes * 60
    base = T0 // 1000
    clicks = [(base + rng.randrange(3 * width), rng.randrange(3)) for _ in range(60)] + [(base - 1, 1), (base, 1), (base + width, 1), (-5, 2)]
    counts = sliding.sliding_counts(pane_table(spark, clicks, seconds), minutes, seconds)
    got = {(r["ad_id"], int(r["slide"].timestamp())): r["click_count"] for r in sliding.at_slides(counts, seconds).collect()}
    want = Counter()
    for s, ad in clicks:
        first = s - s % seconds + seconds
        want.update((ad, slide) for slide in range(first, first + width, seconds))
    assert got == want


def test_a_minute_that_leaves_the_window_keeps_its_count(spark, folder):
    """The reader's window moves on; the stored count of the minute stays whole."""
    keep_minutes(spark, folder, [line(T0)] * 5)
    keep_minutes(spark, folder, [line(T0 + 30 * MINUTE)])
    keep_minutes(spark, folder, [line(T0 + 62 * MINUTE)])
    trend = tables.read_table(spark, f"{folder}/t", schemas.AD_CLICK_TREND)
    assert ("2024-01-01", "00", "00", 1, 5) in rows(trend)
    assert [r[-1] for r in rows(ads.recent_trend(trend, "2024-01-01 01:02"))] == [1, 1]
    clicks = [(T0 // 1000, 1)] * 5 + [(T0 // 1000 + 1800, 1), (T0 // 1000 + 3720, 1)]
    counts = sliding.at_slides(sliding.sliding_counts(pane_table(spark, clicks, 10)))
    at = {r["slide"].strftime("%H:%M:%S"): r["click_count"] for r in counts.collect()}
    assert (at["00:00:10"], at["01:00:00"], at["01:00:10"], at["01:30:10"]) == (5, 6, 1, 1)


def test_sliding_sums_are_split_by_ad_and_window(spark):
    plan = sliding.sliding_counts(pane_table(spark, [(0, 1)], 10))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ad_id" in plan and "_block" in plan and plan.count("Exchange hashpartitioning") <= 2


def test_days_are_those_of_the_session_zone(spark, folder):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        assert counters._day_start(spark) == "57600 seconds"
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert counters._day_start(spark) == "0 seconds"
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        with pytest.raises(ValueError):
            counters._day_start(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ONE_FAMILY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture(params=[None, ONE_FAMILY])
def default_store(spark, request):
    """A session whose state store is Spark's default, unset or named."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, request.param) if request.param else spark.conf.unset(PROVIDER)
    yield request.param
    spark.conf.set(PROVIDER, before)


def test_live_statistics_in_a_session_with_the_default_state_store(spark, folder, default_store):
    live = Live(spark, folder, threshold=3)
    live.send(*[line()] * 4, line(user=2), line(ad=2, user=3), events_only=True)
    live.send(line(), line(user=2))
    assert [r[0] for r in rows(live.store.blacklist())] == [1]
    assert rows(live.store.user_counts()) == [("2024-01-01", 1, 1, 4), ("2024-01-01", 2, 1, 2), ("2024-01-01", 3, 2, 1)]
    assert rows(live.store.city_counts()) == [("2024-01-01", "p", "c", 1, 6), ("2024-01-01", "p", "c", 2, 1)]
    assert rows(live.store.province_top()) == [("2024-01-01", "p", 1, 6), ("2024-01-01", "p", 2, 1)]
    assert rows(live.store.trend()) == [("2024-01-01", "00", "00", 1, 6), ("2024-01-01", "00", "00", 2, 1)]
    assert spark.conf.get(PROVIDER, None) == default_store  # the session's own queries keep their store


def test_processors_need_no_package_on_the_executors(folder):
    """Workers that cannot import the package can still load what a query sends them."""
    sent = cloudpickle.dumps([state.Blacklist(3), state.TopAds(3), state.MinuteCounts()])
    load = "import pickle, sys; print(*[type(p).__name__ for p in pickle.load(sys.stdin.buffer)])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", load], input=sent, cwd=folder, env=env, capture_output=True)
    assert out.stdout.split() == [b"Blacklist", b"TopAds", b"MinuteCounts"], out.stderr.decode()


def test_late_clicks_in_a_session_with_the_default_state_store(spark, folder, default_store):
    for lines in ([line(T0 + 300 * MINUTE)], [line(T0 + 301 * MINUTE)], [line(T0 + 300 * MINUTE), line(T0 + 100 * MINUTE)]):
        arrive(spark, f"{folder}/log", lines)
        clicks = parse_ad_log(ad_log_stream(spark, "text", f"{folder}/log"))
        counters.keep_minutes_and_late(clicks, f"{folder}/t", f"{folder}/late", f"{folder}/ck", available_now=True).awaitTermination()
    counts, late = (rows(tables.read_table(spark, f"{folder}/{n}", schemas.AD_CLICK_TREND)) for n in ("t", "late"))
    assert counts == [("2024-01-01", "05", "00", 1, 2), ("2024-01-01", "05", "01", 1, 1)]
    assert late == [("2024-01-01", "01", "40", 1, 1)]
    assert spark.conf.get(PROVIDER, None) == default_store
