import random
from collections import Counter, defaultdict

import pytest

from footfall import schemas
from footfall.operators import ads
from footfall.sources.ad_log import kafka_options, parse_ad_log, rejected_lines

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def line(ms=T0, province="p", city="c", user=1, ad=1):
    return f"{ms} {province} {city} {user} {ad}"


@pytest.fixture
def log(spark):
    return lambda lines: spark.createDataFrame([(v,) for v in lines], schemas.AD_LOG)


@pytest.fixture
def clicks(log):
    return lambda lines: parse_ad_log(log(lines))


def test_malformed_lines_are_set_aside(log):
    bad = {
        "1 p c 1": "field count",
        "1 p c 1 2 3": "field count",
        "": "field count",
        "soon p c 1 1": "timestamp",
        f"{2**63 - 1} p c 1 1": "timestamp",
        "99999999999999999999 p c 1 1": "timestamp",
        "1  c 1 x": "ad id",
        "1 p c u1 1": "user id",
    }
    lines = log([line(), line(-1), line() + "  ", line(province="A_B", city="x_y"), *bad])
    assert {r["value"]: r["reason"] for r in rejected_lines(lines).collect()} == bad
    good = parse_ad_log(lines).collect()
    assert len(good) == 4
    assert ("A_B", "x_y") in {(r["province"], r["city"]) for r in good}


def test_null_line_is_rejected(log):
    assert rejected_lines(log([None])).first()["reason"] == "field count"
    assert parse_ad_log(log([None])).count() == 0


def test_days_split_at_midnight(clicks):
    df = clicks([line(T0 - 1), line(T0), line(T0 + DAY - 1), line(-1)])
    assert {r["date"]: r["click_count"] for r in ads.user_click_counts(df).collect()} == {
        "2023-12-31": 1, "2024-01-01": 2, "1969-12-31": 1,
    }


def test_blacklist_threshold_is_strict(clicks):
    lines = [line(user=1)] * 100 + [line(user=2)] * 101 + [line(user=3, ad=a % 2) for a in range(150)]
    counts = ads.user_click_counts(clicks(lines))
    assert [r["user_id"] for r in ads.blacklist(counts).collect()] == [2]
    left = ads.drop_blacklisted(clicks(lines), ads.blacklist(counts))
    assert {r["user_id"] for r in left.collect()} == {1, 3}


def test_top_ads_per_day_and_province(clicks):
    lines = [line(ad=a) for a in (4, 3, 2, 1, 1)] + [line(T0 + DAY, ad=9), line(province="q", ad=7)]
    top = ads.province_top_ads(ads.province_click_counts(ads.city_click_counts(clicks(lines)))).collect()
    assert sorted((r["date"], r["province"], r["ad_id"], r["click_count"]) for r in top) == [
        ("2024-01-01", "p", 1, 2), ("2024-01-01", "p", 2, 1), ("2024-01-01", "p", 3, 1),
        ("2024-01-01", "q", 7, 1), ("2024-01-02", "p", 9, 1),
    ]


def test_cities_fold_into_provinces(clicks):
    lines = [line(city="a"), line(city="b"), line(city="b")]
    out = ads.province_click_counts(ads.city_click_counts(clicks(lines))).collect()
    assert [(r["province"], r["click_count"]) for r in out] == [("p", 3)]


def test_recent_trend_covers_sixty_minutes(clicks):
    minute = 60_000
    end = T0 + 10 * minute  # 00:10, the window reaches into the day before
    trend = ads.click_trend(clicks([line(end), line(end + minute - 1), line(end - 59 * minute), line(end - 59 * minute - 1)]))
    got = {(r["date"], r["hour"], r["minute"]): r["click_count"] for r in ads.recent_trend(trend).collect()}
    assert got == {("2024-01-01", "00", "10"): 2, ("2023-12-31", "23", "11"): 1}
    early = ads.recent_trend(trend, now="2023-12-31 23:30")
    assert early.count() == 2
    assert ads.recent_trend(ads.click_trend(clicks([]))).count() == 0


def micro_batches(rows, threshold):
    """The live rule, one batch after another."""
    listed, counts, accepted = {}, Counter(), []
    by_batch = defaultdict(list)
    for row in rows:
        by_batch[row[0]].append(row)
    for batch in sorted(by_batch):
        at_start = set(listed)
        kept = [r for r in by_batch[batch] if r[2] not in at_start]
        accepted += kept
        for _, day, user, ad, _ in kept:
            counts[day, user, ad] += 1
        for (day, user, ad), n in counts.items():
            if n > threshold:
                listed.setdefault(user, batch)
    return listed, accepted


@pytest.mark.parametrize("seed", range(4))
def test_closed_form_equals_batch_by_batch(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        user = 1 if rng.random() < 0.35 else rng.randrange(12)
        rows.append((rng.randrange(5), rng.randrange(3), user, rng.randrange(3), rng.choice("ab")))
    listed, accepted = micro_batches(rows, 6)
    data = [(b, f"{T0 + d * DAY} p {c} {u} {a}") for b, d, u, a, c in rows]
    clicks = parse_ad_log(spark.createDataFrame(data, "batch long, value string"), "batch")
    counts = ads.batch_counts(clicks)
    offences = ads.first_offences(counts, 6)
    assert dict(tuple(r) for r in offences.collect()) == listed
    got = {(r["batch"], r["date"], r["city"], r["user_id"], r["ad_id"]): r["click_count"]
           for r in ads.accepted_counts(counts, offences).collect()}
    assert got == Counter((b, f"2024-01-0{d + 1}", c, u, a) for b, d, u, a, c in accepted)


def test_empty_log(clicks):
    df = clicks([])
    counts = ads.user_click_counts(df)
    assert counts.count() == 0 and ads.blacklist(counts).count() == 0
    assert ads.province_top_ads(ads.province_click_counts(ads.city_click_counts(df))).count() == 0


def test_kafka_options_take_several_topics():
    assert kafka_options("h:1,h:2", ["a", "b"]) == {"kafka.bootstrap.servers": "h:1,h:2", "subscribe": "a,b"}
    assert kafka_options("h:1", "a")["subscribe"] == "a"
