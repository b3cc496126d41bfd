import datetime
import random
from collections import Counter, defaultdict

import pytest

from footfall import constants as K
from footfall import schemas
from footfall.operators import sessions as S
from footfall.params import TaskParams
from footfall.plans.session_job import filtered_sessions, run_session_job, session_report
from footfall.sources.tables import scan_actions, scan_clicks

START = datetime.datetime(2024, 1, 1)


def action(session="s", user=1, second=0.0, page=1, word=None, category=None, product=None, order=None, pay=None,
           date="2024-01-01", city=1):
    at = START + datetime.timedelta(seconds=second)
    return (date, user, session, page, at, word, category, product, order, order, pay, pay, city)


@pytest.fixture
def actions(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.USER_VISIT_ACTION)


@pytest.fixture
def users(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.USER_INFO)


def one_row(df):
    return df.collect()[0].asDict()


def test_date_scan_includes_both_ends(actions):
    df = actions([action(date=f"2024-01-0{d}", product=d) for d in range(1, 6)])
    assert sorted(r["date"] for r in scan_actions(df, "2024-01-02", "2024-01-04").collect()) == [
        "2024-01-02", "2024-01-03", "2024-01-04",
    ]
    assert sorted(r["product_id"] for r in scan_clicks(df, "2024-01-05", "2024-01-09").collect()) == [5]


def test_visit_length_bucket_edges(actions):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    rows = [action(f"s{n}", second=at) for n in lengths for at in (0, n)]
    counts = one_row(S.session_length_counts(S.session_rollup(actions(rows))))
    assert counts["session_count"] == len(lengths)
    assert [counts[f"visit_length_{b}"] for b in K.VISIT_LENGTH_BUCKETS] == [2, 2, 2, 2, 2, 2, 2, 2, 1]


def test_step_length_bucket_edges(actions):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    rows = [action(f"s{n}") for n in steps for _ in range(n)]
    counts = one_row(S.session_length_counts(S.session_rollup(actions(rows))))
    assert [counts[f"step_length_{b}"] for b in K.STEP_LENGTH_BUCKETS] == [2, 2, 2, 2, 2, 1]


def test_length_cuts_each_time_to_whole_seconds(actions):
    rows = [action("a", second=0.9), action("a", second=1.1), action("b", second=0.1), action("b", second=0.9)]
    out = {r["session_id"]: r["visit_length"] for r in S.session_rollup(actions(rows)).collect()}
    assert out == {"a": 1, "b": 0}


def test_keywords_and_categories_are_sets(actions):
    rows = [action(word=w, category=c) for w, c in
            [("kw11", 12), ("kw1", 1), ("", None), (None, 1), ("kw11", 2), ("kw1", None)]]
    row = one_row(S.session_rollup(actions(rows)))
    assert row["search_keywords"] == ["kw1", "kw11"]
    assert row["click_category_ids"] == [1, 2, 12]
    assert row["user_id"] == 1 and row["step_length"] == 6


def profile(user, age=30, job="it", city="x", sex="male"):
    return (user, f"u{user}", f"n{user}", age, job, city, sex)


FILTERS = [
    (TaskParams(), {"s1", "s2", "s3", "s4"}),
    (TaskParams(start_age=20, end_age=30), {"s1", "s2"}),
    (TaskParams(start_age=30), {"s1", "s2", "s3", "s4"}),
    (TaskParams(professionals=("it", "ops")), {"s1", "s3"}),
    (TaskParams(cities=("y",)), {"s2"}),
    (TaskParams(sex="female"), {"s3"}),
    (TaskParams(keywords=("kw1",)), {"s1"}),
    (TaskParams(keywords=("kw9", "kw11")), {"s2"}),
    (TaskParams(category_ids=("5", "x")), {"s1"}),
    (TaskParams(category_ids=("x",)), set()),
    (TaskParams(start_age=20, end_age=40, professionals=("it",), cities=("x",), sex="male", keywords=("kw1",),
                category_ids=("5",)), {"s1"}),
]


@pytest.mark.parametrize("params,expected", FILTERS)
def test_filters_agree_on_both_rollups(actions, users, params, expected):
    acts = actions([
        action("s1", 1, word="kw1", category=5), action("s2", 2, word="kw11", category=55),
        action("s3", 3), action("s4", 4, category=None), action("s5", 99, word="kw1", category=5),
    ])
    people = users([profile(1), profile(2, 20, None, "y"), profile(3, 31, "ops", sex="female"),
                    profile(4, None, "", None, None)])
    full = S.filter_sessions(S.enrich_sessions(S.session_rollup(acts), people), params)
    assert {r["session_id"] for r in full.collect()} == expected
    assert {r["session_id"] for r in filtered_sessions(acts, people, params).collect()} == expected


def test_one_sided_age(actions, users):
    acts = actions([action("s1", 1), action("s2", 2), action("s3", 3)])
    people = users([profile(1, 20), profile(2, 40), profile(3, None)])
    chosen = filtered_sessions(acts, people, TaskParams(start_age=30), one_sided=True)
    assert [r["session_id"] for r in chosen.collect()] == ["s2"]


CATEGORY_ROWS = [
    dict(category=1), dict(category=1), dict(category=None), dict(order="1,2"), dict(order="2"), dict(order=""),
    dict(order="null"), dict(order="NULL"), dict(order="x,,"), dict(pay="3"), dict(pay=None), dict(category=4, pay="4"),
]


def test_category_counts(actions):
    acts = actions([action(**r) for r in CATEGORY_ROWS])
    got = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"]) for r in S.category_counts(acts).collect()}
    assert got == {1: (2, 1, 0), 2: (0, 2, 0), 3: (0, 0, 1), 4: (1, 0, 1)}
    assert sorted(r[0] for r in S.visited_categories(acts).collect()) == [1, 2, 3, 4]
    assert dict(tuple(r) for r in S.click_category_counts(acts).collect()) == {1: 2, 4: 1}
    assert dict(tuple(r) for r in S.order_category_counts(acts).collect()) == {1: 1, 2: 2}
    assert dict(tuple(r) for r in S.pay_category_counts(acts).collect()) == {3: 1, 4: 1}


def test_top_categories_order_and_ties(spark):
    rows = [(1, 5, 1, 1), (2, 5, 2, 0), (3, 5, 1, 1), (4, 2**33, 0, 0), (5, 5, 1, 2)]
    df = spark.createDataFrame(rows, "category_id long, click_count long, order_count long, pay_count long")
    assert [r["category_id"] for r in S.top_categories(df, 4).collect()] == [4, 2, 5, 1]


def test_sample_is_exact_and_repeatable(actions):
    acts = actions([action(f"s{i}", second=i, page=i) for i in range(50)])
    first = S.sample_actions(acts, 10, seed=3).collect()
    assert len(first) == 10
    assert S.sample_actions(acts.repartition(7), 10, seed=3).collect() == first
    assert S.sample_actions(acts, 10, seed=4).collect() != first
    assert S.sample_actions(acts, 500).count() == 50


def test_report_on_no_rows(actions, users, spark):
    report = session_report(actions([]), users([]), TaskParams("2024-01-01", "2024-01-02"), 1)
    stats = one_row(report["session_aggr_stat"])
    assert stats["session_count"] == 0 and stats["task_id"] == 1
    assert all(v is None for k, v in stats.items() if k.endswith("_ratio"))
    assert report["session_detail"].count() == 0 and report["top10_category"].count() == 0


def test_job_writes_tables_in_sink_order(actions, users):
    acts = actions([action("s1", 1, second=n, category=5, word="w", page=n) for n in range(3)])
    out = {}
    run_session_job(acts, users([profile(1)]), TaskParams("2024-01-01", "2024-01-01"), 9, out.__setitem__)
    assert out["session_aggr_stat"].schema.names == schemas.SESSION_AGGR_STAT.names
    assert out["session_detail"].schema.names == schemas.SESSION_DETAIL.names
    assert out["top10_category"].schema.names == schemas.TOP10_CATEGORY.names
    assert one_row(out["session_aggr_stat"])["visit_length_1s_3s_ratio"] == 1.0
    assert [r["action_time"] for r in out["session_detail"].orderBy("action_time").collect()][0] == "2024-01-01 00:00:00"
    assert one_row(out["top10_category"]) == {
        "task_id": 9, "category_id": 5, "click_count": 3, "order_count": 0, "pay_count": 0,
    }


def test_one_session_and_one_user_hold_a_third_of_the_rows(actions, users):
    """Brute force over a skewed log: nothing is lost or double counted."""
    rng = random.Random(5)
    rows = [action("hot", 1, second=rng.randrange(5000), category=rng.randrange(4), order="7,8", page=i)
            for i in range(1000)]
    for i in range(2000):
        n = rng.randrange(400)
        rows.append(action(f"s{n}", n % 50, second=rng.randrange(5000), category=rng.choice([None, 1, 2, 9]), page=i))
    people = [profile(n, age=n) for n in range(50)]
    report = session_report(actions(rows), users(people), TaskParams("2024-01-01", "2024-01-01", 0, 24), 1)

    by_session = defaultdict(list)
    for r in rows:
        by_session[r[2]].append(r)
    kept = {s for s, rs in by_session.items() if min(r[1] for r in rs) <= 24}
    clicks = Counter(r[6] for r in rows if r[2] in kept and r[6] is not None)
    orders = Counter(c for r in rows if r[2] in kept and r[8] for c in (7, 8))
    want = {c: (clicks[c], orders[c], 0) for c in {*clicks, *orders}}
    got = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"])
           for r in report["top10_category"].collect()}
    assert got == want
    assert one_row(report["session_aggr_stat"])["session_count"] == len(kept)


def test_ids_are_what_a_bigint_is_written_as():
    assert S._ids(("-1", "0", "12", "²", "007", "-0", "x", "", "9" * 30)) == [-1, 0, 12]
