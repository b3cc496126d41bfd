import datetime
import random
from collections import Counter, defaultdict

import pytest

from footfall.operators import journeys as J
from footfall.schemas import USER_VISIT_ACTION

START = datetime.datetime(2024, 1, 1)


def frame(spark, rows):
    """``rows``: (seq, session, seconds, page, category)."""
    full = [
        ("2024-01-01", 1, s, page, None if at is None else START + datetime.timedelta(seconds=at), None, category, *[None] * 6, seq)
        for seq, s, at, page, category in rows
    ]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in USER_VISIT_ACTION.fields)
    return spark.createDataFrame(full, names + ", seq bigint")


def some_rows(n=3000, seed=3):
    """A third of all rows in one session, many equal times."""
    rng = random.Random(seed)
    return [
        (i, "hot" if i % 3 == 0 else f"s{rng.randrange(200)}", rng.randrange(4000), rng.randrange(4), rng.choice([None, 1, 2, 3]))
        for i in range(n)
    ]


@pytest.mark.parametrize("flow", ["0,1,2,3", "1,1", "2,0,2,0", "9,1"])
def test_page_flow_is_brute_force(spark, flow):
    rows = some_rows()
    visits, moves = Counter(), Counter()
    by_session = defaultdict(list)
    for seq, s, at, page, _ in rows:
        by_session[s].append((at, seq, page))
        visits[page] += 1
    for way in by_session.values():
        pages = [p for _, _, p in sorted(way)]
        moves.update(zip(pages, pages[1:]))
    pages = [int(p) for p in flow.split(",")]
    base, want = visits[pages[0]], []
    for i, step in enumerate(zip(pages, pages[1:]), 1):
        n = moves[step]
        want.append((i, *step, n, base, (200 * n + base) // (2 * base) / 100 if base else None))
        base = n
    for seconds in (1, 60, 10_000):
        got = J.page_flow_conversion(frame(spark, rows), flow, slot_seconds=seconds)
        assert sorted(map(tuple, got.collect())) == want


def test_page_flow_without_rows_pages_or_keys(spark):
    assert J.page_flow_conversion(frame(spark, some_rows(5)), "7").collect() == []
    got = J.page_flow_conversion(frame(spark, []), "1,2").collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 0, 0, None)]
    rows = [(0, "a", 1, 1, None), (1, None, 2, 2, None), (2, "a", 3, None, None), (3, "a", None, 2, None), (4, "a", 4, 2, None)]
    assert [tuple(r) for r in J.page_flow_conversion(frame(spark, rows), "1,2").collect()] == [(1, 1, 2, 1, 1, 1.0)]


def test_top_sessions_break_ties_by_id(spark):
    rows = some_rows() + [(9000, None, 1, 1, 1)]
    categories = spark.createDataFrame([(1,), (3,), (8,)], "category_id bigint")
    counts = Counter((c, s) for _, s, _, _, c in rows if c in (1, 3) and s)
    want = []
    for c in (1, 3):
        ranked = sorted((-n, s) for (k, s), n in counts.items() if k == c)[:4]
        want += [(c, s, -n) for n, s in ranked]
    got = J.top_sessions_per_category(frame(spark, rows), categories, 4)
    assert sorted(map(tuple, got.select("category_id", "session_id", "click_count").collect())) == sorted(want)


def test_extract_draws_the_same_number_in_every_hour(spark):
    rows = some_rows()
    starts = {}
    for _, s, at, _, _ in rows:
        starts[s] = min(at, starts.get(s, at))
    hours = Counter(at // 3600 for at in starts.values())
    draws = [J.session_extract_by_hour(frame(spark, rows), 5).collect() for _ in range(2)]
    assert sorted(draws[0]) == sorted(draws[1])
    got = Counter((r.start_time - START).seconds // 3600 for r in draws[0])
    assert got == {h: min(5, n) for h, n in hours.items()}
    assert all((r.start_time - START).seconds == starts[r.session_id] for r in draws[0])
    assert J.session_extract_by_hour(frame(spark, []), 5).collect() == []
