import datetime
import random

from pyspark.sql import functions as F

from footfall.functions import text
from footfall.operators import profiles
from footfall.operators.sequence import with_previous


def text_actions(spark, rows):
    return spark.createDataFrame(rows, "seq long, session_id string, action_time string")


def test_features_of_each_action(spark):
    rows = [
        (1, "s", "2024-01-01 5:00:00"),
        (2, "s", "2024-01-01 5:00:07"),
        (3, "s", "2024-01-01 4:59:59"),
        (4, "s", "soon"),
        (5, "s", "2024-01-01 13:00:00"),
        (6, "t", "2024-01-01 5:00:00"),
    ]
    out = {r["seq"]: r for r in profiles.action_time_features(text_actions(spark, rows), slot_rows=2).collect()}
    assert [out[n]["gap_seconds"] for n in range(1, 7)] == [0, 7, -8, 0, 0, 0]
    assert [out[n]["out_of_order"] for n in range(1, 7)] == [False, False, True, False, False, False]
    assert [out[n]["after_noon"] for n in range(1, 7)] == [False, False, False, False, True, False]
    first = out[1].asDict()
    assert first["date_hour"] == "2024-01-01_05" and first["date_hour_text"] == "2024-01-01_5"
    assert first["date_key"] == "20240101" and first["date_from_key"] == "2024-01-01"
    assert (first["hour"], first["minute"]) == ("05", "00")
    assert out[4]["date"] is None


def test_previous_value_across_slots_matches_brute_force(spark):
    """One key holds a third of the rows and is spread over many slots."""
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.randrange(1000)) for i in range(3000)]
    last, want = {}, {}
    for i, key, value in rows:
        want[i] = last.get(key)
        last[key] = value
    df = spark.createDataFrame(rows, "seq long, key string, v long")
    for width in (1, 7, 500, 10_000):
        got = with_previous(df, "key", "seq", "v", F.floor(F.col("seq") / width), "before")
        assert {r["seq"]: r["before"] for r in got.collect()} == want


def test_quality_counts(spark):
    rows = [("1",), ("",), (None,), ("x",), (",2,",), ("99999999999999999999",)]
    row = profiles.action_quality_profile(spark.createDataFrame(rows, "c string"), ["c"]).first().asDict()
    assert row == {
        "column_name": "c", "row_count": 6, "null_count": 1, "empty_count": 2, "numeric_count": 3,
        "non_numeric_count": 2, "unparsable_count": 4, "comma_edge_count": 1,
    }
    times = spark.createDataFrame([("2024-01-01 1:00:00",), ("x",)], "c string")
    assert profiles.action_quality_profile(times, ["c"], ["c"]).first()["unparsable_count"] == 1


def test_packed_sessions_round_trip(spark):
    df = spark.createDataFrame(
        [(1, "s", ["a", "b"], [3, 20], 5, 2), (2, "t", [], [], 0, 1)],
        "user_id long, session_id string, search_keywords array<string>, click_category_ids array<long>, "
        "visit_length long, step_length long",
    )
    packed = profiles.encode_sessions(df)
    assert packed.orderBy("user_id").first()["packed"] == (
        "session_id=s|search_keyword=a,b|category_ids=20,3|visit_time=5|step_length=2"
    )
    out = profiles.decode_kv(packed, "packed", profiles.SESSION_FIELDS).orderBy("user_id").collect()
    assert [tuple(r) for r in out] == [(1, "s", "a,b", "20,3", 5, 2), (2, "t", None, None, 0, 1)]


def test_packed_values_may_hold_the_separators(spark):
    rows = [("a=b",), ("a|b",), ("100%|=%7C",), ("",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    packed = df.select("v", text.encode_kv({"v": "v", "n": F.lit(1)}).alias("packed"))
    out = profiles.decode_kv(packed.withColumnRenamed("v", "was"), "packed", {"v": "string", "n": "int"}).collect()
    assert [(r["v"], r["n"]) for r in out] == [(r[0] or None, 1) for r in rows]
