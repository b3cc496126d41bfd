import datetime

import pytest
from pyspark.sql import functions as F

from footfall.functions import labels, numbers, text, times


@pytest.fixture
def apply(spark):
    """Value of a Column expression over one text column ``c``."""

    def run(values, build, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        return [r["out"] for r in df.select("i", build("c").alias("out")).orderBy("i").collect()]

    return run


def test_emptiness(apply):
    assert apply([None, "", " ", "a"], text.is_empty) == [True, True, False, False]
    assert apply([None, "", " ", "a"], text.is_not_empty) == [False, False, True, True]


def test_trim_comma_takes_at_most_one_from_each_side(apply):
    assert apply([",,a,,", "a", ",", "", ",a,b,", None], text.trim_comma) == [",a,", "a", "", "", "a,b", None]


def test_zero_fill_never_truncates(apply):
    assert apply(["7", "42", "123", ""], text.zero_fill) == ["07", "42", "0123", "0"]


def test_is_numeric(apply):
    assert apply(["12", "", "1.5", "-3", "a", None, "12\n"], text.is_numeric) == [
        True, True, False, False, False, False, False,
    ]


def test_split_list_drops_blanks(apply):
    assert apply(["a,b,,", ",a", "", None], text.split_list) == [["a", "b"], ["a"], [], None]
    assert apply(["a b", "x_y"], lambda c: text.split_list(c, " ")) == [["a", "b"], ["x_y"]]


def test_real_list(apply):
    assert apply(["1,2", "", "null", "NULL", None], text.is_real_list) == [True, False, False, False, False]


def test_concat_long_string(spark):
    df = spark.sql("select * from values (1L, 'north'), (null, 'x'), (3L, null) as t(n, s)")
    assert [r[0] for r in df.select(text.concat_long_string("n", "s", ":")).collect()] == ["1:north", "null:x", None]


def test_kv_get(apply):
    packed = ["a=1|b=|c=x=y|a=2|d=4", "b=5", "", None]
    assert apply(packed, lambda c: text.kv_get(c, "a")) == ["1", None, None, None]
    assert apply(packed, lambda c: text.kv_get(c, "b")) == [None, "5", None, None]
    assert apply(packed, lambda c: text.kv_get(c, "c")) == [None, None, None, None]
    assert apply(["a=1,b=2"], lambda c: text.kv_get(c, "b", ",")) == ["2"]


def test_kv_set_changes_the_first_match_only(apply):
    assert apply(["a=1|b=2|a=3", "b=2"], lambda c: text.kv_set(c, "a", F.lit(9))) == ["a=9|b=2|a=3", "b=2"]
    assert apply(["a=1,b=2"], lambda c: text.kv_set(c, "b", F.lit("z"), ",")) == ["a=1|b=z"]


def test_encode_and_get_are_inverse(apply):
    encode = lambda c: text.kv_get(text.encode_kv({"k": F.col(c), "n": F.lit(3)}), "k")
    assert apply(["v", None, ""], encode) == ["v", None, None]


def test_json_field(apply):
    docs = ['{"s": 1}', '{"s": "x"}', "{bad", "{}", None]
    assert apply(docs, lambda c: text.json_field(c, "s")) == ["1", "x", None, None, None]


def test_group_concat_distinct_is_a_true_set(spark):
    df = spark.createDataFrame([("11:x",), ("1:x",), ("11:x",), (None,)], "c string")
    assert df.agg(text.group_concat_distinct("c")).first()[0] == "11:x,1:x"


def test_sql_functions(spark):
    text.register_sql_functions(spark)
    row = spark.sql(
        "select concat_long_string(7, 'a', ':') a, json_field('{\"s\": 0}', 's') b, sorted_csv(array('b', 'a')) c"
    ).first()
    assert tuple(row) == ("7:a", "0", "a,b")


def test_parse_time(apply):
    out = apply(["2024-01-01 5:00:01", "2024-01-01 15:00:01", "soon", None], times.parse_time)
    assert out == [datetime.datetime(2024, 1, 1, 5, 0, 1), datetime.datetime(2024, 1, 1, 15, 0, 1), None, None]


def test_time_formats(apply):
    at = ["2024-03-09 7:05:09"]
    shown = {
        times.format_time: "2024-03-09 07:05:09",
        times.format_date: "2024-03-09",
        times.format_date_key: "20240309",
        times.format_hour_key: "2024030907",
        times.format_minute_key: "202403090705",
        times.date_hour: "2024-03-09_07",
    }
    for show, want in shown.items():
        assert apply(at, lambda c: show(times.parse_time(c))) == [want]
    assert apply(at, times.date_hour_text) == ["2024-03-09_7"]


def test_parse_date_key(apply):
    assert apply(["20240309", "2024-03-09", "x"], times.parse_date_key) == [datetime.date(2024, 3, 9), None, None]


def test_before_after_minus(spark):
    rows = [("2024-01-01 00:00:10", "2024-01-01 00:00:04"), ("bad", "2024-01-01 00:00:04"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string").select(
        times.parse_time("a").alias("a"), times.parse_time("b").alias("b")
    )
    out = df.select(times.before("a", "b"), times.after("a", "b"), times.minus("a", "b")).collect()
    assert [tuple(r) for r in out] == [(False, True, 6), (False, False, 0), (False, False, 0)]


def test_millis(apply):
    values = [0, -1, 1704067199999, 2**63 - 1, None]
    out = apply(values, lambda c: times.format_time(times.millis_to_timestamp(c)), "bigint")
    assert out == ["1970-01-01 00:00:00", "1969-12-31 23:59:59", "2023-12-31 23:59:59", None, None]


def test_ratio_is_half_up_and_null_on_zero(spark):
    df = spark.sql("select * from values (1L, 200L), (3L, 200L), (1L, 3L), (5L, 5L), (0L, 0L) as t(n, total)")
    out = [r[0] for r in df.select(numbers.ratio(F.col("n"), F.col("total"))).collect()]
    assert out == [0.01, 0.02, 0.33, 1.0, None]


def test_ratio_is_exact_for_large_counts(spark):
    df = spark.range(1).select(numbers.ratio(F.lit(2**54 + 1), F.lit(2**55)))
    assert df.first()[0] == 0.5


def test_format_double(apply):
    assert apply([1.005, 2.345, -1.5], lambda c: numbers.format_double(F.col(c), 1), "double") == [1.0, 2.3, -1.5]
    assert apply([0.125], lambda c: numbers.format_double(F.col(c), 2), "double") == [0.13]


def test_area_level(apply):
    names = ["China North", "China East", "China South", "China Middle", "West North", "West South", "Moon", None]
    assert apply(names, labels.area_level) == [
        "A Level", "A Level", "B Level", "B Level", "C Level", "C Level", "D Level", "D Level",
    ]
    assert apply(["x"], lambda c: labels.area_level(c, {})) == ["D Level"]


def test_product_status(apply):
    docs = ['{"product_status": 0}', '{"product_status": 1}', '{"product_status": "zero"}', "{", None]
    own, other = "自营商品", "第三方商品"
    assert apply(docs, labels.product_status) == [own, other, other, other, other]
