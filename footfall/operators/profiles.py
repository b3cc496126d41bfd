"""Reports over the raw action log: time features, hourly load, field quality, packed records."""

from pyspark.sql import functions as F

from footfall.functions import text, times
from footfall.operators.sequence import with_previous


def action_time_features(actions, slot_rows=1_000_000):
    """Time parts of each action and its distance to the session's previous one in log order.

    ``actions`` needs ``seq`` (position in the log), ``session_id`` and ``action_time`` as text.
    """
    timed = actions.select("seq", "session_id", "action_time", times.parse_time("action_time").alias("_t"))
    slot = F.floor(F.col("seq") / slot_rows)
    timed = with_previous(timed, "session_id", "seq", "_t", slot, "_before")
    noon = F.date_trunc("day", "_t") + F.expr("INTERVAL 12 HOURS")
    return timed.select(
        "seq",
        "session_id",
        times.format_time("_t").alias("action_time"),
        times.format_date("_t").alias("date"),
        times.format_date_key("_t").alias("date_key"),
        times.format_date(times.parse_date_key(times.format_date_key("_t"))).alias("date_from_key"),
        times.date_hour("_t").alias("date_hour"),
        times.date_hour_text("action_time").alias("date_hour_text"),
        times.format_hour_key("_t").alias("hour_key"),
        times.format_minute_key("_t").alias("minute_key"),
        text.zero_fill(F.hour("_t").cast("string")).alias("hour"),
        text.zero_fill(F.minute("_t").cast("string")).alias("minute"),
        times.minus("_t", "_before").alias("gap_seconds"),
        times.before("_t", "_before").alias("out_of_order"),
        times.after("_t", noon).alias("after_noon"),
    )


def action_hourly_profile(features):
    """Load per hour: actions, sessions started in order, total and longest gap."""
    return features.groupBy("date_hour").agg(
        F.count("*").alias("actions"),
        F.count_if("out_of_order").alias("out_of_order"),
        F.sum("gap_seconds").alias("gap_seconds"),
        F.max("gap_seconds").alias("longest_gap"),
    )


def action_quality_profile(actions, columns, time_columns=()):
    """Per text column: rows, nulls, empties, digit-only values, values that do not parse.

    A column in ``time_columns`` is tested as a time, any other as a number. One pass over the
    table; each input partition sends one row to the shuffle.
    """
    def measures(name):
        c = F.col(name).cast("string")
        empty, numeric = text.is_empty(c), text.is_numeric(c)
        parses = (times.parse_time(c) if name in time_columns else text.to_long(c)).isNotNull()
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count("*").alias("row_count"),
            F.count_if(c.isNull()).alias("null_count"),
            F.count_if(empty).alias("empty_count"),
            F.count_if(numeric).alias("numeric_count"),
            F.count_if(~empty & ~numeric).alias("non_numeric_count"),
            F.count_if(c.isNotNull() & ~parses).alias("unparsable_count"),
            F.count_if(F.coalesce(text.trim_comma(c) != c, F.lit(False))).alias("comma_edge_count"),
        )

    return actions.agg(F.array(*[measures(c) for c in columns]).alias("_all")).select(F.inline("_all"))


SESSION_FIELDS = {
    "session_id": "string",
    "search_keyword": "string",
    "category_ids": "string",
    "visit_time": "bigint",
    "step_length": "bigint",
}


def encode_sessions(sessions):
    """Rolled-up sessions as ``user_id`` and one packed ``name=value|...`` text."""
    fields = {
        "session_id": "session_id",
        "search_keyword": text.sorted_csv("search_keywords"),
        "category_ids": text.sorted_csv(F.col("click_category_ids").cast("array<string>")),
        "visit_time": "visit_length",
        "step_length": "step_length",
    }
    columns = {k: F.col(v) if isinstance(v, str) else v for k, v in fields.items()}
    return sessions.select("user_id", text.encode_kv(columns).alias("packed"))


def decode_kv(df, column, fields, sep="|"):
    """Text packed by ``encode_kv`` to typed columns; a field that is absent, empty or unparsable is null."""
    kept = [c for c in df.columns if c != column]
    return df.select(
        *kept, *[text.kv_unescape(text.kv_get(column, n, sep), sep).try_cast(k).alias(n) for n, k in fields.items()]
    )
