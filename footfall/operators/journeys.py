"""Ways through the pages, most active sessions, and samples of sessions."""

from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions.numbers import ratio
from footfall.operators.ranking import top_n_per_group
from footfall.operators.sequence import with_previous
from footfall.operators.sessions import session_actions, session_rollup

#: Actions of one session are ordered minute by minute, so that no task orders a whole session.
SLOT_SECONDS = 60


def page_flow_conversion(actions, flow, tie="seq", slot_seconds=SLOT_SECONDS):
    """One row per step of ``flow`` ("1,2,3"): how many visits went on to the next page.

    A move is a page and the one visited directly before it in the session, in the order of
    (action_time, ``tie``). A step's ``base`` is the number of moves along the step before it, of the
    first step the number of visits to its page. The rate is null when the base is 0. A flow of
    fewer than two pages has no step. Actions without session, page or time take no part.
    """
    pages = [int(p) for p in flow.split(",") if p.strip()]
    steps = list(zip(pages, pages[1:]))
    spark = actions.sparkSession
    if not steps:
        return spark.createDataFrame([], _FLOW)
    known = actions.select("session_id", "action_time", tie, "page_id").dropna(subset=["session_id", "action_time", "page_id"])
    slot = F.floor(F.unix_seconds(F.col("action_time").cast("timestamp")) / slot_seconds)
    moves = with_previous(known, "session_id", F.struct("action_time", tie), "page_id", slot, "_from")

    def count(a, b):
        return F.count_if((F.col("_from") == a) & (F.col("page_id") == b))

    counts = moves.agg(
        F.count_if(F.col("page_id") == pages[0]).alias("n0"), *[count(a, b).alias(f"n{i}") for i, (a, b) in enumerate(steps, 1)]
    )
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("step"),
            F.lit(a).cast("bigint").alias("from_page"),
            F.lit(b).cast("bigint").alias("to_page"),
            F.col(f"n{i}").alias("moves"),
            F.col(f"n{i - 1}").alias("base"),
        )
        for i, (a, b) in enumerate(steps, 1)
    ]
    flat = counts.select(F.inline(F.array(*rows)))
    return flat.select("*", ratio(F.col("moves"), F.col("base")).alias("conversion_rate"))


_FLOW = "step bigint, from_page bigint, to_page bigint, moves bigint, base bigint, conversion_rate double"


def top_sessions_per_category(actions, categories, n=K.TOP_CATEGORIES):
    """The ``n`` sessions that clicked most on each of ``categories`` (category_id); ties by session id."""
    clicks = (
        actions.filter(F.col("click_category_id").isNotNull() & F.col("session_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count("*").alias("click_count"))
    )
    wanted = clicks.join(categories.select("category_id"), "category_id", "left_semi")
    return top_n_per_group(wanted, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n)


def session_extract_by_hour(actions, per_hour, seed=0):
    """``per_hour`` sessions of every hour in which sessions start (all of them where there are fewer).

    Drawn by a seeded hash of the session id, so that every run draws the same. Lists are built
    for the drawn sessions only.
    """
    starts = actions.groupBy("session_id").agg(F.min("action_time").alias("start_time"))
    starts = starts.filter(F.col("session_id").isNotNull()).withColumn("hour", F.date_trunc("hour", "start_time"))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), "session_id"))
    drawn = top_n_per_group(starts, ["hour"], [draw, F.col("session_id")], per_hour)
    return session_rollup(session_actions(actions, drawn)).select(
        "session_id", "start_time", "search_keywords", "click_category_ids"
    )
