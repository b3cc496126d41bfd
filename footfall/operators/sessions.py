"""Session rollup, filters, length statistics and category counts."""

import re
from functools import reduce

from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions import labels, text, times
from footfall.functions.numbers import ratio
from footfall.operators.ranking import sample_exact


def _spans():
    return [
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count("*").alias("step_length"),
    ]


def _with_visit_length(sessions):
    length = times.whole_seconds("end_time") - times.whole_seconds("start_time")
    return sessions.withColumn("visit_length", length)


def session_rollup(actions):
    """One row per session: user, distinct keywords and clicked categories, start, end, lengths.

    Actions are first combined per (session, keyword, category), so the task that builds a
    session's lists receives distinct values only, however many actions the session has.
    """
    keyword = F.when(text.is_not_empty("search_keyword"), F.col("search_keyword"))
    combined = actions.groupBy("session_id", keyword.alias("_keyword"), "click_category_id").agg(*_spans())
    sessions = (
        combined.repartition("session_id")
        .groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
            F.sum("step_length").alias("step_length"),
            F.array_sort(F.collect_set("_keyword")).alias("search_keywords"),
            F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
        )
    )
    return _with_visit_length(sessions)


def session_facts(actions, params):
    """What filtering and the length statistics need of a session, at a fixed width.

    Instead of the sets of keywords and categories it carries whether any wanted one occurs, so
    the aggregation buffer does not grow with the session.
    """
    hits = []
    if params.keywords is not None:
        hit = F.col("search_keyword").isin(list(params.keywords)) & text.is_not_empty("search_keyword")
        hits.append(F.coalesce(F.bool_or(hit), F.lit(False)).alias("keyword_hit"))
    if params.category_ids is not None:
        wanted = F.col("click_category_id").isin(_ids(params.category_ids))
        hits.append(F.coalesce(F.bool_or(wanted), F.lit(False)).alias("category_hit"))
    return _with_visit_length(actions.groupBy("session_id").agg(*_spans(), *hits))


def enrich_sessions(sessions, users):
    """Join the user's profile; sessions of unknown users are dropped."""
    profile = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(profile, "user_id")


def session_predicate(params, columns, one_sided=False):
    """Conjunction of the filters that ``params`` switches on, as one Column.

    ``columns`` are those of the frame it is applied to: either the sets of ``session_rollup``
    or the hit flags of ``session_facts``. A missing bound switches the age filter off unless
    ``one_sided`` is set. Null data fails an active filter.
    """
    tests = []
    low, high = params.start_age, params.end_age
    if one_sided or (low is not None and high is not None):
        tests += [F.col("age") >= low] if low is not None else []
        tests += [F.col("age") <= high] if high is not None else []
    if params.professionals is not None:
        tests.append(F.col("professional").isin(list(params.professionals)))
    if params.cities is not None:
        tests.append(F.col("city").isin(list(params.cities)))
    if params.sex is not None:
        tests.append(F.col("sex") == params.sex)
    if params.keywords is not None:
        tests.append(
            F.col("keyword_hit")
            if "keyword_hit" in columns
            else _overlaps("search_keywords", list(params.keywords), "string")
        )
    if params.category_ids is not None:
        tests.append(
            F.col("category_hit")
            if "category_hit" in columns
            else _overlaps("click_category_ids", _ids(params.category_ids), "bigint")
        )
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def filter_sessions(sessions, params, one_sided=False):
    """Keep the sessions that pass every active filter."""
    return sessions.filter(session_predicate(params, sessions.columns, one_sided))


def _ids(values):
    """The ids among the texts: those a BIGINT would be written as."""
    return [int(v) for v in values if re.fullmatch(r"-?(0|[1-9][0-9]*)", v) and -(1 << 63) <= int(v) < 1 << 63 and v != "-0"]


def _overlaps(column, values, element):
    wanted = F.array(*[F.lit(v) for v in values]).cast(f"array<{element}>")
    return F.coalesce(F.arrays_overlap(F.col(column), wanted), F.lit(False))


def mark_sessions(sessions, params, one_sided=False):
    """``sessions`` with ``chosen``: 1 for those that pass every active filter, else 0.

    A stored list that is filtered by its mark tells the optimizer that it is selective, so that a join
    with the log may send a runtime Bloom filter of its keys to the scan; a list of chosen rows only does not.
    """
    passes = session_predicate(params, sessions.columns, one_sided)
    return sessions.withColumn("chosen", F.when(passes, 1).otherwise(0))


def chosen_sessions(marked):
    return marked.filter(F.col("chosen") == 1)


def length_metrics(visit_buckets=None, step_buckets=None, where=None):
    """Aggregates of session count and sessions per visit- and step-length bucket, for ``agg`` or ``observe``.

    ``where``: count only the sessions for which it holds.
    """
    where = F.lit(True) if where is None else where
    visit_buckets = K.VISIT_LENGTH_BUCKETS if visit_buckets is None else visit_buckets
    step_buckets = K.STEP_LENGTH_BUCKETS if step_buckets is None else step_buckets
    return [
        F.count_if(where).alias("session_count"),
        *[
            F.count_if(where & labels.in_bucket("visit_length", bounds)).alias(f"visit_length_{name}")
            for name, bounds in visit_buckets.items()
        ],
        *[
            F.count_if(where & labels.in_bucket("step_length", bounds)).alias(f"step_length_{name}")
            for name, bounds in step_buckets.items()
        ],
    ]


def session_length_counts(sessions, visit_buckets=None, step_buckets=None):
    """Session count and the number of sessions per visit- and step-length bucket, in one row."""
    return sessions.agg(*length_metrics(visit_buckets, step_buckets))


def observed_length_counts(spark, observation):
    """The row of ``session_length_counts`` as an ``observe`` of ``length_metrics`` has counted it on the side."""
    counted = observation.get
    return spark.createDataFrame([tuple(counted.values())], ", ".join(f"{name} long" for name in counted))


def session_length_ratios(counts):
    """Each bucket's share of the sessions, two decimals; null when there are no sessions."""
    buckets = [c for c in counts.columns if c != "session_count"]
    return counts.select(
        "session_count", *[ratio(F.col(c), F.col("session_count")).alias(f"{c}_ratio") for c in buckets]
    )


def session_length_stats(sessions):
    return session_length_ratios(session_length_counts(sessions))


def session_actions(actions, sessions):
    """The actions that belong to the given sessions."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def visited_in_sessions(actions, sessions):
    """Category columns of the sessions' actions, rows without any category left out beforehand."""
    touching = actions.filter(
        F.col("click_category_id").isNotNull()
        | text.is_real_list("order_category_ids")
        | text.is_real_list("pay_category_ids")
    ).select("session_id", "click_category_id", "order_category_ids", "pay_category_ids")
    return session_actions(touching, sessions)


def _events(actions):
    """One row per (category, kind) an action touches."""
    lists = actions.select(
        F.stack(
            F.lit(3),
            F.lit("click"),
            F.col("click_category_id").cast("string"),
            F.lit("order"),
            F.col("order_category_ids"),
            F.lit("pay"),
            F.col("pay_category_ids"),
        ).alias("kind", "ids")
    )
    return _ids_of(lists.filter(text.is_real_list("ids")), "ids", "kind")


def _ids_of(rows, column, *keep):
    """One row per id in a comma list; entries that are not ids are left out."""
    entries = rows.select(*keep, F.explode(text.split_list(column)).alias("_id"))
    return entries.select(*keep, text.to_long("_id").alias("category_id")).filter(F.col("category_id").isNotNull())


def visited_categories(actions):
    """Distinct categories clicked, ordered or paid for."""
    return _events(actions).select("category_id").distinct()


def click_category_counts(actions):
    return (
        actions.filter(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"))
        .agg(F.count("*").alias("click_count"))
    )


def _list_counts(actions, column, alias):
    return (
        _ids_of(actions.filter(text.is_real_list(column)), column)
        .groupBy("category_id")
        .agg(F.count("*").alias(alias))
    )


def order_category_counts(actions):
    return _list_counts(actions, "order_category_ids", "order_count")


def pay_category_counts(actions):
    return _list_counts(actions, "pay_category_ids", "pay_count")


def category_counts(actions):
    """Clicks, orders and payments per visited category in one pass; an absent kind counts 0."""
    return (
        _events(actions)
        .groupBy("category_id")
        .agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in ("click", "order", "pay")])
    )


def top_categories(counts, n=K.TOP_CATEGORIES):
    """The ``n`` categories with most clicks, then orders, then payments; ties by id."""
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]
    return counts.orderBy(*order).limit(n)


SAMPLE_KEYS = ["session_id", "action_time", "page_id"]


def sample_actions(actions, n=K.SAMPLED_ACTIONS, seed=0, keys=None, digest="xxhash64"):
    """A reproducible sample of exactly ``n`` actions (all of them when there are fewer)."""
    return sample_exact(actions, keys or SAMPLE_KEYS, n, seed, digest)
