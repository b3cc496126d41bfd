import pytest
from pyspark.sql import functions as F

from footfall.checks import settings as P
from footfall.checks.queries import QUERIES
from footfall.operators import ads, sessions
from footfall.operators.sessions import session_facts, top_categories
from footfall.params import TaskParams
from footfall.plans.session_job import filtered_sessions, profiled_sessions, session_report
from footfall.sinks.tables import store_bucketed
from footfall.sources.event_tables import EventTables
from footfall.sources.tables import scan_actions, scan_clicks
from footfall.workdir import new_dir, stage_table, work_root
from footfall import schemas

SF = "/root/testdata/sf0.001"
LAZY = [n for n in QUERIES if not n.startswith(("stream_", "sink_"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_pairs_all_rows_or_leaves_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


@pytest.fixture
def stored_actions(spark, folder):
    rows = [(f"2024-01-0{d}", 1, "s", 1, None, None, 1, 1, None, None, None, None, 1) for d in range(1, 6)]
    df = spark.createDataFrame(rows, schemas.USER_VISIT_ACTION)
    df.write.partitionBy("date").parquet(f"{folder}/actions")
    return spark.read.schema(schemas.USER_VISIT_ACTION).parquet(f"{folder}/actions")


def test_scans_prune_days_and_columns(stored_actions):
    plan = plan_of(scan_clicks(stored_actions, "2024-01-02", "2024-01-03"))
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "IsNotNull(click_product_id)" in plan
    assert "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in plan
    facts = session_facts(scan_actions(stored_actions, "2024-01-02", "2024-01-03"), TaskParams())
    assert "ReadSchema: struct<user_id:bigint,session_id:string,action_time:timestamp>" in plan_of(facts)


def test_session_facts_stay_in_hash_aggregation(stored_actions):
    plan = plan_of(session_facts(stored_actions, TaskParams(keywords=("a",), category_ids=("1",))))
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_top_categories_take_the_top_without_a_full_sort(spark):
    df = spark.createDataFrame([(1, 1, 1, 1)], "category_id long, click_count long, order_count long, pay_count long")
    assert "TakeOrderedAndProject" in plan_of(top_categories(df))


def test_hot_user_is_split_in_the_blacklist_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        # User 0 holds more than a third of the clicks.
        user = F.when(F.col("id") % 5 < 2, F.lit(0)).otherwise(F.col("id") % 1000)
        clicks = spark.range(0, 200_000, 1, 8).select(user.alias("user_id"), F.xxhash64("id").alias("pad"))
        listed = spark.range(0, 2000, 2).select((F.col("id") + 1).alias("user_id"))
        kept = ads.drop_blacklisted(clicks, listed)
        want = sum(1 for i in range(200_000) if (0 if i % 5 < 2 else i % 1000) % 2 == 0)
        assert len(kept.collect()) == want
        assert "skew=true" in plan_of(kept)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_date_ranges_and_clicks_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = plan_of(QUERIES["scan_actions_by_date"](spark, SF))
        assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
        plan = plan_of(QUERIES["scan_clicks"](spark, SF))
        assert "EqualTo(event_type,click)" in plan and "LessThan(ts," in plan
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_replay_and_look_back_read_the_log_once(spark):
    for name in ("blacklist_replay_accepted", "action_hourly_profile"):
        df = QUERIES[name](spark, SF)
        df.collect()
        assert "ReusedExchange" in plan_of(df)


def test_staged_tables_live_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_root(spark) == named.rstrip("/")
    assert new_dir(spark, "x").startswith(work_root(spark))
    assert new_dir(spark, "x") != new_dir(spark, "x")
    staged = stage_table(spark.range(3), "three")
    assert staged.count() == 3 and "FileScan" in plan_of(staged)


def test_lengths_are_counted_while_sessions_are_written(spark, sessions_input):
    """The shares come from metrics on the side: their frame scans nothing."""
    actions, users = sessions_input
    report = session_report(actions, users, P.AGE, 7)
    plan = plan_of(report["session_aggr_stat"])
    assert "Scan parquet" not in plan and "HashAggregate" not in plan
    got = report["session_aggr_stat"].drop("task_id").collect()
    assert got == sessions.session_length_stats(filtered_sessions(actions, users, P.AGE)).collect()


def test_stored_buckets_save_the_shuffle_of_the_log(spark, sessions_input, folder):
    actions, _ = sessions_input
    stored = store_bucketed(actions, f"{folder}/actions", "session_id", 16)
    chosen = spark.read.schema("session_id string").parquet(_ids(spark, folder))
    joined = sessions.session_actions(stored, chosen.hint("merge"))
    plan = plan_of(joined)
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 16 out of 16" in plan
    assert sorted(joined.collect(), key=repr) == sorted(sessions.session_actions(actions, chosen).collect(), key=repr)
    shuffles = lambda frame: plan_of(sessions.session_rollup(frame)).count("hashpartitioning(session_id")
    assert shuffles(stored) < shuffles(actions)


def test_a_bloom_filter_of_the_chosen_sessions_reaches_the_log(spark, sessions_input, folder):
    """Rows of other sessions are dropped before the shuffle, and the result stays the same."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    actions, users = sessions_input
    actions.write.parquet(f"{folder}/log")
    log = spark.read.schema(actions.schema).parquet(f"{folder}/log")
    narrow = TaskParams(start_age=30, end_age=31)
    sessions.mark_sessions(profiled_sessions(log, users, narrow), narrow).select("session_id", "chosen").write.parquet(
        f"{folder}/marked"
    )
    marked = spark.read.schema("session_id string, chosen int").parquet(f"{folder}/marked")
    chosen = sessions.chosen_sessions(marked)
    want = sorted(sessions.session_actions(log, chosen).collect(), key=repr)
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sent = {}
        for enabled in ("false", "true"):
            spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", enabled)
            joined = sessions.session_actions(log, chosen)
            assert sorted(joined.collect(), key=repr) == want
            assert ("might_contain" in plan_of(joined)) == (enabled == "true")
            sent[enabled] = max(rows_shuffled(joined))
        assert sent["false"] == log.count()
        assert 0 < len(want) <= sent["true"] < sent["false"] / 4
    finally:
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_shuffled(df):
    """Rows written by every shuffle of an executed frame."""
    found, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(node.plan())
        elif name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return found


def _ids(spark, folder):
    spark.createDataFrame([(f"{u}_2024-01-01",) for u in range(20)], "session_id string").write.parquet(f"{folder}/ids")
    return f"{folder}/ids"


@pytest.fixture
def sessions_input(spark):
    t = EventTables(spark, "/root/testdata/sf0.001")
    return t.actions, t.users
