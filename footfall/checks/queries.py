"""One callable ``(spark, folder) -> DataFrame`` per operator, over whole tables."""

from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall import constants as K
from footfall import schemas
from footfall.checks import settings as P
from footfall.functions import labels, text
from footfall.functions.times import format_time
from footfall.operators import ads, journeys, products, profiles, sessions, sliding
from footfall.params import task_parameters as parsed_parameters
from footfall.plans.product_job import run_product_job
from footfall.plans.session_job import filtered_sessions, run_session_job
from footfall.sinks import tables as sinks
from footfall.sources import tables
from footfall.sources.ad_log import ad_log_stream, parse_ad_log, rejected_lines
from footfall.sources.event_tables import EventTables
from footfall.streaming import counters
from footfall.streaming.ad_stats import AdStatsStore, start_events, start_tables
from footfall.workdir import new_dir

QUERIES = {}


def query(build):
    """Register ``build(tables)`` under its own name."""

    def run(spark, folder):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(EventTables(spark, folder))

    QUERIES[build.__name__] = run
    return run


_NULLABLE_IDS = ("click_category_id", "click_product_id")


def _as_text(df):
    """Times, lists and ids that may be null as text, which every engine shows alike."""
    out = []
    for field in df.schema.fields:
        kind, c = field.dataType.simpleString(), F.col(field.name)
        if kind.startswith("timestamp"):
            c = format_time(c).alias(field.name)
        elif field.name in _NULLABLE_IDS:
            c = c.cast("string").alias(field.name)
        elif kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), ",").alias(field.name)
        out.append(c)
    return df.select(*out)


# -- scans and products


@query
def scan_actions_by_date(t):
    return _as_text(tables.scan_actions(t.actions, *P.SOME_DAYS, time_column="action_time"))


@query
def scan_clicks(t):
    return tables.scan_clicks(t.click_actions, *P.SOME_DAYS, time_column="action_time")


def _clicks(t):
    return tables.clicks(t.click_actions)


@query
def clicks_with_city(t):
    return products.clicks_with_city(_clicks(t), t.cities)


@query
def product_status(t):
    return t.products.select("product_id", labels.product_status("extend_info").alias("product_status"))


@query
def product_status_sql(t):
    """Status of every product as SQL text, with the registered JSON function."""
    text.register_sql_functions(t.spark)
    return t.spark.sql(
        "SELECT product_id, if(json_field(extend_info, 'product_status') <=> '0', :own, :third) AS product_status FROM {products}",
        args={"own": K.SELF_OPERATED, "third": K.THIRD_PARTY},
        products=t.products,
    )


@query
def area_level(t):
    level = labels.area_level("area", P.AREA_LEVELS, P.OTHER_LEVEL)
    return t.cities.select("city_id", "area", level.alias("area_level"))


@query
def area_product_clicks(t):
    return products.area_product_clicks(_clicks(t), t.cities)


@query
def area_product_full(t):
    return products.area_product_full(products.area_product_clicks(_clicks(t), t.cities), t.products)


@query
def area_top3_products(t):
    return products.area_top_products(_clicks(t), t.cities, t.products, levels=P.AREA_LEVELS, other=P.OTHER_LEVEL)


@query
def area_top3_products_sales(t):
    return products.area_top_products(
        t.sales_clicks, t.cities, t.products, levels=P.AREA_LEVELS, other=P.OTHER_LEVEL
    )


@query
def area_product_clicks_sql(t):
    """The report as SQL text, with the registered SQL functions."""
    text.register_sql_functions(t.spark)
    return t.spark.sql(
        "SELECT area, product_id, count(*) AS click_count, "
        "listagg(DISTINCT city_info, ',') WITHIN GROUP (ORDER BY city_info) AS city_infos "
        "FROM (SELECT area, product_id, concat_long_string(city_id, city_name, ':') AS city_info "
        "FROM {clicks} JOIN {cities} USING (city_id)) GROUP BY area, product_id",
        clicks=_clicks(t),
        cities=t.cities,
    )


# -- sessions


@query
def session_rollup(t):
    return _as_text(sessions.session_rollup(t.actions))


@query
def session_enriched(t):
    return _as_text(sessions.enrich_sessions(sessions.session_rollup(t.actions), t.users))


def _filtered(t, params):
    """Through the full rollup, whose sets the list filters look into."""
    enriched = sessions.enrich_sessions(sessions.session_rollup(t.actions), t.users)
    return _as_text(sessions.filter_sessions(enriched, params))


@query
def filter_by_age(t):
    return _filtered(t, P.AGE)


@query
def filter_by_profession_city(t):
    return _filtered(t, P.PROFESSION_CITY)


@query
def filter_by_sex(t):
    return _filtered(t, P.SEX)


@query
def filter_by_keyword_category(t):
    return _filtered(t, P.KEYWORD_CATEGORY)


@query
def filter_sessions_all(t):
    return _filtered(t, P.ALL_FILTERS)


def _chosen(t, params=None):
    return filtered_sessions(t.actions, t.users, params or P.ALL_FILTERS)


@query
def filter_sessions_facts(t):
    """The same filters over the fixed-width rollup the session job uses."""
    return _chosen(t).select("session_id", "user_id", "visit_length", "step_length")


@query
def session_length_counts(t):
    return sessions.session_length_counts(_chosen(t, P.AGE))


@query
def session_length_counts_hours(t):
    """The same report with hour-scale and single-step buckets."""
    return sessions.session_length_counts(_chosen(t, P.AGE), P.HOUR_BUCKETS, P.SINGLE_STEPS)


@query
def session_length_ratios(t):
    return sessions.session_length_stats(_chosen(t, P.AGE))


@query
def filtered_session_actions(t):
    return _as_text(sessions.session_actions(t.actions, _chosen(t)))


def _visited(t):
    return sessions.visited_in_sessions(t.actions, _chosen(t, P.AGE))


@query
def visited_categories(t):
    return sessions.visited_categories(_visited(t))


@query
def click_category_counts(t):
    return sessions.click_category_counts(_visited(t))


@query
def order_category_counts(t):
    return sessions.order_category_counts(_visited(t))


@query
def pay_category_counts(t):
    return sessions.pay_category_counts(_visited(t))


@query
def category_counts(t):
    return sessions.category_counts(_visited(t))


@query
def page_flow_conversion(t):
    return journeys.page_flow_conversion(t.numbered_actions, P.PAGE_FLOW)


@query
def top10_sessions_per_category(t):
    categories = sessions.top_categories(sessions.category_counts(t.actions))
    return journeys.top_sessions_per_category(t.actions, categories)


@query
def session_extract_by_hour(t):
    return _as_text(journeys.session_extract_by_hour(t.actions, P.SESSIONS_AN_HOUR))


@query
def top10_categories(t):
    return sessions.top_categories(sessions.category_counts(_visited(t)))


@query
def sample_actions(t):
    return _as_text(sessions.sample_actions(t.numbered_actions, keys=["seq"], digest="md5"))


# -- reports over the raw log


def _text_actions(t):
    lenient = F.date_format("action_time", "yyyy-MM-dd H:mm:ss")
    return t.numbered_actions.withColumn("action_time", lenient)


@query
def action_time_features(t):
    return profiles.action_time_features(_text_actions(t))


@query
def action_hourly_profile(t):
    return profiles.action_hourly_profile(profiles.action_time_features(_text_actions(t)))


@query
def action_quality_profile(t):
    padded = F.concat(F.lit(","), "pay_category_ids", F.lit(","))
    actions = _text_actions(t).withColumn("padded_ids", padded)
    return profiles.action_quality_profile(actions, P.PROFILED_COLUMNS, time_columns=["action_time"])


@query
def decode_kv_table(t):
    packed = profiles.encode_sessions(sessions.session_rollup(t.actions))
    return profiles.decode_kv(packed, "packed", profiles.SESSION_FIELDS)


@query
def task_parameters(t):
    """One task per user, about people like them; some documents are cut off, no object, or missing."""
    own = F.struct(
        F.lit(P.SOME_DAYS[0]).alias("startDate"),
        (F.col("age") - 5).alias("startAge"),
        (F.col("age") + 5).cast("string").alias("endAge"),
        F.concat("professional", F.lit(",,other")).alias("professionals"),
        F.col("city").alias("cities"),
        F.when(F.col("user_id") % 3 == 0, "").otherwise(F.col("sex")).alias("sex"),
        F.when(F.col("user_id") % 2 == 0, "many").otherwise("1,2").alias("categoryIds"),
    )
    document = F.to_json(own)
    kind = F.col("user_id") % 7
    document = F.when(kind == 0, F.left(document, F.lit(30))).when(kind == 1, F.concat(F.lit("["), document, F.lit("]"))).when(kind != 2, document)
    parsed = parsed_parameters(t.users.select(F.col("user_id").alias("task_id"), document.alias("task_param")))
    ages = {name: F.col(name).cast("string") for name in ("start_age", "end_age")}
    return _as_text(parsed.withColumns(ages))


@query
def edit_kv_table(t):
    packed = profiles.encode_sessions(sessions.session_rollup(t.actions))
    doubled = text.kv_get("packed", "step_length").try_cast("bigint") * 2
    return packed.select("user_id", text.kv_set("packed", "step_length", doubled).alias("packed"))


# -- ad statistics


def _ad_clicks(t):
    return parse_ad_log(t.ad_log())


def _numbered_clicks(t):
    """Clicks with the number of the micro-batch they arrive in."""
    return parse_ad_log(t.ad_log(P.batch_number("ts").alias("batch")), "batch")


def _spelled_out(clicks):
    millis = F.unix_millis("event_time").alias("event_millis")
    return clicks.select(millis, *ads.minute_parts("event_time"), "*")


@query
def ad_log_parsed(t):
    return _spelled_out(_ad_clicks(t)).drop("event_time")


@query
def ad_log_rejects(t):
    """Lines broken in a different way for each event type."""
    kind, value = F.col("event_type"), F.col("value")
    broken = (
        F.when(kind == "error", F.concat(value, F.lit(" extra")))
        .when(kind == "signup", F.concat(F.lit("t"), value))
        .when(kind == "purchase", F.regexp_replace(value, r" (\d+) (\d+)$", " u$1 $2"))
        .when(kind == "view", F.concat(value, F.lit("x")))
        .otherwise(value)
    )
    return rejected_lines(t.ad_log("event_type").select(broken.alias("value")))


@query
def ad_user_click_count(t):
    return ads.user_click_counts(_ad_clicks(t))


def _blacklist(t):
    return ads.blacklist(ads.user_click_counts(_ad_clicks(t)), P.THRESHOLD)


@query
def ad_blacklist(t):
    return _blacklist(t)


@query
def ad_clicks_not_blacklisted(t):
    return _spelled_out(ads.drop_blacklisted(_ad_clicks(t), _blacklist(t))).drop("event_time")


@query
def ad_city_click_count(t):
    return ads.city_click_counts(_ad_clicks(t))


def _province_counts(clicks):
    return ads.province_click_counts(ads.city_click_counts(clicks))


@query
def ad_province_click_count(t):
    return _province_counts(_ad_clicks(t))


@query
def ad_province_top3(t):
    return ads.province_top_ads(_province_counts(_ad_clicks(t)))


@query
def ad_click_trend(t):
    return ads.click_trend(_ad_clicks(t))


@query
def ad_recent_trend(t):
    return ads.recent_trend(ads.click_trend(_ad_clicks(t)))


@query
def blacklist_replay(t):
    """First offending batch per user, were the log streamed in batches."""
    return ads.first_offences(ads.batch_counts(_numbered_clicks(t)), P.THRESHOLD)


@query
def blacklist_replay_accepted(t):
    """Clicks per city that such a live run counts."""
    counts = ads.batch_counts(_numbered_clicks(t))
    accepted = ads.accepted_counts(counts, ads.first_offences(counts, P.THRESHOLD))
    return accepted.groupBy(*ads.CITY_KEYS).agg(F.sum("click_count").alias("click_count"))


# -- jobs and sinks


def _session_job(t, table):
    out = new_dir(t.spark, "session-job")
    options = {"sample_keys": ["session_id", "action_time", "page_id"], "digest": "md5"}
    run_session_job(
        t.actions,
        t.users,
        P.AGE,
        P.TASK_ID,
        lambda name, frame: sinks.append_table(frame, f"{out}/{name}") if name == table else None,
        **options,
    )
    return t.spark.read.parquet(f"{out}/{table}")


@query
def sink_append_session_aggr_stat(t):
    return _session_job(t, "session_aggr_stat")


@query
def sink_append_session_detail(t):
    return _as_text(_session_job(t, "session_detail"))


@query
def sink_append_top10_category(t):
    return _session_job(t, "top10_category")


@query
def sink_append_area_top3_product(t):
    out = new_dir(t.spark, "product-job")
    run_product_job(
        t.actions,
        t.cities,
        t.products,
        P.AGE,
        P.TASK_ID,
        lambda name, frame: sinks.append_table(frame, f"{out}/{name}", schemas.AREA_TOP3_PRODUCT),
        levels=P.AREA_LEVELS,
        other=P.OTHER_LEVEL,
    )
    return t.spark.read.parquet(f"{out}/area_top3_product")


def _halves(t):
    clicks = _numbered_clicks(t)
    return clicks.filter(F.col("batch") < P.SECOND_HALF), clicks.filter(F.col("batch") >= P.SECOND_HALF), clicks


@query
def top10_categories_bucketed(t):
    """Top categories of the filtered sessions, from actions stored in buckets of their session."""
    stored = sinks.store_bucketed(t.actions, new_dir(t.spark, "bucketed-actions"), "session_id", P.BUCKETS)
    chosen = filtered_sessions(stored, t.users, P.AGE)
    return sessions.top_categories(sessions.category_counts(sessions.visited_in_sessions(stored, chosen)))


@query
def sink_upsert_replace(t):
    """Running totals: the second write carries only the keys that changed."""
    early, late, every = _halves(t)
    changed = ads.city_click_counts(every).join(ads.city_click_counts(late), ads.CITY_KEYS, "left_semi")
    path = new_dir(t.spark, "upsert-replace")
    sinks.upsert_table(ads.city_click_counts(early), path, ads.CITY_KEYS, 0)
    sinks.upsert_table(changed, path, ads.CITY_KEYS, 1)
    return sinks.read_table(t.spark, path, schemas.AD_STAT)


@query
def sink_upsert_add(t):
    """Increments, the second write delivered twice."""
    early, late, _ = _halves(t)
    path = new_dir(t.spark, "upsert-add")
    for number, part in ((0, early), (1, late), (1, late)):
        sinks.upsert_table(ads.user_click_counts(part), path, ads.USER_KEYS, number, how="add")
    return sinks.read_table(t.spark, path, schemas.AD_USER_CLICK_COUNT)


@query
def sink_insert_new(t):
    early, _, every = _halves(t)
    path = new_dir(t.spark, "insert-new")
    for number, part in ((0, early), (1, every), (1, every)):
        listed = ads.blacklist(ads.user_click_counts(part), P.THRESHOLD)
        sinks.insert_new(listed, path, ["user_id"], number)
    return sinks.read_table(t.spark, path, schemas.AD_BLACKLIST)


@query
def sink_replace_groups(t):
    early, late, every = _halves(t)
    path = new_dir(t.spark, "replace-groups")
    keys = ["date", "province"]
    changed = ads.province_top_ads(_province_counts(every)).join(
        ads.city_click_counts(late).select(*keys), keys, "left_semi"
    )
    sinks.replace_groups(ads.province_top_ads(_province_counts(early)), path, keys, 0)
    sinks.replace_groups(changed, path, keys, 1)
    return sinks.read_table(t.spark, path, schemas.AD_PROVINCE_TOP3)


# -- streams


_STREAMED = {}


def _streamed(t, name, build):
    """What ``build(folder)`` gives after it has streamed the log, once per session and state of the tables."""
    key = (t.spark.sparkContext.applicationId, t.folder, t.version("events", "nation", "region"), name)
    if key not in _STREAMED:
        _STREAMED[key] = build(new_dir(t.spark, name))
    return _STREAMED[key]


def _arrive(t, folder, batch, *starts):
    """Let the log arrive in ``folder`` batch by batch; each of ``starts`` resumes a query that takes all new files."""
    log = t.ad_log(batch.alias("batch"))
    for number in sorted(r["batch"] for r in log.select("batch").distinct().collect()):
        log.filter(F.col("batch") == number).select("value").write.mode("append").text(folder)
        for running in [start() for start in starts]:
            running.awaitTermination()


@contextmanager
def _closed_stores(spark):
    """Runs started within take one batch each, so their state stores are closed with it and not kept open for a next one."""
    name = "spark.sql.streaming.stateStore.unloadOnCommit"
    usual = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def _live(t):
    """The statistics after the whole log was streamed in, restarted after every batch."""

    def build(root):
        store = AdStatsStore(t.spark, f"{root}/tables")
        store.prepare()
        with _closed_stores(t.spark):
            _arrive(t, f"{root}/log", P.batch_number("ts"), lambda: start_events(
                ad_log_stream(t.spark, "text", f"{root}/log"), store, f"{root}/ck", P.THRESHOLD, available_now=True
            ))
            start_tables(store, f"{root}/ck", available_now=True).awaitTermination()
        return store

    return _streamed(t, "ad-stats", build)


@query
def stream_ad_user_click_count(t):
    return _live(t).user_counts()


@query
def stream_ad_blacklist(t):
    return _live(t).blacklist().select("user_id")


@query
def stream_ad_city_click_count(t):
    return _live(t).city_counts()


@query
def stream_ad_province_top3(t):
    return _live(t).province_top()


@query
def stream_ad_click_trend(t):
    return _live(t).trend()


_RUNNING = {
    "ad_user_click_count": (counters.running_user_counts, schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS),
    "ad_stat": (counters.running_city_counts, schemas.AD_STAT, ads.CITY_KEYS),
    "ad_click_trend": (counters.running_minute_counts, schemas.AD_CLICK_TREND, ads.TREND_KEYS),
    "ad_click_panes": (counters.running_pane_counts, counters.PANES, counters.PANE_KEYS),
}


def _running(t):
    """Folder of the tables and checkpoints of the native counters, after the whole log was streamed in."""

    def build(root):
        def starter(name):
            count, _, keys = _RUNNING[name]
            clicks = parse_ad_log(ad_log_stream(t.spark, "text", f"{root}/log"))
            return lambda: counters.keep_counts(
                count(clicks), f"{root}/{name}", keys, f"{root}/ck-{name}", available_now=True,
                partitions=t.spark.sparkContext.defaultParallelism,
            )

        t.spark.createDataFrame([], schemas.AD_LOG).write.text(f"{root}/log")
        _arrive(t, f"{root}/log", P.batch_number("ts", 9), *[starter(n) for n in _RUNNING])
        return root

    return _streamed(t, "running-counts", build)


def _running_table(t, name):
    schema = _RUNNING[name][1]
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return sinks.read_table(t.spark, f"{_running(t)}/{name}", schema)


@query
def stream_running_user_counts(t):
    return _running_table(t, "ad_user_click_count")


@query
def stream_running_city_counts(t):
    return _running_table(t, "ad_stat")


@query
def stream_minute_counts_watermark(t):
    return _running_table(t, "ad_click_trend")


@query
def stream_sliding_trend(t):
    """Clicks of the last hour at every slide of ten seconds, from the panes a stream keeps."""
    counts = sliding.sliding_counts(_running_table(t, "ad_click_panes"))
    return counts.select("ad_id", format_time("first_slide").alias("first_slide"), format_time("last_slide").alias("last_slide"), "click_count")


@query
def stream_pane_counts_in_state(t):
    """Panes that the stream still holds in its state, read from the checkpoint."""
    counts = counters.counts_in_state(t.spark, f"{_running(t)}/ck-ad_click_panes", ["ad_id"])
    return counts.select(format_time("_start").alias("pane"), "ad_id", "click_count")


@query
def stream_minute_counts_late(t):
    """Minute counts and late clicks of a log in which every seventh event arrives a batch late."""

    def build(root):
        t.spark.createDataFrame([], schemas.AD_LOG).write.text(f"{root}/log")
        batch = P.batch_number("ts") + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
        clicks = parse_ad_log(ad_log_stream(t.spark, "text", f"{root}/log"))
        with _closed_stores(t.spark):
            _arrive(t, f"{root}/log", batch, lambda: counters.keep_minutes_and_late(
                clicks, f"{root}/counts", f"{root}/late", f"{root}/ck", available_now=True,
                partitions=t.spark.sparkContext.defaultParallelism,
            ))
        return root

    root = _streamed(t, "late-clicks", build)
    read = lambda name: sinks.read_table(t.spark, f"{root}/{name}", schemas.AD_CLICK_TREND)
    late = read("late").groupBy(*ads.TREND_KEYS).agg(F.sum("click_count").alias("click_count"))
    kinds = [F.lit(k).alias("kind") for k in ("count", "late")]
    return read("counts").select(kinds[0], "*").unionByName(late.select(kinds[1], "*"))
