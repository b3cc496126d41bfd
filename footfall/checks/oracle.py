"""SQL for DuckDB that gives the rows each named query must give."""

from footfall import constants as K
from footfall.checks import settings as P

# -- input tables

_VIEWS = {
    "ev": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               strftime(ts, '%Y-%m-%d') AS day FROM events""",
    "user_visit_action": """
        SELECT event_id AS seq, day AS date, user_id, CAST(user_id AS VARCHAR) || '_' || day AS session_id,
               k % 10 AS page_id, ts AS action_time,
               CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 12 AS VARCHAR) END AS search_keyword,
               CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
               CASE WHEN event_type = 'click' THEN k END AS click_product_id,
               CASE WHEN event_type = 'purchase'
                    THEN CAST(k % 20 AS VARCHAR) || ',' || CAST((k + 7) % 20 AS VARCHAR) END AS order_category_ids,
               CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS order_product_ids,
               CASE WHEN event_type = 'signup' THEN CAST((k + 3) % 20 AS VARCHAR) END AS pay_category_ids,
               CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
               user_id % 27 AS city_id
        FROM ev""",
    "user_info": """
        SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
               CAST(floor(abs(c_acctbal)) AS INTEGER) % 60 AS age, c_mktsegment AS professional,
               'city' || CAST(c_nationkey AS VARCHAR) AS city,
               CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
        FROM customer""",
    "product_info": f"""
        SELECT p_partkey AS product_id, p_name AS product_name,
               CASE WHEN p_size % 5 <> 0 AND p_size % 2 = 0 THEN '{K.SELF_OPERATED}'
                    ELSE '{K.THIRD_PARTY}' END AS product_status
        FROM part""",
    "city_info": """
        SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "sales_click": """
        SELECT CAST(c_nationkey AS BIGINT) AS city_id, l_partkey AS product_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "click": """
        SELECT city_id, click_product_id AS product_id FROM user_visit_action
        WHERE click_product_id IS NOT NULL""",
    "session": """
        SELECT session_id, min(user_id) AS user_id, min(action_time) AS t0, max(action_time) AS t1,
               epoch_us(max(action_time)) // 1000000 - epoch_us(min(action_time)) // 1000000 AS visit_length,
               count(*) AS step_length,
               coalesce(string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword), '') AS search_keywords,
               list_sort(list(DISTINCT click_category_id) FILTER (click_category_id IS NOT NULL)) AS categories,
               list(search_keyword) FILTER (search_keyword IS NOT NULL) AS keywords
        FROM user_visit_action GROUP BY session_id""",
    "enriched": """
        SELECT s.*, age, professional, city, sex FROM session s JOIN user_info USING (user_id)""",
    "log_line": """
        SELECT ev.* EXCLUDE (value), CAST(epoch_us(ts) // 1000 AS VARCHAR) || ' ' || replace(r_name, ' ', '-') || ' '
               || replace(n_name, '_', '-') || ' ' || CAST(user_id AS VARCHAR) || ' ' || CAST(k % 5 AS VARCHAR) AS value
        FROM ev JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "ad_click": f"""
        SELECT event_id, CAST(p[1] AS BIGINT) AS event_millis, strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%Y-%m-%d') AS date,
               strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%H') AS hour,
               strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%M') AS minute,
               p[2] AS province, p[3] AS city, CAST(p[4] AS BIGINT) AS user_id, CAST(p[5] AS BIGINT) AS ad_id,
               (epoch_us(ts) // 1000000 - {P.FIRST_SECOND}) // {P.BATCH_SECONDS} AS batch
        FROM (SELECT event_id, ts, string_split(value, ' ') AS p FROM log_line)""",
    "arrived": "SELECT *, batch + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS arrival FROM ad_click",
    "marks": """
        SELECT arrival, max(max(event_millis)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - 7200000 AS mark
        FROM arrived GROUP BY arrival""",
    "user_count": """
        SELECT date, user_id, ad_id, count(*) AS click_count FROM ad_click GROUP BY ALL""",
    "black": f"SELECT DISTINCT user_id FROM user_count WHERE click_count > {P.THRESHOLD}",
    "offence": f"""
        SELECT user_id, min(batch) AS first_batch FROM (
            SELECT user_id, batch,
                   sum(count(*)) OVER (PARTITION BY user_id, date, ad_id ORDER BY batch) AS total
            FROM ad_click GROUP BY user_id, date, ad_id, batch)
        WHERE total > {P.THRESHOLD} GROUP BY user_id""",
    "accepted": """
        SELECT c.* FROM ad_click c LEFT JOIN offence o USING (user_id)
        WHERE first_batch IS NULL OR batch <= first_batch""",
}
_NEEDS = {
    "user_visit_action": ["ev"],
    "click": ["user_visit_action"],
    "session": ["user_visit_action"],
    "enriched": ["session", "user_info"],
    "log_line": ["ev"],
    "ad_click": ["log_line"],
    "user_count": ["ad_click"],
    "black": ["user_count"],
    "offence": ["ad_click"],
    "accepted": ["ad_click", "offence"],
    "arrived": ["ad_click"],
    "marks": ["arrived"],
}


def _sql(body, *views):
    """``body`` preceded by the views it needs, each defined once."""
    order = []

    def add(name):
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in views:
        add(name)
    defined = ",\n".join(f"{n} AS ({_VIEWS[n]})" for n in order)
    return f"WITH {defined}\n{body}"


_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_ACTION_COLUMNS = (
    "date, user_id, session_id, page_id, " + _TIME.format("action_time") + " AS action_time, search_keyword, "
    "CAST(click_category_id AS VARCHAR) AS click_category_id, CAST(click_product_id AS VARCHAR) AS click_product_id, "
    "order_category_ids, order_product_ids, pay_category_ids, "
    "pay_product_ids, city_id"
)
_SESSION_COLUMNS = (
    "session_id, user_id, " + _TIME.format("t0") + " AS start_time, " + _TIME.format("t1") + " AS end_time, "
    "visit_length, step_length, search_keywords, "
    "coalesce(array_to_string(categories, ','), '') AS click_category_ids"
)
_PROFILE = ", age, professional, city, sex"


def _quoted(values):
    return ", ".join(f"'{v}'" for v in values)


def _where(params):
    tests = ["true"]
    if params.start_age is not None:
        tests.append(f"age BETWEEN {params.start_age} AND {params.end_age}")
    if params.professionals:
        tests.append(f"professional IN ({_quoted(params.professionals)})")
    if params.cities:
        tests.append(f"city IN ({_quoted(params.cities)})")
    if params.sex:
        tests.append(f"sex = '{params.sex}'")
    if params.keywords:
        tests.append(f"coalesce(list_has_any(keywords, [{_quoted(params.keywords)}]), false)")
    if params.category_ids:
        tests.append(f"coalesce(list_has_any(categories, [{', '.join(params.category_ids)}]::BIGINT[]), false)")
    return " AND ".join(tests)


def _filtered(params, columns=_SESSION_COLUMNS + _PROFILE):
    return _sql(f"SELECT {columns} FROM enriched WHERE {_where(params)}", "enriched")


_CITY_INFOS = (
    "string_agg(DISTINCT CAST(city_id AS VARCHAR) || ':' || city_name, ',' "
    "ORDER BY CAST(city_id AS VARCHAR) || ':' || city_name) AS city_infos"
)
_LEVEL = (
    "CASE "
    + "WHEN area = 'ASIA' THEN 'A Level' WHEN area = 'EUROPE' THEN 'B Level' WHEN area = 'AMERICA' THEN 'C Level'"
    + " ELSE 'D Level' END AS area_level"
)


def _area_counts(clicks):
    return (
        f"SELECT area, product_id, count(*) AS click_count, {_CITY_INFOS} "
        f"FROM {clicks} JOIN city_info USING (city_id) GROUP BY area, product_id"
    )


def _area_top(clicks, extra=""):
    return (
        f"SELECT {extra} area, {_LEVEL}, product_id, city_infos, click_count, product_name, product_status "
        f"FROM ({_area_counts(clicks)}) JOIN product_info USING (product_id) "
        "QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) <= 3"
    )


def _bucket_counts(prefix, column, buckets):
    return [
        f"count(*) FILTER ({column} >= {low}" + (f" AND {column} <= {high}" if high else "") + f") AS {prefix}_{name}"
        for name, (low, high) in buckets.items()
    ]


def _length_counts(params, visit=K.VISIT_LENGTH_BUCKETS, step=K.STEP_LENGTH_BUCKETS):
    columns = [
        "count(*) AS session_count",
        *_bucket_counts("visit_length", "visit_length", visit),
        *_bucket_counts("step_length", "step_length", step),
    ]
    return f"SELECT {', '.join(columns)} FROM enriched WHERE {_where(params)}"


def _length_ratios(params, extra=""):
    names = [f"visit_length_{n}" for n in K.VISIT_LENGTH_BUCKETS] + [f"step_length_{n}" for n in K.STEP_LENGTH_BUCKETS]
    ratios = [
        f"CASE WHEN session_count > 0 THEN CAST((200 * {n} + session_count) // (2 * session_count) AS DOUBLE) / 100 END"
        f" AS {n}_ratio"
        for n in names
    ]
    return f"SELECT {extra} session_count, {', '.join(ratios)} FROM ({_length_counts(params)})"


def _touched(params):
    """Each (category, kind) an action of the chosen sessions touches."""
    chosen = f"(SELECT * FROM user_visit_action SEMI JOIN (SELECT session_id FROM enriched WHERE {_where(params)}) USING (session_id))"
    return (
        f"(SELECT click_category_id AS category_id, 'click' AS kind FROM {chosen} WHERE click_category_id IS NOT NULL "
        f"UNION ALL SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'order' FROM {chosen} "
        f"UNION ALL SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'pay' FROM {chosen})"
    )


def _kind_counts(kind):
    return _sql(
        f"SELECT category_id, count(*) AS {kind}_count FROM {_touched(P.AGE)} WHERE kind = '{kind}' GROUP BY category_id",
        "enriched",
    )


def _category_counts():
    kinds = ", ".join(f"count(*) FILTER (kind = '{k}') AS {k}_count" for k in ("click", "order", "pay"))
    return f"SELECT category_id, {kinds} FROM {_touched(P.AGE)} GROUP BY category_id"


_TOP_CATEGORIES = " ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10"


def _features():
    return f"""
        SELECT seq, session_id, {_TIME.format('t')} AS action_time, strftime(t, '%Y-%m-%d') AS date,
               strftime(t, '%Y%m%d') AS date_key, strftime(t, '%Y-%m-%d') AS date_from_key,
               strftime(t, '%Y-%m-%d_%H') AS date_hour, strftime(t, '%Y-%m-%d_%-H') AS date_hour_text,
               strftime(t, '%Y%m%d%H') AS hour_key, strftime(t, '%Y%m%d%H%M') AS minute_key,
               strftime(t, '%H') AS hour, strftime(t, '%M') AS minute,
               coalesce(date_diff('second', before, t), 0) AS gap_seconds, coalesce(t < before, false) AS out_of_order,
               t > date_trunc('day', t) + INTERVAL 12 HOUR AS after_noon
        FROM (SELECT seq, session_id, t, lag(t) OVER (PARTITION BY session_id ORDER BY seq) AS before
              FROM (SELECT *, date_trunc('second', action_time) AS t FROM user_visit_action))"""


def _quality():
    def one(name, expr):
        parses = "try_strptime(c, '%Y-%m-%d %H:%M:%S')" if name == "action_time" else "TRY_CAST(c AS BIGINT)"
        return (
            f"SELECT '{name}' AS column_name, count(*) AS row_count, count(*) FILTER (c IS NULL) AS null_count, "
            "count(*) FILTER (c IS NULL OR c = '') AS empty_count, "
            "count(*) FILTER (regexp_full_match(c, '[0-9]*')) AS numeric_count, "
            "count(*) FILTER (c <> '' AND NOT regexp_full_match(c, '[0-9]*')) AS non_numeric_count, "
            f"count(*) FILTER (c IS NOT NULL AND {parses} IS NULL) AS unparsable_count, "
            "count(*) FILTER (c LIKE ',%' OR c LIKE '%,') AS comma_edge_count "
            f"FROM (SELECT {expr} AS c FROM user_visit_action)"
        )

    special = {
        "action_time": "strftime(action_time, '%Y-%m-%d %-H:%M:%S')",
        "padded_ids": "',' || pay_category_ids || ','",
    }
    return " UNION ALL ".join(one(n, special.get(n, n)) for n in P.PROFILED_COLUMNS)


_PACKED_CATEGORIES = (
    "array_to_string(list_sort(list_transform(categories, lambda x: CAST(x AS VARCHAR))), ',')"
)


def _count(keys, source="ad_click"):
    return f"SELECT {keys}, count(*) AS click_count FROM {source} GROUP BY ALL"


_USER, _CITY, _PROVINCE, _MINUTE = (
    "date, user_id, ad_id",
    "date, province, city, ad_id",
    "date, province, ad_id",
    "date, hour, minute, ad_id",
)


def _top_ads(source="ad_click"):
    return (
        f"SELECT * FROM ({_count(_PROVINCE, source)}) "
        "QUALIFY row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) <= 3"
    )


_BROKEN = """
    SELECT CASE event_type WHEN 'error' THEN value || ' extra' WHEN 'signup' THEN 't' || value
                WHEN 'purchase' THEN regexp_replace(value, ' (\\d+) (\\d+)$', ' u\\1 \\2')
                WHEN 'view' THEN value || 'x' END AS value,
           CASE event_type WHEN 'error' THEN 'field count' WHEN 'signup' THEN 'timestamp'
                WHEN 'purchase' THEN 'user id' WHEN 'view' THEN 'ad id' END AS reason
    FROM log_line WHERE event_type IN ('error', 'signup', 'purchase', 'view')"""

_FIRST_DAY, _LAST_DAY = P.SOME_DAYS
_TASK = f"CAST({P.TASK_ID} AS BIGINT) AS task_id, "
_SAMPLE = (
    "SELECT {columns} FROM user_visit_action ORDER BY md5(concat_ws('|', '0', {keys})) LIMIT 10"
)
_DETAIL_COLUMNS = _ACTION_COLUMNS.replace("date, user_id", "user_id").replace(", city_id", "")

#: Every count is taken anew from the clicks of the hour before; windows are those that end on ten seconds.
_SLIDING = """
    SELECT ad_id, strftime(epoch_ms(1000 * slide), '%Y-%m-%d %H:%M:%S') AS first_slide,
           strftime(epoch_ms(1000 * (next_slide - 10)), '%Y-%m-%d %H:%M:%S') AS last_slide, click_count
    FROM (
        SELECT p.ad_id, slide, next_slide, count(*) AS click_count
        FROM (
            SELECT ad_id, slide, coalesce(lead(slide) OVER (PARTITION BY ad_id, block ORDER BY slide), block + 3600) AS next_slide
            FROM (
                SELECT ad_id, pane_end AS slide, pane_end // 3600 * 3600 AS block
                FROM (SELECT ad_id, event_millis // 10000 * 10 + 10 AS pane_end FROM ad_click)
                UNION
                SELECT ad_id, unnest([pane_end // 3600 * 3600 + 3600, pane_end + 3600]), pane_end // 3600 * 3600 + 3600
                FROM (SELECT ad_id, event_millis // 10000 * 10 + 10 AS pane_end FROM ad_click) WHERE pane_end % 3600 > 0)) p
        JOIN ad_click c ON c.ad_id = p.ad_id
            AND c.event_millis >= (slide - 3600) * 1000 AND c.event_millis < slide * 1000
        GROUP BY ALL)"""

#: The watermark of the last batch stands two hours before the newest click.
_PANES_IN_STATE = """
    SELECT strftime(epoch_ms(event_millis // 10000 * 10000), '%Y-%m-%d %H:%M:%S') AS pane, ad_id, count(*) AS click_count
    FROM ad_click
    WHERE (event_millis // 10000 + 1) * 10000 > (SELECT max(event_millis) - 7200000 FROM ad_click) GROUP BY ALL"""

_LATE = f"""
    SELECT CASE WHEN (event_millis // 60000 + 1) * 60000 <= mark THEN 'late' ELSE 'count' END AS kind,
           {_MINUTE}, count(*) AS click_count
    FROM arrived JOIN marks USING (arrival) GROUP BY ALL"""


def _page_flow():
    """Moves along the pages 1, 2, 5, 3, each step against the moves of the step before."""
    return """
    , moved AS (
        SELECT lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, seq) AS a, page_id AS b
        FROM user_visit_action),
    steps AS (
        SELECT * FROM (VALUES (1::BIGINT, 1::BIGINT, 2::BIGINT), (2, 2, 5), (3, 5, 3)) f(step, from_page, to_page)),
    counted AS (
        SELECT step, from_page, to_page, count(b) AS moves
        FROM steps LEFT JOIN moved ON a = from_page AND b = to_page GROUP BY ALL),
    based AS (
        SELECT *, coalesce(lag(moves) OVER (ORDER BY step),
                           (SELECT count(*) FROM user_visit_action WHERE page_id = 1)) AS base
        FROM counted)
    SELECT *, CASE WHEN base > 0 THEN ((200 * moves + base) // (2 * base)) / 100.0 END AS conversion_rate FROM based"""


_TOP_SESSIONS = """
    , touched AS (
        SELECT click_category_id AS c, 1 AS click, 0 AS ordered, 0 AS paid FROM user_visit_action
        WHERE click_category_id IS NOT NULL
        UNION ALL SELECT CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 0, 1, 0 FROM user_visit_action
        UNION ALL SELECT CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 0, 0, 1 FROM user_visit_action),
    ranked AS (
        SELECT c FROM touched WHERE c IS NOT NULL GROUP BY c ORDER BY sum(click) DESC, sum(ordered) DESC, sum(paid) DESC, c LIMIT 10),
    clicked AS (
        SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM user_visit_action
        WHERE click_category_id IN (SELECT c FROM ranked) GROUP BY ALL)
    SELECT category_id, session_id, click_count FROM clicked
    QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10"""

_EXTRACT = """
    SELECT session_id, strftime(t0, '%Y-%m-%d %H:%M:%S') AS start_time, search_keywords,
           coalesce(array_to_string(categories, ','), '') AS click_category_ids
    FROM session
    QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', t0) ORDER BY md5('0|' || session_id), session_id) <= 2"""

ORACLE = {
    "page_flow_conversion": _sql(_page_flow(), "user_visit_action"),
    "top10_sessions_per_category": _sql(_TOP_SESSIONS, "user_visit_action"),
    "session_extract_by_hour": _sql(_EXTRACT, "session"),
    "scan_actions_by_date": _sql(
        f"SELECT {_ACTION_COLUMNS} FROM user_visit_action WHERE date BETWEEN '{_FIRST_DAY}' AND '{_LAST_DAY}'",
        "user_visit_action",
    ),
    "scan_clicks": _sql(
        "SELECT city_id, click_product_id AS product_id FROM user_visit_action WHERE click_product_id IS NOT NULL "
        f"AND date BETWEEN '{_FIRST_DAY}' AND '{_LAST_DAY}'",
        "user_visit_action",
    ),
    "clicks_with_city": _sql(
        "SELECT city_id, city_name, area, product_id FROM click JOIN city_info USING (city_id)", "click", "city_info"
    ),
    "product_status": _sql("SELECT product_id, product_status FROM product_info", "product_info"),
    "product_status_sql": _sql("SELECT product_id, product_status FROM product_info", "product_info"),
    "area_level": _sql(f"SELECT city_id, area, {_LEVEL} FROM city_info", "city_info"),
    "area_product_clicks": _sql(_area_counts("click"), "click", "city_info"),
    "area_product_clicks_sql": _sql(_area_counts("click"), "click", "city_info"),
    "area_product_full": _sql(
        "SELECT area, product_id, click_count, city_infos, product_name, product_status "
        f"FROM ({_area_counts('click')}) JOIN product_info USING (product_id)",
        "click",
        "city_info",
        "product_info",
    ),
    "area_top3_products": _sql(_area_top("click"), "click", "city_info", "product_info"),
    "area_top3_products_sales": _sql(_area_top("sales_click"), "sales_click", "city_info", "product_info"),
    "session_rollup": _sql(f"SELECT {_SESSION_COLUMNS} FROM session", "session"),
    "session_enriched": _sql(f"SELECT {_SESSION_COLUMNS}{_PROFILE} FROM enriched", "enriched"),
    "filter_by_age": _filtered(P.AGE),
    "filter_by_profession_city": _filtered(P.PROFESSION_CITY),
    "filter_by_sex": _filtered(P.SEX),
    "filter_by_keyword_category": _filtered(P.KEYWORD_CATEGORY),
    "filter_sessions_all": _filtered(P.ALL_FILTERS),
    "filter_sessions_facts": _filtered(P.ALL_FILTERS, "session_id, user_id, visit_length, step_length"),
    "session_length_counts": _sql(_length_counts(P.AGE), "enriched"),
    "session_length_counts_hours": _sql(_length_counts(P.AGE, P.HOUR_BUCKETS, P.SINGLE_STEPS), "enriched"),
    "session_length_ratios": _sql(_length_ratios(P.AGE), "enriched"),
    "filtered_session_actions": _sql(
        f"SELECT {_ACTION_COLUMNS} FROM user_visit_action WHERE session_id IN "
        f"(SELECT session_id FROM enriched WHERE {_where(P.ALL_FILTERS)})",
        "enriched",
    ),
    "visited_categories": _sql(f"SELECT DISTINCT category_id FROM {_touched(P.AGE)}", "enriched"),
    "click_category_counts": _kind_counts("click"),
    "order_category_counts": _kind_counts("order"),
    "pay_category_counts": _kind_counts("pay"),
    "category_counts": _sql(_category_counts(), "enriched"),
    "top10_categories_bucketed": _sql(_category_counts() + _TOP_CATEGORIES, "enriched"),
    "top10_categories": _sql(_category_counts() + _TOP_CATEGORIES, "enriched"),
    "sample_actions": _sql(
        _SAMPLE.format(columns="seq, " + _ACTION_COLUMNS, keys="CAST(seq AS VARCHAR)"), "user_visit_action"
    ),
    "task_parameters": _sql(
        "SELECT user_id AS task_id, user_id % 7 < 2 AS malformed, "
        + ", ".join(
            f"CASE WHEN user_id % 7 > 2 THEN {value} END AS {name}"
            for name, value in {
                "start_date": f"'{P.SOME_DAYS[0]}'",
                "start_age": "CAST(age - 5 AS VARCHAR)",
                "end_age": "CAST(age + 5 AS VARCHAR)",
                "professionals": "professional || ',other'",
                "cities": "city",
                "sex": "CASE WHEN user_id % 3 <> 0 THEN sex END",
                "category_ids": "CASE WHEN user_id % 2 = 0 THEN 'many' ELSE '1,2' END",
            }.items()
        )
        + ", CAST(NULL AS VARCHAR) AS end_date, CAST(NULL AS VARCHAR) AS keywords, "
        "CAST(NULL AS VARCHAR) AS target_page_flow FROM user_info",
        "user_info",
    ),
    "action_time_features": _sql(_features(), "user_visit_action"),
    "action_hourly_profile": _sql(
        "SELECT date_hour, count(*) AS actions, count(*) FILTER (out_of_order) AS out_of_order, "
        "CAST(sum(gap_seconds) AS BIGINT) AS gap_seconds, max(gap_seconds) AS longest_gap "
        f"FROM ({_features()}) GROUP BY date_hour",
        "user_visit_action",
    ),
    "action_quality_profile": _sql(_quality(), "user_visit_action"),
    "decode_kv_table": _sql(
        "SELECT user_id, session_id, nullif(search_keywords, '') AS search_keyword, "
        f"nullif({_PACKED_CATEGORIES}, '') AS category_ids, visit_length AS visit_time, step_length FROM session",
        "session",
    ),
    "edit_kv_table": _sql(
        "SELECT user_id, 'session_id=' || session_id || '|search_keyword=' || search_keywords || '|category_ids=' "
        f"|| coalesce({_PACKED_CATEGORIES}, '') || '|visit_time=' || visit_length || '|step_length=' "
        "|| step_length * 2 AS packed FROM session",
        "session",
    ),
    "ad_log_parsed": _sql(
        "SELECT event_millis, date, hour, minute, province, city, user_id, ad_id FROM ad_click", "ad_click"
    ),
    "ad_log_rejects": _sql(_BROKEN, "log_line"),
    "ad_user_click_count": _sql(_count(_USER), "ad_click"),
    "ad_blacklist": _sql("SELECT user_id FROM black", "black"),
    "ad_clicks_not_blacklisted": _sql(
        "SELECT event_millis, date, hour, minute, province, city, user_id, ad_id FROM ad_click ANTI JOIN black USING (user_id)",
        "black",
    ),
    "ad_city_click_count": _sql(_count(_CITY), "ad_click"),
    "ad_province_click_count": _sql(_count(_PROVINCE), "ad_click"),
    "ad_province_top3": _sql(_top_ads(), "ad_click"),
    "ad_click_trend": _sql(_count(_MINUTE), "ad_click"),
    "ad_recent_trend": _sql(
        f"SELECT * FROM ({_count(_MINUTE)}) WHERE strptime(date || ' ' || hour || ':' || minute, '%Y-%m-%d %H:%M') > "
        "(SELECT date_trunc('minute', epoch_ms(max(event_millis))) - INTERVAL 60 MINUTE FROM ad_click)",
        "ad_click",
    ),
    "blacklist_replay": _sql("SELECT user_id, first_batch FROM offence", "offence"),
    "blacklist_replay_accepted": _sql(_count(_CITY, "accepted"), "accepted"),
    "sink_append_session_aggr_stat": _sql(_length_ratios(P.AGE, _TASK), "enriched"),
    "sink_append_session_detail": _sql(
        _SAMPLE.format(
            columns=_TASK + _DETAIL_COLUMNS,
            keys="session_id, CAST(action_time AS VARCHAR), CAST(page_id AS VARCHAR)",
        ),
        "user_visit_action",
    ),
    "sink_append_top10_category": _sql(
        f"SELECT {_TASK} * FROM ({_category_counts()})" + _TOP_CATEGORIES, "enriched"
    ),
    "sink_append_area_top3_product": _sql(_area_top("click", _TASK), "click", "city_info", "product_info"),
    "sink_upsert_replace": _sql(_count(_CITY), "ad_click"),
    "sink_upsert_add": _sql(_count(_USER), "ad_click"),
    "sink_insert_new": _sql("SELECT user_id FROM black", "black"),
    "sink_replace_groups": _sql(_top_ads(), "ad_click"),
    "stream_ad_user_click_count": _sql(_count(_USER, "accepted"), "accepted"),
    "stream_ad_blacklist": _sql("SELECT user_id FROM offence", "offence"),
    "stream_ad_city_click_count": _sql(_count(_CITY, "accepted"), "accepted"),
    "stream_ad_province_top3": _sql(_top_ads("accepted"), "accepted"),
    "stream_ad_click_trend": _sql(_count(_MINUTE, "accepted"), "accepted"),
    "stream_running_user_counts": _sql(_count(_USER), "ad_click"),
    "stream_running_city_counts": _sql(_count(_CITY), "ad_click"),
    "stream_sliding_trend": _sql(_SLIDING, "ad_click"),
    "stream_pane_counts_in_state": _sql(_PANES_IN_STATE, "ad_click"),
    "stream_minute_counts_late": _sql(_LATE, "arrived", "marks"),
    "stream_minute_counts_watermark": _sql(_count(_MINUTE), "ad_click"),
}
