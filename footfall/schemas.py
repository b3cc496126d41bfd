"""Schemas of the input tables and of the nine result tables.

Result tables list their columns in sink order.
"""

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "string": StringType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
}


def _schema(columns):
    """``"name type, ..."`` to a schema of nullable fields (needs no running session)."""
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


USER_VISIT_ACTION = _schema(
    "date string, user_id bigint, session_id string, page_id bigint, action_time timestamp, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, "
    "order_category_ids string, order_product_ids string, "
    "pay_category_ids string, pay_product_ids string, city_id bigint"
)
USER_INFO = _schema(
    "user_id bigint, username string, name string, age int, professional string, city string, sex string"
)
PRODUCT_INFO = _schema("product_id bigint, product_name string, extend_info string")
CITY_INFO = _schema("city_id bigint, city_name string, area string")
TASK = _schema(
    "task_id bigint, task_name string, create_time string, start_time string, finish_time string, "
    "task_type string, task_status string, task_param string"
)
AD_LOG = _schema("value string")

SESSION_AGGR_STAT = _schema(
    "task_id bigint, session_count bigint, "
    "visit_length_1s_3s_ratio double, visit_length_4s_6s_ratio double, visit_length_7s_9s_ratio double, "
    "visit_length_10s_30s_ratio double, visit_length_30s_60s_ratio double, visit_length_1m_3m_ratio double, "
    "visit_length_3m_10m_ratio double, visit_length_10m_30m_ratio double, visit_length_30m_ratio double, "
    "step_length_1_3_ratio double, step_length_4_6_ratio double, step_length_7_9_ratio double, "
    "step_length_10_30_ratio double, step_length_30_60_ratio double, step_length_60_ratio double"
)
SESSION_DETAIL = _schema(
    "task_id bigint, user_id bigint, session_id string, page_id bigint, action_time string, "
    "search_keyword string, click_category_id bigint, click_product_id bigint, "
    "order_category_ids string, order_product_ids string, pay_category_ids string, pay_product_ids string"
)
TOP10_CATEGORY = _schema(
    "task_id bigint, category_id bigint, click_count bigint, order_count bigint, pay_count bigint"
)
AREA_TOP3_PRODUCT = _schema(
    "task_id bigint, area string, area_level string, product_id bigint, city_infos string, "
    "click_count bigint, product_name string, product_status string"
)
AD_USER_CLICK_COUNT = _schema("date string, user_id bigint, ad_id bigint, click_count bigint")
AD_BLACKLIST = _schema("user_id bigint")
AD_STAT = _schema("date string, province string, city string, ad_id bigint, click_count bigint")
AD_PROVINCE_TOP3 = _schema("date string, province string, ad_id bigint, click_count bigint")
AD_CLICK_TREND = _schema("date string, hour string, minute string, ad_id bigint, click_count bigint")
AD_LOG_REJECT = _schema("value string, reason string")
