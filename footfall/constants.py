"""Labels, bucket edges, names and limits that results must carry exactly."""

# Task parameter names.
PARAM_START_DATE = "startDate"
PARAM_END_DATE = "endDate"
PARAM_START_AGE = "startAge"
PARAM_END_AGE = "endAge"
PARAM_PROFESSIONALS = "professionals"
PARAM_CITIES = "cities"
PARAM_SEX = "sex"
PARAM_KEYWORDS = "keywords"
PARAM_CATEGORY_IDS = "categoryIds"
PARAM_TARGET_PAGE_FLOW = "targetPageFlow"

# Visit length in whole seconds, both ends included; None is open. Zero seconds is in no bucket.
VISIT_LENGTH_BUCKETS = {
    "1s_3s": (1, 3),
    "4s_6s": (4, 6),
    "7s_9s": (7, 9),
    "10s_30s": (10, 30),
    "30s_60s": (31, 60),
    "1m_3m": (61, 180),
    "3m_10m": (181, 600),
    "10m_30m": (601, 1800),
    "30m": (1801, None),
}

# Step length in actions, both ends included; None is open.
STEP_LENGTH_BUCKETS = {
    "1_3": (1, 3),
    "4_6": (4, 6),
    "7_9": (7, 9),
    "10_30": (10, 30),
    "30_60": (31, 60),
    "60": (61, None),
}

# Area to level.
AREA_LEVELS = {
    "China North": "A Level",
    "China East": "A Level",
    "China South": "B Level",
    "China Middle": "B Level",
    "West North": "C Level",
    "West South": "C Level",
}
OTHER_AREA_LEVEL = "D Level"

# Product status 0 is the shop's own product, any other a third party's.
SELF_OPERATED = "自营商品"
THIRD_PARTY = "第三方商品"

# Report sizes and limits.
TOP_CATEGORIES = 10
TOP_PRODUCTS = 3
TOP_ADS = 3
SAMPLED_ACTIONS = 10
BLACKLIST_THRESHOLD = 100
TREND_MINUTES = 60
SLIDE_SECONDS = 10
BATCH_INTERVAL = "5 seconds"

# Time patterns.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LENIENT_TIME_FORMAT = "yyyy-MM-dd H:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
HOUR_KEY_FORMAT = "yyyyMMddHH"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
