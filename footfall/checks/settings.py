"""Parameters the named queries and their SQL share."""

from pyspark.sql import functions as F

from footfall.params import TaskParams

# Every day a date can name: queries where a range is not the feature read whole tables.
ALL_DAYS = ("0001-01-01", "9999-12-31")
SOME_DAYS = ("2024-01-08", "2024-01-21")
TASK_ID = 7

AREA_LEVELS = {"ASIA": "A Level", "EUROPE": "B Level", "AMERICA": "C Level"}
OTHER_LEVEL = "D Level"


def _params(**filters):
    return TaskParams(start_date=ALL_DAYS[0], end_date=ALL_DAYS[1], **filters)


AGE = _params(start_age=20, end_age=45)
PROFESSION_CITY = _params(
    professionals=("FURNITURE", "MACHINERY", "BUILDING"), cities=tuple(f"city{n}" for n in range(0, 25, 2))
)
SEX = _params(sex="female")
KEYWORD_CATEGORY = _params(keywords=("kw1", "kw7"), category_ids=("3", "7", "11", "19"))
ALL_FILTERS = _params(
    start_age=10,
    end_age=50,
    professionals=("FURNITURE", "MACHINERY", "BUILDING", "AUTOMOBILE"),
    cities=tuple(f"city{n}" for n in range(0, 20)),
    sex="male",
    keywords=("kw1", "kw2", "kw3", "kw5", "kw8", "kw10"),
    category_ids=tuple(str(n) for n in range(0, 15)),
)

HOUR_BUCKETS = {"1h": (1, 3600), "6h": (3601, 21600), "12h": (21601, 43200), "1d": (43201, None)}
SINGLE_STEPS = {"1": (1, 1), "2": (2, 2), "3": (3, 3), "4": (4, None)}

PROFILED_COLUMNS = [
    "action_time",
    "search_keyword",
    "order_category_ids",
    "order_product_ids",
    "pay_product_ids",
    "padded_ids",
]

PAGE_FLOW = "1,2,5,3"
SESSIONS_AN_HOUR = 2

# The blacklist limit that the given log reaches; the product default is 100.
THRESHOLD = 2
# A micro-batch covers four and a half days, so that days are split between batches.
BATCH_DAYS = 4.5
BATCH_SECONDS = int(BATCH_DAYS * 86_400)
FIRST_SECOND = 1_704_067_200
SECOND_HALF = 4


def batch_number(ts, days=BATCH_DAYS):
    seconds = F.unix_seconds(F.col(ts).cast("timestamp")) - FIRST_SECOND
    return F.floor(seconds / int(days * 86_400))

# Buckets of the stored actions; at scale as many as make buckets of about 128 MB.
BUCKETS = 16
