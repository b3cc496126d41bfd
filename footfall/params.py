"""Task parameters: one JSON document per task."""

import datetime
import json
from dataclasses import dataclass

from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions.text import document_field, json_document

#: Task parameters by field of ``TaskParams``: name in the JSON document and type.
_FIELDS = {
    "start_date": (K.PARAM_START_DATE, "string"),
    "end_date": (K.PARAM_END_DATE, "string"),
    "start_age": (K.PARAM_START_AGE, "int"),
    "end_age": (K.PARAM_END_AGE, "int"),
    "professionals": (K.PARAM_PROFESSIONALS, "array"),
    "cities": (K.PARAM_CITIES, "array"),
    "sex": (K.PARAM_SEX, "string"),
    "keywords": (K.PARAM_KEYWORDS, "array"),
    "category_ids": (K.PARAM_CATEGORY_IDS, "array"),
    "target_page_flow": (K.PARAM_TARGET_PAGE_FLOW, "string"),
}


def task_parameters(tasks):
    """(task_id, malformed, one column per parameter) of every task, each document parsed once.

    Parameters that are missing, empty or of another kind are null; lists are split at commas. ``malformed`` tells
    documents that are no JSON object from tasks without parameters.
    """
    parsed = tasks.select("task_id", "task_param", json_document("task_param").alias("_document"))

    def field(name, kind):
        text = F.nullif(document_field(F.col("_document"), name), F.lit(""))
        if kind == "array":
            return F.array_remove(F.split(text, ","), "")
        return text.try_cast(kind)

    given = F.coalesce(F.col("task_param"), F.lit("")) != ""
    is_object = F.coalesce(F.schema_of_variant("_document").startswith("OBJECT"), F.lit(False))
    columns = [field(name, kind).alias(column) for column, (name, kind) in _FIELDS.items()]
    return parsed.select("task_id", (given & ~is_object).alias("malformed"), *columns)


@dataclass(frozen=True)
class TaskParams:
    """Filters of one analysis task. ``None`` switches a filter off."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None
    target_page_flow: str | None = None

    @classmethod
    def from_json(cls, text, today=None):
        """Read the parameters; a missing date range means the day before ``today``.

        ``today`` defaults to the wall clock; pass it to keep a job reproducible.
        """
        doc = json.loads(text) if text else {}
        yesterday = str((today or datetime.date.today()) - datetime.timedelta(days=1))

        def value(name):
            v = doc.get(name)
            return None if v is None or str(v) == "" else str(v)

        def number(name):
            return None if value(name) is None else int(value(name))

        def items(name):
            return None if value(name) is None else tuple(e for e in value(name).split(",") if e)

        return cls(
            start_date=value(K.PARAM_START_DATE) or yesterday,
            end_date=value(K.PARAM_END_DATE) or yesterday,
            start_age=number(K.PARAM_START_AGE),
            end_age=number(K.PARAM_END_AGE),
            professionals=items(K.PARAM_PROFESSIONALS),
            cities=items(K.PARAM_CITIES),
            sex=value(K.PARAM_SEX),
            keywords=items(K.PARAM_KEYWORDS),
            category_ids=items(K.PARAM_CATEGORY_IDS),
            target_page_flow=value(K.PARAM_TARGET_PAGE_FLOW),
        )
