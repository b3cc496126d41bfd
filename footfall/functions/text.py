"""String helpers as Column expressions."""

import re

from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def is_empty(c):
    """True for null and for the empty string."""
    return F.coalesce(_col(c), F.lit("")) == ""


def is_not_empty(c):
    return ~is_empty(c)


def trim_comma(c):
    """Drop at most one comma from each side."""
    c = _col(c)
    left = F.when(F.startswith(c, F.lit(",")), F.substr(c, F.lit(2))).otherwise(c)
    return F.when(F.endswith(left, F.lit(",")), F.left(left, F.length(left) - 1)).otherwise(left)


def zero_fill(c):
    """Keep two-character text; put one zero before anything else (never truncates)."""
    c = _col(c)
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def is_numeric(c):
    """Digits only; the empty string counts, null does not."""
    return F.coalesce(_col(c).rlike(r"\A[0-9]*\z"), F.lit(False))


def to_long(c):
    """Text to BIGINT, null where it does not parse."""
    return _col(c).try_cast("bigint")


def split_list(c, sep=","):
    """Non-empty elements of a separated list; null stays null."""
    return F.array_remove(F.split(_col(c), _quote(sep)), "")


def is_real_list(c):
    """A list column that holds something: not null, not empty, not the word null."""
    return ~F.lower(F.coalesce(_col(c), F.lit(""))).isin("", "null")


def sorted_csv(array):
    """Array to comma-joined text in sorted order; an empty array gives the empty string."""
    return F.array_join(F.array_sort(_col(array)), ",")


def concat_long_string(number, text, sep):
    """``id<sep>name``; a null id is written as the word null."""
    return F.concat(F.coalesce(_col(number).cast("string"), F.lit("null")), F.lit(sep), _col(text))


def group_concat_distinct(c):
    """Aggregate: the distinct values of the group, sorted and comma-joined."""
    return sorted_csv(F.collect_set(_col(c)))


def encode_kv(fields, sep="|"):
    """Pack ``{name: column}`` as ``name=value|name=value``; nulls become empty values.

    ``%``, ``=`` and the separator inside values are written as percent codes; see ``kv_unescape``.
    """
    parts = [
        F.concat(F.lit(f"{name}="), _kv_escape(F.coalesce(_col(c).cast("string"), F.lit("")), sep))
        for name, c in fields.items()
    ]
    return F.concat_ws(sep, *parts)


def _kv_codes(sep):
    return [("%", "%25"), ("=", "%3D"), *[(s, f"%{ord(s):02X}") for s in sep]]


def _kv_escape(c, sep):
    for plain, code in _kv_codes(sep):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def kv_unescape(c, sep="|"):
    """The value that ``encode_kv`` packed."""
    for plain, code in reversed(_kv_codes(sep)):
        c = F.replace(_col(c), F.lit(code), F.lit(plain))
    return c


def kv_get(c, field, sep="|"):
    """Value of ``field`` in packed text: the first pair that has a name and a non-empty value."""
    pair = rf"(?:\A|[{sep}]){re.escape(field)}=([^={sep}]+)(?=[{sep}]|\z)"
    return F.nullif(F.regexp_extract(_col(c), pair, 1), F.lit(""))


def kv_set(c, field, value, sep="|"):
    """Replace the value of the first pair named ``field`` and rejoin with a bar."""
    pairs = F.split(_col(c), _quote(sep))
    names = F.transform(pairs, lambda e: F.substring_index(e, "=", 1))
    at = F.array_position(names, F.lit(field)) - 1
    new = F.concat(F.lit(f"{field}="), F.coalesce(_col(value).cast("string"), F.lit("null")))
    return F.array_join(F.transform(pairs, lambda e, i: F.when(i == at, new).otherwise(e)), "|")


def json_field(c, field):
    """Top-level field of a JSON document as text; null when absent or when the JSON is bad."""
    return F.get_json_object(_col(c), f"$.{field}")


def json_document(c):
    """A JSON document as a VARIANT, to take several fields of one parse; null when the JSON is bad."""
    return F.try_parse_json(_col(c))


def document_field(document, field, kind="string"):
    """Top-level field of a VARIANT document; null when absent, null or not readable as ``kind``."""
    return F.try_variant_get(document, f"$.{field}", kind)


def _quote(sep):
    return f"[{sep}]" if sep in ",|_ " else sep


def register_sql_functions(spark):
    """The scalar helpers under their SQL names, as SQL functions that the optimizer inlines.

    ``group_concat_distinct`` is an aggregate: in SQL text write
    ``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(number BIGINT, text STRING, sep STRING) "
        "RETURNS STRING RETURN concat(coalesce(cast(number AS STRING), 'null'), sep, text)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION json_field(document STRING, field STRING) "
        "RETURNS STRING RETURN get_json_object(document, concat('$.', field))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION sorted_csv(items ARRAY<STRING>) "
        "RETURNS STRING RETURN array_join(array_sort(items), ',')"
    )
