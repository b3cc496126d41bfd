"""Date and time helpers as Column expressions. Text that does not parse becomes null."""

from pyspark.sql import functions as F

from footfall import constants as K


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def parse_time(c):
    """``yyyy-MM-dd H:mm:ss`` text to timestamp; the hour may lack its leading zero."""
    return F.try_to_timestamp(_col(c), F.lit(K.LENIENT_TIME_FORMAT))


def format_time(c):
    return F.date_format(_col(c), K.TIME_FORMAT)


def format_date(c):
    return F.date_format(_col(c), K.DATE_FORMAT)


def format_date_key(c):
    return F.date_format(_col(c), K.DATE_KEY_FORMAT)


def parse_date_key(c):
    """``yyyyMMdd`` text to date."""
    return F.try_to_timestamp(_col(c), F.lit(K.DATE_KEY_FORMAT)).cast("date")


def format_hour_key(c):
    return F.date_format(_col(c), K.HOUR_KEY_FORMAT)


def format_minute_key(c):
    return F.date_format(_col(c), K.MINUTE_KEY_FORMAT)


def date_hour(c):
    return F.date_format(_col(c), K.DATE_HOUR_FORMAT)


def date_hour_text(c):
    """``yyyy-MM-dd_H`` cut from time text, the hour kept as written."""
    c = _col(c)
    return F.concat_ws("_", F.substring_index(c, " ", 1), F.substring_index(F.substring_index(c, " ", -1), ":", 1))


def before(a, b):
    """Parsed time ``a`` is earlier than ``b``; false when either is null, as unparsable text is."""
    return F.coalesce(_col(a) < _col(b), F.lit(False))


def after(a, b):
    return F.coalesce(_col(a) > _col(b), F.lit(False))


def minus(a, b):
    """Whole seconds from parsed time ``b`` to ``a``; 0 when either is null."""
    return F.coalesce(F.unix_seconds(_col(a)) - F.unix_seconds(_col(b)), F.lit(0))


def whole_seconds(c):
    """Seconds since the epoch of a timestamp, fractions cut off."""
    return F.unix_seconds(_col(c).cast("timestamp"))


def millis_to_timestamp(c):
    """Epoch milliseconds to timestamp; null outside the years 1 to 9999."""
    c = _col(c)
    return F.when(c.between(-62135596800000, 253402300799999), F.timestamp_millis(c))
