"""Ratios and rounding."""

from pyspark.sql import functions as F


def ratio(part, total):
    """``part / total`` rounded half up to two decimals in integer arithmetic; null when total is 0."""
    hundredths = F.call_function("div", 200 * part + total, 2 * total)
    return F.when(total > 0, hundredths / F.lit(100.0))


def format_double(c, scale):
    """Round half up to ``scale`` decimals."""
    return F.round(c, scale)
