"""Business labels: length buckets, area levels, product status."""

from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions.text import document_field, json_document


def in_bucket(c, bounds):
    low, high = bounds
    return F.col(c) >= low if high is None else F.col(c).between(low, high)


def area_level(c, levels=None, other=K.OTHER_AREA_LEVEL):
    """Level of an area by name; areas that are not listed get ``other``."""
    levels = K.AREA_LEVELS if levels is None else levels
    if not levels:
        return F.lit(other)
    chain = F
    for area, level in levels.items():
        chain = chain.when(F.col(c) == area, level)
    return chain.otherwise(other)


def product_status(extend_info):
    """Who sells the product; compared as text, so unreadable values count as third party."""
    own = F.coalesce(document_field(json_document(extend_info), "product_status") == "0", F.lit(False))
    return F.when(own, K.SELF_OPERATED).otherwise(K.THIRD_PARTY)
