"""The ad-click log: one line per click, ``epoch_millis province city userid adid``."""

from pyspark.sql import functions as F

from footfall.functions.text import to_long
from footfall.functions.times import millis_to_timestamp


# Columns of a click.
CLICK = ["event_time", "province", "city", "user_id", "ad_id"]


def kafka_options(brokers, topics):
    """Options for one or several topics."""
    topics = [topics] if isinstance(topics, str) else topics
    return {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics)}


def ad_log_stream(spark, fmt="text", path=None, **options):
    """The log as a stream with one ``value`` column, from Kafka or from a folder of text files."""
    reader = spark.readStream.format(fmt).options(**options)
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))


def _fields(lines, keep=()):
    part = F.split(F.rtrim(F.col("value")), " ")
    fields = F.struct(
        F.size("_part").alias("_size"),
        to_long(F.get("_part", F.lit(0))).alias("_millis"),
        F.get("_part", F.lit(1)).alias("province"),
        F.get("_part", F.lit(2)).alias("city"),
        to_long(F.get("_part", F.lit(3))).alias("user_id"),
        to_long(F.get("_part", F.lit(4))).alias("ad_id"),
    )
    # Without the generator between them, the optimizer would push the tests on the fields below
    # the split and split each line once per test.
    return (
        lines.select(*keep, "value", part.alias("_part"))
        .select(*keep, "value", F.inline(F.array(fields)))
        .withColumn("event_time", millis_to_timestamp("_millis"))
    )


def parse_ad_log(lines, *keep):
    """Clicks of the well-formed lines: time, province, city, user, ad.

    ``event_time`` is the instant of the click. Of the other columns of ``lines`` those named in
    ``keep`` are carried along.
    """
    good = _fields(lines, keep).filter(
        (F.col("_size") == 5)
        & F.col("event_time").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("ad_id").isNotNull()
    )
    return good.select(*keep, *CLICK)


def _reason():
    return (
        F.when(F.coalesce(F.col("_size"), F.lit(-1)) != 5, "field count")
        .when(F.col("event_time").isNull(), "timestamp")
        .when(F.col("user_id").isNull(), "user id")
        .when(F.col("ad_id").isNull(), "ad id")
    )


def rejected_lines(lines):
    """The lines ``parse_ad_log`` leaves out, each with its reason."""
    return _fields(lines).select("value", _reason().alias("reason")).filter(F.col("reason").isNotNull())

