"""Counts over a sliding window, summed from panes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall import constants as K


def sliding_counts(panes, minutes=K.TREND_MINUTES, slide=K.SLIDE_SECONDS):
    """(ad_id, first_slide, last_slide, click_count): clicks of the last ``minutes`` minutes at every slide.

    ``panes`` (pane, ad_id, click_count) counts clicks per ``slide`` seconds. The count at a slide covers
    the panes that ended in the ``minutes`` minutes up to it; it changes where a pane enters or leaves only, so a row
    covers all slides from ``first_slide`` to ``last_slide``. Slides without clicks have no row.

    A pane gives three changes at most, never one row per slide. Time is cut in blocks as long as the window, and
    what a window brings over from the block before is a change at the block's start: running sums stay
    within (ad, block), so a busy ad with a long history is many short groups.
    """
    width = minutes * 60
    block = lambda at: at - F.pmod(at, F.lit(width))
    end, n = F.col("_end"), F.col("click_count")
    left = end + width
    change = lambda start, at, delta: F.struct(start.alias("_block"), at.alias("_at"), delta.alias("_delta"))
    changes = F.array(
        change(block(end), end, n),
        # Windows that do not end with their block go on into the next one.
        F.when(block(left) < left, change(block(left), block(left), n)),
        F.when(block(left) < left, change(block(left), left, -n)),
    )
    ended = panes.select("ad_id", (F.unix_seconds("pane") + slide).alias("_end"), "click_count")
    steps = ended.select("ad_id", F.inline(F.filter(changes, lambda c: c.isNotNull())))
    steps = steps.groupBy("ad_id", "_block", "_at").agg(F.sum("_delta").alias("_delta"))
    within = Window.partitionBy("ad_id", "_block").orderBy("_at")
    runs = steps.select(
        "ad_id",
        "_at",
        F.coalesce(F.lead("_at").over(within), F.col("_block") + width).alias("_next"),
        F.sum("_delta").over(within).alias("click_count"),
    )
    return runs.filter("click_count > 0").select(
        "ad_id",
        F.timestamp_seconds("_at").alias("first_slide"),
        F.timestamp_seconds(F.col("_next") - slide).alias("last_slide"),
        "click_count",
    )


def at_slides(counts, slide=K.SLIDE_SECONDS):
    """One row (ad_id, slide, click_count) per slide of ``sliding_counts``."""
    every = F.sequence("first_slide", "last_slide", F.make_interval(secs=F.lit(slide)))
    return counts.select("ad_id", F.explode(every).alias("slide"), "click_count")
