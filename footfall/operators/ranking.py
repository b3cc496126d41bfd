"""Top-N and exact-size samples with a total order, so that results are reproducible."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def top_n_per_group(df, group, order, n):
    """The first ``n`` rows of each group.

    Spark limits each group before the shuffle as well as after it, so even a group that holds
    most of the rows sends at most ``n`` rows per input partition.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def sample_exact(df, keys, n, seed=0, digest="xxhash64"):
    """``n`` rows without replacement, chosen by a seeded hash of the key columns.

    ``digest="md5"`` hashes the text of the keys, which other engines can repeat. Rows equal in the
    keys are ordered by all their other columns, so that every run draws the same rows.
    """
    if digest == "md5":
        parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
        draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    else:
        draw = F.xxhash64(F.lit(seed), *keys)
    others = [c for c in df.columns if c not in keys]
    # A column of its own: an expression in the sort order would be evaluated at every comparison.
    drawn = df.withColumn("_draw", draw).orderBy("_draw", *keys, *others).limit(n)
    return drawn.drop("_draw")
