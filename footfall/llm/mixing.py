"""Mixing of sources to target weights by Poisson replication.

Every document is repeated k times, k drawn from the Poisson distribution whose mean is its
source's repetition rate (target size / size). The draw inverts the distribution at a uniform
number hashed from (seed, doc_id), so it is the same in every run and on every partition, and needs
no state. The copies are then dealt out and ordered by a second hash, which shuffles globally.

Rows whose doc_id is null or stands on several rows draw apart: their number is hashed from the id, the
whole row and its place among the rows equal to it in all columns, so it is as reproducible.

Nulls: a null source is a source of its own, a null text has size 0. A source of total size 0 gets rate 1.
Targets that name no source of the table are ignored. An empty table gives no rows.
"""

from pyspark.sql import functions as F

from footfall.llm.common import fresh, shuffle_partitions, stage


def hashed_uniform(seed, *cols):
    """A number in [0, 1) with 52 bits, hashed by MD5 from the seed and the columns' texts."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def inverse_poisson(u, rate):
    """Smallest k with P(X <= k) > u for a Poisson variable of mean ``rate`` (a column).

    The walk ends at rate + 12 sqrt(rate) + 40, beyond which less weight lies than one 2^-52 step of
    ``u``. Terms are carried as logarithms, so that large rates do not underflow.
    """
    top = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    # ``u`` travels in the state: inside the lambda it would be hashed again at every step.
    start = F.struct(F.lit(0).alias("k"), (-rate).alias("logp"), F.exp(-rate).alias("cdf"), u.alias("u"))

    def step(state, i):
        logp = state["logp"] + F.log(rate) - F.log(i.cast("double"))
        further = F.struct(
            i.alias("k"), logp.alias("logp"), (state["cdf"] + F.exp(logp)).alias("cdf"), state["u"].alias("u")
        )
        return F.when(state["cdf"] > state["u"], state).otherwise(further)

    drawn = F.aggregate(F.sequence(F.lit(1), top), start, step)["k"]
    return F.when(rate > 0, drawn).otherwise(F.lit(0))


def repetition_rates(docs, source_col="source", text_col="text", targets=None, temperature=0.7):
    """One row per source: ``rate``, the mean number of copies that brings it to its target share.

    ``targets``: a table (source, weight); without it the weight of a source is its byte size to the
    power ``temperature``. Shares are taken among the sources present and the total size is kept.
    """
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0))
    sources = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).cast("double").alias("size"))
    if targets is None:
        sources = sources.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        weights = targets.groupBy("source").agg(F.sum("weight").cast("double").alias("weight"))
        sources = (
            sources.alias("s")
            .join(weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left")
            .select("s.source", "s.size", F.coalesce("w.weight", F.lit(0.0)).alias("weight"))
        )
    sums = sources.agg(F.sum("size").alias("sizes"), F.sum("weight").alias("weights"))
    rate = F.col("weight") / F.col("weights") * F.col("sizes") / F.col("size")
    # ``sums`` is one row.
    return sources.join(F.broadcast(sums)).select(
        "source",
        "size",
        F.when((F.col("size") > 0) & (F.col("weights") > 0), rate).otherwise(F.lit(1.0)).alias("rate"),
    )


#: Equal rows that one task numbers together.
EQUAL_ROWS = 1000


def with_draws(docs, id_col, seed, draw, equal_rows=EQUAL_ROWS):
    """``docs`` with a uniform number per row in ``draw``.

    Equal rows are counted, never sorted or gathered: the counted row goes out once per block of
    ``equal_rows``, and the blocks are numbered wherever the shuffle takes them.
    """
    names = docs.columns
    n, block, place, row, shared = (fresh(x) for x in ("n", "block", "place", "row", "shared"))
    ids = docs.groupBy(F.col(id_col).alias(shared)).agg(F.count("*").alias(n))
    ids = stage(ids.filter((F.col(n) > 1) | F.col(shared).isNull()).select(shared), "shared-ids")
    is_shared = docs[id_col].eqNullSafe(ids[shared])
    single = docs.join(ids, is_shared, "left_anti").withColumn(draw, hashed_uniform(seed, F.col(id_col)))
    counted = docs.join(ids, is_shared, "left_semi").groupBy(*names).agg(F.count("*").alias(n))
    blocks = counted.withColumn(row, F.xxhash64(*names)).withColumn(
        block, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / equal_rows)))
    )
    blocks = blocks.repartition(shuffle_partitions(docs.sparkSession), F.xxhash64(row, block))
    begin = F.col(block) * equal_rows
    placed = blocks.withColumn(
        place, F.explode(F.sequence(begin, F.least(begin + equal_rows, F.col(n)) - 1))
    ).withColumn(draw, hashed_uniform(seed, F.col(id_col), F.col(row), F.col(place)))
    return single.select(*names, draw).union(placed.select(*names, draw))


def poisson_mix(docs, source_col="source", text_col="text", id_col="doc_id", targets=None, temperature=0.7, seed=1):
    """``docs`` with every row repeated by its draw, and a ``copy`` number from 0, in hashed order."""
    spark = docs.sparkSession
    source, rate, count, copy, key, draw = (fresh(n) for n in ("source", "rate", "count", "copy", "key", "draw"))
    # Rates are staged: one row per source, joined by whatever strategy their size allows.
    rates = stage(repetition_rates(docs, source_col, text_col, targets, temperature), "rates")
    rates = rates.select(F.col("source").alias(source), F.col("rate").alias(rate))
    drawn = with_draws(docs, id_col, seed, draw)
    counted = drawn.join(rates, drawn[source_col].eqNullSafe(F.col(source)), "left").withColumn(
        count, inverse_poisson(F.col(draw), F.col(rate))
    )
    copies = counted.filter(F.col(count) > 0).withColumn(
        copy, F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    )
    key_of = F.xxhash64(F.lit(seed), F.col(id_col), F.col(draw), F.col(copy))
    out = copies.withColumn(key, key_of).repartition(shuffle_partitions(spark), key).sortWithinPartitions(key)
    out = out.drop(source, rate, count, key, draw)
    return out.withColumnRenamed(copy, "copy") if "copy" not in docs.columns else out.drop(copy)
