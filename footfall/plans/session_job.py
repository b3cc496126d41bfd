"""Session analysis of one task: length statistics, sampled actions, top categories."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from footfall import constants as K
from footfall import schemas
from footfall.functions.times import format_time
from footfall.operators import sessions as S
from footfall.sources.tables import scan_actions
from footfall.workdir import stage_table


def profiled_sessions(actions, users, params):
    """Sessions in the task's date range with their users' profiles and the flags the task's filters need."""
    facts = S.session_facts(scan_actions(actions, params.start_date, params.end_date), params)
    return S.enrich_sessions(facts, users)


def filtered_sessions(actions, users, params, one_sided=False):
    """Sessions in the task's date range whose user and content pass its filters."""
    return S.filter_sessions(profiled_sessions(actions, users, params), params, one_sided)


def _for_task(df, task_id, schema):
    return df.withColumn("task_id", F.lit(task_id).cast("bigint")).select(*schema.names)


def session_report(
    actions, users, params, task_id, sample=K.SAMPLED_ACTIONS, seed=0, sample_keys=None, digest="xxhash64"
):
    """The task's three result frames by table name.

    The sessions are stored once, as ids with a mark for the category counts; the lengths of the marked ones are
    counted on the side while they are written, so they are not read again for the shares. Where few are
    marked, a Bloom filter of their ids keeps the other actions out of the join's shuffle.
    """
    in_range = scan_actions(actions, params.start_date, params.end_date)
    lengths = Observation("session_lengths")
    marked = S.mark_sessions(profiled_sessions(actions, users, params), params)
    counted = marked.observe(lengths, *S.length_metrics(where=F.col("chosen") == 1))
    chosen = S.chosen_sessions(stage_table(counted.select("session_id", "chosen"), "marked-sessions"))
    shares = S.session_length_ratios(S.observed_length_counts(actions.sparkSession, lengths))
    categories = S.top_categories(S.category_counts(S.visited_in_sessions(in_range, chosen)))
    sampled = S.sample_actions(in_range, sample, seed, sample_keys, digest)
    sampled = sampled.withColumn("action_time", format_time("action_time"))
    return {
        "session_aggr_stat": _for_task(shares, task_id, schemas.SESSION_AGGR_STAT),
        "session_detail": _for_task(sampled, task_id, schemas.SESSION_DETAIL),
        "top10_category": _for_task(categories, task_id, schemas.TOP10_CATEGORY),
    }


def run_session_job(actions, users, params, task_id, write, **options):
    """Compute the report and hand each frame to ``write(table_name, frame)``."""
    for name, frame in session_report(actions, users, params, task_id, **options).items():
        write(name, frame)
