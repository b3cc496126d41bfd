"""Shared scratch space for staged tables and stream checkpoints."""

import tempfile
import uuid

_LOCAL_ROOTS = {}


def work_root(spark):
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="footfall-")
    return _LOCAL_ROOTS[app]


def new_dir(spark, name):
    """A folder path not used before."""
    app = spark.sparkContext.applicationId
    return f"{work_root(spark)}/footfall/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df, name):
    """Write ``df`` once and read it back.

    Cuts the lineage at a stored table, so losing executors costs no recomputation, and the
    planner sees the true size of the frame when it picks join strategies.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
