"""Connected components of a graph given as a table of edges."""

from pyspark.sql import functions as F

from footfall.llm.common import stage


def components(edges):
    """(vertex, component) for every vertex of ``edges`` (a, b); component is its smallest vertex.

    Every vertex points at a label, and labels at labels. A round takes the smallest label's label among
    the neighbours of each vertex, points both the vertex and the label it had at it (so whole trees
    merge, not vertices one by one), and then halves the way to the root. Regions at least pair up in
    every round, so even long chains end after about as many rounds as their length has bits; the loop
    ends when no label moves. Each round is written to the shared folder, so lost executors cost one
    round at most. Labels are combined before they are shuffled; the joins of edges with labels
    are left to adaptive execution to split.

    Loops and repeated edges do no harm. An edge with a null end is ignored.
    """
    pairs = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stage(both, "edges")
    start = both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.col("a"), F.min("b")).alias("label"))
    labels = _with_roots(stage(start, "labels"))
    while True:
        reached = both.join(labels, both["b"] == labels["vertex"]).groupBy("a").agg(F.min("root").alias("seen"))
        known = stage(labels.join(reached, labels["vertex"] == reached["a"]).select(
            "vertex", "label", "root", F.least("root", "seen").alias("next")
        ), "reached")
        hooks = known.groupBy(F.col("label").alias("hooked")).agg(F.min("next").alias("to"))
        new = known.join(hooks, known["vertex"] == hooks["hooked"], "left").select(
            "vertex", F.least("next", F.coalesce("to", "next")).alias("label"), F.col("root").alias("before")
        )
        labels = _with_roots(stage(new, "labels"), "before")
        if labels.filter("root <> before OR root <> label").isEmpty():
            return labels.select("vertex", F.col("root").alias("component"))


def _with_roots(labels, *keep):
    """``labels`` (vertex, label) with the label of every label as ``root``."""
    of = labels.select(F.col("vertex").alias("at"), F.col("label").alias("root"))
    return stage(labels.join(of, labels["label"] == of["at"]).select("vertex", "label", "root", *keep), "roots")
