"""Connected components of an edge table, by hooking and pointer jumping between written tables."""

from pyspark.sql import functions as F

from locrank.llm.words import keep


def components(edges, purpose):
    """(vertex, component) for every end of edges(a, b): the smallest vertex reachable.

    Each round lowers a vertex's label to the smallest label of its neighbours' labels, lowers the
    label of its former root too, and then jumps to its label's label, so that the rounds grow with
    the logarithm of the longest path. Labels are written tables with one row per vertex: joins
    meet plain scans, whose hot keys adaptive execution splits, and the minimum is combined in the
    map tasks, so a hub costs one row per task. Only a count of changes reaches the driver.
    """
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = keep(both.distinct(), f"{purpose}-edges")
    labels = keep(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("l")), purpose)
    while True:
        ends = labels.select(F.col("v").alias("b"), F.col("l").alias("near"))
        roots = labels.select(F.col("v").alias("a"), F.col("l").alias("root"))
        offers = both.join(ends, "b").groupBy("a").agg(F.min("near").alias("near")).join(roots, "a")
        # A neighbour's label is offered to the vertex and to the root it hung on.
        lowered = (
            offers.select(F.expr("stack(2, a, least(near, root), root, least(near, root)) as (v, l)"))
            .groupBy("v")
            .agg(F.min("l").alias("l"))
        )
        lowered = keep(lowered, purpose)
        above = lowered.select(F.col("v").alias("l"), F.col("l").alias("top"))
        before = labels.select("v", F.col("l").alias("was"))
        jumped = lowered.join(above, "l").select("v", F.col("top").alias("l")).join(before, "v")
        jumped = keep(jumped.select("v", "l", (F.col("l") != F.col("was")).alias("moved")), purpose)
        labels = jumped.select("v", "l")
        if jumped.where("moved").limit(1).count() == 0:
            return labels.select(F.col("v").alias("vertex"), F.col("l").alias("component"))
