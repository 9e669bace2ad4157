"""Graphs of pipelines and of runs, walked by joins of a frontier with the edges until nothing is new.

Each round writes its frontier down, so that plans stay short and survive lost executors. The number of
rounds is the depth of the graph; no path is ever enumerated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import lookup_join
from tidemark.scratch import Scratch, measure

CHILD, PARENT = "pipeline_id", "parent_pipeline_id"


def _without(edges: DataFrame, nodes: DataFrame, column: str, how: str = "left_anti") -> DataFrame:
    named = nodes.select(F.col("node").alias(column))
    return lookup_join(edges, named, [column], how, size=measure(named))


def _nodes(edges: DataFrame, *columns: str) -> DataFrame:
    return edges.select(F.explode(F.array(*columns)).alias("node")).distinct()


def dependency_levels(dependencies: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``pipeline_id`` and ``level`` of every pipeline of the active dependencies: 0 without parents, else one
    more than the highest parent's. Pipelines on a cycle, or behind one, have no level (null): the
    ones that can run in waves are exactly those with a level. Rows with a null on either side are no edges."""
    scratch = scratch or Scratch(dependencies.sparkSession)
    edges = scratch.table(dependencies.filter("is_active").select(CHILD, PARENT).dropna().distinct())
    everyone = scratch.table(_nodes(edges, CHILD, PARENT))
    levels, open_edges, level = None, edges, 0
    waiting = everyone
    while True:
        blocked = open_edges.select(F.col(CHILD).alias("node")).distinct()
        free = scratch.table(waiting.join(blocked, "node", "left_anti"))
        if not free.take(1):
            break
        found = free.withColumn("level", F.lit(level))
        levels = found if levels is None else levels.union(found)
        waiting = scratch.table(waiting.join(free, "node", "left_anti"))
        open_edges = scratch.table(_without(open_edges, free, PARENT))
        level += 1
    rest = waiting.withColumn("level", F.lit(None).cast("int"))
    all_levels = rest if levels is None else levels.union(rest)
    return all_levels.withColumnRenamed("node", CHILD)


def dependency_cycles(dependencies: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``pipeline_id`` and ``cycle`` (the smallest id of its knot) of every pipeline that waits for itself, over
    however many others. Two are in one knot when each waits for the other."""
    scratch = scratch or Scratch(dependencies.sparkSession)
    edges = scratch.table(dependencies.filter("is_active").select(CHILD, PARENT).dropna().distinct())
    found = None
    while True:
        edges = _trimmed(edges, scratch)
        if not edges.take(1):
            break
        # each node takes the smallest id that reaches it; those that reach that id back are one knot
        label = scratch.table(_least_reaching(edges, scratch))
        ends = lookup_join(edges, label.toDF(CHILD, "a"), [CHILD], size=measure(label))
        ends = scratch.table(lookup_join(ends, label.toDF(PARENT, "b"), [PARENT], size=measure(label)).filter("a = b"))
        reached = scratch.table(_nodes(ends.filter("a = " + CHILD), CHILD).withColumn("cycle", F.col("node")))
        frontier = reached
        while True:
            step = lookup_join(ends, frontier.select(F.col("node").alias(CHILD), "cycle"), [CHILD], "inner", size=measure(frontier))
            step = step.filter("a = cycle").select(F.col(PARENT).alias("node"), "cycle").distinct()
            frontier = scratch.table(step.join(reached, "node", "left_anti"))
            if not frontier.take(1):
                break
            reached = scratch.table(reached.union(frontier))
        # a smallest id without a way back is alone, and alone is a knot only with an edge to itself
        sizes = reached.groupBy("cycle").agg(F.count(F.lit(1)).alias("n"))
        own = edges.filter(F.col(CHILD) == F.col(PARENT)).select(F.col(CHILD).alias("cycle")).withColumn("own", F.lit(True))
        knots = sizes.join(own, "cycle", "left").filter("n > 1 OR own").select("cycle")
        members = scratch.table(reached.join(knots, "cycle").select("node", "cycle"))
        found = members if found is None else found.union(members)
        edges = scratch.table(_without(_without(edges, reached, CHILD), reached, PARENT))
    if found is None:
        return dependencies.sparkSession.createDataFrame([], "pipeline_id string, cycle string")
    return found.select(F.col("node").alias(CHILD), "cycle")


def _trimmed(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges on or between cycles: ends without a parent or without a child go until there are none."""
    while True:
        children, parents = edges.select(F.col(CHILD).alias("node")).distinct(), edges.select(F.col(PARENT).alias("node")).distinct()
        kept = scratch.table(_without(_without(edges, children, PARENT, "left_semi"), parents, CHILD, "left_semi"))
        if kept.count() == edges.count():
            return kept
        edges = kept


def _least_reaching(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node and the smallest id among itself and all its ancestors, by passing labels down the edges."""
    labels = scratch.table(_nodes(edges, CHILD, PARENT).withColumn("label", F.col("node")))
    while True:
        passed = edges.join(labels.toDF(PARENT, "label"), PARENT).groupBy(F.col(CHILD).alias("node")).agg(F.min("label").alias("new"))
        joined = labels.join(passed, "node", "left")
        lower = F.coalesce(F.col("new") < F.col("label"), F.lit(False))
        after = scratch.table(joined.select("node", F.when(lower, F.col("new")).otherwise(F.col("label")).alias("label"), lower.alias("moved")))
        labels = after.select("node", "label")
        if not after.filter("moved").take(1):
            return labels


def ancestors(parents: DataFrame, start: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``run_id`` of the runs in ``start`` and of all runs that their rows came from, over any number of layers,
    with ``steps``, the fewest between. ``parents`` has run_id and parent_run_id. Cycles end the walk."""
    scratch = scratch or Scratch(parents.sparkSession)
    edges = parents.select("run_id", "parent_run_id").dropna().distinct()
    found = scratch.table(start.select("run_id").dropna().distinct().withColumn("steps", F.lit(0)))
    frontier, steps = found, 0
    while True:
        steps += 1
        size = measure(frontier)
        met = lookup_join(edges, frontier.select("run_id"), ["run_id"], "left_semi", size=size)
        new = met.select(F.col("parent_run_id").alias("run_id")).distinct().join(found, "run_id", "left_anti")
        frontier = scratch.table(new.withColumn("steps", F.lit(steps)))
        if not frontier.take(1):
            return found
        found = scratch.table(found.union(frontier))
