"""Hierarchies: walks level by level, forests by pointer doubling, closure of graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.skew import partial_salted_join
from lakeops.session import scratch_path, scratch_root, sibling_session


def walk(
    edges: DataFrame,
    roots: DataFrame,
    child: str = "id",
    parent: str = "parent_id",
    sep: str = "/",
) -> DataFrame:
    """(root, node, level, path) for every path from the roots down.

    A step that would revisit a node of its own path is not taken, so cycles end. Each
    level is checkpointed: the plan stays flat and a lost executor repeats one level. The
    walk ends when a level is empty, however deep that is.
    """
    scratch_root(edges.sparkSession)
    # Read at every level, so the two columns are kept; what is returned does not need them.
    links = edges.select(F.col(parent).alias("__p"), F.col(child).alias("__c")).filter(F.col("__p").isNotNull()).persist()
    node = roots.columns[0]
    frontier = roots.select(
        F.col(node).alias("root"),
        F.col(node).alias("node"),
        F.lit(1).cast("long").alias("level"),
        F.col(node).cast("string").alias("path"),
        F.array(F.col(node)).alias("__seen"),
    ).checkpoint()
    found = frontier
    while True:
        frontier = (
            frontier.join(links, F.col("node") == F.col("__p"))
            .filter(~F.array_contains("__seen", F.col("__c")))
            .select(
                "root",
                F.col("__c").alias("node"),
                (F.col("level") + 1).alias("level"),
                F.concat_ws(sep, "path", F.col("__c").cast("string")).alias("path"),
                F.concat("__seen", F.array("__c")).alias("__seen"),
            )
            .checkpoint()
        )
        if frontier.isEmpty():
            links.unpersist()
            return found.drop("__seen")
        found = found.unionAll(frontier)


def forest(edges: DataFrame, child: str = "id", parent: str = "parent_id", sep: str = "/", paths: bool = True) -> DataFrame:
    """(node, root, level, path) of every node of trees, in as many rounds as the depth has binary digits.

    Every node points to an ancestor, and a round replaces that by the ancestor's own one, so
    the distance doubles. Nodes named as parents only, without a parent, or their own
    parent are roots of level 1. Nodes on a cycle longer than that, or below one, have a null root,
    level and path. A node with two parents is refused: `walk` follows those. Paths take space by the
    square of the depth; without `paths` there is no such column. Ancestors that many nodes point to are
    salted, as they get hotter from round to round.

    The rounds are partitions of one table in the shared folder, read anew by each: a plan is as long
    as one round's, and its sizes are those of files. Of a checkpoint Spark keeps the size estimated by the plan
    that made it, for a join the product of both sides': a number whose digits double with every round.
    """
    spark = edges.sparkSession
    table = scratch_path(spark, "forest")
    # Estimated by its files a side would be broadcast through the driver, though its rows are many times longer there.
    tuned = sibling_session(spark, spark__sql__autoBroadcastJoinThreshold="-1")
    c, p = F.col(child), F.col(parent)
    links = edges.filter(c.isNotNull()).select(c.alias("node"), F.when(c != p, p).alias("anc")).distinct().checkpoint()
    up = links.filter("anc is not null")
    twice = up.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node").take(1)
    if twice:
        raise ValueError(f"{twice[0]['node']!r} has more than one parent")
    # A null parent beside a real one says nothing.
    ends = links.select("node").unionAll(up.select("anc")).distinct().join(up.select("node"), "node", "left_anti")
    text = [F.col("node").cast("string").alias("path")] if paths else []
    state = ["node", "anc", "steps", *(["path"] if paths else [])]
    known = ends.select("node", F.col("node").alias("anc"), F.lit(1).cast("long").alias("steps"), *text, F.lit(True).alias("done"))
    open_ = up.select("node", "anc", F.lit(1).cast("long").alias("steps"), *text, F.lit(False).alias("done"))
    # A side without rows still gives the table its types.
    schema = known.unionAll(open_).withColumn("round", F.lit(0)).schema
    path = [F.concat_ws(sep, "__path", "path").alias("path")] if paths else []

    def keep(moved: DataFrame, number: int) -> None:
        moved.select(*state, "done", F.lit(number).alias("round")).write.mode("append").partitionBy("round", "done").parquet(table)

    def read(session: SparkSession) -> DataFrame:
        return session.read.schema(schema).parquet(table)

    keep(known.unionAll(open_), 0)
    number = 0
    while True:
        now = read(tuned)
        there = now.filter(F.col("done") | (F.col("round") == number)).select(
            F.col("node").alias("anc"), F.col("anc").alias("__anc"), F.col("steps").alias("__steps"), F.col("done").alias("__done"),
            *([F.col("path").alias("__path")] if paths else []),
        )
        open_ = now.filter((F.col("round") == number) & ~F.col("done")).select(*state)
        moved = partial_salted_join(open_, there, "anc", ["node"], how="inner").select(
            "node", F.col("__anc").alias("anc"), (F.col("steps") + F.col("__steps")).alias("steps"), *path, F.col("__done").alias("done")
        )
        number += 1
        keep(moved, number)
        # A tree has nodes at every distance up to its depth: where none came in, none is left in a tree.
        if read(tuned).filter((F.col("round") == number) & F.col("done")).isEmpty():
            break
    found = read(spark)
    lost = found.filter((F.col("round") == number) & ~F.col("done")).select("node", F.lit(None), F.lit(None), *([F.lit(None)] if paths else []))
    kept = ["path"] if paths else []
    return found.filter("done").select("node", F.col("anc").alias("root"), F.col("steps").alias("level"), *kept).unionAll(lost)


def closure(edges: DataFrame, source: str, target: str, sources: Sequence[str] | None = None) -> DataFrame:
    """(source, target, hops) reachable pairs of a graph of tables, with the fewest hops.

    From all sources, or those given. A round goes on from the pairs that are new only, and the
    walk ends when there are none. Nodes that many of these pairs lead to are salted.
    """
    scratch_root(edges.sparkSession)
    step = edges.select(F.col(source).alias("source"), F.col(target).alias("target")).distinct().checkpoint()
    hop = step.select(F.col("source").alias("target"), F.col("target").alias("__t"))
    frontier = step.withColumn("hops", F.lit(1).cast("long"))
    if sources is not None:
        frontier = frontier.filter(F.col("source").isin(list(sources)))
    known = frontier
    while True:
        reached = (
            partial_salted_join(frontier, hop, "target", ["source"], how="inner")
            .select("source", F.col("__t").alias("target"), (F.col("hops") + 1).alias("hops"))
            .distinct()
        )
        frontier = reached.join(known, ["source", "target"], "left_anti").checkpoint()
        if frontier.isEmpty():
            return known
        known = known.unionAll(frontier)
