"""An index of a hierarchy that answers "is this above that" without the closure.

The nodes are cut into chains, each node above the one before it. Whatever reaches a place of a chain reaches all places
further up, so one number per node and chain it reaches, the lowest place, stands for all its ancestors there. A deep
hierarchy has long chains, and its index is far smaller than its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kgspark.errors import IngestError
from kgspark.operators.hierarchy import peel
from kgspark.session import any_row, folder_exists, remove_folder, remove_shared, shared_folder, write_shared

#: Longest chain of a hierarchy that is indexed level by level.
SHALLOW = 64


@dataclass(frozen=True)
class ReachabilityIndex:
    """``places`` (node, chain, position: each node once) and ``reach`` (node, chain, lowest: proper ancestors only)."""

    places: DataFrame
    reach: DataFrame

    def is_above(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (node, ancestor) with ``above``: whether the one is a proper ancestor of the other."""
        at = self.places.select(F.col("node").alias("ancestor"), "chain", "position")
        held = pairs.select("node", "ancestor").join(at, "ancestor", "left").join(self.reach, ["node", "chain"], "left")
        return held.select("node", "ancestor", F.coalesce(F.col("position") >= F.col("lowest"), F.lit(False)).alias("above"))

    def ancestors_of(self, start: DataFrame, start_col: str = "id") -> DataFrame:
        """Proper ``node, ancestor`` pairs of the start nodes: as many rows as there are, and no round."""
        wanted = self.reach.join(start.select(F.col(start_col).alias("node")).distinct().hint("merge"), "node", "left_semi")
        above = wanted.join(self.places.withColumnRenamed("node", "ancestor").hint("merge"), "chain").filter("position >= lowest")
        return above.select("node", "ancestor")

    def ancestor_counts(self) -> DataFrame:
        """Proper ancestors per node that has any: sums over chains, no pair is made."""
        length = self.places.groupBy("chain").agg((F.max("position") + 1).alias("length"))
        counted = self.reach.join(length.hint("merge"), "chain").groupBy("node").agg(F.sum(F.col("length") - F.col("lowest")).alias("ancestors"))
        return counted


def chains(edges: DataFrame) -> DataFrame:
    """Every node once in a chain: ``node, chain, position``, positions from 0 upwards; a chain is named by its first node.

    A node goes on to its smallest parent, a parent goes on from the smallest child that chose it. Places follow by
    doubling, in as many rounds as the logarithm of the longest chain. More rounds than that mean a cycle, an error.
    """
    nodes = edges.select(F.explode(F.array("child", "parent")).alias("node")).distinct()
    chosen = edges.groupBy("child").agg(F.min("parent").alias("parent")).groupBy("parent").agg(F.min("child").alias("child"))
    # Pointers to the node below, until they point at the first node of the chain.
    below = nodes.join(chosen.select(F.col("parent").alias("node"), F.col("child").alias("to")), "node", "left").select(
        "node", F.coalesce("to", "node").alias("to"), F.when(F.col("to").isNull(), 0).otherwise(1).cast("bigint").alias("steps")
    )
    below, walked = write_shared(below), None
    for _ in range(below.count().bit_length() + 2):
        far = below.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        below = write_shared(below.join(far.hint("merge"), "to").select("node", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps")))
        walked, before = below.agg(F.sum("steps")).first()[0], walked
        if walked == before:
            return below.select("node", F.col("to").alias("chain"), F.col("steps").alias("position"))
    raise IngestError("the hierarchy has a cycle")


def reachability_index(edges: DataFrame) -> ReachabilityIndex:
    """The index of a hierarchy ``child, parent``; a cycle is an error, repeated edges count once.

    Up to chains of ``SHALLOW`` nodes, nodes hand on what they reach level by level; deeper hierarchies are doubled.
    """
    pairs = write_shared(edges.select("child", "parent").distinct())
    places = write_shared(chains(pairs))
    longest = places.agg(F.max("position")).first()[0]
    return ReachabilityIndex(places, (_by_levels if longest is None or longest < SHALLOW else _doubled)(pairs, places))


def _by_levels(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """``reach``: from the roots down, a node whose parents are all done hands what it reaches to its children.

    What a node reaches waits at its level. So it is moved once for each edge, however many rounds there are: as many as
    levels.
    """
    spark = pairs.sparkSession
    peeled = peel(pairs)
    if peeled.residue is not None:
        raise IngestError("the hierarchy has a cycle")
    level = write_shared(peeled.levels(pairs))  # of children; roots have none
    remove_folder(spark, peeled.folder)
    to = level.select(F.col("node").alias("child"), F.col("level").alias("to")).hint("merge")
    steps, waiting, done = shared_folder(spark), shared_folder(spark), shared_folder(spark)
    onward = write_shared(pairs.join(to, "child"))
    onward.join(level.withColumnRenamed("node", "parent").hint("merge"), "parent").write.partitionBy("level").parquet(steps)
    at = places.withColumnRenamed("node", "parent").hint("merge")
    handed = lambda found, lowest: found.select(F.col("child").alias("node"), "chain", F.col(lowest).alias("lowest"), F.col("to").alias("level"))
    first = handed(onward.join(at, "parent"), "position")
    shape, path = first.drop("level").schema, onward.schema
    first.write.partitionBy("level").parquet(waiting)
    remove_shared(onward)
    remove_shared(level)
    for n in range(1, peeled.rounds + 1):
        held = spark.read.schema(shape).parquet(f"{waiting}/level={n}")
        found = write_shared(held.groupBy("node", "chain").agg(F.min("lowest").alias("lowest")), f"{done}/level={n}")
        if folder_exists(spark, f"{steps}/level={n}"):
            step = spark.read.schema(path).parquet(f"{steps}/level={n}")
            passed = found.withColumnRenamed("node", "parent").join(step.hint("merge"), "parent")
            handed(passed, "lowest").write.partitionBy("level").mode("append").parquet(waiting)
        remove_folder(spark, f"{waiting}/level={n}")
    remove_folder(spark, steps)
    return spark.read.schema(shape).parquet(*[f"{done}/level={n}" for n in range(1, peeled.rounds + 1)]) if peeled.rounds else first.drop("level").limit(0)


def _doubled(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """``reach`` in rounds that compose what is known with itself: a node reaches what the lowest node it reaches on a chain does.

    Paths over twice as many chains are covered by each round; one that lowers nothing is the last.
    """
    at = places.select(F.col("node").alias("parent"), "chain", "position")
    reach = pairs.join(at, "parent").groupBy(F.col("child").alias("node"), "chain").agg(F.min("position").alias("lowest"))
    size = None
    while True:
        filled = write_shared(_filled(reach, places))
        there = places.select(F.col("node").alias("other"), "chain", F.col("position").alias("lowest"))
        beyond = filled.select(F.col("node").alias("other"), F.col("chain").alias("to"), F.col("lowest").alias("reached"))
        further = filled.join(there, ["chain", "lowest"]).join(beyond, "other").select("node", F.col("to").alias("chain"), F.col("reached").alias("lowest"))
        reach = write_shared(filled.unionByName(further).groupBy("node", "chain").agg(F.min("lowest").alias("lowest")))
        # Rows are only added and places only lowered, so both numbers tell whether anything moved.
        now = tuple(reach.agg(F.count(F.lit(1)), F.sum("lowest")).first())
        if now == size:
            break
        size = now
    own = reach.join(places, ["node", "chain"]).filter("lowest <= position")
    if any_row(own):  # a node above itself
        raise IngestError("the hierarchy has a cycle")
    return reach


def _filled(reach: DataFrame, places: DataFrame) -> DataFrame:
    """``reach`` with what the nodes further up the same chain reach: running minima down each chain."""
    here = places.select("node", F.col("chain").alias("own"), "position")
    known = reach.join(here, "node")
    last = known.groupBy("own", "chain").agg(F.max("position").alias("last"))
    grid = here.join(last, "own").filter("position <= last").join(reach, ["node", "chain"], "left")
    downward = Window.partitionBy("own", "chain").orderBy(F.desc("position"))
    return grid.select("node", "chain", F.min("lowest").over(downward).alias("lowest"))
