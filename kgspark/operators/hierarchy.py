"""Iterative operators on a multi-parent hierarchy ``child, parent``.

Loops are driven from the driver, one shuffle join per level; what each round
keeps goes to the checkpoint folder, so lost executors cost one round at most.
Tables of a hierarchy compress so well that their files look small enough for
broadcasts which are not: joins of a loop are sorted and merged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kgspark.operators.stats import distribution
from kgspark.session import (
    ROWS_A_TASK, folder_exists, gathering, materialise, observed, remove_folder, remove_shared, shared_folder, small_tasks,
    write_shared,
)


# Rounds after which a growing union becomes one stored table.
COMPACT = 4
# Shares of the pairs of one ancestor, so that one with many pairs is not one task.
SHARES = 8
# Rows of a counted table up to which it may be broadcast.
FEW_ROWS = 100_000
# Children up to which the packs of one place are put together as arrays; those of a place with more go by rows.
FAN = 16
# Layers of leaves that are set aside before levels are peeled, as long as a layer holds at least this share of the edges.
LAYERS, LAYER_SHARE = 3, 0.25
# Levels of pairs that go no further, and of those whose ancestor is on or below a cycle.
DONE, ENDLESS = -1, -2


@dataclass(frozen=True)
class Peeling:
    """``folder`` with the edges ``child, parent`` left at each level, and the edges that never peel off (none for a DAG)."""

    folder: str
    rounds: int
    residue: DataFrame | None

    def levels(self, edges: DataFrame) -> DataFrame:
        """``node, level``: the last level that a child has edges at; children on or below a cycle have the last of all."""
        if not self.rounds:
            return edges.select(F.col("child").alias("node"), F.lit(0).alias("level")).limit(0)
        shape = edges.select("child", F.lit(0).alias("level")).schema
        left = edges.sparkSession.read.schema(shape).parquet(self.folder)
        return left.groupBy(F.col("child").alias("node")).agg(F.max("level").alias("level"))


def peel(edges: DataFrame) -> Peeling:
    """Drop the edges below a root, level by level.

    Round k keeps the edges whose parent is still somebody's child. A node that
    is a child in round k therefore has a path of length k + 1 above it. The
    kept edges only shrink; once a round drops none, the rest hangs below a cycle.
    There are as many rounds as levels.
    """
    folder = shared_folder(edges.sparkSession)
    current, n = materialise(edges.select("child", "parent").distinct(), f"{folder}/level=1")
    rounds = 0
    while n:
        rounds += 1
        children = current.select(F.col("child").alias("parent")).hint("merge")
        deeper = current.join(children, "parent", "left_semi").select("child", "parent")
        following, left = materialise(deeper, f"{folder}/level={rounds + 1}")
        if left == n:
            return Peeling(folder, rounds, following)
        current, n = following, left
    return Peeling(folder, rounds, None)


def find_cycle_nodes(edges: DataFrame) -> DataFrame:
    """Nodes on a cycle or below one; no rows for a DAG."""
    peeled = peel(edges)
    if peeled.residue is None:
        return edges.select(F.col("child").alias("node")).limit(0)
    return peeled.residue.select(F.col("child").alias("node")).distinct()


def name_cycle(edges: DataFrame) -> DataFrame:
    """One cycle as ``position, node`` in walking order, from its smallest node.

    Each residue node points to its smallest parent in the residue, so pointers
    form cycles with tails. Pointer doubling finds the nodes on cycles and ranks
    the smallest one's cycle in a logarithmic number of joins.
    """
    residue = peel(edges).residue
    empty = edges.select(F.lit(0).cast("bigint").alias("position"), F.col("child").alias("node")).limit(0)
    if residue is None:
        return empty
    step, n = materialise(residue.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("next")))

    # After 2^k >= n steps every pointer has left its tail.
    jump, span = step, 1
    while span < n:
        hop = jump.select(F.col("node").alias("next"), F.col("next").alias("far"))
        jump, _ = materialise(jump.join(hop, "next").select("node", F.col("far").alias("next")))
        span *= 2
    on_cycle, _ = materialise(jump.select(F.col("next").alias("node")).distinct().join(step, "node"))
    first = on_cycle.agg(F.min("node")).collect()[0][0]

    # List ranking: distances to the first node double until it has come full circle.
    rank, _ = materialise(on_cycle.select("node", "next", F.lit(1).cast("bigint").alias("steps")))
    while True:
        closed = rank.filter((F.col("node") == F.lit(first)) & (F.col("next") == F.lit(first))).collect()
        if closed:
            length = F.lit(closed[0]["steps"])
            ranked = rank.filter(F.col("next") == F.lit(first))
            return ranked.select((length - F.col("steps")).alias("position"), "node")
        ahead = rank.select(
            F.col("node").alias("next"), F.col("next").alias("far"), F.col("steps").alias("more")
        )
        moved = rank.filter(F.col("next") != F.lit(first)).join(ahead, "next").select(
            "node", F.col("far").alias("next"), (F.col("steps") + F.col("more")).alias("steps")
        )
        rank, _ = materialise(rank.filter(F.col("next") == F.lit(first)).unionByName(moved))


def depth(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """Longest path to a root per node: ``id, depth``; roots are 0.

    Nodes on or below a cycle have no longest path and get NULL.
    """
    base = nodes.select(F.col(id_col).alias("id")).distinct()
    level = _levels(edges).withColumnRenamed("node", "id")
    found = F.when(F.col("level") == ENDLESS, F.lit(None)).otherwise(F.coalesce(F.col("level"), F.lit(0))).cast("bigint")
    return base.join(level.hint("merge"), "id", "left").select("id", found.alias("depth"))


def _levels(edges: DataFrame) -> DataFrame:
    """``node, level`` of every child, stored; ``ENDLESS`` on or below a cycle.

    Most edges of a hierarchy lead to leaves, which nothing hangs below: their level follows from their parents' at the
    end, so they need not take part in every round. Layers of them are set aside first and come back in reverse order.
    """
    spark, layers = edges.sparkSession, []
    inner, n = materialise(edges.select("child", "parent").distinct())
    while n and len(layers) < LAYERS:
        parents = inner.select(F.col("parent").alias("child")).distinct().withColumn("above", F.lit(True))
        folder, shape = shared_folder(spark), inner.schema
        parted = inner.join(parents.hint("merge"), "child", "left").withColumn("above", F.coalesce("above", F.lit(False)))
        parted.write.partitionBy("above").parquet(folder)
        part = lambda above: spark.read.schema(shape).parquet(f"{folder}/above={above}") if folder_exists(
            spark, f"{folder}/above={above}") else inner.limit(0)
        leaves, inner = part("false"), part("true")
        left = inner.count()
        layers.append(leaves)
        if n - left < LAYER_SHARE * n:
            break
        n = left
    peeled = peel(inner)
    level = peeled.levels(inner)
    if peeled.residue is not None:
        endless = peeled.residue.select(F.col("child").alias("node"), F.lit(True).alias("endless")).distinct()
        level = level.join(endless.hint("merge"), "node", "left").select(
            "node", F.when(F.col("endless"), F.lit(ENDLESS)).otherwise(F.col("level")).alias("level")
        )
    level = write_shared(level)
    remove_folder(spark, peeled.folder)
    for leaves in reversed(layers):
        above = level.select(F.col("node").alias("parent"), "level").hint("merge")
        deepest = F.max(F.coalesce("level", F.lit(0))) + 1
        below = leaves.join(above, "parent", "left").groupBy(F.col("child").alias("node")).agg(
            F.when(F.bool_or(F.coalesce(F.col("level") == ENDLESS, F.lit(False))), F.lit(ENDLESS)).otherwise(deepest).alias("level")
        )
        level = write_shared(level.unionByName(below))
    return level


def ancestors(edges: DataFrame) -> DataFrame:
    """All proper ``node, ancestor`` pairs."""
    return closed_pairs(edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")), edges)


def ancestors_of(edges: DataFrame, start: DataFrame, start_col: str = "id") -> DataFrame:
    """Proper ``node, ancestor`` pairs of the start nodes only."""
    begin = start.select(F.col(start_col).alias("node")).distinct()
    pairs = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"))
    return closed_pairs(pairs.join(begin.hint("merge"), "node", "left_semi"), edges)


def gene_ancestors(participation: DataFrame, edges: DataFrame, few: bool = False) -> DataFrame:
    """Distinct ``gene, ancestor``: a gene's pathways and everything above them.

    ``few`` says that the memberships are those of some genes only; it changes nothing any more.
    """
    return closed_packs(participation, edges).select(F.explode("genes").alias("gene"), F.col("pathway").alias("ancestor"))


def closed_packs(participation: DataFrame, edges: DataFrame) -> DataFrame:
    """Closed memberships as arrays, ``pathway, share, genes``: the genes of a pathway and of all below it; stored.

    Genes climb together (see :func:`_climbed`): a closed table has many memberships for each row of the hierarchy, and a
    membership costs a few bytes and one look into a hash set at each step, not a row that is moved and sorted. A set is cut
    into shares by the hash of the gene, and where many children meet their genes do so by rows, so that neither a set
    nor a place of any size is one array.
    """
    spark = participation.sparkSession
    with small_tasks(spark), gathering(spark):
        seen = Observation()
        genes = F.approx_count_distinct("gene").alias("genes")
        pairs = write_shared(participation.select("gene", "pathway").observe(seen, genes))
        most = observed(seen, "genes")
        shares = int(pairs.select(genes).first()[0] if most is None else most) // ROWS_A_TASK + 1
        rows = pairs.select(F.col("gene").alias("node"), F.col("pathway").alias("ancestor"))
        wide, hubs = materialise(_fans(edges).filter("wide").select(F.col("parent").alias("hub"), "wide"))
        wide = wide.hint("broadcast" if hubs <= FEW_ROWS else "merge")

        def merged(held: DataFrame) -> DataFrame:
            if not hubs:
                return _merged(held)
            held = held.join(wide, F.col("ancestor").eqNullSafe(F.col("hub")), "left")
            by_rows = held.filter("wide").select(F.explode("nodes").alias("node"), "ancestor").distinct()
            return _merged(held.filter("wide IS NULL")).unionByName(_packed(by_rows, shares))

        def in_rounds(held: DataFrame, step: DataFrame) -> DataFrame:
            return _packed(_closed_in_rounds(held.select(F.explode("nodes").alias("node"), "ancestor"), step), shares)

        closed = _climbed(_packed(rows, shares), edges, merged, in_rounds, shares)
        remove_shared(pairs)
        remove_shared(wide)
    return closed.select(F.col("ancestor").alias("pathway"), "share", F.col("nodes").alias("genes"))


def _packed(pairs: DataFrame, shares: int) -> DataFrame:
    """Distinct ``node, ancestor`` as arrays: ``ancestor, share, nodes``."""
    share = F.pmod(F.xxhash64("node"), F.lit(shares)).cast("int").alias("share")
    dealt = pairs.select("ancestor", share, "node").repartition("ancestor", "share")
    null = F.when(F.bool_or(F.isnull("node")), F.array(F.lit(None))).otherwise(F.array())
    return dealt.groupBy("ancestor", "share").agg(F.concat(F.collect_set("node"), null).alias("nodes"))


def _merged(packs: DataFrame) -> DataFrame:
    """One array for each ``ancestor, share``, of which there are a handful."""
    dealt = packs.select("ancestor", "share", "nodes").repartition("ancestor", "share")
    return dealt.groupBy("ancestor", "share").agg(F.array_distinct(F.flatten(F.collect_list("nodes"))).alias("nodes"))


def _fans(edges: DataFrame) -> DataFrame:
    """``parent, wide``: whether more than ``FAN`` children meet there."""
    step = edges.select("child", "parent").distinct()
    return step.groupBy("parent").agg((F.count(F.lit(1)) > FAN).alias("wide"))


def closed_pairs(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct ``node, ancestor`` with every ancestor of an ancestor; stored."""
    share = F.pmod(F.xxhash64("node"), F.lit(SHARES)).cast("int").alias("share")

    def merged(held: DataFrame) -> DataFrame:
        dealt = held.select("node", "ancestor", share).repartition("ancestor", "share")
        return dealt.dropDuplicates(["ancestor", "share", "node"])

    return _climbed(pairs.select("node", "ancestor"), edges, merged, _closed_in_rounds, SHARES)


def _climbed(
    held: DataFrame, edges: DataFrame, merged: Callable[[DataFrame], DataFrame],
    in_rounds: Callable[[DataFrame, DataFrame], DataFrame], shares: int,
) -> DataFrame:
    """What is held at an ``ancestor``, at every ancestor of it too; stored.

    Rows wait at the level of their ancestor. From the deepest level up, those of
    one level are merged and step to the parents, which are at higher levels:
    all that can reach a level has come before it is its turn. So a pair is moved
    once, is never looked up among those found before, and pairs that are closed
    already cost nothing more.

    ``merged`` makes rows distinct and tells the ``share`` of each, ``in_rounds`` closes them under steps that may go round
    in circles.
    """
    spark = held.sparkSession
    both = held.select("ancestor").union(edges.select("parent"))
    kind = both.schema["ancestor"].dataType
    held = held.withColumn("ancestor", F.col("ancestor").cast(kind))
    columns = held.columns
    step = edges.select(F.col("child").cast(kind).alias("ancestor"), F.col("parent").cast(kind).alias("next")).distinct()

    peeled = peel(edges)
    level = peeled.levels(edges)
    if peeled.residue is not None:
        endless = peeled.residue.select(F.col("child").alias("node"), F.lit(ENDLESS).alias("endless")).distinct()
        level = level.join(endless.hint("merge"), "node", "left").select("node", F.coalesce("endless", "level").alias("level"))
    level = write_shared(level)
    remove_folder(spark, peeled.folder if peeled.residue is None else f"{peeled.folder}/level=1")
    of = lambda df, column: df.join(
        level.select(F.col("node").alias(column), "level").hint("merge"), column, "left"
    ).withColumn("level", F.coalesce("level", F.lit(0)))

    # A step leads to the next ancestor and its level; one more stays where it is and is done.
    steps, waiting = shared_folder(spark), shared_folder(spark)
    onward = of(step, "next").withColumnRenamed("level", "to")
    stay = level.select(F.col("node").alias("ancestor"), F.col("node").alias("next"), F.lit(DONE).alias("to"))
    of(onward.unionByName(stay), "ancestor").write.partitionBy("level").parquet(steps)
    of(held, "ancestor").select(*columns, "level").write.partitionBy("level").parquet(waiting)

    shape, path_shape = held.schema, step.withColumn("to", F.lit(0)).schema

    def at(n: int) -> DataFrame:
        return spark.read.schema(shape).parquet(f"{waiting}/level={n}")

    def put(found: DataFrame) -> None:
        found.select(*columns, "level").write.partitionBy("level").mode("append").parquet(waiting)

    def stepped(found: DataFrame, path: DataFrame, on: list[str]) -> DataFrame:
        return found.join(path.hint("merge"), on).withColumn("ancestor", F.col("next")).withColumnRenamed("to", "level")

    for n in [ENDLESS, *range(peeled.rounds, 0, -1)]:
        if not folder_exists(spark, f"{waiting}/level={n}"):
            continue
        path = spark.read.schema(path_shape).parquet(f"{steps}/level={n}")
        if n == ENDLESS:
            inner = path.filter(F.col("to") == ENDLESS).select("ancestor", "next")
            outer = path.filter(F.col("to") != ENDLESS)
            put(stepped(in_rounds(at(n), inner), outer, ["ancestor"]))
        else:
            dealt = path.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
            put(stepped(merged(at(n)), dealt, ["ancestor", "share"]))
        remove_folder(spark, f"{waiting}/level={n}")
    if folder_exists(spark, f"{waiting}/level=0"):
        put(merged(at(0)).withColumn("level", F.lit(DONE)))
        remove_folder(spark, f"{waiting}/level=0")
    remove_folder(spark, steps)
    remove_shared(level)
    return at(DONE) if folder_exists(spark, f"{waiting}/level={DONE}") else held.limit(0)


def _closed_in_rounds(pairs: DataFrame, step: DataFrame) -> DataFrame:
    """Distinct ``node, ancestor`` closed under steps ``ancestor, next`` that may go round in circles.

    A round extends only the pairs found in the round before and drops those already known.
    """
    frontier, n = materialise(pairs.distinct())
    known, rounds = frontier, 0
    while n:
        found = frontier.join(step.hint("merge"), "ancestor").select("node", F.col("next").alias("ancestor")).distinct()
        frontier, n = materialise(found.join(known.hint("merge"), ["node", "ancestor"], "left_anti"))
        if n:
            known, rounds = known.unionByName(frontier), rounds + 1
            if rounds % COMPACT == 0:
                known = materialise(known)[0]
    return known


def closure_violations(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Parent memberships that a closed table would hold and this one lacks."""
    return _held_and_implied(members, edges, {"held": F.lit(True)}).filter("held_lacks").select("gene", "pathway")


def closure_violation_counts(members: DataFrame, edges: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """Number of :func:`closure_violations` of several parts of one table, from one grouping: ``memberships, violations``.

    ``parts``: which memberships are in a part, by its name.
    """
    keys = {name: f"p{i}" for i, name in enumerate(parts)}
    found = _held_and_implied(members, edges, {keys[name]: condition for name, condition in parts.items()})
    counted = found.agg(*[F.count_if(F.col(f"{key}_lacks")).alias(key) for key in keys.values()])
    return counted.select(_by_part(keys))


def packed_violation_counts(packs: DataFrame, edges: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """:func:`closure_violation_counts` of memberships given as arrays ``pathway, share, genes``.

    ``parts``: which pathways are in a part, by its name; the columns may be any of ``packs``. The arrays of a pathway
    and of its children meet in one grouping; where many children meet, their genes do so by rows.
    """
    spark = packs.sparkSession
    keys = {name: f"p{i}" for i, name in enumerate(parts)}
    fans = _fans(edges)
    hubs, rootless = fans.agg(F.bool_or("wide"), F.bool_or(F.isnull("parent"))).first()
    step = edges.select("child", "parent").distinct().alias("s").join(
        fans.alias("f").hint("merge"), F.col("s.parent").eqNullSafe(F.col("f.parent"))
    )
    to = step.select(F.col("child").alias("pathway"), F.col("s.parent").alias("at"), "wide", F.lit(True).alias("wants"))
    own = fans.select(F.col("parent").alias("pathway"), F.col("parent").alias("at"), "wide", F.lit(False).alias("wants"))
    marked = packs.select("pathway", "share", "genes", *[F.coalesce(parts[name], F.lit(False)).alias(key) for name, key in keys.items()])
    told = marked.join(to.unionByName(own).hint("merge"), "pathway")
    if rootless:
        told = told.unionByName(marked.filter("pathway IS NULL").crossJoin(own.filter("pathway IS NULL").drop("pathway").hint("broadcast")))
    told = told.select("at", "share", "genes", "wide", "wants", *keys.values())

    given = {(key, wants): F.collect_list(F.when(F.col(key) & (F.col("wants") == F.lit(wants)), F.col("genes"))).alias(f"{key}_{wants}")
             for key in keys.values() for wants in (True, False)}
    met = told.filter(~F.col("wide")).repartition("at", "share").groupBy("at", "share").agg(*given.values())
    lacks = {key: F.size(F.array_except(F.flatten(f"{key}_True"), F.flatten(f"{key}_False"))) for key in keys.values()}
    counted = met.agg(*[F.sum(n).alias(key) for key, n in lacks.items()])
    if hubs:
        rows = told.filter("wide").select("at", F.explode("genes").alias("gene"), "wants", *keys.values())
        seen = lambda key, wants: F.bool_or(F.col(key) & (F.col("wants") == F.lit(wants)))
        each = rows.groupBy("at", "gene").agg(*[(seen(key, True) & ~seen(key, False)).alias(key) for key in keys.values()])
        counted = counted.unionByName(each.agg(*[F.count_if(key).alias(key) for key in keys.values()]))
    with small_tasks(spark), gathering(spark):
        counted = write_shared(counted)
    total = counted.agg(*[F.coalesce(F.sum(key), F.lit(0)).cast("bigint").alias(key) for key in keys.values()])
    return total.select(_by_part(keys))


def _by_part(keys: Mapping[str, str]) -> Column:
    """One row ``memberships, violations`` for each part, from one column each."""
    return F.inline(F.array(*[F.struct(F.lit(name).alias("memberships"), F.col(key).alias("violations")) for name, key in keys.items()]))


def _held_and_implied(members: DataFrame, edges: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """``gene, pathway`` with ``<part>_lacks`` for each part: implied by one of its memberships, but not among them.

    A membership says what it holds and what it implies; both meet in one grouping.
    """
    marked = members.select("gene", "pathway", *[F.coalesce(c, F.lit(False)).alias(name) for name, c in parts.items()])
    step = edges.select(F.col("child").alias("pathway"), "parent").distinct().hint("merge")
    no = F.lit(False)
    held = marked.select("gene", "pathway", *[F.col(n).alias(f"{n}_has") for n in parts], *[no.alias(f"{n}_wants") for n in parts])
    wants = marked.join(step, "pathway").select(
        "gene", F.col("parent").alias("pathway"), *[no.alias(f"{n}_has") for n in parts], *[F.col(n).alias(f"{n}_wants") for n in parts]
    )
    told = held.unionByName(wants).groupBy("gene", "pathway").agg(
        *[F.bool_or(f"{n}_{what}").alias(f"{n}_{what}") for n in parts for what in ("has", "wants")]
    )
    return told.select("gene", "pathway", *[(F.col(f"{n}_wants") & ~F.col(f"{n}_has")).alias(f"{n}_lacks") for n in parts])


def degrees(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """``id, parents, children`` per node, zeros included."""
    pairs = edges.select("child", "parent").distinct()
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("child").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("parent").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )).alias("e")).select("e.*")
    counts = ends.groupBy("id").agg(F.sum("up").alias("parents"), F.sum("down").alias("children"))
    zero = F.lit(0).cast("bigint")
    return nodes.select(F.col(id_col).alias("id")).distinct().join(counts, "id", "left").select(
        "id", F.coalesce("parents", zero).alias("parents"), F.coalesce("children", zero).alias("children")
    )


def hierarchy_shape(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: edges, roots, leaves and multi-parent nodes.

    The edge count is the sum of the parents of the listed nodes.
    """
    return shape_of(degrees(nodes, edges, id_col))


def shape_of(degree: DataFrame) -> DataFrame:
    """:func:`hierarchy_shape` from ``id, parents, children``."""
    return degree.agg(
        F.coalesce(F.sum("parents"), F.lit(0)).cast("bigint").alias("part_of_edges"),
        F.count_if(F.col("parents") == 0).alias("roots"),
        F.count_if(F.col("children") == 0).alias("leaves"),
        F.count_if(F.col("parents") > 1).alias("multi_parent"),
    )


def degree_distributions(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """Distribution of parents and of children per node, one row per ``measure``."""
    both = degrees(nodes, edges, id_col).select(F.inline(F.array(
        F.struct(F.lit("parents").alias("measure"), F.col("parents").alias("value")),
        F.struct(F.lit("children").alias("measure"), F.col("children").alias("value")),
    )))
    return distribution(both, "value", by=["measure"])


def roots(nodes: DataFrame, edges: DataFrame, id_col: str = "id", label_col: str = "label") -> DataFrame:
    """Every node without a parent, with its label and number of children."""
    labels = nodes.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    return degrees(nodes, edges, id_col).filter(F.col("parents") == 0).join(labels, "id").select(
        F.col("id").alias("pathway"), "label", F.col("children").alias("direct_children")
    )
