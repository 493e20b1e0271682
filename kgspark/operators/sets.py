"""Member sets ``pathway, gene``: sizes, overlaps, identical sets, comparisons.

Sets may be of any size, one of them may hold a third of all memberships: no
operator gathers a set into one row or one task. Sizes and overlaps are counts
that combine before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.operators.stats import distribution
from kgspark.session import ROWS_A_TASK, any_row, ensure_checkpoint_dir, gathering, materialise, small_tasks, write_shared

#: Rows of a counted table up to which it may be broadcast.
FEW_ROWS = 100_000
#: Hash seeds of the fingerprints that packs carry.
PACK_SEEDS = 2


def _held(members: DataFrame, is_set: bool) -> DataFrame:
    """Distinct memberships; ``is_set`` promises that they are, which saves a shuffle of them all."""
    held = members.select("pathway", "gene")
    return held if is_set else held.distinct()


def set_sizes(members: DataFrame, is_set: bool = False) -> DataFrame:
    """Distinct members per set: ``pathway, genes``."""
    return _held(members, is_set).groupBy("pathway").agg(F.count(F.lit(1)).alias("genes"))


def degree_of_genes(members: DataFrame, is_set: bool = False) -> DataFrame:
    """Distinct sets per member: ``gene, pathways``."""
    return _held(members, is_set).groupBy("gene").agg(F.count(F.lit(1)).alias("pathways"))


def top_genes(degree: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of ``gene, pathways`` by pathways, then id."""
    return degree.orderBy(F.desc("pathways"), "gene").limit(n)


def top_sets(sizes: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of ``pathway, genes`` by size, then id."""
    return sizes.orderBy(F.desc("genes"), "pathway").limit(n)


def hub_by_id(members: DataFrame, symbols: DataFrame | None = None, n: int = 20) -> DataFrame:
    """The ``n`` members in most sets; ties by id."""
    top = top_genes(degree_of_genes(members), n)
    if symbols is None:
        return top
    names = symbols.groupBy(F.col("id").alias("gene")).agg(F.max("symbol").alias("symbol"))
    return top.join(names, "gene", "left").select(
        "gene", F.coalesce("symbol", F.lit("")).alias("symbol"), "pathways"
    )


def largest_sets(members: DataFrame, nodes: DataFrame | None = None, n: int = 20) -> DataFrame:
    """The ``n`` largest sets; ties by id."""
    top = top_sets(set_sizes(members), n)
    if nodes is None:
        return top
    labels = nodes.groupBy(F.col("id").alias("pathway")).agg(F.max("label").alias("label"))
    return top.join(labels, "pathway", "left").select(
        "pathway", F.coalesce("label", F.col("pathway").cast("string")).alias("label"), "genes"
    )


def all_set_sizes(nodes: DataFrame, members: DataFrame, id_col: str = "id", is_set: bool = False) -> DataFrame:
    """Size of every node's set, 0 for a node without members."""
    return with_empty_sets(nodes, set_sizes(members, is_set), id_col)


def with_empty_sets(nodes: DataFrame, sizes: DataFrame, id_col: str = "id") -> DataFrame:
    """``pathway, genes`` of every node, 0 where ``sizes`` has none."""
    return nodes.select(F.col(id_col).alias("pathway")).distinct().join(sizes, "pathway", "left").select(
        "pathway", F.coalesce("genes", F.lit(0).cast("bigint")).alias("genes")
    )


def set_size_distribution(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Spread of members per set (empty sets included) and of sets per member."""
    sizes = all_set_sizes(nodes, members).select(
        F.lit("genes_per_pathway").alias("measure"), F.col("genes").alias("value")
    )
    degrees = degree_of_genes(members).select(
        F.lit("pathways_per_gene").alias("measure"), F.col("pathways").alias("value")
    )
    return distribution(sizes.unionByName(degrees), "value", by=["measure"])


def scoring_band(members: DataFrame, low: int = 15, high: int = 500) -> DataFrame:
    """Sets within, below and above a size band; empty sets are in none of them."""
    return band_counts(set_sizes(members), low, high)


def band_counts(sizes: DataFrame, low: int, high: int) -> DataFrame:
    """:func:`scoring_band` from ``pathway, genes``."""
    size = F.col("genes")
    return sizes.agg(
        F.count_if(size.between(low, high)).alias("in_band"),
        F.count_if(size.between(1, low - 1)).alias("below_band"),
        F.count_if(size > high).alias("above_band"),
    )


def empty_sets(nodes: DataFrame, members: DataFrame, id_col: str = "id") -> DataFrame:
    """Nodes without a member."""
    return nodes.select(F.col(id_col).alias("pathway")).distinct().join(
        members.select("pathway").distinct(), "pathway", "left_anti"
    )


def containment(edges: DataFrame, members: DataFrame, is_set: bool = False) -> DataFrame:
    """Per edge, the share of the child's members that the parent has too.

    Edges with an empty set on either side are left out. One pass over the
    members of the children gives both the size of the child and the overlap.
    """
    held = _held(members, is_set)
    pairs = edges.select("child", "parent").distinct().join(
        held.select(F.col("pathway").alias("parent")).distinct(), "parent", "left_semi"
    )
    shared = held.select(F.col("pathway").alias("parent"), "gene", F.lit(1).alias("both"))
    counted = (
        pairs.join(held.select(F.col("pathway").alias("child"), "gene"), "child")
        .join(shared, ["parent", "gene"], "left")
        .groupBy("child", "parent")
        .agg(F.count(F.lit(1)).alias("child_genes"), F.count("both").alias("common"))
    )
    return counted.withColumn("fraction", F.col("common").cast("double") / F.col("child_genes"))


def packs(members: DataFrame, most: int, is_set: bool = False) -> DataFrame:
    """Members of each set as arrays: ``pathway, share, genes, f0, f1, members``; one exchange, stored.

    ``most`` is a bound of the members of a set, such as the number of distinct genes. A set is cut into shares by the
    hash of the gene, so that an array and the rows of its task are bounded however large a set is. ``genes`` and the
    fingerprints are those of the share.
    """
    share = F.pmod(F.xxhash64("gene"), F.lit(most // ROWS_A_TASK + 1)).cast("int").alias("share")
    dealt = _held(members, is_set).select("pathway", share, "gene").repartition("pathway", "share")
    prints = [F.bit_xor(member_hash(seed)).alias(f"f{seed}") for seed in range(PACK_SEEDS)]
    packed = dealt.groupBy("pathway", "share").agg(
        F.count(F.lit(1)).alias("genes"), *prints, F.collect_list("gene").alias("members")
    )
    spark = members.sparkSession
    with small_tasks(spark, members.count()), gathering(spark):
        return write_shared(packed)


def packed_fingerprints(packed: DataFrame) -> DataFrame:
    """:func:`fingerprints` from :func:`packs`."""
    prints = [F.bit_xor(f"f{seed}").alias(f"f{seed}") for seed in range(PACK_SEEDS)]
    return packed.groupBy("pathway").agg(F.sum("genes").alias("genes"), *prints)


def packed_containment(edges: DataFrame, packed: DataFrame) -> DataFrame:
    """:func:`containment` from stored :func:`packs`: one row per edge and share is joined instead of one per member."""
    side = lambda name: packed.select(F.col("pathway").alias(name), "share", F.col("members").alias(f"{name}_members"))
    child = packed.select(F.col("pathway").alias("child"), "share", "genes", F.col("members").alias("child_members"))
    pairs = edges.select("child", "parent").distinct().join(
        packed.select(F.col("pathway").alias("parent")).distinct().hint("merge"), "parent", "left_semi"
    )
    common = F.array_size(F.array_intersect("child_members", "parent_members"))
    counted = (
        pairs.join(child.hint("merge"), "child").join(side("parent").hint("merge"), ["parent", "share"], "left")
        .select("child", "parent", "genes", F.coalesce(common, F.lit(0)).cast("bigint").alias("common"))
        .groupBy("child", "parent").agg(F.sum("genes").alias("child_genes"), F.sum("common").alias("common"))
    )
    return counted.withColumn("fraction", F.col("common").cast("double") / F.col("child_genes"))


def containment_summary(contained: DataFrame, digits: int = 4) -> DataFrame:
    """Pairs compared, fully contained, their share, and the spread of the shares."""
    with small_tasks(contained.sparkSession):
        contained = write_shared(contained.select("child_genes", "common", "fraction"))
    spread = distribution(contained, "fraction", digits=digits).select(
        F.col("n").alias("pairs_compared"), "mean", "min", "p25", "median", "p75", "p95", "max",
        F.lit(0).alias("_k"),
    )
    full = contained.agg(
        F.count_if(F.col("common") == F.col("child_genes")).alias("fully_contained"), F.lit(0).alias("_k")
    )
    return full.join(spread, "_k").drop("_k").withColumn(
        "fully_contained_fraction",
        F.round(F.col("fully_contained") / F.greatest("pairs_compared", F.lit(1)), digits),
    )


def member_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("gene"))


def _fingerprints(held: DataFrame, seeds: int) -> tuple[DataFrame, list[str]]:
    prints = [F.bit_xor(member_hash(seed)).alias(f"f{seed}") for seed in range(seeds)]
    names = ["genes"] + [f"f{seed}" for seed in range(seeds)]
    return held.groupBy("pathway").agg(F.count(F.lit(1)).alias("genes"), *prints), names


def fingerprints(held: DataFrame, seeds: int) -> DataFrame:
    """Size and xor fingerprints of each set of distinct memberships: ``pathway, genes, f0, ...``."""
    return _fingerprints(held, seeds)[0]


def identical_members(
    members: DataFrame, is_set: bool = False, prints: DataFrame | None = None, packed: DataFrame | None = None
) -> DataFrame:
    """``pathway, group_id, genes, sets`` for every set that equals another one; stored.

    ``group_id`` is the smallest set of its group. Sets are grouped by size and
    xor fingerprints, which combine on the map side. The grouping is then proved
    on the members themselves: in a true group every member occurs once per set.
    Should a fingerprint ever collide, more hash seeds split the group until the
    proof holds; equal sets are never split. ``prints`` are :func:`fingerprints`
    kept from before, ``packed`` the stored :func:`packs` of the members.
    """
    ensure_checkpoint_dir(members.sparkSession)
    held = _held(members, True) if is_set else write_shared(_held(members, False))
    seeds = 2
    while True:
        if prints is None:
            prints, names = _fingerprints(held, seeds)
            prints = prints.checkpoint(eager=True)
        else:
            names = [c for c in prints.columns if c != "pathway"]
        groups = prints.groupBy(*names).agg(
            F.count(F.lit(1)).alias("sets"), F.min("pathway").alias("group_id")
        ).filter(F.col("sets") > 1)
        grouped, n = materialise(prints.join(groups, names).select("pathway", "group_id", "genes", "sets"))
        if not n:
            return grouped
        chosen = grouped.select("pathway", "group_id", "sets").hint("broadcast" if n <= FEW_ROWS else "merge")
        if packed is None:
            found = held.join(chosen, "pathway")
        else:
            found = packed.select("pathway", "members").join(chosen, "pathway").select(
                "group_id", "sets", F.explode("members").alias("gene")
            )
        seen = found.groupBy("group_id", "gene").agg(F.count(F.lit(1)).alias("seen"), F.max("sets").alias("sets"))
        if not any_row(seen.filter(F.col("seen") != F.col("sets"))):
            return grouped
        prints, seeds = None, seeds + 2


def identical_sets(members: DataFrame) -> DataFrame:
    """Groups of equal sets: ``group_id, sets, genes``."""
    return identical_members(members).groupBy("group_id").agg(
        F.max("sets").alias("sets"), F.max("genes").alias("genes")
    )


def largest_identical_group(grouped: DataFrame) -> DataFrame:
    """Sets of the group with most sets (ties: smallest id)."""
    first = grouped.select("sets", "group_id").distinct().orderBy(F.desc("sets"), "group_id").limit(1)
    return grouped.join(first.select("group_id"), "group_id", "left_semi").select("pathway", "genes")


def reconcile_sets(ours: DataFrame, theirs: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Per key: sizes on both sides, members missing here, members extra here, equal or not.

    Inputs are ``key, member``. ``keys`` restricts the comparison to a sample; it is
    applied to the counted keys, so a hot key is combined before any join on it.
    """
    sides = [
        df.select("key", "member", F.lit(mine).alias("mine"), F.lit(1 - mine).alias("other"))
        for df, mine in ((ours, 1), (theirs, 0))
    ]
    both = reduce(DataFrame.unionByName, sides)
    per_member = both.groupBy("key", "member").agg(F.max("mine").alias("mine"), F.max("other").alias("other"))
    mine, other = F.col("mine") == 1, F.col("other") == 1
    counted = per_member.groupBy("key").agg(
        F.count_if(mine).alias("ours"),
        F.count_if(other).alias("theirs"),
        F.count_if(other & ~mine).alias("missing"),
        F.count_if(mine & ~other).alias("extra"),
    ).withColumn("exact_match", (F.col("missing") == 0) & (F.col("extra") == 0))
    return counted if keys is None else counted.join(keys.select("key"), "key", "left_semi")
