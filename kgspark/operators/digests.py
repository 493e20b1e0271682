"""Comparing tables that are nearly equal: digests of buckets first, rows only where digests differ.

A digest is a count, an xor and two sums of row hashes; all combine before the shuffle, so equal tables cost one row per
bucket and partition however long they are. Two different buckets have equal digests with a probability of about 2^-128;
the row hash is not a cryptographic one, so tables made to deceive it are not what this is for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.operators.diff import release_diff
from kgspark.session import small_tasks, write_shared

#: Bits of the key hash that name a bucket, level by level. The last level has a million buckets at most: their names
#: stay below Spark's own limit for broadcasts, so that choosing rows by them shuffles no row.
LEVELS = (10, 20)
#: Rows below which no further level is worth its pass.
ENOUGH = 100_000
#: Members of both sides that a share of a set must hold on average for digests of shares to be fewer than the members.
MEMBERS_A_SHARE = 8


def _hash(columns: Sequence[Column], seed: int) -> Column:
    """64-bit hash of several columns; a null differs from nothing at all and from a null elsewhere."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (c, c.isNull())])


def distinct_count(df: DataFrame) -> DataFrame:
    """Number of distinct rows, ``rows``: 128 bits of each are shuffled, however long it is.

    Two different rows count as one with a probability of about 2^-128.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    marks = df.select(_hash(columns, 1).alias("a"), _hash(columns, 2).alias("b")).distinct()
    return marks.agg(F.count(F.lit(1)).alias("rows"))


def _bucket(columns: Sequence[Column], bits: int) -> Column:
    return F.shiftrightunsigned(_hash(columns, 3), 64 - bits)


def _compared(left: DataFrame, right: DataFrame, by: dict[str, Column], columns: Sequence[Column]) -> DataFrame:
    """Rows of both sides per group ``by`` and whether their digests are equal: ``by``, n, n_right, same.

    The digests of both sides are one: rows of the right count against those of the left, so equal sides leave nothing.
    That is one exchange, and no join of digests.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        more = _hash(columns, 2)
        return df.select(
            *[c.alias(name) for name, c in by.items()], F.lit(sign).alias("sign"), _hash(columns, 1).alias("x"),
            (more.bitwiseAND(F.lit(0xFFFFFFFF)) * sign).alias("lo"), (F.shiftrightunsigned(more, 32) * sign).alias("hi"),
        )

    found = side(left, 1).unionByName(side(right, -1)).groupBy(*by).agg(
        F.count_if(F.col("sign") > 0).alias("n"), F.count_if(F.col("sign") < 0).alias("n_right"),
        F.bit_xor("x").alias("x"), F.sum("lo").alias("lo"), F.sum("hi").alias("hi"),
    )
    same = (F.col("n") == F.col("n_right")) & (F.col("x") == 0) & (F.col("lo") == 0) & (F.col("hi") == 0)
    return found.select(*by, "n", "n_right", same.alias("same"))


def differing_rows(
    left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None,
    levels: Sequence[int] = LEVELS, enough: int = ENOUGH,
) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in buckets of keys whose rows are not the same on both sides.

    Every row that has no equal on the other side is among them, with all other rows of its key. ``columns`` are
    compared, all of ``left`` unless given; repeated rows count. Each level reads the rows of the differing buckets of
    the one before, and none when few rows are left.
    """
    columns = list(columns or left.columns)
    sides = [df.select(*columns) for df in (left, right)]
    chosen = sides
    for bits in levels:
        bucket = _bucket([F.col(c) for c in key], bits)
        found = _compared(*chosen, {"bucket": bucket}, [F.col(c) for c in columns])
        differing = write_shared(found.filter(~F.col("same")).select("bucket", (F.col("n") + F.col("n_right")).alias("rows")))
        left_over = differing.agg(F.sum("rows")).first()[0]
        if left_over is None:
            return sides[0].limit(0), sides[1].limit(0)
        names = differing.select(F.col("bucket").alias("_bucket"))
        chosen = [df.join(names, bucket == F.col("_bucket"), "left_semi") for df in sides]
        if left_over <= enough:
            break
    return chosen[0], chosen[1]


def release_diff_by_digest(previous: DataFrame, current: DataFrame) -> DataFrame:
    """:func:`kgspark.operators.diff.release_diff` of releases that have most rows in common."""
    return release_diff(*differing_rows(previous, current, ["id"], ["id", "label"]))


def table_difference(left: DataFrame, right: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows that do not occur equally often in both tables: their columns, ``left_rows``, ``right_rows``.

    No row says that the tables are equal as bags. Nulls equal each other.
    """
    columns = left.columns
    ours, theirs = differing_rows(left, right, key or columns)
    both = ours.select(*columns, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        theirs.select(*columns, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counted = both.groupBy(*columns).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    return counted.filter(F.col("left_rows") != F.col("right_rows"))


def reconcile_sets_by_digest(ours: DataFrame, theirs: DataFrame, is_set: bool = False, bits: int = 10) -> DataFrame:
    """:func:`kgspark.operators.sets.reconcile_sets` of sets that are mostly the same.

    Sizes and digests per key, then the members of small sets that differ. Large ones are compared per share of their
    members before, and only the members of the shares that differ are: a set of any size that lost one member costs a
    share of it, and a small one no digests of shares that hold a member each. ``is_set`` promises that both sides hold
    each membership once; without it they are made distinct first, which shuffles them. Both sides are read several
    times, so they should be stored.
    """
    sides = [df.select("key", "member") if is_set else df.select("key", "member").distinct() for df in (ours, theirs)]
    member = [F.col("member")]
    with small_tasks(ours.sparkSession):
        by_key = write_shared(_compared(*sides, {"key": F.col("key")}, member))
    large = F.col("n") + F.col("n_right") > F.lit(MEMBERS_A_SHARE << bits)
    unlike = by_key.filter(~F.col("same")).select("key", large.alias("large"))
    parts = [df.join(unlike.filter("large").select("key"), "key", "left_semi").withColumn("share", _bucket(member, bits)) for df in sides]
    shares = write_shared(
        _compared(*parts, {"key": F.col("key"), "share": F.col("share")}, member).filter(~F.col("same")).select("key", "share")
    )
    small = unlike.filter(~F.col("large")).select("key")

    def marked(of: int, mine: int) -> DataFrame:
        found = sides[of].join(small, "key", "left_semi").unionByName(
            parts[of].join(shares, ["key", "share"], "left_semi").select("key", "member")
        )
        return found.select("key", "member", F.lit(mine).alias("mine"), F.lit(1 - mine).alias("other"))

    per_member = marked(0, 1).unionByName(marked(1, 0)).groupBy("key", "member").agg(F.max("mine").alias("mine"), F.max("other").alias("other"))
    changed = per_member.groupBy("key").agg(F.count_if(F.col("mine") == 0).alias("missing"), F.count_if(F.col("other") == 0).alias("extra"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return by_key.select("key", none(F.col("n")).alias("ours"), none(F.col("n_right")).alias("theirs"), "same").join(changed, "key", "left").select(
        "key", "ours", "theirs", none(F.col("missing")).alias("missing"), none(F.col("extra")).alias("extra"), F.col("same").alias("exact_match")
    )
