"""Sharding by extendible hashing.

A directory maps prefixes of a hash to shards. It starts with one shard for everything; a shard over the byte limit, and
only such a one, splits on the next bit, until each fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kgspark.session import write_shared

#: Bits of the hash; 60 are fifteen hex digits of an md5.
BITS = 60
#: Bits looked at in one round.
STEP = 10


def hashed(key: Column) -> Column:
    """The first 60 bits of the md5 of a key's text; a null key hashes like an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def prefix(depth: Column | int) -> Column:
    """The first ``depth`` bits of column h."""
    return F.expr(f"shiftright(h, {BITS - depth})") if isinstance(depth, int) else F.call_function("shiftright", F.col("h"), F.lit(BITS) - depth)


def directory(keyed: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, documents), stored: the shards. ``keyed``: h, bytes.

    A round sums bytes by a prefix ``STEP`` bits longer, then follows the splits on these sums alone, which number at
    most 2^STEP for each shard still too large. Only rows under prefixes that are still too large enter the next round.
    Past the last bit a shard stays as it is: its rows have one hash.
    """
    done, active, depth = None, keyed, 0
    while True:
        low, depth = depth, min(depth + STEP, BITS)
        cells = write_shared(active.groupBy(prefix(depth).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("documents")))
        levels = F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth")
        sums = cells.select(levels, "cell", "bytes", "documents").groupBy(
            "depth", F.call_function("shiftright", F.col("cell"), F.lit(depth) - F.col("depth")).alias("prefix")
        ).agg(F.sum("bytes").alias("bytes"), F.sum("documents").alias("documents"))
        fits = (F.col("bytes") <= limit) | (F.col("depth") == BITS)
        # a shard is a prefix that fits while the one above it does not
        sums = write_shared(sums.withColumn("fits", fits))
        above = sums.where("not fits").select((F.col("depth") + 1).alias("d"), F.col("prefix").alias("p"))
        split = sums.where("fits").join(above, (F.col("depth") == F.col("d")) & (F.expr("shiftright(prefix, 1)") == F.col("p")), "left_semi")
        shards = split if low else split.unionByName(sums.where("fits and depth = 0"))
        shards = write_shared(shards.select("depth", "prefix", "bytes", "documents"))
        done = shards if done is None else done.unionByName(shards)
        large = write_shared(sums.where(f"depth = {depth} and not fits").select("prefix"))
        if large.isEmpty():
            return done
        active = active.join(large, prefix(depth) == F.col("prefix"), "left_semi")


def assign_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(assignment, directory). Assignment: doc_id, bytes (of the text in UTF-8), shard, depth, overflow; one row per row.

    ``shard`` is the prefix in bits, empty for the only one. A null text has 0 bytes. A document larger than the limit
    ends up alone. Rows that repeat one id have one hash, which bits cannot split: their shard is continued in overflow
    pages 0, 1, ..., each within the limit. An empty table gives no row and an empty directory.
    """
    text = F.col(f"`{text_col}`")
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes"))
    keyed = write_shared(keyed.withColumns({"h": hashed(F.col("doc_id")), "row": F.monotonically_increasing_id()}))
    shards = write_shared(directory(keyed.select("h", "bytes"), limit))
    depths = sorted(r["depth"] for r in shards.select("depth").distinct().collect())  # at most one per bit
    places = keyed.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]) if depths else F.array().cast("array<int>")))
    over = ((F.col("bytes") > limit) & (F.col("documents") > 1)).alias("over")
    found = places.withColumn("prefix", prefix(F.col("depth"))).join(shards.select("depth", "prefix", over), ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    found = found.select("doc_id", "bytes", bits.alias("shard"), "depth", "h", "row", "over")
    columns = ["doc_id", "bytes", "shard", "depth", "overflow"]
    if shards.where(over).isEmpty():
        return found.withColumn("overflow", F.lit(0).cast("bigint")).select(columns), shards
    paged = found.where("not over").withColumn("overflow", F.lit(0).cast("bigint"))
    return paged.select(columns).unionByName(_pages(found.where("over"), limit).select(columns)), shards


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` of overfull hashes with their page: running bytes, summed by block of rows first, then within blocks.

    Pages are cut every ``limit`` - largest row + 1 bytes and a row belongs to the page it starts in, so a page of rows
    within the limit is within it too.
    """
    rows = rows.withColumn("block", F.shiftright("row", 33) * (1 << 20) + F.shiftright(F.col("row").bitwiseAND(F.lit((1 << 33) - 1)), 14))
    blocks = rows.groupBy("h", "block").agg(F.sum("bytes").alias("size"), F.max("bytes").alias("largest"))
    whole = Window.partitionBy("h")
    ahead = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("h", "block", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"), F.max("largest").over(whole).alias("largest"))
    inside = Window.partitionBy("h", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    step = F.greatest(F.lit(1).cast("bigint"), F.lit(limit).cast("bigint") - F.col("largest") + 1)
    return rows.join(blocks, ["h", "block"]).withColumn("overflow", F.floor(start / step))


def op10_sharding(docs: DataFrame, limit: int = 1 << 20) -> DataFrame:
    assigned, _ = assign_shards(docs, limit)
    return assigned.select("doc_id", "bytes", "shard", "depth")
