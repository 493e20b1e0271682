"""Histograms, tallies and the exact nearest-rank distribution summary."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kgspark.functions.text import is_isoform

QUANTILES = {"p25": 0.25, "median": 0.50, "p75": 0.75, "p95": 0.95}
# Bits of an order key left out at each level of the descent to a rank.
LEVELS = (44, 26, 8)


def _order_key(value: Column) -> Column:
    """A long that never decreases as the value grows: exponent, then 48 bits of the mantissa.

    NaN comes last, as in a sort; infinities come at the ends.
    """
    size = F.abs(value.cast("double"))
    rough = F.floor(F.log2(size))
    scaled = size / F.pow(F.lit(2.0), rough)
    exponent = rough + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    mantissa = F.least(F.greatest(size / F.pow(F.lit(2.0), exponent), F.lit(1.0)), F.lit(1.9999999999999998))
    finite = (exponent + 1100) * F.lit(1 << 48) + F.floor((mantissa - 1) * float(1 << 48))
    top = F.lit(1 << 60)
    magnitude = F.when(size == float("inf"), top).otherwise(finite)
    return (
        F.when(F.isnan(value.cast("double")), top + 1).when(value > 0, magnitude).when(value < 0, -magnitude)
        .otherwise(F.lit(0)).cast("bigint")
    )


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row counts per value, for several columns in one pass: ``column, value, rows``."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def field_counts(parsed: DataFrame) -> DataFrame:
    """Rows per number of fields, in the form of :func:`value_histogram`."""
    return value_histogram(parsed.select(F.col("n_fields").cast("string").alias("number of fields")), ["number of fields"])


def distribution(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    digits: int | None = None,
    totals: bool = False,
) -> DataFrame:
    """``n, mean, min, p25, median, p75, p95, max`` of a column, per ``by`` group.

    Quantiles are values that occur: the nearest rank is ``f * (n - 1)`` rounded
    half to even. ``digits`` rounds mean and values for display; rounding keeps
    the order, so it is applied before the histogram. Integers stay integers.
    Without ``by``, an empty input gives one row with n = 0. ``totals`` adds the
    sum of the values.

    Ranks are found by descending through prefixes of an order key, on a
    histogram of the values: the cells of one level give the offsets, and only
    cells that hold a wanted rank are opened at the next. A window sees at most
    2^18 cells, the last one at most 2^13 values, however the values cluster.
    NaN counts as the largest value and makes the mean NaN.
    """
    by = list(by)
    raw = F.col(column)
    integral = dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint")
    shown = raw.cast("bigint") if integral else raw.cast("double")
    if digits is not None and not integral:
        shown = F.round(shown, digits)
    # Integers are summed exactly; doubles carry their unrounded sum.
    exact = raw.cast("decimal(38,0)") if integral else raw.cast("double")
    hist = (
        df.filter(raw.isNotNull())
        .select(*by, shown.alias("v"), exact.alias("x"))
        .groupBy(*by, "v")
        .agg(F.count(F.lit(1)).alias("c"), F.sum("x").alias("s"))
        .withColumn("key", _order_key(F.col("v")))
    )
    ranks = {q: F.bround(F.lit(f) * (F.col("n") - 1).cast("double")).cast("bigint") for q, f in QUANTILES.items()}
    hit = reduce(or_, [(rank >= F.col("before")) & (rank < F.col("before") + F.col("bc")) for rank in ranks.values()])
    facts = ["n", "total", "vmin", "vmax"]
    opened = None
    for shift in LEVELS:
        cell = F.shiftright("key", shift).alias("cell")
        if opened is None:
            cells = hist.groupBy(*by, cell).agg(
                F.sum("c").alias("bc"), F.sum("s").alias("bs"), F.min("v").alias("lo"), F.max("v").alias("hi")
            )
            group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
            cells = cells.select(
                *by, "cell", "bc", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("above"),
                F.sum("bc").over(group).alias("n"), F.sum("bs").over(group).alias("total"),
                F.min("lo").over(group).alias("vmin"), F.max("hi").over(group).alias("vmax"),
            )
        else:
            inside = _under(hist, opened, by, last).groupBy(*by, "above", cell)
            cells = inside.agg(
                F.sum("c").alias("bc"), F.first("start").alias("start"), *[F.first(f).alias(f) for f in facts]
            )
        upto = Window.partitionBy(*by, "above").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = (F.col("start") + F.sum("bc").over(upto) - F.col("bc")).alias("before")
        opened = cells.select(*by, "cell", "bc", before, *facts).filter(hit).select(
            *by, F.col("cell").alias("above"), F.col("before").alias("start"), *facts
        )
        last = shift
    within = Window.partitionBy(*by, "above").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = _under(hist, opened, by, last).withColumn("upto", F.col("start") + F.sum("c").over(within))
    picked = [F.min(F.when(F.col("upto") > rank, F.col("v"))).alias(q) for q, rank in ranks.items()]
    mean = F.try_divide(F.first("total").cast("double"), F.first("n"))
    if digits is not None:
        mean = F.round(mean, digits)
    extra = []
    if totals:
        kind = "bigint" if integral else "double"
        extra.append(F.coalesce(F.first("total").cast(kind), F.lit(0).cast(kind)).alias("total"))
    return fine.groupBy(*by).agg(
        F.coalesce(F.first("n"), F.lit(0)).cast("bigint").alias("n"),
        mean.alias("mean"), F.first("vmin").alias("min"), *picked, F.first("vmax").alias("max"), *extra,
    )


def _under(hist: DataFrame, opened: DataFrame, by: list[str], shift: int) -> DataFrame:
    """Histogram rows in the opened cells, with what is known of these."""
    cells = opened.select(*[F.col(c).alias(f"_{c}") for c in by], *[c for c in opened.columns if c not in by])
    same = F.shiftright("key", shift) == F.col("above")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return hist.join(cells, same).drop(*[f"_{c}" for c in by])


def evidence_mix(facts: DataFrame, known_codes: Sequence[str]) -> DataFrame:
    """Facts per code: ``code, facts, mapped``."""
    return facts.groupBy("code").agg(F.count(F.lit(1)).alias("facts")).withColumn("mapped", is_mapped(known_codes))


def is_mapped(known_codes: Sequence[str]) -> Column:
    return F.coalesce(F.col("code").isin(*known_codes), F.lit(False))


def accession_counts(facts: DataFrame) -> DataFrame:
    """Distinct accessions and distinct isoform accessions among the facts."""
    distinct = facts.select("accession").filter(F.length("accession") > 0).distinct()
    return distinct.agg(
        F.count(F.lit(1)).alias("source_accessions"),
        F.count_if(is_isoform(F.col("accession"))).alias("isoform_accessions"),
    )


def coverage(
    nodes: DataFrame, genes: DataFrame, participation: DataFrame, crosswalk: DataFrame
) -> DataFrame:
    """``measure, n``: genes, with a symbol, in an association; pathways, with a set, with a term."""
    def one(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.alias("n")).select(F.lit(name).alias("measure"), "n")

    symbols = genes.groupBy("id").agg(F.max(F.length(F.coalesce("symbol", F.lit("")))).alias("len"))
    rows = F.count(F.lit(1))
    parts = [
        one("genes", symbols, rows),
        one("genes_with_symbol", symbols, F.count_if(F.col("len") > 0)),
        one("genes_in_association", participation.select("gene").distinct(), rows),
        one("pathways", nodes.select("id").distinct(), rows),
        one("pathways_with_set", participation.select("pathway").distinct(), rows),
        one("pathways_with_term", crosswalk.select("pathway").distinct(), rows),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def crosswalk_summary(crosswalk: DataFrame) -> DataFrame:
    """``pathways_with_term``, ``edges`` and the spread of terms per pathway, one row."""
    per_pathway = crosswalk.select("pathway", "term").distinct().groupBy("pathway").agg(
        F.count(F.lit(1)).alias("terms")
    )
    spread = distribution(per_pathway, "terms", totals=True)
    return spread.select(
        F.col("n").alias("pathways_with_term"), F.col("total").alias("edges"),
        "mean", "min", "p25", "median", "p75", "p95", "max",
    )


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` distinct keys in hash order: the same seed picks the same keys."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.select(key).distinct().orderBy(order, key).limit(n)
