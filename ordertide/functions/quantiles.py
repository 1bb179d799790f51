"""Exact percentiles that never hold one group in one task.

The built-in ``percentile`` keeps every distinct value of a group in a single
buffer. Here the rows are first reduced to (group, value) counts, which a shuffle
spreads over the cluster however large one group is. A histogram of coarse bins
then tells which bin holds each wanted rank, and only those bins are ranked.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F


def _same(left, right, names):
    """Null-safe equality of the named columns, so that a null group is a group."""
    pairs = [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    return reduce(lambda a, b: a & b, pairs)


def exact_quantiles(df, keys, value, probs, weight=None, bin_width=1.0):
    """Linearly interpolated percentiles per group.

    ``probs`` maps output column to probability. ``weight`` is a column holding
    how many rows a row stands for. Rows with a null value do not count. Returns
    the keys, the percentile columns and ``n``, the number of values.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys,
        F.col(value).alias("_value"),
        (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_count"),
        F.floor(F.col(value) / F.lit(bin_width)).alias("_bin"),
    )
    counts = rows.groupBy(*keys, "_bin", "_value").agg(F.sum("_count").alias("_count"))

    # Rank range of every coarse bin of a group.
    by_bin = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = (
        counts.groupBy(*keys, "_bin")
        .agg(F.sum("_count").alias("_in_bin"))
        .withColumn("_end", F.sum("_in_bin").over(by_bin))
        .withColumn("n", F.sum("_in_bin").over(Window.partitionBy(*keys)))
        .withColumn("_start", F.col("_end") - F.col("_in_bin"))
    )

    # Each percentile lies between two ranks; a bin keeps the ranks it holds, at most
    # two per percentile, and bins that hold none are dropped.
    def rank(name, probability, low):
        position = (F.col("n") - 1) * F.lit(probability)
        return F.struct(
            F.lit(name).alias("name"),
            F.lit(low).alias("low"),
            (position - F.floor(position)).alias("fraction"),
            ((F.floor(position) if low else F.ceil(position)) - F.col("_start")).alias("rank"),
        )

    ranks = F.array(*[rank(name, p, low) for name, p in probs.items() for low in (True, False)])
    held = F.filter(ranks, lambda r: (r["rank"] >= 0) & (r["rank"] < F.col("_in_bin")))
    chosen = bins.select(*keys, "_bin", "n", held.alias("_held")).filter(F.size("_held") > 0)

    # Rank the values of the chosen bins only.
    bin_keys = [*keys, "_bin"]
    in_bin = Window.partitionBy(*bin_keys).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        counts.alias("v")
        .join(chosen.alias("c"), _same("v", "c", bin_keys))
        .select(*[F.col(f"v.{name}") for name in bin_keys], "v._value", "v._count", "c.n", "c._held")
        .withColumn("_upto", F.sum("_count").over(in_bin))
    )
    here = F.filter(
        "_held", lambda r: (r["rank"] < F.col("_upto")) & (r["rank"] >= F.col("_upto") - F.col("_count"))
    )
    found = ranked.select(*keys, "n", "_value", F.explode(here).alias("_r"))

    def interpolated(name):
        of = F.col("_r.name") == name
        low = F.max(F.when(of & F.col("_r.low"), F.col("_value")))
        high = F.max(F.when(of & ~F.col("_r.low"), F.col("_value")))
        fraction = F.max(F.when(of, F.col("_r.fraction")))
        return (low * (1 - fraction) + high * fraction).alias(name)

    return found.groupBy(*keys).agg(*[interpolated(name) for name in probs], F.max("n").alias("n"))
