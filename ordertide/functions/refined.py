"""Exact percentiles of whole numbers by repeated refinement of bins.

Each round counts, per group and wanted rank, how many values fall into each of at most ``BINS`` equal
bins, and goes on inside the bin that holds the rank. Rounds end when a bin is a single value, after 64
bits / log2(BINS) rounds at most. No values are ranked: a task sees up to BINS counts of one rank,
however many values a group has.
"""

from pyspark.sql import functions as F

from ordertide.functions.quantiles import _same

BINS = 1 << 12


def refined_quantiles(df, keys, value, probs, weight=None, bins=BINS):
    """Linearly interpolated percentiles of the whole numbers in ``value``, by group.

    ``probs`` maps output column to probability, ``weight`` holds how many rows a row stands for. Rows
    with a null value do not count. Returns the keys, the percentile columns as doubles and ``n``.
    The rows are read once for each round; the number of rounds follows from the widest group and is
    found by one small aggregate.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("bigint").alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w")
    )
    groups = rows.groupBy(*keys).agg(
        F.sum("_w").alias("n"), F.min("_v").alias("_base"), (F.max("_v") - F.min("_v") + 1).alias("_size")
    )
    groups = groups.filter("n > 0")

    def rank(name, p, low):
        position = (F.col("n") - 1) * F.lit(p)
        at = F.floor(position) if low else F.ceil(position)
        return F.struct(F.lit(name).alias("name"), F.lit(low).alias("low"), at.cast("bigint").alias("rank"), (position - F.floor(position)).alias("fraction"))

    ranks = F.array(*[rank(name, p, low) for name, p in probs.items() for low in (True, False)])
    wanted = groups.select(*keys, "n", "_base", "_size", F.inline(ranks))
    widest = groups.agg(F.max("_size")).first()[0] or 1
    while widest > 1:
        wanted = _narrowed(rows, keys, wanted, bins)
        widest = -(-widest // bins)

    def interpolated(name):
        of = F.col("name") == name
        low = F.max(F.when(of & F.col("low"), F.col("_base")))
        high = F.max(F.when(of & ~F.col("low"), F.col("_base")))
        fraction = F.max(F.when(of, F.col("fraction")))
        return (low * (1 - fraction) + high * fraction).alias(name)

    return wanted.groupBy(*keys).agg(*[interpolated(name) for name in probs], F.max("n").alias("n"))


def _narrowed(rows, keys, wanted, bins):
    """Each wanted rank with the bin that holds it as its new range."""
    wanted = wanted.withColumn("_width", F.ceil(F.col("_size") / bins).cast("bigint"))
    inside = (F.col("v._v") >= F.col("w._base")) & (F.col("v._v") < F.col("w._base") + F.col("w._size"))
    # without keys there are two ranks for each percentile, so that side may be broadcast
    side = wanted.alias("w") if keys else F.broadcast(wanted.alias("w"))
    same = _same("v", "w", keys) & inside if keys else inside
    of_rank = [F.col(f"w.{c}").alias(c) for c in (*keys, "n", "_base", "_width", "name", "low", "rank", "fraction")]
    place = F.expr("(v._v - w._base) div w._width").alias("_bin")
    counts = rows.alias("v").join(side, same).select(*of_rank, place, "v._w")
    names = [*keys, "n", "_base", "_width", "name", "low", "rank", "fraction"]
    counts = counts.groupBy(*names, "_bin").agg(F.sum("_w").alias("_w"))
    held = counts.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("_bin", "_w"))).alias("_bins"))
    # walks the bins until the rank is inside one: (bin, values before it)
    start = F.struct(F.lit(-1).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("before"), F.lit(0).cast("bigint").alias("upto"))

    def step(s, b):
        upto = s["upto"] + b["_w"]
        here = F.struct(b["_bin"].alias("bin"), s["upto"].alias("before"), upto.alias("upto"))
        return F.when(s["upto"] > F.col("rank"), s).otherwise(here)

    found = held.withColumn("_at", F.aggregate("_bins", start, step))
    return found.select(
        *keys,
        "n",
        (F.col("_base") + F.col("_at.bin") * F.col("_width")).alias("_base"),
        F.col("_width").alias("_size"),
        "name",
        "low",
        (F.col("rank") - F.col("_at.before")).alias("rank"),
        "fraction",
    )
