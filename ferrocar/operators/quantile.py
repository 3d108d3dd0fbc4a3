"""Exact quantiles per group, without holding a group in one task.

The built-in ``percentile`` keeps every distinct value of a group in one buffer, which a hot
group can outgrow. Here equal values are counted first (a hash aggregate with map-side
combining, spread over group *and* value). The counts are range-sorted by group and value, so
that a task holds its share of them whatever the groups and values are; sums per group and task
tell which tasks hold the wanted ranks, and only their rows are numbered.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrocar.session import stage


def count_values(
    df: DataFrame, keys: Sequence[str], value: str, carried: Sequence[Column] = ()
) -> DataFrame:
    """One staged row per group and distinct value: ``keys, value, n`` and carried aggregates."""
    complete = df
    for key in keys:
        complete = complete.where(F.col(key).isNotNull())
    counted = complete.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), *carried)
    return stage(counted, "value-counts")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    *,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group: ``keys`` and one column per name."""
    if counts is None:
        counts = count_values(df, keys, value)
    counts = counts.select(*keys, value, "n").where(F.col(value).isNotNull())
    order = [*keys, value]
    placed = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("_part", F.spark_partition_id()).withColumn("_all", F.lit(0)), "sorted-counts")

    # One row per group and task.
    group = ["_all", *keys]
    running = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    per_part = (
        placed.groupBy(*group, "_part")
        .agg(F.sum("n").alias("_held"))
        .withColumn("_before", F.coalesce(F.sum("_held").over(running), F.lit(0)))
        .withColumn("_total", F.sum("_held").over(W.partitionBy(*group)))
    )

    def ranks(p: float) -> tuple[Column, Column, Column]:
        position = (F.col("_total") - 1) * F.lit(float(p))
        return F.floor(position), F.ceil(position), position - F.floor(position)

    def held(rank: Column, start: Column, count: Column) -> Column:
        return (start <= rank) & (rank < start + count)

    wanted = F.lit(False)
    for p in probs:
        below, above, _ = ranks(p)
        for rank in (below, above):
            wanted = wanted | held(rank, F.col("_before"), F.col("_held"))
    targets = per_part.where(wanted).select(*group, "_part", "_before", "_total")

    up_to = W.partitionBy(*group, "_part").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    ordered = placed.join(targets, [*group, "_part"]).withColumn(
        "_start", F.col("_before") + F.sum("n").over(up_to) - F.col("n")
    )
    picked, outputs = [], []
    for i, (p, name) in enumerate(zip(probs, names)):
        below, above, part = ranks(p)
        at = held(below, F.col("_start"), F.col("n"))
        picked.append(F.max(F.when(at, F.col(value))).alias(f"_lo{i}"))
        at = held(above, F.col("_start"), F.col("n"))
        picked.append(F.max(F.when(at, F.col(value))).alias(f"_hi{i}"))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outputs.append((low + (high - low) * part).alias(name))
    return (
        ordered.groupBy(*group)
        .agg(F.max("_total").alias("_total"), *picked)
        .select(*keys, *outputs)
    )


def order_code(value: Column) -> Column:
    """A long that orders as the double ``value`` does: equal values, equal codes; NaN above all.

    For |v| the code is its IEEE-754 magnitude (biased exponent, then the 52 fraction bits), worked
    out exactly from the exponent and the scaled mantissa; negative values get the negated magnitude.
    """
    a = F.abs(value)
    e0 = F.floor(F.log2(a))
    # log2 may round across a power of two; one step either way puts the exponent right.
    e = e0 - F.when(F.pow(F.lit(2.0), e0) > a, 1).otherwise(0) + F.when(F.pow(F.lit(2.0), e0 + 1) <= a, 1).otherwise(0)
    normal = ((e + 1023).cast("long") * F.lit(1 << 52)) + ((a / F.pow(F.lit(2.0), e) - 1.0) * F.lit(float(1 << 52))).cast("long")
    tiny = ((a * F.lit(2.0**1022)) * F.lit(float(1 << 52))).cast("long")
    magnitude = (
        F.when(F.isnan(value), F.lit((2047 << 52) + 1))
        .when(a == F.lit(float("inf")), F.lit(2047 << 52))
        .when(a == 0, F.lit(0))
        .when(a < F.lit(2.0**-1022), tiny)
        .otherwise(normal)
    )
    return F.when(value < 0, -magnitude).otherwise(magnitude)


DIGIT_BITS = 16


def radix_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group, by radix selection over ``counts``.

    ``counts`` has ``keys``, ``value`` and ``n`` (rows with that value; 1 for raw rows). Values are
    turned into ``order_code`` and selected 16 bits at a time, all groups and ranks at once: a level
    counts the rows per group and digit of the buckets that still hold a wanted rank (a partial
    aggregate), numbers those digits within their bucket (at most 65,536 rows a window), and keeps
    the digit that holds the rank. A bucket of a single code is its value, so most ranks end after
    a level or two. Nothing is sorted, and no group is gathered in one task. Null values count as
    absent; groups with a null key and groups without values give no row.
    """
    keys, alone = list(keys), not keys
    if alone:
        # One group for all rows, so that every join has a key.
        counts, keys = counts.withColumn("_all", F.lit(0)), ["_all"]
    for key in keys:
        counts = counts.where(F.col(key).isNotNull())
    base = counts.where(F.col(value).isNotNull()).select(*keys, value, "n", order_code(F.col(value)).alias("_code"))
    totals = base.groupBy(*keys).agg(F.sum("n").alias("_total"))
    wanted = []
    for i, p in enumerate(probs):
        position = (F.col("_total") - 1) * F.lit(float(p))
        wanted += [F.struct(F.lit(2 * i).alias("t"), F.floor(position).alias("rank")), F.struct(F.lit(2 * i + 1).alias("t"), F.ceil(position).alias("rank"))]
    fractions = [((F.col("_total") - 1) * F.lit(float(p)) - F.floor((F.col("_total") - 1) * F.lit(float(p)))).alias(f"_f{i}") for i, p in enumerate(probs)]
    open_ = totals.select(*keys, F.inline(F.array(*wanted)), F.lit(None).cast("long").alias("_parent"))
    found = None
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        upper = shift + DIGIT_BITS
        rows = base.withColumn("_parent", F.shiftright("_code", upper) if upper < 64 else F.lit(None).cast("long"))
        buckets = open_.select(*keys, "_parent").distinct()
        rows = rows.join(buckets, [*keys, "_parent"], "left_semi") if upper < 64 else rows
        hist = rows.groupBy(*keys, "_parent", F.shiftright("_code", shift).alias("_digit")).agg(
            F.sum("n").alias("_c"), F.min("_code").alias("_lo"), F.max("_code").alias("_hi"), F.max(value).alias("_v")
        )
        before = W.partitionBy(*keys, "_parent").orderBy("_digit").rowsBetween(W.unboundedPreceding, -1)
        hist = hist.withColumn("_start", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        on = [open_[k].eqNullSafe(hist[k]) for k in keys] + [open_["_parent"].eqNullSafe(hist["_parent"])]
        hit = open_.join(hist, on).where((hist["_start"] <= open_["rank"]) & (open_["rank"] < hist["_start"] + hist["_c"]))
        hit = hit.select(
            *[open_[k] for k in keys], "t", (open_["rank"] - hist["_start"]).alias("rank"), hist["_digit"].alias("_parent"),
            (hist["_lo"] == hist["_hi"]).alias("_done"), hist["_v"].alias("_v"),
        )
        hit = stage(hit, "radix-ranks")
        done = hit.where("_done").select(*keys, "t", "_v")
        found = done if found is None else found.unionByName(done)
        open_ = hit.where("NOT _done").select(*keys, "t", "rank", "_parent")
        if open_.isEmpty():
            break
    picked = found.groupBy(*keys).agg(*[F.max(F.when(F.col("t") == t, F.col("_v"))).alias(f"_x{t}") for t in range(2 * len(probs))])
    out = totals.select(*keys, *fractions).join(picked, keys)
    return out.select(
        *([] if alone else keys), *[(F.col(f"_x{2 * i}") + (F.col(f"_x{2 * i + 1}") - F.col(f"_x{2 * i}")) * F.col(f"_f{i}")).alias(name) for i, name in enumerate(names)]
    )
