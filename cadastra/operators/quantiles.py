"""Exact quantiles in bounded memory, for groups of any size, by selection.

Of each group only the ranks that the quantiles need are looked for. A pass counts values in equal bins of the range in which a rank
must lie, and the bin that holds it, from its least to its greatest value, is the next range; a few passes leave ranges of one
value. No task holds a group's values: they are counted where they are read, and a range has `bins` counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_OCTAVES = 1100


def exact_quantiles(df: DataFrame, keys: list[str], value: str, percents: list[float] | tuple[float, ...], cut: Callable[[DataFrame, str], DataFrame], bins: int = 4096, few: int = 1000) -> DataFrame:
    """(keys, n, quantiles) with the quantiles of each group's finite values in the order of percents, interpolated between the two
    nearest ranks, as percentile() gives them. Groups without finite values have no row; keys may be null. Ranges of `few` values
    are read out in order. cut writes a
    DataFrame and gives it back without its lineage."""
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    v = df.select(F.to_json(key, {"ignoreNullFields": "false"}).alias("_k"), key.alias("_key"), F.col(value).cast("double").alias("_v"))
    v = v.where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf")))
    groups = cut(v.groupBy("_k").agg(F.first("_key").alias("_key"), F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")), "quantile-groups")
    at = lambda p: (F.col("n") - 1) * F.lit(float(p))
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(at(p)), F.ceil(at(p))) for p in percents))))
    open_ = groups.select("_k", F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("before"), "lo", "hi", F.col("n").alias("m"))
    values = v.select("_k", "_v")
    done = []
    while True:
        open_ = cut(open_, "quantile-ranges")
        done.append(open_.where("lo = hi").select("_k", "rank", F.col("lo").alias("value")))
        small = open_.where(f"lo < hi AND m <= {few}")
        held = values.join(small.select("_k", "lo", "hi").distinct(), "_k").where("_v BETWEEN lo AND hi").groupBy("_k", "lo", "hi").agg(F.sort_array(F.collect_list("_v")).alias("all"))
        done.append(small.join(held, ["_k", "lo", "hi"]).select("_k", "rank", F.element_at("all", (F.col("rank") - F.col("before") + 1).cast("int")).alias("value")))
        wide = open_.where(f"lo < hi AND m > {few}").drop("m")
        if wide.isEmpty():
            break
        ranges = wide.select("_k", "lo", "hi", "before").distinct()
        share = (F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)  # halves don't overflow
        if len(done) % 4 == 0:  # every other pass by magnitude, for values of very different sizes; logarithms keep the order too
            share = F.when(share > 0, F.greatest(F.lit(0.0), 1 + F.log2(share) / _OCTAVES)).otherwise(0.0)
        held = values.join(ranges, "_k").where("_v BETWEEN lo AND hi").groupBy("_k", "lo", "hi", "before", F.least(F.lit(bins - 1), F.floor(share * bins)).alias("bin"))
        counts = held.agg(F.count("*").alias("m"), F.min("_v").alias("least"), F.max("_v").alias("most"))
        first = F.col("before") + F.sum("m").over(W.partitionBy("_k", "lo", "hi").orderBy("bin")) - F.col("m")
        counts = counts.withColumn("first", first)
        found = wide.join(counts.drop("before"), ["_k", "lo", "hi"]).where("rank >= first AND rank < first + m")
        open_ = found.select("_k", "rank", F.col("first").alias("before"), F.col("least").alias("lo"), F.col("most").alias("hi"), "m")
    known = done[0]
    for part in done[1:]:
        known = known.unionByName(part)
    per = groups.join(known.groupBy("_k").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")), "_k")  # two ranks a quantile

    def between(p: float) -> Column:
        low, high = F.floor(at(p)), F.ceil(at(p))
        a, b = F.element_at("at", low), F.element_at("at", high)
        return F.when(a == b, a).otherwise((high - at(p)) * a + (at(p) - low) * b)

    out = per.select("_key", "n", F.array(*map(between, percents)).alias("quantiles"))
    return out.select(*(F.col("_key")[k].alias(k) for k in keys), "n", "quantiles")


def least_of(df: DataFrame, key: str, value: str, n: int = 3) -> DataFrame:
    """(key, samples): the n least different values of each key; tasks keep n of a key before anything is sent."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(value))
    first = df.where(F.col(value).isNotNull()).select(key, value).distinct().withColumn("_r", rank).where(F.col("_r") <= n)
    return first.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("samples"))
