"""Data profiling: completeness, distributions, histograms, findings summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quantiles import exact_quantiles

Cut = Callable[[DataFrame, str], DataFrame]
NULL_LIKE = ("null", "none", "nan", "n/a", "na", "undefined")


def long_form(df: DataFrame, columns: list[str], as_: str) -> DataFrame:
    """(field, value) rows of the given columns, cast to one type; nulls stay."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast(as_).alias("value")) for c in columns))
    return df.select(F.explode(pairs).alias("p")).select("p.field", "p.value")


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per field: rows, nulls, blanks, null-like texts (which count as complete), not-a-numbers, infinities, finite numbers,
    distinct values, least, greatest and up to three examples."""
    v = F.col("value")
    number = F.trim(v).try_cast("double")
    odd = F.isnan(number) | (F.abs(number) == float("inf"))
    return long_form(df, columns, "string").groupBy("field").agg(
        F.count("*").alias("n_rows"), F.count_if(v.isNull()).alias("n_null"), F.count_if(F.trim(v) == "").alias("n_blank"),
        F.count_if(F.lower(F.trim(v)).isin(*NULL_LIKE)).alias("n_null_like"), F.count_if(v.isNotNull() & (F.trim(v) != "")).alias("n_complete"),
        F.count_if(F.isnan(number)).alias("n_nan"), F.count_if(F.abs(number) == float("inf")).alias("n_infinite"), F.count_if(number.isNotNull() & ~odd).alias("n_numeric"),
        F.count_distinct(v).alias("n_distinct"), F.min(v).alias("least"), F.max(v).alias("greatest"), _examples(v).alias("examples"),
    )


def _examples(v: Column, n: int = 3) -> Column:
    """The least, the greatest and the value of the least hash: bounded, and the same however rows are dealt."""
    return F.slice(F.array_distinct(F.array_compact(F.array(F.min(v), F.max(v), F.min_by(v, F.xxhash64(v))))), 1, n)


def distributions(df: DataFrame, columns: list[str], percents=(0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99), approx: bool = False, cut: Cut | None = None) -> DataFrame:
    """Per numeric field: finite values' count, min, max, mean, population deviation, percentiles; zero, negative and
    non-finite counts. With cut percentiles are found by selection, exact whatever a field's size; without it a field's different values meet
    in one task, unless approx takes approximate ones."""
    v = F.col("value")
    odd = F.isnan(v) | (F.abs(v) == float("inf"))
    good = F.when(~odd, v)
    q = F.percentile_approx(good, list(percents), 10_000) if approx else F.percentile(good, F.array(*map(F.lit, percents)))
    if cut:
        rows = cut(long_form(df, columns, "double"), "distributions")
        exact = exact_quantiles(rows, ["field"], "value", percents, cut).select("field", F.col("quantiles").alias("percentiles"))
        plain = rows.groupBy("field").agg(
            F.count(good).alias("n"), F.min(good).alias("min"), F.max(good).alias("max"), F.avg(good).alias("mean"), F.stddev_pop(good).alias("std"),
            F.count_if(v == 0).alias("n_zero"), F.count_if(v < 0).alias("n_negative"), F.count_if(odd).alias("n_not_finite"),
        )
        return plain.join(exact, "field", "left")
    return long_form(df, columns, "double").groupBy("field").agg(
        F.count(good).alias("n"), F.min(good).alias("min"), F.max(good).alias("max"), F.avg(good).alias("mean"), F.stddev_pop(good).alias("std"), q.alias("percentiles"),
        F.count_if(v == 0).alias("n_zero"), F.count_if(v < 0).alias("n_negative"), F.count_if(odd).alias("n_not_finite"),
    )


def histogram(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """(bin, lo, hi, n) of n equal-width bins, the last closed, empty ones included; one bin if all values are equal."""
    v = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    span = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where(F.col("lo").isNotNull())
    wide = F.col("hi") > F.col("lo")
    counted = v.join(F.broadcast(span)).groupBy(F.when(wide, F.least(F.lit(n - 1), F.floor((F.col("v") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / n)))).otherwise(0).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    bins = span.select("*", F.explode(F.when(wide, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))).alias("bin"))
    width = F.when(wide, (F.col("hi") - F.col("lo")) / n).otherwise(0.0)
    bins = bins.select("bin", (F.col("lo") + F.col("bin") * width).alias("lo"), (F.col("lo") + (F.col("bin") + 1) * width).alias("hi"))
    return bins.join(counted, "bin", "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def categories(df: DataFrame, column: str, top: int = 10, vocabulary: list[str] | None = None) -> DataFrame:
    """The `top` values by count (a report): value, n, rank, rare (n = 1), known."""
    counted = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    known = F.col("value").isin(vocabulary) if vocabulary else F.lit(True)
    best = counted.orderBy(F.desc("n"), F.col("value").asc_nulls_last()).limit(top)
    return best.select("value", "n", F.row_number().over(W.orderBy(F.desc("n"), F.col("value").asc_nulls_last())).alias("rank"), (F.col("n") == 1).alias("rare"), F.coalesce(known, F.lit(False)).alias("known"))


def outliers(df: DataFrame, key: str, columns: list[str], factor: float = 3.0, least: int = 4, cut: Cut | None = None) -> DataFrame:
    """(key, field, value, low, high) of values beyond factor times the quartile range; fields need `least` values and a range. With cut
    quartiles are those of finite values, found by selection; without it a field's different values meet in one task."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in columns))
    v = df.select(key, F.explode(pairs).alias("p")).select(key, "p.*").where(F.col("value").isNotNull() & ~F.isnan("value"))
    if cut:
        q = exact_quantiles(v, ["field"], "value", (0.25, 0.75), cut).withColumnRenamed("quantiles", "q")
    else:
        q = v.groupBy("field").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.count("*").alias("n"))
    q = q.select("field", "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")).where((F.col("n") >= least) & (F.col("q3") > F.col("q1")))
    q = q.select("field", (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("low"), (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("high"))
    return v.join(F.broadcast(q), "field").where((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))).select(key, "field", "value", "low", "high")  # one row a field


def summary(findings: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n, n_buildings) for every dimension in one pass over grouping sets."""
    sets = ", ".join(f"({d})" for d in dimensions)
    name = "CASE " + " ".join(f"WHEN grouping({d}) = 0 THEN '{d}'" for d in dimensions) + " END"
    value = f"CAST(coalesce({', '.join(f'CAST({d} AS STRING)' for d in dimensions)}) AS STRING)"
    return findings.sparkSession.sql(f"SELECT {name} AS dimension, {value} AS value, count(*) AS n, count(DISTINCT building_id) AS n_buildings FROM {{findings}} GROUP BY GROUPING SETS ({sets})", findings=findings)


def id_comparison(left: DataFrame, right: DataFrame, id_: str) -> DataFrame:
    """One row: matched, missing (left only), extra (right only), duplicated ids on either side, ratio (null if left is empty)."""
    a = left.groupBy(id_).agg(F.count("*").alias("a"))
    b = right.groupBy(id_).agg(F.count("*").alias("b"))
    j = a.join(b, id_, "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    out = j.agg(F.count_if(both).alias("matched"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("extra"), F.count_if((F.col("a") > 1) | (F.col("b") > 1)).alias("duplicated"))
    return out.withColumn("ratio", F.when(F.col("matched") + F.col("missing") > 0, F.col("matched") / (F.col("matched") + F.col("missing"))))


def first_of(df: DataFrame, key: list[str], order: list[Column | str], keep_null_keys: bool = False) -> DataFrame:
    """The first row of each key; with keep_null_keys rows whose (single) key is null all stay."""
    r = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    ranked = df.withColumn("_r", r)
    keep = (F.col("_r") == 1) | F.col(key[0]).isNull() if keep_null_keys else F.col("_r") == 1
    return ranked.where(keep).drop("_r")
