"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken target / source size times on average. The whole part is certain; the
fraction is settled by pairs: of two documents with open fractions, mass (fraction times size) moves from one to the other,
in a random direction that keeps both expectations, until one of them is 0 or 1. Mass is conserved, so a source misses
its target by less than one document. Buckets of bounded size settle their own documents and pass on one residual each;
residuals meet in a tree of bounded fan-in. Random numbers come from hashes of the seed and the document, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table

_DRAW = float(1 << 53)


def word_count(text: F.Column) -> F.Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text; null has none."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def targets(sizes: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target, rate for sizes(source, source_size).

    Sources by code point, null last, have the weights in turn; targets share `share` times the total by weight, stop at
    `most` times the source's size, and the excess is reshared by weight among the others until none is above. The capped
    sources are those of the largest weight to size ratio, so one ordered pass over the sources settles it: the first k
    are capped, where k is the smallest number for which the next isn't above its cap. Empty sources have target 0."""
    by_source = W.orderBy(F.col("source").isNull(), F.col("source"))
    n = len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_source) - 1) % n + 1).cast("int")))
    total = weighted.agg(F.sum("source_size").alias("all")).withColumn("goal", F.col("all") * share)
    order = W.orderBy((F.col("source_size") / F.col("weight")), F.col("source").isNull(), "source")
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    ranked = weighted.join(F.broadcast(total)).select(
        "source", "source_size", "weight", "goal",
        F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(rest).alias("open"),
        F.row_number().over(order).alias("i"),
    )
    level = (F.col("goal") - F.col("capped")) / F.col("open")
    stop = F.min(F.when(level * F.col("weight") <= most * F.col("source_size"), F.struct("i", level.alias("level")))).over(W.partitionBy())
    out = ranked.withColumn("stop", stop)
    target = F.when(F.col("stop").isNull() | (F.col("i") < F.col("stop.i")), most * F.col("source_size")).otherwise(F.col("weight") * F.col("stop.level"))
    return out.select("source", "source_size", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target"))


def pivot(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Settle fractions p of units of these sizes in the given order. Gives p with at most one open, and its index or -1."""
    p = p.copy()
    open_ = -1
    for i in range(len(p)):
        if not 1e-12 < p[i] < 1 - 1e-12 or size[i] == 0:
            p[i] = round(p[i])
            continue
        if open_ < 0:
            open_ = i
            continue
        a, b = open_, i
        ma, mb = p[a] * size[a], p[b] * size[b]
        up = min(size[a] - ma, mb)  # mass that a can take from b
        down = min(ma, size[b] - mb)
        if draw[i] * (up + down) < down:
            ma, mb = ma + up, mb - up
        else:
            ma, mb = ma - down, mb + down
        p[a], p[b] = ma / size[a], mb / size[b]
        open_ = -1
        for x in (a, b):
            if 1e-12 < p[x] < 1 - 1e-12:
                open_ = x
            else:
                p[x] = round(p[x])
    return p, open_


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["draw", "key", *(["row"] if "row" in pdf else [])], kind="stable").reset_index(drop=True)
    p, open_ = pivot(pdf["p"].to_numpy(), pdf["size"].to_numpy(float), ((pdf["draw"].to_numpy() >> 10) & ((1 << 53) - 1)) / _DRAW)
    pdf["p"] = p
    pdf["settled"] = np.arange(len(pdf)) != open_
    return pdf


def mix(docs: DataFrame, seed: int = 17, bucket_rows: int = 4096, fan_in: int = 256, **rule) -> DataFrame:
    """(key, source, size, source_size, target, taken) for docs(key, source, size).

    key tells rows apart and orders ties. Repeated rows are rounded like others, except that rows equal in key, source and
    size share their draw. Sizes of 0 take nothing. No rows, no result. A column row (long) of docs orders them then, and is
    carried to the result."""
    row = [c for c in docs.columns if c == "row"]
    sized = cut(docs.select("key", "source", F.col("size").cast("long").alias("size"), *row), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = cut(targets(sources, **rule).join(sources.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-targets")
    rows = sources.agg(F.max("n")).first()[0] or 0
    t = sources.select(F.col("source").alias("_s"), "source_size", "target", "n")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    draw = F.xxhash64(F.lit(seed), "key", "source", "size")
    joined = sized.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        "key", "source", "size", "source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("p"), draw.alias("draw"),
        F.pmod(F.shiftright(F.xxhash64(F.lit(seed + 1), "key", "size"), 20), F.ceil(F.col("n") / bucket_rows)).alias("bucket"), *row,
    )
    fields = "key long, source string, size long, source_size long, target double, whole long, p double, draw long, bucket long" + (", row long" if row else "")
    levels = []
    todo, buckets = joined, -(-rows // bucket_rows)
    while True:
        done = cut(todo.groupBy("source", "bucket").applyInPandas(_settle, fields + ", settled boolean"), "mix-level")
        levels.append(done.where("settled").drop("settled"))
        rest = done.where("not settled").drop("settled")
        if buckets <= 1:
            break
        buckets = -(-buckets // fan_in)
        todo = rest.withColumn("bucket", F.floor(F.col("bucket") / fan_in))
    # What is left of a source, one document at most, is rounded by its own draw.
    last = F.pmod(F.xxhash64(F.lit(seed + 2), "key", "size"), F.lit(1 << 30)) / float(1 << 30)
    out = rest.withColumn("p", F.when(last < F.col("p"), 1.0).otherwise(0.0))
    for level in levels:
        out = out.unionByName(level)
    return out.select("key", "source", "size", "source_size", "target", ((F.col("whole") + F.round("p").cast("long")) * F.col("size")).alias("taken"), *row)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "source", word_count(F.col("text")).alias("size"))
    return mix(docs).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")
