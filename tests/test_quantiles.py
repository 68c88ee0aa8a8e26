"""Exact quantiles by selection against sorting, and samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.operators import audit as A
from cadastra.operators import profile as P
from cadastra.operators.quantiles import exact_quantiles, least_of
from cadastra.plans.clusters import cut

PERCENTS = (0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0)


@pytest.mark.parametrize(("bins", "few"), [(64, 3), (1000, 0), (64, 1000)])
def test_quantiles_of_many_shapes(spark, bins, few):
    rng = np.random.default_rng(bins)
    groups = {
        "normal": rng.normal(size=400), "ties": rng.integers(0, 4, 300).astype(float), "one": [3.5], "two": [1.0, 2.0], "equal": [7.0] * 50, "wide": [-1.7e308, 1.7e308, 0.0, 1.0, 1e-300],
        "skewed": np.exp(rng.normal(size=200) * 20), "negative": -rng.random(101), None: rng.random(30),
    }
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("odd", float("nan")), ("odd", float("inf")), ("normal", float("-inf")), ("normal", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, ["g"], "v", PERCENTS, cut, bins, few).collect()}
    want = {r["g"]: (r["n"], r["q"]) for r in df.where("v BETWEEN -1.79e308 AND 1.79e308").groupBy("g").agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, PERCENTS))).alias("q")).collect()}
    assert got == want and "odd" not in got and None in got


def test_a_million_values_in_a_thousand_bins(spark):
    """However large the field, a range has a thousand counts."""
    df = spark.range(1_000_000).select(((F.col("id") * 7919 % 1_000_003) / 7.0).alias("v"))
    seen = []

    def counted(x, label):
        seen.append((label, out := cut(x, label)))
        return out

    got = exact_quantiles(df, [], "v", PERCENTS, counted, 1000).first()
    values = np.sort((np.arange(1_000_000) * 7919 % 1_000_003) / 7.0)
    assert got["n"] == 1_000_000 and np.allclose(got["quantiles"], np.quantile(values, PERCENTS), rtol=1e-12)
    assert max(x.count() for _, x in seen) <= 2 * len(PERCENTS) and len(seen) <= 5


def test_profiles_by_selection_equal_plain_ones(spark):
    df = spark.createDataFrame([(k, float(k * k % 97), None if k % 5 else float("nan") if k % 2 else k / 3) for k in range(300)], "id int, a double, b double")
    plain, exact = ({r["field"]: r.asDict() for r in P.distributions(df, ["a", "b"], cut=c).collect()} for c in (None, cut))
    assert plain == exact
    far = [sorted(tuple(r) for r in P.outliers(df, "id", ["a", "b"], 0.4, cut=c).collect()) for c in (None, cut)]
    assert far[0] == far[1] and far[0]


def test_least_samples(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "x"), ("a", "x"), ("a", "y"), ("a", "w"), ("b", None), ("c", "q")], "k string, v string")
    assert {r["k"]: r["samples"] for r in least_of(df, "k", "v").collect()} == {"a": ["w", "x", "y"], "c": ["q"]}


def test_views_of_the_user_stay(spark):
    for name in ("_findings", "_level"):
        spark.sql("SELECT 1 AS mine").createOrReplaceTempView(name)
    P.summary(spark.createDataFrame([("en", 1)], "lang string, building_id int"), ["lang"]).collect()
    A.json_leaves(spark.createDataFrame([(1, '{"a": {"b": 2}}')], "id int, t string"), "id", "t").collect()
    assert all(spark.table(name).columns == ["mine"] for name in ("_findings", "_level"))
