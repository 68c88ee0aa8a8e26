"""Evidence of pipeline runs: inventories, completeness, comparisons of documents and identities, contracts between tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import scalars as S

from .audit import first_true

#: Severities from bad to good with the verdict that each leads to.
VERDICTS = {"BLOCKING": "FAIL", "NON_BLOCKING": "PASS_WITH_NON_BLOCKING_FINDINGS", "NONE": "PASS"}


def compare_leaves(a: DataFrame, b: DataFrame, key: str, ignored: list[str], tolerances: list[tuple[str, float]]) -> DataFrame:
    """(key, path, status) of two tables of leaves(key, path, value) that aren't the same: only_a, only_b, differs; within where numbers
    differ by no more than the tolerance of the first pattern that the path matches.

    Paths of which a part is in ignored don't count."""
    part = lambda p: F.arrays_overlap(F.split(p, r"\."), F.array(*map(F.lit, ignored))) if ignored else F.lit(False)
    side = lambda d, n: d.where(~part(F.col("path"))).select(key, "path", F.col("value").alias(n), F.lit(True).alias(f"_{n}"))
    j = side(a, "a").join(side(b, "b"), [key, "path"], "full")
    limit = F.coalesce(*(F.when(F.col("path").rlike(p), F.lit(float(t))) for p, t in tolerances), F.lit(0.0))
    gap = F.abs(F.col("a").try_cast("double") - F.col("b").try_cast("double"))
    status = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(F.col("a").eqNullSafe(F.col("b")), "same").when(gap <= limit, "within").otherwise("differs")
    return j.select(key, "path", status.alias("status")).where("status != 'same'")


def compare_identity(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row on two runs' tiles(tile_id, source_sha256, runtime, commit): tiles of one only, sources that differ, and whether runtimes
    and commits agree."""
    j = a.select("tile_id", F.col("source_sha256").alias("_a"), F.lit(1).alias("_in_a")).join(b.select("tile_id", F.col("source_sha256").alias("_b"), F.lit(1).alias("_in_b")), "tile_id", "full")
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    out = j.agg(F.count_if(F.col("_in_b").isNull()).alias("only_a"), F.count_if(F.col("_in_a").isNull()).alias("only_b"), F.count_if(both & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("sources_differ"))
    for field in ("runtime", "commit"):
        of = lambda d, n, f=field: d.agg(F.array_sort(F.collect_set(f)).alias(n))  # noqa: E731  (a run has one of each, or few)
        one = of(a, "_x").join(F.broadcast(of(b, "_y"))).select((F.col("_x") == F.col("_y")).alias(f"same_{field}"))
        out = out.join(F.broadcast(one))  # one row each
    return out.withColumn("comparable", (F.col("only_a") == 0) & (F.col("only_b") == 0) & (F.col("sources_differ") == 0) & F.col("same_runtime") & F.col("same_commit"))


def run_inventory(files: DataFrame, expected: DataFrame, prohibited: str) -> DataFrame:
    """files(path, size_bytes, sha256) with media type and standing by expected(pattern, standing): prohibited where the path matches that
    pattern or is absolute, else required or conditional as the first pattern says (a handful), else unexpected."""
    rules = [(r["pattern"], r["standing"]) for r in expected.orderBy("pattern").collect()]
    standing = first_true([(F.col("path").rlike(prohibited) | S.is_absolute_path(F.col("path")), "prohibited"), *((F.col("path").rlike(p), s) for p, s in rules)], "unexpected")
    return files.withColumns({"media_type": S.media_type(F.col("path")), "standing": standing})


def run_findings(inventory: DataFrame, manifest: DataFrame, authorized: DataFrame, required: list[str]) -> DataFrame:
    """(code, severity, subject) of what is wrong with a run: its inventory, and manifest(tile_id, contract, production, path) against
    the tiles that were authorized."""
    row = lambda d, code, severity, subject: d.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), subject.cast("string").alias("subject"))
    named = authorized.sparkSession.createDataFrame([(p,) for p in required], "pattern string")
    there = inventory.select("path").join(F.broadcast(named), F.regexp_like("path", F.col("pattern")))  # the required names, a handful
    twice = manifest.groupBy("tile_id").agg(F.count("*").alias("n")).where("n > 1")
    parsed = F.try_parse_json(F.col("contract"))
    found = [
        row(inventory.where("standing = 'unexpected'"), "unexpected_file", "NON_BLOCKING", F.col("path")), row(inventory.where("standing = 'prohibited'"), "prohibited_file", "BLOCKING", F.col("path")),
        row(named.join(there.select("pattern").distinct(), "pattern", "left_anti"), "required_file_missing", "BLOCKING", F.col("pattern")), row(twice, "tile_duplicate", "BLOCKING", F.col("tile_id")),
        row(manifest.join(authorized.select("tile_id"), "tile_id", "left_anti"), "tile_unauthorized", "BLOCKING", F.col("tile_id")), row(authorized.join(manifest.select("tile_id"), "tile_id", "left_anti"), "tile_missing", "BLOCKING", F.col("tile_id")),
        row(manifest.where(F.col("contract").isNull() | parsed.isNull()), "contract_unparsable", "BLOCKING", F.col("tile_id")), row(manifest.where(F.coalesce("production", F.lit(False))), "production_flag_set", "BLOCKING", F.col("tile_id")),
        row(manifest.where(F.col("path").contains("..")), "path_traversal", "BLOCKING", F.col("tile_id")), row(manifest.where(S.is_absolute_path(F.col("path"))), "local_path", "NON_BLOCKING", F.col("tile_id")),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def verdict(findings: DataFrame) -> DataFrame:
    """One row: FAIL if any finding blocks, else whether there are others; counts by severity."""
    n = findings.agg(F.count_if(F.col("severity") == "BLOCKING").alias("blocking"), F.count_if(F.col("severity") == "NON_BLOCKING").alias("non_blocking"))
    return n.withColumn("verdict", first_true([(F.col("blocking") > 0, VERDICTS["BLOCKING"]), (F.col("non_blocking") > 0, VERDICTS["NON_BLOCKING"])], VERDICTS["NONE"]))


def contract_problems(tiles: DataFrame, crs: str, factor: float) -> DataFrame:
    """tiles(tile_id, unit, crs, factor, version) with the reasons why their source contract can't be trusted, and whether the units of
    all tiles agree."""
    absent = lambda c: F.lower(S.text(F.col(c))).isin("", "unknown", "none", "null", "unverified", "tbd")
    state = S.unit_state(F.col("unit"))
    rules = {
        "no_unit": absent("unit"), "unknown_unit": ~absent("unit") & (state == "unknown"), "no_crs": absent("crs"), "wrong_crs": ~absent("crs") & (F.upper("crs") != crs.upper()), "no_factor": F.col("factor").isNull(),
        "wrong_factor": (state == "ftUS") & (F.abs(F.col("factor") - factor) > 1e-12), "converted_twice": (state == "m") & (F.col("factor") != 1.0), "no_version": absent("version"),
    }
    mixed = tiles.agg(F.count_distinct(state).alias("_k")).select((F.col("_k") > 1).alias("mixed_units"))
    return tiles.withColumn("problems", F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items())))).join(F.broadcast(mixed))  # one row


def config_problems(config: DataFrame, required: list[str], boxes: tuple[str, ...] = ("bbox",)) -> DataFrame:
    """config rows with errors (required fields that are missing, boxes that are inverted) and warnings (sources without a license)."""
    types = dict(config.dtypes)
    text = lambda c: S.text(F.col(c).cast("string")) if c in types else F.lit("")
    inverted = [F.when((F.col(f"{b}.xmin") >= F.col(f"{b}.xmax")) | (F.col(f"{b}.ymin") >= F.col(f"{b}.ymax")), F.lit(f"inverted_{b}")) for b in boxes if b in types]
    errors = F.array_compact(F.array(*(F.when(text(c) == "", F.lit(f"no_{c}")) for c in required), *inverted))
    warnings = F.array_compact(F.array(F.when(text("license") == "", F.lit("no_license")), F.when(S.unconfirmed_license(text("license")), F.lit("license_unconfirmed"))))
    return config.withColumns({"errors": errors, "warnings": warnings})


def stale_artefacts(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """(path, status) of files(path, tile_id, kind, modified) against manifests(tile_id, generated): orphaned without a manifest, stale
    where older than it, else current."""
    j = files.join(manifests.groupBy("tile_id").agg(F.max("generated").alias("_g")), "tile_id", "left")
    return j.select("path", F.when(F.col("_g").isNull(), "orphaned").when(F.col("modified") < F.col("_g"), "stale").otherwise("current").alias("status"))


def tile_gate(sampled: DataFrame, tiles: DataFrame, z_low: float, z_high: float, tolerance: float = 1.0) -> DataFrame:
    """tiles(tile_id, xmin..ymax) with n, low and high percentiles and the share of sampled(tile_id, x, y, z) in the plausible range of z,
    and the reasons to reject: no points, points outside the bounds, most heights implausible."""
    p = sampled.groupBy("tile_id").agg(
        F.count("*").alias("n"), F.percentile("z", F.array(F.lit(0.01), F.lit(0.99))).alias("_q"), F.count_if(F.col("z").between(z_low, z_high)).alias("_ok"),
        *(f(c).alias(f"_{n}{c}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))),
    )
    j = tiles.join(p, "tile_id", "left")
    off = F.greatest(F.col("xmin") - F.col("_lox"), F.col("_hix") - F.col("xmax"), F.col("ymin") - F.col("_loy"), F.col("_hiy") - F.col("ymax"))
    rules = {"no_points": F.col("n").isNull(), "out_of_bounds": off > tolerance, "implausible_z": 2 * F.col("_ok") < F.col("n")}
    reject = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items())))
    return j.select(*tiles.columns, F.coalesce("n", F.lit(0)).alias("n"), F.col("_q")[0].alias("z_low"), F.col("_q")[1].alias("z_high"), (F.col("_ok") / F.col("n")).alias("plausible"), reject.alias("reject"))


def roof_eligibility(roofs: DataFrame, least_coverage: float = 0.6, most_rmse: float = 0.35, least_confidence: float = 0.6) -> Column:
    """Why a roof's geometry isn't built: its outcome, coverage, error or confidence; empty if it may be."""
    rules = {
        "not_supported": F.col("outcome") != "reconstruction_supported", "coverage": F.col("coverage") < least_coverage, "rmse": F.col("rmse") > most_rmse, "confidence": F.col("confidence") < least_confidence, "no_ring": F.col("n_corners") < 3,
    }
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in rules.items())))


def social_state(posts: DataFrame, history: DataFrame, viewer: str, structure: str, tile: str, n_posts: int = 50, n_history: int = 25) -> tuple[DataFrame, DataFrame]:
    """The latest posts of a structure or its tile that the viewer may see (public, unlisted or their own), and the structure's latest
    claim events (top-n reports)."""
    seen = F.col("visibility").isin("public", "unlisted") | (F.col("user_id") == viewer)
    at = (F.col("structure_id") == structure) | (F.col("tile_id") == tile)
    order = [F.desc("created_at"), F.desc("id")]
    return posts.where(seen & at).orderBy(*order).limit(n_posts), history.where(F.col("structure_id") == structure).orderBy(*order).limit(n_history)


def owned_by(status: DataFrame, user: str) -> DataFrame:
    """Structures that a user holds, the latest first."""
    return status.where(F.col("claimed_by") == user).orderBy(F.desc("claimed_at"), "structure_id")
