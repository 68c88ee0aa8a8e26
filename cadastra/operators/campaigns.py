"""Survey campaigns: files grouped by the campaign in their names, scored, and the best one recommended."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import scalars as S

from .quantiles import least_of


@dataclass(frozen=True)
class City:
    """What a city's configuration says: words of its names, words that campaigns should or shouldn't have, a sample project."""

    terms: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    sample_project: str = ""
    avoid: tuple[str, ...] = ("arra", "legacy")


def rollup(files: DataFrame) -> DataFrame:
    """files(filename, size_bytes, publication_date, has_box, on_disk, title) by campaign: counts, bytes, prefixes (a map to
    their counts), dates, three sample names, the share of files with a box."""
    named = files.withColumn("_c", S.campaign(F.col("filename"))).select("*", "_c.campaign_group", "_c.detailed_prefix")
    prefixes = named.groupBy("campaign_group", "detailed_prefix").agg(F.count("*").alias("n")).groupBy("campaign_group")
    prefixes = prefixes.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("detailed_prefix", "n")))).alias("prefixes"))
    out = named.groupBy("campaign_group").agg(
        F.count("*").alias("tile_count"), F.sum("size_bytes").alias("bytes"), F.count_if("on_disk").alias("on_disk_count"),
        F.bool_or(F.lower("filename").endswith(".laz")).alias("has_laz"), F.round(100.0 * F.count_if("has_box") / F.count("*"), 1).alias("bbox_percent"),
        F.array_sort(F.collect_set("publication_date")).alias("dates"), F.min("title").alias("title"),
    )
    return out.join(prefixes, "campaign_group").join(least_of(named, "campaign_group", "filename"), "campaign_group", "left")


def _rules(city: City) -> list[tuple[Column, Column, Column]]:
    """(holds, points, reason) of the additive rules."""
    prefixes = F.lower(F.array_join(F.map_keys("prefixes"), " "))
    hay = F.lower(F.concat_ws(" ", "campaign_group", prefixes, F.coalesce("title", F.lit("")), F.array_join("samples", " ")))
    has = lambda t: F.contains(hay, F.lit(t.lower()))
    years = F.transform(F.filter("dates", lambda d: d.rlike("^(19|20)[0-9]{2}")), lambda d: F.substring(d, 1, 4).cast("int"))
    named_year = F.regexp_extract(prefixes, r"\b(?:19|20)\d{2}\b", 0).try_cast("int")
    year = F.array_max(F.array_compact(F.concat(years, F.array(named_year))))
    n_terms = sum((has(t).cast("int") for t in sorted(set(city.terms))), F.lit(0))
    any_of = lambda words: sum((has(w).cast("int") for w in words), F.lit(0)) > 0
    n, box = F.col("tile_count"), F.col("bbox_percent")
    bonus = F.least(F.lit(40), 12 + 4 * n_terms)
    local = F.least(F.col("on_disk_count"), F.lit(25))
    return [
        (year.isNotNull(), (year - 2000) * 2.5, F.lit("newer survey")),
        (n_terms > 0, bonus, F.lit("city words")),
        (any_of([k for k in city.keywords if len(k) >= 4]), F.lit(30), F.lit("keyword")),
        (has(city.sample_project) if city.sample_project else F.lit(False), F.lit(50), F.lit("sample project")),
        (any_of(city.avoid), F.lit(-25), F.lit("legacy")),
        (n.between(30, 3000), F.lit(10), F.lit("plausible count")),
        (n < 5, F.lit(-20), F.lit("few tiles")),
        (F.col("has_laz"), F.lit(5), F.lit("compressed")),
        (local > 0, local, F.lit("local files")),
        (box >= 95, F.lit(8), F.lit("boxes")),
        ((box == 0) & (n > 0), F.lit(-15), F.lit("no boxes")),
        (F.exists("dates", lambda d: d.startswith("1899")), F.lit(-40), F.lit("bogus date")),
    ]


def scores(groups: DataFrame, city: City) -> DataFrame:
    """rollup() rows with score and the reasons of the rules that hold."""
    rules = _rules(city)
    total = sum((F.when(holds, points.cast("double")).otherwise(0.0) for holds, points, _ in rules), F.lit(0.0))
    return groups.withColumns({"score": total, "reasons": F.array_compact(F.array(*(F.when(holds, reason) for holds, _, reason in rules)))})


def recommended(scored: DataFrame) -> DataFrame:
    """One row: the campaign of the highest score (ties to the name) and its commonest prefix."""
    best = scored.orderBy(F.desc("score"), "campaign_group").limit(1)
    prefix = F.array_sort(F.transform(F.map_entries("prefixes"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("p"))))[0]["p"]
    return best.select("campaign_group", prefix.alias("detailed_prefix"), "score", "tile_count", "reasons")


def readiness(scored: DataFrame, configured: str | None, boundary: bool, manifest: bool) -> DataFrame:
    """One row on what a new city still lacks: counts, the recommended campaign, steps that are left, and whether it is ready."""
    totals = scored.agg(F.count("*").alias("n_campaigns"), F.sum("tile_count").alias("n_files"), F.sum("bytes").alias("bytes"), F.sum("on_disk_count").alias("n_on_disk"))
    j = totals.join(F.broadcast(recommended(scored).select(F.col("campaign_group").alias("recommended"), F.col("tile_count").alias("n_wanted"))))  # one row each
    steps = F.array_compact(
        F.array(
            F.when(F.lit(not boundary), F.lit("boundary")), F.when(F.lit(configured is None), F.lit("choose_campaign")), F.when(F.lit(configured) != F.col("recommended"), F.lit("review_campaign")),
            F.when(F.col("n_on_disk") < F.col("n_wanted"), F.lit("download")), F.when(F.lit(not manifest), F.lit("tile_manifest")),
        )
    )
    return j.withColumn("steps", steps).withColumn("ready", F.size("steps") == 0)


def projects(files: DataFrame, selected: Column) -> DataFrame:
    """files(filename, size_bytes) by project: how many, how large, and how much of it is selected."""
    return files.groupBy(S.project(F.col("filename")).alias("project")).agg(
        F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"), F.count_if(selected).alias("n_selected"), F.coalesce(F.sum(F.when(selected, F.col("size_bytes"))), F.lit(0)).alias("bytes_selected")
    )
