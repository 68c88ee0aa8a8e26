"""Quality report on building records: relationships between fields, summaries by group, findings in order, written by section.

Records have any of the columns below; what a table lacks counts as missing. Some fields have older names that are read where the
current one isn't there."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import profile as P

#: Current field names with their older ones, names under which other facts stand, and severities from bad to good.
ALIASES = {
    "estimated_height": ("height",), "ground_z": ("ground_elevation",), "roof_z": ("roof_elevation",), "footprint_area_m2": ("footprint_area",), "perimeter_m": ("perimeter",), "roof_area_m2": ("roof_area",), "volume_m3": ("volume",),
    "point_count_inside": ("point_count_filtered",), "point_count_cluster": ("point_count_raw",),
}
HASHES = ("source_hash", "source_sha256", "metadata_sha256", "input_hash")
CRS = ("source_crs", "crs", "horizontal_crs", "vertical_crs", "target_crs")
ORIGINS = ("footprint_provenance", "provenance")
UNITS = ("horizontal_units", "horizontal_unit", "vertical_units", "vertical_unit", "units")
MARKERS = ("fallback_reason", "fallback_type", "is_fallback", "footprint_provenance")
VERSIONS = ("normalization_version", "metric_normalization_version", "unit_provenance", "metric_provenance")
SEVERITIES = ("ERROR", "WARNING", "INFO")


@dataclass(frozen=True)
class Tolerances:
    height: float = 2.0
    density: float = 0.05
    iqr: float = 3.0


class _Record:
    def __init__(self, df: DataFrame):
        self.types = dict(df.dtypes)

    def text(self, name: str) -> Column:
        return F.col(name).cast("string") if name in self.types else F.lit(None).cast("string")

    def number(self, name: str) -> Column:
        """The finite number under a name or, where a table lacks it, under its first older name."""
        found = next((n for n in (name, *ALIASES.get(name, ())) if n in self.types), None)
        if found is None:
            return F.lit(None).cast("double")
        v = F.col(found).try_cast("double")
        return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)

    def any_of(self, names) -> Column:
        """Whether one of these is there: not null, empty, zero or false."""
        truth = [F.coalesce(~F.lower(self.text(n)).isin("", "false", "0", "0.0"), F.lit(False)) for n in names if n in self.types]
        return reduce(lambda a, b: a | b, truth, F.lit(False))


def _diagnosis(code: str, holds: Column, field: str, kind: str = "DATA_QUALITY_SIGNAL", severity: str = "WARNING") -> Column:
    row = F.struct(F.lit(kind).alias("diagnostic_type"), F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(field).alias("characteristic"))
    return F.when(F.coalesce(holds, F.lit(False)), row)


def record_rules(df: DataFrame, tol: Tolerances = Tolerances()) -> list[Column]:
    r = _Record(df)
    n, d = r.number, _diagnosis
    rise, area = n("roof_z") - n("ground_z"), n("footprint_area_m2")
    expected = n("point_count_inside") / F.when(area != 0, area)
    metric = reduce(lambda a, b: a | b, (F.coalesce(F.lower(r.text(u)).isin("meter", "meters", "metre", "metres"), F.lit(False)) for u in UNITS))
    origin = r.any_of(ORIGINS)
    looks = reduce(lambda a, b: a | b, (F.coalesce(F.lower(F.col(c)).contains("fallback"), F.lit(False)) for c, t in r.types.items() if t == "string"), F.lit(False))
    city = F.replace(F.lower(F.coalesce(r.text("city"), F.lit(""))), F.lit(" "), F.lit("_"))
    tiles = "contributing_source_tiles"
    twice = F.size(tiles) > F.size(F.array_distinct(tiles)) if r.types.get(tiles, "").startswith("array") else F.lit(False)
    return [
        d("REL-HEIGHT-MAX-P95", n("height_max") < n("height_p95"), "height_max"), d("REL-HEIGHT-P95-P90", n("height_p95") < n("height_p90"), "height_p95"), d("REL-ROOF-BELOW-GROUND", rise < 0, "roof_z"),
        d("REL-HEIGHT-DELTA", F.abs(n("estimated_height") - rise) > tol.height, "estimated_height"), d("REL-NEG-FOOTPRINT-AREA", area < 0, "footprint_area_m2"), d("REL-NEG-PERIMETER", n("perimeter_m") < 0, "perimeter_m"),
        d("REL-NEG-ROOF-AREA", n("roof_area_m2") < 0, "roof_area_m2"), d("REL-NEG-VOLUME", n("volume_m3") < 0, "volume_m3"), d("REL-ZERO-FOOTPRINT-AREA", area == 0, "footprint_area_m2"),
        d("REL-FILTERED-GT-RAW", n("point_count_inside") > n("point_count_cluster"), "point_count_inside"),
        d("REL-DENSITY-MISMATCH", (expected != 0) & (F.abs(n("point_density") - expected) / F.abs(F.nullif(expected, F.lit(0.0))) > tol.density), "point_density"),
        d("REL-METRIC-PROVENANCE-MISSING", metric & ~r.any_of(VERSIONS), "unit_provenance"), d("REL-CRS-MISSING", ~r.any_of(CRS), "source_crs"), d("REL-PROVENANCE-MISSING", ~origin, "footprint_provenance"),
        d("REL-SOURCE-HASH-MISSING", ~r.any_of(HASHES), "source_hash", severity="INFO"), d("REL-HIGH-CONFIDENCE-NO-PROVENANCE", (F.upper(r.text("confidence")) == "HIGH") & ~origin, "confidence"),
        d("REL-FALLBACK-MARKER-MISSING", looks & ~r.any_of(MARKERS), "fallback_reason", "UNSUPPORTED_INFERENCE"),
        d("REL-MIAMI-NORMALIZATION-MISSING", city.isin("miami", "miami_dade", "miami-dade") & ~r.any_of(VERSIONS[:2]), "normalization_version"), d("REL-DUPLICATE-SOURCE-TILE", twice, tiles),
    ]


def relationships(df: DataFrame, numeric: list[str], tol: Tolerances = Tolerances()) -> DataFrame:
    """(diagnostic_type, code, severity, characteristic, building_id, city, source_tile, pipeline_version, scope, scope_value) of df
    (building_id, ...): rules on records, units that are mixed within a city or tile, numbers far outside the quartiles."""
    r = _Record(df)
    who = [r.text("building_id").alias("building_id"), r.text("city").alias("city"), r.text("tile_id").alias("source_tile"), r.text("pipeline_version").alias("pipeline_version")]
    none = F.lit(None).cast("string")
    rows = df.select(*who, F.explode(F.array_compact(F.array(*record_rules(df, tol)))).alias("d")).select("d.*", "building_id", "city", "source_tile", "pipeline_version", none.alias("scope"), none.alias("scope_value"))
    out = [rows]
    for column in (u for u in UNITS[:4] if u in r.types):
        code = "REL-MIXED-HORIZONTAL-UNITS" if column.startswith("horizontal") else "REL-MIXED-VERTICAL-UNITS"
        for scope, name in (("city", "city"), ("tile", "tile_id")):
            g = df.where(F.col(column) != "").groupBy(r.text(name).alias("v")).agg(F.count_distinct(column).alias("n")).where("n > 1")
            out.append(g.select(F.lit("DATA_QUALITY_SIGNAL"), F.lit(code), F.lit("WARNING"), F.lit(column), none, none, none, none, F.lit(scope), F.col("v")))
    if numeric:
        far = P.outliers(df.withColumn("building_id", r.text("building_id")), "building_id", numeric, tol.iqr)
        far = far.join(df.select(*who).dropDuplicates(["building_id"]), "building_id", "left")
        out.append(far.select(F.lit("STATISTICAL_OUTLIER"), F.lit("STAT-IQR-OUTLIER"), F.lit("INFO"), "field", "building_id", "city", "source_tile", "pipeline_version", none, none))
    return reduce(DataFrame.union, out)


def ordered(findings: DataFrame) -> DataFrame:
    """Findings in one order: code, building, file, message."""
    return findings.orderBy("code", "building_id", *(c for c in ("source_file", "message") if c in findings.columns))


def by_severity(findings: DataFrame) -> DataFrame:
    """Findings from the worst to the least, then by code and building."""
    rank = F.create_map(*(F.lit(x) for i, s in enumerate(SEVERITIES) for x in (s, i)))
    return findings.orderBy(F.coalesce(rank[F.upper("severity")], F.lit(len(SEVERITIES))), "code", "building_id")


def warned_only(findings: DataFrame) -> DataFrame:
    """building_id of buildings with warnings but no errors."""
    s = F.upper("severity")
    return findings.groupBy("building_id").agg(F.bool_or(s == "ERROR").alias("e"), F.bool_or(s == "WARNING").alias("w")).where("w AND NOT e").select("building_id")


def group_summary(df: DataFrame, diagnostics: DataFrame, findings: DataFrame, keys: dict[str, str]) -> DataFrame:
    """(level, value, n_records, n_buildings, n_diagnostics, n_findings, hash_percent) for each value of each key; keys map a column
    of df to that of diagnostics and findings. One pass over each table, by grouping sets."""
    r = _Record(df)
    long = lambda d, names: d.select("*", F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.coalesce(F.col(c).cast("string"), F.lit("UNKNOWN")).alias("value")) for k, c in names))).alias("g"))
    own = long(df.withColumn("_h", r.any_of(HASHES)), [(k, k) for k in keys]).groupBy("g.level", "g.value")
    own = own.agg(F.count("*").alias("n_records"), F.count_distinct("building_id").alias("n_buildings"), F.round(100.0 * F.count_if("_h") / F.count("*"), 4).alias("hash_percent"))
    counts = lambda d, name: long(d, list(keys.items())).groupBy("g.level", "g.value").agg(F.count("*").alias(name))
    out = own.join(counts(diagnostics, "n_diagnostics"), ["level", "value"], "left").join(counts(findings, "n_findings"), ["level", "value"], "left")
    return out.na.fill(0, ["n_diagnostics", "n_findings"])


def write_report(path: str, **sections: DataFrame) -> None:
    """Each section as a folder of Parquet under path."""
    for name, rows in sections.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
