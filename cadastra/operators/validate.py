"""Record validation: every rule is a Column that is a finding where it is violated; findings are rows.

Rules read columns by name; a column that a table lacks counts as null. `codes` can be limited, thresholds replaced."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geometry as G
from cadastra.functions import scalars as S


@dataclass(frozen=True)
class Limits:
    height_tolerance: float = 0.5
    least_height: float = 1.5
    roof_tolerance: float = 1.0
    area_ratio: float = 2.0
    volume_tolerance: float = 0.25
    density_tolerance: float = 0.10
    points_for_p90: int = 3
    points_for_good: int = 8
    fallback_confidence: float = 0.7
    unit_confidence: float = 0.6
    source_confidence: float = 0.5
    centroid_distance: float = 1.0


#: Quality and confidence words.
QUALITIES = ("good", "sparse", "fallback", "empty", "poor", "unknown")
LABELS = ("high", "medium", "low", "unknown")
FEET = ("ft", "feet", "ftus", "us_survey_foot")
METRES = ("m", "metre", "meter", "metres", "meters")


def finding(code: str, severity: str, violated: Column, message: str, observed: Column | None = None) -> Column:
    return F.when(
        violated,
        F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(message).alias("message"), (observed.cast("string") if observed is not None else F.lit(None).cast("string")).alias("observed_value")),
    )


class _Columns:
    """Columns of a table by name; null where the table lacks one."""

    def __init__(self, df: DataFrame):
        self.types = dict(df.dtypes)

    def __call__(self, name: str, as_: str | None = None) -> Column:
        if name not in self.types:
            return F.lit(None).cast(as_ or "string")
        return F.col(name).cast(as_) if as_ else F.col(name)

    def has(self, name: str) -> bool:
        return name in self.types


def _bad(c: Column) -> Column:
    return c.isNotNull() & (F.isnan(c) | (F.abs(c) == float("inf")))


def rules(df: DataFrame, limits: Limits = Limits()) -> list[Column]:
    """All rules, E errors, W warnings, I notes, in the order of their codes."""
    c = _Columns(df)
    num = lambda n: c(n, "double")
    txt = lambda n: c(n, "string")
    blank = lambda x: x.isNull() | (F.trim(x) == "")
    fine = lambda x: x.isNotNull() & ~_bad(x)
    tiles = c("source_tiles", None if c.has("source_tiles") else "array<string>")
    ring = c("ring", None if c.has("ring") else f"array<{G.POINT}>")
    flags = c("quality_flags", None if c.has("quality_flags") else "array<string>")
    id_, metric, version = txt("cluster_id"), c("z_values_metric", "boolean"), txt("normalization_version")
    hcrs, vcrs, hunit, vunit = txt("horizontal_crs"), txt("vertical_crs"), F.lower(txt("horizontal_unit")), F.lower(txt("vertical_unit"))
    elevation = num("ground_z").isNotNull() | num("height_p90").isNotNull()
    p90, p95, top, ground, height, roof = num("height_p90"), num("height_p95"), num("height_max"), num("ground_z"), num("estimated_height"), num("roof_z")
    area, per, cx, cy, turn = num("footprint_area_m2"), num("perimeter_m"), num("centroid_x"), num("centroid_y"), num("orientation")
    box = [num(f"bbox_{k}") for k in ("xmin", "ymin", "xmax", "ymax")]
    corners = F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    values = F.flatten(corners)
    quality, label, conf = txt("source_quality"), txt("confidence_label"), num("confidence")
    n_all, n_in, n_kept, density = num("point_count_cluster"), num("point_count_inside"), num("point_count_filtered"), num("point_density")
    classes = c("class_counts", None if c.has("class_counts") else "map<string,bigint>")
    inside = F.coalesce(F.when(n_in != 0, n_in), n_all)
    multi = F.size(F.coalesce(tiles, F.array().cast("array<string>"))) > 1
    risk = F.coalesce(F.array_contains(flags, "multi_tile"), F.lit(False))
    roof_area, volume = num("roof_area_m2"), num("volume_m3")
    mesh = [num(f"mesh_{k}") for k in ("xmin", "ymin", "zmin", "xmax", "ymax", "zmax")]
    expect = F.when((p90 - ground).isNotNull(), F.greatest(F.lit(limits.least_height), p90 - ground))
    any_ = lambda xs, f: F.greatest(*(F.coalesce(f(x), F.lit(False)) for x in xs))
    count_bad = lambda x: x.isNotNull() & ((x < 0) | (x != F.floor(x)) | _bad(x))
    E, Wn, I = "error", "warning", "info"  # noqa: E741
    return [
        finding("ID-001", E, id_.isNull(), "no building id"),
        finding("ID-002", E, id_.isNotNull() & (F.trim(id_) == ""), "blank building id"),
        finding("PROV-001", Wn, blank(txt("footprint_source_id")) & blank(txt("footprint_provenance")), "no footprint source"),
        finding("PROV-002", Wn, tiles.isNull() | (F.size(tiles) == 0), "no source tiles"),
        finding("PROV-003", Wn, F.size(F.array_distinct(tiles)) < F.size(tiles), "source tiles repeat"),
        finding("PROV-004", I, blank(txt("pipeline_version")), "no pipeline version"),
        finding("PROV-005", E, metric & blank(version), "metric without normalisation version"),
        finding("PROV-006", E, txt("source_sha256").isNotNull() & ~S.is_sha256(txt("source_sha256")), "no SHA-256", txt("source_sha256")),
        finding("PROV-007", E, txt("generated_at").isNotNull() & ~S.is_iso_time(txt("generated_at")), "no ISO time", txt("generated_at")),
        finding("PROV-008", E, ~blank(version) & blank(hcrs) & blank(vcrs), "normalised without reference system"),
        finding("CRS-001", Wn, blank(hcrs) & blank(vcrs), "no reference system"),
        finding("CRS-002", Wn, blank(hcrs) & ~blank(vcrs), "no horizontal reference system"),
        finding("CRS-003", Wn, elevation & blank(vcrs), "elevation without vertical reference system"),
        finding("UNIT-001", Wn, blank(hunit), "no horizontal unit"),
        finding("UNIT-002", Wn, elevation & blank(vunit), "elevation without vertical unit"),
        finding("UNIT-003", E, (metric & vunit.isin(*FEET)) | (~metric & vunit.isin(*METRES)), "metric flag contradicts unit", vunit),
        finding("UNIT-004", Wn, area.isNotNull() & blank(hunit) & blank(version), "metric fields without unit provenance"),
        finding("UNIT-005", E, txt("contract_z_unit").isNotNull() & ~blank(vunit) & (F.lower(txt("contract_z_unit")) != vunit), "unit differs from contract", txt("contract_z_unit")),
        finding("UNIT-006", E, (hunit.isin(*METRES) & vunit.isin(*FEET)) | (hunit.isin(*FEET) & vunit.isin(*METRES)), "metres with feet"),
        finding("UNIT-007", E, area.isNotNull() & metric & blank(version), "metric claim on metric fields without version"),
        finding("UNIT-008", I, box[0].isNotNull() & blank(txt("axis_convention")), "box without axis convention"),
        finding("GEOM-001", Wn, ring.isNull(), "no geometry"),
        finding("GEOM-002", E, F.size(ring) < 3, "fewer than three vertices"),
        finding("GEOM-003", E, (area <= 0) | ((F.size(ring) >= 3) & (G.area(ring) <= 0)), "area not positive", area),
        finding("GEOM-004", E, (per <= 0) | ((F.size(ring) >= 3) & (G.perimeter(ring) <= 0)), "perimeter not positive", per),
        finding("GEOM-005", E, _bad(cx) | _bad(cy), "centroid not finite"),
        finding("GEOM-006", Wn, fine(cx) & fine(cy) & (F.size(ring) >= 3) & ~G.contains(ring, cx, cy) & (G.edge_distance(ring, cx, cy) > limits.centroid_distance), "centroid off the footprint"),
        finding("GEOM-007", E, any_(box, _bad), "box not finite"),
        finding("GEOM-008", E, (box[0] > box[2]) | (box[1] > box[3]), "box inverted"),
        finding("GEOM-009", E, (F.size(ring) >= 3) & ((G.bbox(ring)["xmin"] < box[0] - 0.01) | (G.bbox(ring)["ymin"] < box[1] - 0.01) | (G.bbox(ring)["xmax"] > box[2] + 0.01) | (G.bbox(ring)["ymax"] > box[3] + 0.01)), "box misses the ring"),
        finding("GEOM-010", E, _bad(turn), "orientation not finite"),
        finding("GEOM-011", Wn, fine(turn) & (F.abs(turn) > 180), "orientation beyond 180", turn),
        finding("GEOM-012", E, any_(mesh, _bad), "mesh box not finite"),
        finding("GEOM-013", E, F.exists(values, lambda v: F.isnan(v)), "NaN in ring"),
        finding("GEOM-014", E, F.exists(values, lambda v: F.abs(v) == float("inf")), "infinity in ring"),
        finding("GEOM-015", I, multi & ~risk, "several tiles without risk flag"),
        finding("HEIGHT-001", E, _bad(height), "height not finite"),
        finding("HEIGHT-002", E, fine(height) & (height <= 0), "height not positive", height),
        finding("HEIGHT-003", E, (p90 > p95) | (p95 > top) | (p90 > top), "percentiles out of order"),
        finding("HEIGHT-004", Wn, fine(height) & (quality != "fallback") & (F.abs(height - expect) > limits.height_tolerance), "height differs from p90 - ground", height),
        finding("HEIGHT-005", E, roof < ground, "roof below ground"),
        finding("HEIGHT-006", Wn, F.abs(roof - ground - height) > limits.roof_tolerance, "roof - ground differs from height"),
        finding("HEIGHT-007", I, (inside == 0) & height.isNotNull() & (F.coalesce(quality, F.lit("")) != "fallback"), "fallback not marked"),
        finding("AREA-001", E, area == 0, "zero area"),
        finding("AREA-002", E, roof_area < 0, "negative roof area"),
        finding("AREA-003", Wn, (area > 0) & (roof_area / F.nullif(area, F.lit(0.0)) > limits.area_ratio), "roof area beyond footprint"),
        finding("VOLUME-001", E, volume < 0, "negative volume"),
        finding("VOLUME-002", Wn, (volume >= 0) & (area > 0) & (height > 0) & (F.abs(volume - area * height) > limits.volume_tolerance * area * height), "volume differs from area x height"),
        finding("LIDAR-001", E, any_([n_all, n_in], count_bad), "count is no natural number"),
        finding("LIDAR-002", E, n_kept < 0, "negative filtered count"),
        finding("LIDAR-003", E, n_kept > n_all, "filtered beyond raw count"),
        finding("LIDAR-004", E, density.isNotNull() & (_bad(density) | (density < 0)), "density invalid"),
        finding("LIDAR-005", Wn, (area > 0) & (density > 0) & (F.abs(density - inside / F.nullif(area, F.lit(0.0))) > limits.density_tolerance * density), "density differs from count / area"),
        finding("LIDAR-006", E, num("return_count") < num("first_return_count"), "return counts out of order"),
        finding("LIDAR-007", E, F.aggregate(F.map_values(classes), F.lit(0).cast("long"), lambda s, v: s + v) > n_all, "class counts exceed total"),
        finding("LIDAR-008", Wn, p90.isNotNull() & (inside < limits.points_for_p90), "p90 from few points"),
        finding("LIDAR-009", Wn, (quality == "good") & (inside < limits.points_for_good), "good from few points"),
        finding("CONF-001", Wn, conf.isNull(), "no confidence"),
        finding("CONF-002", E, _bad(conf) | (conf < 0) | (conf > 1), "confidence outside 0 to 1", conf),
        finding("CONF-003", Wn, label.isNotNull() & ~F.lower(label).isin(*LABELS), "unknown confidence label", label),
        finding("CONF-004", E, quality.isNotNull() & ~F.lower(quality).isin(*QUALITIES), "unknown quality", quality),
        finding("CONF-005", Wn, (quality == "fallback") & (conf > limits.fallback_confidence), "fallback with high confidence", conf),
        finding("CONF-006", I, multi & (conf > limits.fallback_confidence), "several tiles with high confidence"),
        finding("CONF-007", Wn, blank(vunit) & elevation & (conf > limits.unit_confidence), "unit doubt with high confidence", conf),
        finding("CONF-008", I, blank(txt("footprint_provenance")) & blank(txt("footprint_source_id")) & (conf > limits.source_confidence), "no source with high confidence", conf),
    ]


def validate(df: DataFrame, limits: Limits = Limits(), codes: list[str] | None = None) -> DataFrame:
    """(building_id, code, severity, message, observed_value), PROV-010 for repeated ids included; a null id stays null."""
    c = _Columns(df)
    found = df.withColumn("_f", F.explode(F.array_compact(F.array(*rules(df, limits))))).select(c("cluster_id", "string").alias("building_id"), "_f.*")
    ids = df.where(c("cluster_id", "string").isNotNull()).groupBy(c("cluster_id", "string").alias("building_id")).agg(F.count("*").alias("n")).where("n > 1")
    repeated = ids.select("building_id", F.lit("PROV-010").alias("code"), F.lit("error").alias("severity"), F.lit("building id repeats").alias("message"), F.col("n").cast("string").alias("observed_value"))
    out = found.unionByName(repeated)
    return out.where(F.col("code").isin(codes)) if codes else out
