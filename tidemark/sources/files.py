"""Reading and writing tables: Parquet, CSV, GeoJSON, and sets of tables published as one."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, *, allow_empty: bool = True) -> DataFrame:
    """A Parquet table, only the named columns; a missing path is an error, as is an empty table if so asked."""
    df = spark.read.parquet(path)
    if columns:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
        df = df.select(*columns)
    if not allow_empty and df.isEmpty():
        raise ValueError(f"{path} is empty")
    return df


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), order_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Rows sorted within files, if asked. Modes: overwrite, append, errorifexists."""
    out = df.sortWithinPartitions(*order_by) if order_by else df
    writer = out.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_table(df: DataFrame, path: str, mode: str = "replace") -> None:
    """Write a table by one of the loaders' modes: replace, append, or fail where the table is there."""
    modes = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
    if mode not in modes:
        raise ValueError(f"mode must be one of {', '.join(modes)}")
    df.write.mode(modes[mode]).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()).exists(at)


def backup(spark: SparkSession, path: str, stamp: str) -> str | None:
    """Copy a table to backups/<its name>_<stamp> beside it before it is overwritten; None where there is no table."""
    if not _exists(spark, path):
        return None
    folder, _, name = path.rstrip("/").rpartition("/")
    target = f"{folder}/backups/{name}_{stamp}"
    spark.read.parquet(path).write.parquet(target)
    return target


def write_csv(df: DataFrame, path: str, *, order_by: Sequence[str] = (), single: bool = False) -> None:
    """CSV with header; `single` puts a table that is known to be small into one file."""
    out = df.coalesce(1) if single else df
    (out.sortWithinPartitions(*order_by) if order_by else out).write.mode("overwrite").option("header", True).csv(path)


def domain_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of an audit CSV whose flag reads true; duplicate ids or coordinates, or no cell at all, are errors."""
    raw = spark.read.option("header", True).csv(path)
    return select_domain(raw)


def select_domain(raw: DataFrame) -> DataFrame:
    from ..operators.validate import ValidationError, amount, require, suite

    kept = raw.filter(F.lower(F.trim("included_in_coastal_domain")) == "true").select(
        "cell_id", F.col("longitude").cast("double").alias("longitude"), F.col("latitude").cast("double").alias("latitude")
    )
    if kept.isEmpty():
        raise ValidationError("no cell is in the coastal domain")
    many = lambda key, name: amount(kept.groupBy(*key).count().filter("count > 1"), name)
    require(suite(many(["cell_id"], "duplicate_cell_id"), many(["longitude", "latitude"], "duplicate_coordinates")))
    return kept.orderBy("cell_id")


def file_date_mismatches(df: DataFrame, name: str = "file_name", time: str = "time") -> DataFrame:
    """Rows whose file name has another date than their content, or none."""
    text = F.regexp_extract(name, r"oisst_(\d{4}-\d{2}-\d{2})\.nc", 1)
    stated = F.when(text != "", text).try_cast("date")
    return df.withColumn("file_date", stated).filter(F.col("file_date").isNull() | (F.col("file_date") != F.to_date(time)))


def write_geojson(df: DataFrame, path: str, ring: str = "ring") -> None:
    """One Feature a line; see `geojson`."""
    geojson(df, ring).write.mode("overwrite").text(path)


def geojson(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Features as text: Polygon or, of several parts, MultiPolygon of `rings` (or of one shell in `ring`); the other columns are properties."""
    from ..operators.spatial import with_rings

    df = with_rings(df, ring)
    parts = F.array_distinct(F.transform("rings", lambda r: r["part"]))
    points = lambda r: F.transform(r["points"], lambda p: F.array(p["x"], p["y"]))
    shape = F.transform(parts, lambda k: F.transform(F.filter("rings", lambda r: r["part"] == k), points))
    properties = F.struct(*[c for c in df.columns if c not in ("rings", ring)])
    feature = lambda kind, at: F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(F.lit(kind).alias("type"), at.alias("coordinates")).alias("geometry")))
    return df.select(F.when(F.size(parts) == 1, feature("Polygon", F.get(shape, 0))).otherwise(feature("MultiPolygon", shape)).alias("value"))


def geojson_points(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Features of points; all columns are properties."""
    shape = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*df.columns).alias("properties"), shape.alias("geometry"))).alias("value"))


def distance_label(km: float) -> str:
    """A distance as part of a file name: 75 or 62p5."""
    return f"{km:g}".replace(".", "p")


def write_land_previews(land: DataFrame, folder: str) -> dict[str, str]:
    """The land of `spatial.split_land`, kept and excluded, as GeoJSON; no file of excluded land where there is none. Returns the paths."""
    paths = {"retained_land_geojson": f"{folder}/retained_mainland_land.geojson"}
    write_geojson(land.filter("exclusion_reason is null").drop("exclusion_reason"), paths["retained_land_geojson"])
    excluded = land.filter("exclusion_reason is not null")
    if not excluded.isEmpty():
        paths["excluded_remote_land_geojson"] = f"{folder}/excluded_remote_islands.geojson"
        write_geojson(excluded, paths["excluded_remote_land_geojson"])
    return paths


def write_domain(cells: DataFrame, folder: str, max_km: float, size: float = 0.25) -> dict[str, str]:
    """The audit of a classified grid as CSV, its centres as points and the included cells as squares. Returns the paths."""
    paths = {
        "audit_csv": f"{folder}/coastal_grid_audit.csv", "all_points_geojson": f"{folder}/all_candidate_grid_centres.geojson",
        "included_cells_geojson": f"{folder}/candidate_coastal_cells_{distance_label(max_km)}km.geojson",
    }
    audit = ["cell_id", "longitude", "latitude", "is_land", "distance_to_land_km", *[c for c in ("oisst_coordinate_exists", "oisst_ocean_cell") if c in cells.columns], "included_in_coastal_domain"]
    write_csv(cells.select(*audit), paths["audit_csv"], order_by=["latitude", "longitude"])
    geojson_points(cells).write.mode("overwrite").text(paths["all_points_geojson"])
    at = lambda x, y: F.struct((F.col("longitude") + x * size / 2).alias("x"), (F.col("latitude") + y * size / 2).alias("y"))
    square = F.array(*[at(x, y) for x, y in ((1, -1), (1, 1), (-1, 1), (-1, -1), (1, -1))])
    write_geojson(cells.filter("included_in_coastal_domain").withColumn("ring", square), paths["included_cells_geojson"])
    return paths


#: Names of longitude and latitude in degrees of WGS84.
WGS84 = ("urn:ogc:def:crs:OGC:1.3:CRS84", "urn:ogc:def:crs:EPSG::4326", "EPSG:4326", "OGC:CRS84")


def read_geojson(spark: SparkSession, path: str, properties: str, *, collection: bool = True, require_crs: bool = False) -> DataFrame:
    """Polygons and MultiPolygons as properties, `ring` (their first shell) and `rings`. `properties` is their schema, such as "region_id int, region_name string".

    A collection is one JSON object; otherwise each line is a Feature. Without a
    stated system the coordinates are WGS84 degrees, or with `require_crs` that
    is an error, as any other system is. A property that no feature has, and
    other geometries, are errors; a null geometry has no rings.
    """
    feature = f"type string, properties struct<{', '.join(p.strip().replace(' ', ':', 1) for p in properties.split(','))}>, geometry struct<type:string,coordinates:string>"
    stated = None
    if collection:
        kind = feature.replace("type string, properties ", "type:string,properties:").replace(", geometry ", ",geometry:")
        df = spark.read.schema(f"crs struct<properties:struct<name:string>>, features array<struct<{kind}>>").option("multiLine", True).json(path)
        stated = df.select("crs.properties.name").first()
        df = df.select(F.explode("features").alias("f")).select("f.*")
    else:
        df = spark.read.schema(feature).json(path)
    name = stated[0] if stated else None
    if name is None and require_crs:
        raise ValueError("the file states no coordinate system")
    if name is not None and name not in WGS84:
        raise ValueError(f"coordinates in {name}; degrees of WGS84 are needed")
    fields = [f.name for f in df.schema["properties"].dataType.fields]
    have = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(f"properties.{f}").alias(f) for f in fields]).first()
    missing = [f for f in fields if have["_n"] and not have[f]]
    if missing:
        raise ValueError(f"no feature has the properties {', '.join(missing)}")
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    many = F.when(kind == "Polygon", F.array(F.from_json(text, "array<array<array<double>>>"))).when(kind == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>"))
    many = many.when(kind.isNull(), F.array().cast("array<array<array<array<double>>>>")).otherwise(F.raise_error(F.concat(F.lit("no polygon: "), kind)).cast("array<array<array<array<double>>>>"))
    point = lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))
    ring = lambda part: lambda r, j: F.struct(part.alias("part"), j.alias("ring"), F.transform(r, point).alias("points"))
    rings = F.flatten(F.transform(many, lambda shape, i: F.transform(shape, ring(i))))
    return df.select("properties.*", rings.alias("rings")).select(*fields, F.get("rings", 0)["points"].alias("ring"), "rings")


def download_manifest(dates: DataFrame, base: str = "https://example.invalid/avhrr/", prefix: str = "oisst-avhrr-v02r01.") -> DataFrame:
    """URL (by month, then day) and file name of each date."""
    url = F.concat(F.lit(base), F.date_format("date", "yyyyMM"), F.lit(f"/{prefix}"), F.date_format("date", "yyyyMMdd"), F.lit(".nc"))
    return dates.select("date", url.alias("url"), F.format_string("oisst_%s.nc", F.date_format("date", "yyyy-MM-dd")).alias("file_name"))


#: Of a table's name and what was observed of earlier tables, the aggregates to observe of it.
Observe = Callable[[str, Mapping[str, Mapping[str, Any]]], Mapping[str, Column]]


class Publication:
    """A set of tables under one root, replaced together.

    Every table is written under a new version first; then one small file, the
    pointer, is renamed into place. Readers go by the pointer, so they see the
    old set or the new one. Old versions stay as backups.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.seen: dict[str, dict[str, Any]] = {}
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def publish(self, tables: Mapping[str, DataFrame], version: str | None = None, *, check: Callable[[dict[str, DataFrame]], None] | None = None, observe: Observe | None = None) -> str:
        """Write all, then switch; a failure before the switch leaves the old set.

        `check` gets the tables as they were written and raises if they may not
        be published: it reads what readers would, and computes nothing anew.
        `observe` is that of `stage`.
        """
        version = version or uuid.uuid4().hex
        staged = self.stage(tables, version, observe)
        if check:
            check(staged)
        self.switch(version, sorted(tables))
        return version

    def stage(self, tables: Mapping[str, DataFrame], version: str, observe: Observe | None = None) -> dict[str, DataFrame]:
        """Write tables under a version that no reader sees yet, and read them back.

        `observe(name, seen)` gives aggregates that the job which writes a table
        computes along; their values go to `self.seen[name]`, which is what it
        gets for the tables written before.
        """
        if not tables:
            raise ValueError("no table to publish")
        for name, df in tables.items():
            wanted = observe(name, self.seen) if observe else {}
            note = Observation()
            out = df.observe(note, *[c.alias(n) for n, c in wanted.items()]) if wanted else df
            out.write.mode("errorifexists").parquet(f"{self.root}/version={version}/{name}")
            if wanted:
                self.seen[name] = dict(note.get)
        return {name: self.spark.read.schema(df.schema).parquet(f"{self.root}/version={version}/{name}") for name, df in tables.items()}

    def switch(self, version: str, names: Sequence[str]) -> None:
        note = json.dumps({"version": version, "tables": list(names)})
        temporary, pointer = self._path(f"{self.root}/.current-{version}"), self._path(f"{self.root}/current.json")
        out = self._fs.create(temporary, True)
        out.write(bytearray(note.encode()))
        out.close()
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext
        files = context.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        files.rename(self._fs.makeQualified(temporary), self._fs.makeQualified(pointer), self._overwrite())

    def _overwrite(self):
        jvm = self.spark.sparkContext._jvm
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        found = self.spark.sparkContext._gateway.new_array(kind, 1)
        found[0] = kind.OVERWRITE
        return found

    def current(self) -> dict:
        """Version and names of the published set; an error if there is none."""
        row = self.spark.read.text(f"{self.root}/current.json").first()
        return json.loads(row["value"])

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/version={self.current()['version']}/{name}")


def publication_plan(final: Mapping[str, DataFrame] | None = None, preliminary: Mapping[str, DataFrame] | None = None, monitoring: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Tables of the chosen groups; none chosen is an error."""
    plan = {**(final or {}), **(preliminary or {}), **(monitoring or {})}
    if not plan:
        raise ValueError("no group of tables is chosen")
    return plan
