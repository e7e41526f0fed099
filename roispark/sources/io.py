"""Readers and writers (S1-S9): ROI pixels, measurements, centroids, run tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.functions import bits
from roispark.functions.ranking import ranked
from roispark.schema import K, require_columns

# Tables of one run and the candidate centroid columns, in order.
RUN_TABLES = ("object_a_pixels", "object_b_pixels", "overlap", "eligible_pairs", "a_preferences",
              "b_preferences", "matching", "positive_objects", "cell_id_mapping",
              "filtered_object_a_pixels", "filtered_object_b_pixels", "unmatched", "summary",
              "filtering_stage_counts", "nuclear_constraint_audit", "object_a_nuclear_assignments",
              "object_b_nuclear_assignments")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Parquet, CSV (header) or JSON; CSV and JSON need an explicit schema (no inference pass)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError(f"{fmt} input needs an explicit schema")
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def id_column(columns: list[str], label: str = "ROI table") -> str:
    """``roi`` wins over ``cell_id``; decided by column presence, not per row."""
    lowered = {c.lower(): c for c in columns}
    for name in ("roi", "cell_id", "cellid"):
        if name in lowered:
            return lowered[name]
    raise ValueError(f"{label} needs a ROI or CellID column, found {sorted(columns)}")


def finite(c: Column | str) -> Column:
    """Null for null, NaN and infinite values: null alone means missing downstream."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf")), d)


def read_roi_pixels(df: DataFrame, keys: list[str] = K) -> DataFrame:
    """Choose the id column, cast strictly, drop duplicate pixels.

    Extra columns are kept as they are (the first of equal pixels wins; of differing ids the lowest).  A value
    that is not a number fails the job under ANSI mode.  A table of ids alone moves as words.
    """
    ident = id_column(df.columns)
    names = {c.lower(): c for c in df.columns}
    require_columns(df, [*keys, names.get("x", "x"), names.get("y", "y")], "ROI table")
    out = df.select(
        *df.columns, F.col(ident).cast("long").alias("object_id")
    ).withColumn(names["x"], F.col(names["x"]).cast("long")).withColumn(
        names["y"], F.col(names["y"]).cast("long"))
    x, y = names["x"], names["y"]
    ids = [c for c in df.columns if c not in (*keys, x, y)]
    if {c.lower() for c in ids} - {"roi", "cell_id", "cellid"}:
        return out.dropDuplicates([*keys, "object_id", x, y])
    return _distinct_pixels(out, [*keys, "object_id", y], ids, x).select(*out.columns)


def _distinct_pixels(pixels: DataFrame, place: list[str], ids: list[str], x: str) -> DataFrame:
    """One row per ``place`` and ``x``, with the lowest ``ids``.

    Pixels with the same ids combine to words before they move; a word then loses what words with lower ids hold.  A
    missing ``x`` is the first place of a segment without number.
    """
    bit = F.coalesce(F.col(x).bitwiseAND(F.lit(bits.SEGMENT - 1)), F.lit(0)).cast("int")
    words = pixels.groupBy(*place, F.shiftright(x, 5).alias("_seg"), *ids).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    lower = Window.partitionBy(*place, "_seg").orderBy(*ids).rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.bit_or("_bits").over(lower), F.lit(0).cast("long"))
    own = words.withColumn("_held", held).withColumn("_own", F.col("_bits").bitwiseAND(F.bitwise_not("_held"))).where("_own <> 0")
    low, high = bits.lowest(F.col("_own")).cast("int"), bits.highest(F.col("_own")).cast("int")
    spread = own.select(*place, *ids, "_seg", "_own", F.explode_outer(F.sequence(low, high)).alias("_i"))
    return spread.where("getbit(_own, _i) = 1").select(
        *place, *ids, (F.col("_seg") * bits.SEGMENT + F.col("_i")).alias(x))


def read_roi_words(df: DataFrame, keys: list[str] = K) -> DataFrame:
    """S1 straight into bit-row words: the packing itself removes duplicates."""
    return bits.pack(
        df.select(*keys, F.col(id_column(df.columns)).cast("long").alias("object_id"),
                  F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")),
        [*keys, "object_id"])


def read_objects(df: DataFrame, keys: list[str] = K, required: tuple = ("image_number", "object_number"),
                 ) -> DataFrame:
    """Measurements of the image with number 1.

    When an acquisition holds one row only, that row is used whatever its number.
    Row counts are aggregated map-side and joined, never windowed per acquisition.
    """
    require_columns(df, [*keys, *required], "measurement table")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return df.join(counts, keys).where("_rows = 1 OR image_number = 1").drop("_rows")


def centroid_column(columns: list[str], axis: str, override: str | None = None) -> str:
    """Override, then the known names, then a unique ``location_center*_<axis>``."""
    if override:
        if override not in columns:
            raise ValueError(f"column {override!r} not found")
        return override
    lowered = {c.lower(): c for c in columns}
    # Known centroid columns.
    for name in (f"location_center_{axis}", f"areashape_center_{axis}", f"centroid_{axis}",
                 f"center_{axis}", axis):
        if name in lowered:
            return lowered[name]
    hits = [c for k, c in lowered.items() if k.startswith("location_center") and k.endswith(f"_{axis}")]
    if len(hits) != 1:
        raise ValueError(f"no unique {axis} centroid column in {sorted(columns)}")
    return hits[0]


def read_centroids(df: DataFrame, keys: list[str] = K, x: str | None = None,
                   y: str | None = None) -> DataFrame:
    """S3: finite centroids with the acquisition's point count; fewer than 3 is flagged."""
    cx, cy = centroid_column(df.columns, "x", x), centroid_column(df.columns, "y", y)
    pts = df.select(*keys, "object_id", finite(cx).alias("x"), finite(cy).alias("y")).where(
        "x IS NOT NULL AND y IS NOT NULL")
    counts = pts.groupBy(*keys).agg(F.count(F.lit(1)).alias("points"))
    return pts.join(counts, keys).withColumn("enough_points", F.col("points") >= 3)


def organoid_area(df: DataFrame, positive_only: bool, keys: list[str] = ["acquisition_id"]) -> DataFrame:
    """Summed organoid area; positive finite rows only, or every non-null row."""
    area = F.expr("try_cast(area_shape_area AS double)")
    ok = area.isNotNull() & ~F.isnan(area)
    if positive_only:
        ok = ok & (area > 0) & (area < float("inf"))
    return df.where(ok).groupBy(*keys).agg(
        F.sum(area).alias("organoid_area_px"), F.count(F.lit(1)).alias("organoid_count"))


def save_run(tables: dict[str, DataFrame], path: str, partition_by: list[str]) -> None:
    """One Parquet folder per table, partitioned; only the touched partitions are replaced."""
    for name, df in tables.items():
        parts = [c for c in partition_by if c in df.columns]
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(f"{path.rstrip('/')}/{name}"))


def load_run(spark: SparkSession, path: str, names: tuple[str, ...],
             where: Column | str | None = None) -> dict[str, DataFrame]:
    """Read result tables back; ``where`` on partition columns prunes folders."""
    out = {}
    for name in names:
        df = spark.read.parquet(f"{path.rstrip('/')}/{name}")
        out[name] = df.where(where) if where is not None else df
    return out


MANIFEST = "table_name string, rows long, columns string, partition_columns array<string>, metadata string"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def save_bundle(tables: dict[str, DataFrame], path: str, partition_by: list[str], metadata: dict | None = None) -> DataFrame:
    """The tables of a run with a manifest that is written last, so that a run is whole or absent.

    The manifest holds the rows that each write counted on the way, the schema, the partition columns and the run's
    metadata.  Names are those of ``RUN_TABLES``.  What an interrupted run left behind is written over; a committed run
    is refused.  Returns the manifest.
    """
    root = path.rstrip("/")
    unknown = sorted(set(tables) - set(RUN_TABLES))
    if unknown or not tables:
        raise ValueError(f"not tables of a run: {unknown}" if unknown else "a run needs a table")
    spark = next(iter(tables.values())).sparkSession
    if _exists(spark, f"{root}/manifest"):
        raise ValueError(f"{path} holds a committed run")
    entries, text = [], json.dumps(metadata or {}, sort_keys=True)
    for name, df in tables.items():
        parts = [c for c in partition_by if c in df.columns]
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(*parts).parquet(f"{root}/{name}")
        entries.append((name, seen.get.get("rows", 0), df.schema.json(), parts, text))
    staged = f"{root}/_manifest-{uuid.uuid4().hex}"
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.json(staged)
    # The commit: one rename.
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, f"{root}/manifest"))
    if not old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(old, new):
        raise ValueError(f"{path} holds a committed run")
    return spark.read.schema(MANIFEST).json(f"{root}/manifest")


def load_bundle(spark: SparkSession, path: str, names: tuple[str, ...] | None = None,
                where: Column | str | None = None) -> dict[str, DataFrame]:
    """The tables of a committed run with the types they were written with.

    Every table asked for must hold the rows that the manifest names (counted from the Parquet footers); ``where`` on
    partition columns prunes folders.
    """
    root = path.rstrip("/")
    if not _exists(spark, f"{root}/manifest"):
        raise ValueError(f"{path} holds no committed run")
    manifest = {r.table_name: r for r in spark.read.schema(MANIFEST).json(f"{root}/manifest").collect()}
    out = {}
    for name in names or manifest:
        if name not in manifest:
            raise ValueError(f"the run has no table {name}")
        schema = T.StructType.fromJson(json.loads(manifest[name].columns))
        # A table without rows may have no files of its own.
        df = spark.read.schema(schema).parquet(f"{root}/{name}") if _exists(spark, f"{root}/{name}") else (
            spark.createDataFrame([], schema))
        if df.count() != manifest[name].rows:
            raise ValueError(f"table {name} does not hold the {manifest[name].rows} rows of the manifest")
        df = df.select(*schema.names)
        out[name] = df.where(where) if where is not None else df
    return out


def export_gate(tables: dict[str, DataFrame], path: str, keys: list[str] = K) -> None:
    """CSV exports of a gate (pixels, metrics with status, kept, cutoffs, ids)."""
    for name, df in tables.items():
        parts = [k for k in keys if k in df.columns]
        (df.write.mode("overwrite").option("header", True).partitionBy(*parts)
         .csv(f"{path.rstrip('/')}/{name}"))


def nuclear_positive(cells_pixels: DataFrame, nuclear_channel) -> DataFrame:
    """Matched marker pixels of the marker-vs-nucleus runs, input of the pair stage."""
    return cells_pixels.where(F.col("channel_b") == F.lit(nuclear_channel)).withColumnRenamed(
        "channel_a", "channel").drop("channel_b")


def read_blocks(df: DataFrame, vocabulary: dict[str, list[str]], overrides: DataFrame | None = None,
                key: str = "block_id") -> DataFrame:
    """Block metadata with overrides and a fixed-vocabulary check per column.

    Returns the table with ``violations``, an array that is empty for a good row.
    """
    out = df
    if overrides is not None:
        named = overrides.select(key, *[F.col(c).alias(f"_new_{c}") for c in overrides.columns if c != key])
        out = out.join(named, key, "left")
        for c in overrides.columns:
            if c != key:
                out = out.withColumn(c, F.coalesce(f"_new_{c}", c)).drop(f"_new_{c}")
    problems = [
        F.when(~F.coalesce(F.col(c).isin(allowed), F.lit(False)), F.lit(c))
        for c, allowed in sorted(vocabulary.items())]
    return out.withColumn("violations", F.filter(F.array(*problems), lambda v: v.isNotNull()))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Stable row numbers for an export that wants them."""
    return ranked(df, keys, order, name, None)
