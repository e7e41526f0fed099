"""Object, pixel, image and mask tables derived from the given star-schema tables.

Every table is computed by Spark from ``orders`` / ``lineitem`` with integer
arithmetic, so it grows with the input and a SQL engine can rebuild it exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roispark.functions.bits import pack, unpack
from roispark.schema import K, PIXEL_SIZE_X_UM, PIXEL_SIZE_Y_UM

CANVAS = 256
MASK_CANVAS = 64
BAND = 32
GREY_LEVELS = "array(" + ", ".join(
    f"cast(((seg * 32 + {i}) * 131 + y * 17 + (acquisition_id + 1) * (channel + 1) * 29) % 4096 AS int)"
    for i in range(32)) + ") AS pixel_values"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Distinct ``keys`` that are about to become many rows, in a fixed number of partitions: adaptive execution, which
    sees only their present size, would merge them into one task."""
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*keys).repartition(count, *keys).distinct()


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangle-like objects: 3 channels (0 nuclear, 1 and 2 markers) per acquisition."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey div 600 AS acquisition_id",
        "o_orderkey % 3 AS channel",
        "o_orderkey AS object_id",
        "(o_custkey * 37 + o_orderkey * 11) % 240 AS cx",
        "(o_orderkey * 53 + o_custkey * 7) % 240 AS cy",
        "3 + o_orderkey % 7 AS w",
        "3 + o_custkey % 5 AS h",
    )


def roi_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per object pixel; objects of one channel may overlap.

    The objects are dealt before their pixels are made: what is grouped by object moves no pixels and no words.
    """
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        objects(spark, sf_dir)
        .repartition(count, *K, "object_id")
        .selectExpr("*", "explode(sequence(0L, w - 1)) AS i")
        .selectExpr("*", "explode(sequence(0L, h - 1)) AS j")
        .where("(i + j + object_id) % 11 <> 0")
        .selectExpr(*K, "object_id", "cx + i AS x", "cy + j AS y")
    )


def roi_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(roi_pixels(spark, sf_dir), [*K, "object_id"])


def label_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label image without overlaps: the lowest object id wins a pixel.

    The objects are dealt by bands of image rows before their pixels are made: a band holds all that may claim its
    pixels, so no pixel moves, and nearly all pixels of an object lie together.  Who wins is decided on words.
    """
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = [*K, "band"]
    words = pack(
        objects(spark, sf_dir)
        .selectExpr("*", f"explode(array_distinct(transform(sequence(0L, h - 1), j -> (cy + j) div {BAND}))) AS band")
        .repartition(count, *place)
        .selectExpr("*", "explode(sequence(0L, h - 1)) AS j")
        .where(f"(cy + j) div {BAND} = band")
        .selectExpr("*", "explode(sequence(0L, w - 1)) AS i")
        .where("(i + j + object_id) % 11 <> 0")
        .selectExpr(*place, "object_id", "cx + i AS x", "cy + j AS y"), [*place, "object_id"])
    lower = Window.partitionBy(*place, "y", "seg").orderBy("object_id").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.bit_or("bits").over(lower), F.lit(0).cast("long"))
    won = words.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(taken))).where("bits <> 0")
    return unpack(won, [*K, "object_id"]).select(*K, "x", "y", (F.col("object_id") * 97).alias("level"))


def image_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fluorescence images (integer grey levels) as 32-pixel row blocks aligned with the words.

    The places of the blocks are dealt as joins with words need them before their pixels are computed, so that such a
    join moves the images no more.
    """
    places = (
        spread(objects(spark, sf_dir), *K)
        .selectExpr("*", f"explode(sequence(0L, {CANVAS - 1}L)) AS y")
        .selectExpr("*", f"explode(sequence(0L, {CANVAS // 32 - 1}L)) AS seg")
    )
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return places.repartition(count, *K, "y", "seg").selectExpr(*K, "y", "seg", GREY_LEVELS)


def image_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``image_rows`` with the ``band`` of 16 image rows of each block, dealt by acquisition, band and segment before the
    image rows are made, so that neither blocks nor their places move for a join on these."""
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        spread(objects(spark, sf_dir), *K)
        .selectExpr("*", f"explode(sequence(0L, {CANVAS // 16 - 1}L)) AS band")
        .selectExpr("*", f"explode(sequence(0L, {CANVAS // 32 - 1}L)) AS seg")
        .repartition(count, "acquisition_id", "band", "seg")
        .selectExpr("*", "explode(sequence(band * 16, band * 16 + 15)) AS y")
        .selectExpr(*K, "y", "seg", GREY_LEVELS, "band")
    )


def stack_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small Z stack per acquisition and channel in the same block layout.

    Sparse signal, an empty tail plane and zero padding at the right and lower
    edge, so that projection, plane and extent trimming have work to do.
    """
    return (
        spread(objects(spark, sf_dir), *K)
        .selectExpr("*", "explode(sequence(0L, 3L)) AS z")
        .selectExpr("*", f"explode(sequence(0L, {MASK_CANVAS - 1}L)) AS y")
        .selectExpr("*", "explode(sequence(0L, 1L)) AS seg")
        .selectExpr(
            *K, "z", "y", "seg", "array(" + ", ".join(
                f"cast(CASE WHEN z <= 1 + acquisition_id % 3 AND y < {MASK_CANVAS} - acquisition_id % 9 "
                f"AND seg * 32 + {i} < {MASK_CANVAS} - channel * 5 - acquisition_id % 4 "
                f"THEN ((seg * 32 + {i}) * 131 + y * 17 + (z + 1) * 7 "
                "+ (acquisition_id + 1) * (channel + 1) * 29) % 4096 ELSE 0 END AS int)"
                for i in range(32)) + ") AS pixel_values")
    )


def mask_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreground pixels of three masks per acquisition on a 64 x 64 canvas."""
    grid = (
        spread(objects(spark, sf_dir), "acquisition_id")
        .selectExpr("acquisition_id", f"explode(sequence(0L, {MASK_CANVAS - 1}L)) AS y")
        .selectExpr("acquisition_id", "y", f"explode(sequence(0L, {MASK_CANVAS - 1}L)) AS x")
    )
    block = "(x div 8) + 3 * (y div 8) + acquisition_id"
    return grid.selectExpr(
        "acquisition_id", "x", "y",
        "explode(filter(array("
        f"CASE WHEN ({block}) % 5 <> 0 THEN 'organoid' END, "
        f"CASE WHEN ({block}) % 7 <> 0 THEN 'reference' END, "
        "CASE WHEN (x * y + acquisition_id) % 11 = 0 THEN 'cell' END), v -> v IS NOT NULL)) AS kind",
    )


def organoids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organoid measurements: several rows per acquisition, some not usable."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey div 600 AS acquisition_id",
        "1 + o_orderkey % 2 AS image_number",
        "o_orderkey AS object_number",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN -1.0D "
        "ELSE cast(4000 + o_custkey AS double) END AS area_shape_area",
    )


def dense_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible pairs with many ties and contention for the matching operators."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey div 20 AS run_id", "l_partkey % 12 AS object_a", "l_suppkey % 11 AS object_b",
        "25.0D * (1 + l_linenumber % 4) AS score",
    ).groupBy("run_id", "object_a", "object_b").agg(F.max("score").alias("score"))


def field_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-field metric rows with a three-level line, a batch and an enhancer."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS field_id", "l_returnflag AS line",
        "l_suppkey % 3 AS batch", "l_linestatus AS enhancer",
        "l_discount * 1000 AS specificity_percent", "l_extendedprice / 1000 AS density",
    )


def centroids_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # By channel too, as the objects were dealt: the pixels of an object lie together.
    return roi_pixels(spark, sf_dir).where("channel = 1").groupBy(*K, "object_id").agg(
        F.avg("x").alias("x"), F.avg("y").alias("y")).drop("channel")


def centroids_moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed centroids turned by an exact small rotation, then shifted."""
    return centroids_fixed(spark, sf_dir).selectExpr(
        "acquisition_id", "object_id",
        "x * 9999.0D / 10001.0D - y * 200.0D / 10001.0D + 3.5D AS x",
        "x * 200.0D / 10001.0D + y * 9999.0D / 10001.0D - 2.25D AS y",
    )


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tile files per acquisition, with a missing and a doubled tile now and then."""
    acq = objects(spark, sf_dir).select("acquisition_id").distinct()
    tiles = acq.selectExpr(
        "acquisition_id",
        "explode(concat(filter(array(0L, 1L, 2L, 3L), t -> NOT (t = 3 AND acquisition_id % 7 = 0)), "
        "CASE WHEN acquisition_id % 11 = 5 THEN array(1L) ELSE cast(array() AS array<bigint>) END)) AS tile",
    )
    return tiles.selectExpr(
        "concat('Session_', acquisition_id % 4, '/Exp17_', 149 + acquisition_id % 5, '-', "
        "2 + acquisition_id % 2, '_Set', 1 + acquisition_id % 3, '_DAPI_GFP_LHX6_PV_Field_', "
        "acquisition_id, '/Exp17_', 149 + acquisition_id % 5, '-', 2 + acquisition_id % 2, '_Set', "
        "1 + acquisition_id % 3, '_DAPI_GFP_LHX6_PV_Field_', acquisition_id, '_F0', tile, '.ims') AS path",
        "1000 + acquisition_id * 7 + tile AS size",
    )


def pixel_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration is a column per acquisition, never a constant of the job."""
    return objects(spark, sf_dir).select("acquisition_id").distinct().select(
        "acquisition_id", F.lit(PIXEL_SIZE_X_UM).alias("px"), F.lit(PIXEL_SIZE_Y_UM).alias("py"))
