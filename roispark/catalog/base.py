"""Shared inputs of the registered queries and the result normalisation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.functions import bits
from roispark.operators import matching, metrics, overlap
from roispark.schema import K
from roispark.session import collecting, settled
from roispark.sources import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
PAIRS = [(1, 0), (2, 0), (1, 2)]
THRESHOLD = 0.25

_MEMO: dict[tuple, DataFrame] = {}


def shared_table(name: str):
    """An intermediate that several queries read is written once per session and input; what was written on the way
    is deleted, but for other such tables, which outlive whoever asked for them first."""
    def wrap(build):
        def get(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _MEMO:
                with collecting([]):
                    _MEMO[key] = settled(lambda: build(spark, sf_dir))
            return _MEMO[key]
        return get
    return wrap


def forget() -> None:
    """Drop the shared intermediates (used by the benchmark before each timing)."""
    _MEMO.clear()


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Longs, doubles rounded for comparison across engines, everything else as is."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), special.get(f.name, digits)) + F.lit(0.0)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, digits: int = 6, **special: int):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir), digits, **special)
        run.__name__ = name
        QUERIES[name] = run
        return fn
    return wrap


@shared_table("words")
def words(spark, sf_dir):
    return fixtures.roi_words(spark, sf_dir)


def images(spark, sf_dir):
    return fixtures.image_bands(spark, sf_dir)


@shared_table("areas")
def areas(spark, sf_dir):
    return metrics.object_areas(words(spark, sf_dir))


@shared_table("sizes")
def sizes(spark, sf_dir):
    return fixtures.pixel_sizes(spark, sf_dir)


@shared_table("metrics")
def roi_metrics(spark, sf_dir):
    return metrics.roi_metrics(words(spark, sf_dir), images(spark, sf_dir), sizes(spark, sf_dir))


@shared_table("shared_words")
def shared_words(spark, sf_dir):
    return overlap.shared_words(words(spark, sf_dir), PAIRS)


@shared_table("overlap")
def pair_overlap(spark, sf_dir):
    counts = overlap.overlap_counts(words(spark, sf_dir), PAIRS, areas(spark, sf_dir), shared_words(spark, sf_dir))
    return overlap.mark_eligible(counts, THRESHOLD)


@shared_table("matches")
def matches(spark, sf_dir):
    return matching.stable_matching(pair_overlap(spark, sf_dir).where("eligible"))


@shared_table("cells")
def cells(spark, sf_dir):
    return matching.cell_ids(matches(spark, sf_dir))


@shared_table("mask_words")
def mask_words(spark, sf_dir):
    return bits.pack(fixtures.mask_pixels(spark, sf_dir), ["acquisition_id", "kind"])


def channel_union(spark, sf_dir):
    return bits.merge(words(spark, sf_dir), K)
