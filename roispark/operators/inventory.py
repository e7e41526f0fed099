"""File inventory, provenance and checks as table jobs.

The input is ``file_inventory(path, size, ...)``; the library reads no image files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# File name conventions (Java regex) and ignored names.
TILE_PATTERN = r"(?i)(?:^|[_\s-])F[_\s-]?(\d{1,3})$"
SET_PATTERN = r"(?i)(?:^|[_\s-])Set(\d+)(?=$|[_\s-])"
DERIVED_PATTERN = r"(?i)(?:^|[_\s-])fusionstitcher(?:$|[_\s.-])"
IGNORED_FILES = ["thumbs.db", "desktop.ini", "icon\r"]
OUTPUT_SUFFIXES = ["_ims_to_tiff", "_ims_to_tiff_output"]
EXPECTED_TILES = 4
CALIBRATION_REL, CALIBRATION_ABS = 1e-4, 1e-9


def path_parts(df: DataFrame) -> DataFrame:
    """Name, stem and parent folder of every path."""
    name = F.element_at(F.split("path", "/"), -1)
    return df.select("*", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"),
                     F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))


def exclude_files(df: DataFrame, output_names: list[str] = ()) -> DataFrame:
    """Drop hidden and operating-system files, output folders and derived images."""
    p = path_parts(df)
    folders = F.split("folder", "/")
    skip = F.exists(folders, lambda d: d.startswith(".") | F.lower(d).isin([*output_names, ""])
                    | F.lower(d).endswith(OUTPUT_SUFFIXES[0]) | F.lower(d).endswith(OUTPUT_SUFFIXES[1]))
    bad = (F.col("name").startswith(".") | F.lower("name").isin(IGNORED_FILES)
           | F.regexp_like("stem", F.lit(DERIVED_PATTERN)) | ((F.col("folder") != "") & skip))
    return p.where(~bad)


def tiles(files: DataFrame, expected: int = EXPECTED_TILES, contiguous: bool = True) -> DataFrame:
    """Tile files grouped per acquisition folder with a status.

    A folder holds at most a few distinct tile numbers (three digits), so the
    collected set is bounded by 1000 numbers however many files there are.
    """
    t = files.where(F.lower("name").endswith(".ims")).select(
        "folder", "path", F.nullif(F.regexp_extract("stem", TILE_PATTERN, 1), F.lit("")).cast("long").alias("tile"))
    per_tile = t.groupBy("folder", "tile").agg(F.count(F.lit(1)).alias("_n"))
    g = per_tile.groupBy("folder").agg(
        F.sum("_n").alias("files"), F.count("tile").alias("tiles"), F.min("tile").alias("_lo"),
        F.max("tile").alias("_hi"), F.coalesce(F.sum(F.when(F.col("tile").isNull(), F.col("_n"))), F.lit(0)).alias("_bad"),
        F.count_if((F.col("_n") > 1) & F.col("tile").isNotNull()).alias("_twice"),
        F.sort_array(F.collect_list("tile")).alias("tile_list"))
    # Statuses.
    status = (F.when(F.col("_bad") > 0, F.lit("unnumbered_tile")).when(F.col("_twice") > 0, F.lit("duplicate_tile"))
              .when(F.col("tiles") < expected, F.lit("incomplete"))
              .when(F.col("tiles") > expected, F.lit("too_many_tiles")))
    if contiguous:
        status = status.when(F.col("_hi") - F.col("_lo") != expected - 1, F.lit("noncontiguous"))
    return g.select("folder", "files", "tiles", F.array_join(F.col("tile_list").cast("array<string>"), ",").alias("tile_list"),
                    status.otherwise(F.lit("complete")).alias("status"))


def _before_tile(stem: Column) -> Column:
    return F.regexp_replace(stem, TILE_PATTERN, "")


def channel_names(files: DataFrame, markers: list[str]) -> DataFrame:
    """Biological channels named at the end of a file name, in order.

    The vocabulary is matched from the right, markers of more tokens first.  If the
    name ended in a tile, a ``Field_N`` or a bare number before it is taken off
    first; without a tile nothing is.  The pattern is
    applied to the reversed name with atomic groups, so that a match is never
    taken back.  Nothing found leaves an empty list.
    """
    if len({m.lower() for m in markers}) != len(markers):
        raise ValueError("markers differ only by case")
    ordered = sorted(markers, key=lambda m: (-m.count("_"), m))
    alternatives = "|".join(re.escape(m[::-1]) for m in ordered)
    one = f"(?>(?:{alternatives})(?=_|$))"
    numeric_tail = [m for m in markers if "_" in m and m.rsplit("_", 1)[1].isdigit()]
    base = F.trim(_before_tile(F.col("stem")), F.lit("_"))
    strip = F.when(~F.regexp_like("stem", F.lit(TILE_PATTERN)), base)
    strip = strip.when(F.regexp_like(base, F.lit(r"(?i)_Field_\d+$")), F.regexp_replace(base, r"(?i)_Field_\d+$", ""))
    if numeric_tail:
        keep = "|".join(re.escape(m) for m in numeric_tail)
        strip = strip.when(F.regexp_like(base, F.lit(f"(?i)(?:^|_)(?:{keep})$")), base)
    strip = strip.otherwise(F.regexp_replace(base, r"_\d+$", ""))
    suffix = F.regexp_extract(F.reverse(strip), f"^(?i)((?:{one}_?)+)", 1)
    found = F.regexp_extract_all(suffix, F.lit(f"(?i)({one})"), F.lit(1))
    names = F.create_map(*[F.lit(x) for m in markers for x in (m.lower(), m)])
    return files.select("*", F.reverse(F.transform(found, lambda v: names[F.lower(F.reverse(v))])).alias("channels"))


def acquisition_identity(files: DataFrame, markers: list[str]) -> DataFrame:
    """I4: acquisition number and experimental set of folder and files must agree."""
    numeric_tail = [m for m in markers if "_" in m and m.rsplit("_", 1)[1].isdigit()]
    keep = "|".join(re.escape(m) for m in numeric_tail)

    def number(text):
        value = F.nullif(F.regexp_extract(text, r"(?:^|_)(\d+)$", 1), F.lit("")).cast("long")
        return F.when(F.regexp_like(text, F.lit(f"(?i)(?:^|_)(?:{keep})$")), F.lit(None)).otherwise(value) if keep else value

    def sets(text):
        return F.array_distinct(F.regexp_extract_all(text, F.lit(SET_PATTERN), F.lit(1)))

    folder = F.element_at(F.split("folder", "/"), -1)
    stem = _before_tile(F.col("stem"))
    rows = files.select("folder", number(folder).alias("_fd"), number(stem).alias("_fn"),
                        F.array_union(sets(folder), sets(stem)).alias("_sets"))
    g = rows.groupBy("folder").agg(
        F.max("_fd").alias("acquisition_number"), F.min("_fn").alias("_min"), F.max("_fn").alias("_max"),
        F.count("_fn").alias("_have"), F.count(F.lit(1)).alias("_files"),
        F.max(F.size("_sets")).alias("_several"), F.min(F.get("_sets", F.lit(0)).cast("long")).alias("set_number"),
        F.max(F.get("_sets", F.lit(0)).cast("long")).alias("_set_max"))
    # Statuses.
    status = (
        F.when((F.col("_min") != F.col("_max")) | ((F.col("_have") > 0) & (F.col("_have") < F.col("_files"))),
               F.lit("files_disagree"))
        .when(~F.col("acquisition_number").eqNullSafe(F.col("_min")), F.lit("folder_and_files_disagree"))
        .when((F.col("_several") > 1) | (F.col("set_number") != F.col("_set_max")), F.lit("set_mismatch"))
        .otherwise(F.lit("ok")))
    return g.select("folder", "acquisition_number", "set_number", status.alias("status"))


def metadata_violations(meta: DataFrame, configured: int) -> DataFrame:
    """Every tile must agree with the first tile of its acquisition.

    ``meta``: ``(acquisition_id, tile, indices, names, wavelengths, shape, vx, vy, vz)``.
    """
    cols = ["indices", "names", "wavelengths", "shape", "vx", "vy", "vz"]
    first = meta.groupBy("acquisition_id").agg(F.min_by(F.struct("tile", *cols), "tile").alias("_f"))
    both = meta.join(first, "acquisition_id")

    def differs(c):
        return ~F.col(c).eqNullSafe(F.col(f"_f.{c}"))

    def far(c):
        a, b = F.col(c), F.col(f"_f.{c}")
        return F.abs(a - b) > F.greatest(CALIBRATION_REL * F.greatest(F.abs(a), F.abs(b)), F.lit(CALIBRATION_ABS))

    is_first = F.col("tile") == F.col("_f.tile")
    expected = F.sequence(F.lit(0).cast("long"), (F.size("indices") - 1).cast("long"))
    rules = {
        "indices_not_sequential": is_first & (F.col("indices") != expected),
        "phase_channel": is_first & F.exists("names", lambda n: F.lower(n).contains("phase")),
        "channel_count": is_first & (F.size("indices") != configured),
        "indices_differ": ~is_first & differs("indices"), "names_differ": ~is_first & differs("names"),
        "wavelengths_differ": ~is_first & differs("wavelengths"), "shape_differs": ~is_first & differs("shape"),
        "calibration_differs": ~is_first & (far("vx") | far("vy") | far("vz")),
    }
    found = F.filter(F.array(*[F.when(bad, F.lit(n)) for n, bad in rules.items()]), lambda v: v.isNotNull())
    return both.select("acquisition_id", "tile", F.explode(found).alias("check"))


def stitched_samples(files: DataFrame, pattern: str, channels: list[str]) -> DataFrame:
    """Samples from a file name pattern with groups (sample, channel) and their defects.

    ``files`` may carry ``canvas``; different canvases of one sample are reported.
    """
    canvas = F.col("canvas") if "canvas" in files.columns else F.lit("")
    rows = files.where(F.lower("name").rlike(r"\.tiff?$") & F.regexp_like("name", F.lit(f"^(?:{pattern})$"))).select(
        F.regexp_extract("name", pattern, 1).alias("sample"), F.regexp_extract("name", pattern, 2).alias("channel"),
        canvas.alias("canvas"))
    per = rows.groupBy("sample", "channel").agg(
        F.count(F.lit(1)).alias("_n"), F.min("canvas").alias("_c0"), F.max("canvas").alias("_c1"))
    known = F.col("channel").isin(channels)
    g = per.groupBy("sample").agg(
        F.sum("_n").alias("files"), F.count_if(known).alias("known_channels"),
        *[F.max(F.when(F.col("channel") == c, True).otherwise(False)).alias(f"_has_{i}") for i, c in enumerate(channels)],
        F.count_if(~known).alias("unknown_channels"), F.count_if(F.col("_n") > 1).alias("duplicate_channels"),
        (F.min("_c0") != F.max("_c1")).alias("canvas_mismatch"))
    missing = F.filter(F.array(*[F.when(~F.col(f"_has_{i}"), F.lit(c)) for i, c in enumerate(channels)]),
                       lambda v: v.isNotNull())
    out = g.select("sample", "files", "known_channels", F.array_join(missing, ",").alias("missing_channels"),
                   "unknown_channels", "duplicate_channels", "canvas_mismatch")
    return out.withColumn("valid", (F.col("missing_channels") == "") & (F.col("unknown_channels") == 0)
                          & (F.col("duplicate_channels") == 0) & ~F.col("canvas_mismatch"))


def shared_files(assignment: DataFrame) -> DataFrame:
    """I6 for explicit lists: one file given to more than one channel of a sample."""
    return assignment.groupBy("sample", "path").agg(F.count(F.lit(1)).alias("channels")).where("channels > 1")


def reconcile_plan(found: DataFrame, plan: DataFrame) -> DataFrame:
    """Expected against found complete fields, incomplete fields and tiles per session.

    ``found``: ``(session, status, tiles)`` per acquisition; ``plan``: ``(session,
    complete_fields, incomplete_fields, original_tiles)``.
    """
    complete = F.col("status") == "complete"
    have = found.groupBy("session").agg(
        F.count_if(complete).alias("found_complete"), F.count_if(F.col("status") == "incomplete").alias("found_incomplete"),
        F.count_if(~F.col("status").isin("complete", "incomplete")).alias("found_invalid"),
        F.coalesce(F.sum(F.when(complete, F.col("tiles"))), F.lit(0)).alias("found_tiles"))
    both = plan.withColumn("_p", F.lit(True)).join(have, "session", "full_outer")
    numbers = ["complete_fields", "incomplete_fields", "original_tiles", "found_complete", "found_incomplete",
               "found_invalid", "found_tiles"]
    both = both.select("session", F.coalesce("_p", F.lit(False)).alias("planned"),
                       *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers])
    ok = (F.col("planned") & (F.col("complete_fields") == F.col("found_complete"))
          & (F.col("incomplete_fields") == F.col("found_incomplete")) & (F.col("found_invalid") == 0)
          & (F.col("original_tiles") == F.col("found_tiles")))
    return both.withColumn("passed", ok)


def glob_pattern(glob: str) -> str:
    """A glob as a regular expression: ``*``, ``?``, ``[abc]``, ``[a-c]`` and ``[!abc]``; an open bracket is itself."""
    parts = re.findall(r"\[!?\]?[^\]]*\]|.", glob, re.DOTALL)
    out = []
    for part in parts:
        if len(part) > 1:
            negated = part[1] == "!"
            inside = re.sub(r"([\\\[\]&^])", r"\\\1", part[1 + negated:-1])
            out.append(f"[{'^' if negated else ''}{inside}]")
        else:
            out.append({"*": ".*", "?": "."}.get(part) or re.escape(part))
    return "".join(out)


def select_fields(fields: DataFrame, sessions: list[str] | None = None, name_glob: str | None = None,
                  indices: list[int] | None = None, contains: str | None = None,
                  first: int | None = None) -> DataFrame:
    """I8: filters by session, case-folded name glob, index, literal substring, first n."""
    out = fields
    if sessions:
        out = out.where(F.col("session").isin(sessions))
    if name_glob:
        out = out.where(F.regexp_like(F.lower("name"), F.lit(f"^{glob_pattern(name_glob.lower())}$")))
    if indices is not None:
        out = out.where(F.col("index").isin(indices))
    if contains:
        out = out.where(F.contains("name", F.lit(contains)))
    if first is not None:
        out = out.orderBy("index").limit(first)
    return out


def group_totals(fields: DataFrame, by: str) -> DataFrame:
    return fields.groupBy(by).agg(F.count(F.lit(1)).alias("fields"))


def fingerprints(files: DataFrame, keys: list[str], fields: list[str], config: str = "") -> DataFrame:
    """SHA-256 over the sorted file entries of a group and the configuration.

    Built in two levels (digests of 256 sub-groups, then one digest), so that a
    group with very many files is not collected into one row.
    """
    entry = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in fields]), 256)
    level1 = files.select(*keys, entry.alias("_d")).groupBy(*keys, F.substring("_d", 1, 2).alias("_b")).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list("_d")), ""), 256).alias("_d"),
        F.count(F.lit(1)).alias("_n"))
    return level1.groupBy(*keys).agg(
        F.sum("_n").alias("files"),
        F.sha2(F.concat(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_d"))),
                                                 lambda s: s["_d"]), ""), F.lit(config)), 256).alias("fingerprint"))


def pending(current: DataFrame, completed: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose fingerprint has no completed run yet."""
    return current.join(completed.select(*keys, "fingerprint"), [*keys, "fingerprint"], "left_anti")


def duplicates(name: str, df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, as ``(check, key, rows)``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(
        F.lit(name).alias("check"), F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key"), "rows")


def not_one_to_one(name: str, left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that break a one-to-one join of two tables."""
    return duplicates(f"{name}:left", left, key).unionByName(duplicates(f"{name}:right", right, key))


def channel_pairs(panel: DataFrame, nuclear) -> DataFrame:
    """All unordered marker pairs of each acquisition's panel, the nucleus excluded.

    A panel has a handful of channels, so the self-join per acquisition stays small.
    """
    m = panel.select("acquisition_id", "channel").where(F.col("channel") != F.lit(nuclear)).distinct()
    a, b = m.withColumnRenamed("channel", "channel_a"), m.withColumnRenamed("channel", "channel_b")
    return a.join(b, "acquisition_id").where("channel_a < channel_b")
