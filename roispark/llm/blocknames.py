"""Exact duplicates by deterministic block naming (operator 11), in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roispark.session import discard, materialize

# Characters of a block.
BLOCK = 8192
# Stands for the missing right half of an odd pair; no name has this value.
_NONE = -(1 << 63)


def normalised(text: str | Column = "text") -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(column.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Sorted distinct keys with an integer name each, written so that names stay what they are."""
    return materialize(distinct.sortWithinPartitions(*order).select(*order, F.monotonically_increasing_id().alias("name")))


def _block_names(blocks: DataFrame) -> DataFrame:
    """``blocks(row, doc_id, sha, n, pos)`` with ``name``: equal for two blocks exactly if their texts are equal.

    Texts move once, to be told apart; the names go back by a 64-bit hash of the block.  A hash with more than one
    text is found by counting and its blocks are named by the texts themselves (negative names).
    """
    keep = ["row", "doc_id", "sha", "n", "pos"]
    distinct = blocks.select("hash", "block").distinct()
    names = materialize(distinct.sortWithinPartitions("hash", "block").select(
        "hash", F.monotonically_increasing_id().alias("name")))
    per_hash = names.groupBy("hash").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("_texts"))
    lone = per_hash.where("_texts = 1").drop("_texts")
    shared = materialize(per_hash.where("_texts > 1").select("hash"))
    by_text = blocks.join(shared, "hash")
    text_names = _numbered(by_text.select("hash", "block").distinct(), ["hash", "block"])
    return blocks.drop("block").join(lone, "hash").select(*keep, "name").unionByName(
        by_text.join(text_names, ["hash", "block"]).select(*keep, (-1 - F.col("name")).alias("name")))


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(row, doc_id, sha, level, name)``: two rows have the same ``(level, name)`` exactly if their texts are equal.

    The normalised text is cut into blocks of ``block`` characters; distinct blocks are sorted and numbered.  Then
    adjacent names are paired, distinct pairs are numbered, and so on until one name is left: as many rounds as the
    longest text's number of blocks has bits, each over half as many rows, and only over rows that are not done.
    ``sha`` is the SHA-256 of the normalised text; it decides nothing.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("_text"),
                       F.monotonically_increasing_id().alias("row"))
    # One pass cuts the whole text; substrings by position would start over for every block.
    parts = F.when(F.col("_text") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("_text", F.lit(rf"(?s).{{1,{block}}}"), F.lit(0)))
    cut = text.select("row", "doc_id", F.sha2("_text", 256).alias("sha"), parts.alias("_parts"))
    blocks = materialize(cut.select("row", "doc_id", "sha", F.size("_parts").alias("n"), F.posexplode("_parts").alias("pos", "block"))
                         .withColumn("hash", F.xxhash64("block")))
    current = materialize(_block_names(blocks))
    discard(blocks)
    done, level = [], 0
    columns = ["row", "doc_id", "sha", F.lit(0).alias("level"), "name"]
    done.append(current.where("n = 1").select(*columns))
    longest = current.agg(F.max("n")).first()[0] or 0
    current = current.where("n > 1")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        odd = F.col("pos") % 2 == 1
        half = F.shiftright("pos", 1).alias("pos")
        pairs = materialize(current.groupBy("row", "doc_id", "sha", F.shiftright(F.col("n") + 1, 1).alias("n"), half).agg(
            F.max(F.when(~odd, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(_NONE)).alias("right")))
        names = _numbered(pairs.select("left", "right").distinct(), ["left", "right"])
        current = pairs.join(names, ["left", "right"]).drop("left", "right")
        done.append(current.where("n = 1").select("row", "doc_id", "sha", F.lit(level).alias("level"), "name"))
        current = current.where("n > 1")
    return reduce(DataFrame.unionByName, done)


def exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs(doc_id, text)``.

    Of equal normalised texts the row with the smallest doc_id stays.  Members are counted by partial sums and joined
    by their identity, so a group of any size is spread over tasks by the adaptive skew join; nothing is collected.

    Defined cases: null and white-space texts compare as they are normalised (null as empty); a null doc_id comes after
    all others, and a group of only such rows has a null keep_id; of rows with the same doc_id in a group exactly one
    stays; an empty table gives no rows; other columns are ignored.
    """
    named = materialize(identities(docs, block))
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    groups = materialize(named.groupBy("level", "name").agg(F.min(first).alias("_first"), F.count(F.lit(1)).alias("group_size")))
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("_first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("_first.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` whose doc_id stays, with all columns.

    Defined cases: as in ``exact_duplicates``; doc_id must tell rows apart, rows without one are left as they are.
    """
    gone = exact_duplicates(docs, block).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
