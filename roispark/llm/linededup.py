"""Exact repeated text units across documents (operator 6).

Units are lines; a line of several sentences is cut after each.  Units are compared by their normalised words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import text_of
from roispark.llm.text import ALNUM, Slice, mix, slices
from roispark.session import materialize

# A unit of fewer words counts together with the unit before it.
LEAST_WORDS = 5
_U = np.uint64
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True

UNIT_FIELDS = "doc_id long, copy long, unit int, start int, end int, words int, d1 long, d2 long"
_NAMES = [f.split()[0] for f in UNIT_FIELDS.split(", ")]
_KINDS = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.int64()]
_BASES = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)]


def unit_bounds(part: Slice) -> np.ndarray:
    """Byte places where a unit begins: after a line feed, after a sentence end with white space, at each text."""
    data, n = part.data, len(part.data)
    begin = np.zeros(n + 1, bool)
    begin[part.offsets] = True
    begin[1:] |= data == 10
    begin[2:] |= _ENDS[data[:-1]] & _SPACES[data[1:]]
    return np.flatnonzero(begin[:n])


def _digests(word: np.ndarray, first: np.ndarray, last: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of the words ``first`` to ``last`` in order, for each unit."""
    inverse = _U(pow(int(base), -1, 1 << 64))
    ones = np.ones(len(word) + 1, np.uint64)
    power, back = ones * base, ones * inverse
    power[0] = back[0] = _U(1)
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    total = np.concatenate([[_U(0)], np.cumsum(mix(word ^ base) * power[:-1])])
    return mix((total[last] - total[first]) * back[first] + (last - first).astype(np.uint64))


def units_of(part: Slice) -> dict[str, np.ndarray]:
    """The units of a slice that have words and can be compared: row, number, bounds in code points, words, digests."""
    begin = unit_bounds(part)
    end = np.append(begin[1:], len(part.data))
    first = np.searchsorted(part.begin, begin)
    last = np.append(first[1:], len(part.word))
    some = last > first
    begin, end, first, last = begin[some], end[some], first[some], last[some]
    row = np.searchsorted(part.offsets, begin, "right") - 1
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    short = last - first < LEAST_WORDS
    digests = []
    for base in _BASES:
        own = _digests(part.word, first, last, base)
        # A short unit's digest takes in the words of the unit before it.
        digests.append(np.where(short, mix(own + np.concatenate([[_U(0)], own[:-1]]) * base), own))
    point = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    start = point[part.offsets[row]]
    number = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    keep = ~(short & new)
    out = {"row": row, "unit": number, "start": point[begin] - start, "end": point[end] - start, "words": last - first,
           "d1": digests[0].view(np.int64), "d2": digests[1].view(np.int64)}
    return {k: v[keep] for k, v in out.items()}


def _source(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))


def units(docs: DataFrame) -> DataFrame:
    """Every comparable unit of ``docs(doc_id, copy, text)``; ``copy`` tells texts with equal doc_id apart."""

    def run(batches):
        for batch in batches:
            ids, copies = batch.column("doc_id"), batch.column("copy")
            for part in slices(text_of(batch), ALNUM):
                if len(part.word):
                    found = units_of(part)
                    at = pa.array(found.pop("row") + part.rows.start)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), copies.take(at), *(pa.array(v, t) for v, t in zip(found.values(), _KINDS[2:]))], _NAMES)

    return docs.mapInArrow(run, UNIT_FIELDS)


def repeated_units(docs: DataFrame) -> DataFrame:
    """``(doc_id, copy, start, end, words)`` of every unit of ``docs(doc_id, text)`` that an earlier place holds.

    Earliest is the smallest doc_id (none last), then the copy, then the place in the text.
    """
    rank = F.coalesce("doc_id", F.lit(2**63 - 1))
    found = units(_source(docs)).withColumn("_rank", rank)
    # Counts and first places combine before they move, so a very common unit costs its tasks one row each.
    busy = found.groupBy("d1", "d2").agg(F.count("*").alias("_n"), F.min("_rank").alias("_first")).where("_n > 1")
    again = materialize(found.join(busy.select("d1", "d2", "_first"), ["d1", "d2"]))
    within = again.where("_rank = _first").groupBy("d1", "d2").agg(F.min(F.struct("copy", "unit")).alias("_place"))
    same = again.where("_rank = _first").join(within, ["d1", "d2"]).where(F.struct("copy", "unit") != F.col("_place"))
    columns = ["doc_id", "copy", "start", "end", "words"]
    return again.where("_rank > _first").select(*columns).unionByName(same.select(*columns))


REMOVED = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def dedup_units(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, removed, removed_words)`` for every row of ``docs(doc_id, text)``.

    ``text`` is what stays when every unit that an earlier place holds is gone; ``removed`` are the places of
    what went in the original text (start and end in code points, end exclusive).

    Defined cases: null and empty texts stay as they are with nothing removed; rows that repeat doc_id and text
    are one document and fare alike; documents without doc_id come last; an empty table gives no rows; other
    columns are ignored.
    """
    gone = repeated_units(docs).distinct().groupBy(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_rank"), "copy").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"), F.sum("words").alias("removed_words"))
    rows = _source(docs).withColumn("_rank", F.coalesce("doc_id", F.lit(2**63 - 1))).join(gone, ["_rank", "copy"], "left")
    return _cut(rows).select(
        "doc_id", "text", F.coalesce("removed", F.array().cast(REMOVED)).alias("removed"),
        F.coalesce("removed_words", F.lit(0)).cast("long").alias("removed_words"))


def _cut(rows: DataFrame) -> DataFrame:
    """``rows(text, removed)`` with the removed places left out of the text; stays in the JVM."""
    ends = F.transform("removed", lambda s: s["end"])
    starts = F.transform("removed", lambda s: s["start"])
    left = F.concat(F.array(F.lit(0)), ends)
    right = F.concat(starts, F.array(F.length("text")))
    kept = F.zip_with(left, right, lambda a, b: F.substring(F.col("text"), a + 1, b - a))
    return rows.withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "")))
