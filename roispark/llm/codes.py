"""Product codes of integer vectors, trained exactly with adaptive distance bounds (operator 13).

Each vector is cut into equal parts with a codebook of their own (k-means on integers, ties to the lower index).
Drake and Hamerly's bounds spare most distances: for each part a row keeps its ``b`` closest entries with ordered lower
bounds and one outer bound for all other entries.  Bounds are floating-point and always rounded to the safe side;
whatever they leave uncertain is decided by exact integer distances.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.session import discard, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Entries with a bound of their own: at first, and at least.
TRACKED, LEAST_TRACKED = 16, 4
# Share of the parts for which the next round may have to look at all entries.
FULL_SHARE = 0.005
# Integers stay below this, so that squares, their sums and the sums of all rows fit into 64 bits.
LIMIT = 1 << 27
# Rows that are compared with all entries at a time.
_ROWS = 4096


def _down(x: np.ndarray) -> np.ndarray:
    """As 32-bit floats that are not greater; what may be below zero says nothing and is kept as it is."""
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y).astype(np.float32)


def _up(x: np.ndarray) -> np.ndarray:
    return -_down(-x)


def _root(d: np.ndarray, side: float) -> np.ndarray:
    """Square roots of integer distances, rounded outwards to ``side``."""
    return np.nextafter(np.sqrt(d.astype(np.float64)), side)


@dataclass
class Bounds:
    """Of one part of some rows: the entries looked at first (the assigned one leads), the upper bound of its distance,
    lower bounds of the other tracked ones, and the outer bound of all the rest."""

    near: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    outer: np.ndarray


def squared(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """All squared distances, exact: in floating point where every sum stays below 2^53, else in 64-bit integers."""
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * largest * largest * rows.shape[1] < 1 << 53:
        x, c = rows.astype(np.float64), entries.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    out = np.zeros((len(rows), len(entries)), np.int64)
    for j in range(rows.shape[1]):
        out += (rows[:, j, None] - entries[None, :, j]) ** 2
    return out


def compare_all(rows: np.ndarray, entries: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """Bounds and exact distance of the nearest entry from the distances to all entries."""
    d = squared(rows, entries)
    k = len(entries)
    b = min(b, k)
    # Distance first, then index: both fit into one sort of the distances with a stable order.
    order = np.argsort(d, axis=1, kind="stable")[:, :b + 1]
    sorted_ = np.take_along_axis(d, order, 1)
    outer = _root(sorted_[:, b], -np.inf) if k > b else np.full(len(rows), np.inf)
    lower = _root(sorted_[:, 1:b], -np.inf)
    return Bounds(order[:, :b].astype(np.uint8), _root(sorted_[:, 0], np.inf), lower, outer), sorted_[:, 0]


def reassign(rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, old: Bounds, b: int) -> tuple[Bounds, np.ndarray]:
    """The bounds after the entries have moved by at most ``moved``, and how many tracked entries each row needed.

    0: the bounds alone were enough; z: z tracked entries were compared exactly; more than ``b``: all entries were.
    """
    n = len(rows)
    near, upper = old.near.copy(), np.nextafter(old.upper + moved[old.near[:, 0]], np.inf)
    lower = np.nextafter(old.lower - moved[old.near[:, 1:]], -np.inf)
    outer = np.nextafter(old.outer - moved.max(initial=0.0), -np.inf)
    # Fewer tracked entries than before: the outer bound covers those that leave.
    b = min(b, near.shape[1])
    outer = np.minimum(outer, lower[:, b - 1:].min(axis=1, initial=np.inf))
    near, lower = near[:, :b], lower[:, :b - 1]
    # Ordered: each bound also holds for all entries behind it.
    ordered = np.minimum.accumulate(np.concatenate([lower, outer[:, None]], 1)[:, ::-1], 1)[:, ::-1]
    need = np.zeros(n, np.int64)
    unsure = np.flatnonzero(upper >= ordered[:, 0])

    def exact(at: np.ndarray, column: int) -> np.ndarray:
        return ((rows[at] - entries[near[at, column]]) ** 2).sum(1)

    if len(unsure):
        first = exact(unsure, 0)
        upper[unsure] = _root(first, np.inf)
        need[unsure] = 1
        still = upper[unsure] >= ordered[unsure, 0]
        unsure, first = unsure[still], first[still]
    if len(unsure):
        # The bounds are ordered, so the entries that may be as near are a prefix.
        z = 1 + (upper[unsure, None] >= ordered[unsure]).sum(1)
        need[unsure] = z
        far = z > b
        full, part, first, z = unsure[far], unsure[~far], first[~far], z[~far]
        distance = np.full((len(part), b), np.iinfo(np.int64).max)
        distance[:, 0] = first
        for j in range(1, b):
            some = np.flatnonzero(z > j)
            if not len(some):
                break
            distance[some, j] = exact(part[some], j)
        if len(part):
            # Compared entries are put in order, the others keep their place and bounds behind them.
            rank = np.where(np.arange(b) < z[:, None], near[part].astype(np.int64), ENTRIES + np.arange(b))
            order = np.lexsort((rank, distance), axis=1)
            near[part] = np.take_along_axis(near[part], order, 1)
            distance = np.take_along_axis(distance, order, 1)
            known = np.arange(1, b) < z[:, None]
            upper[part] = _root(distance[:, 0], np.inf)
            lower[part] = np.where(known, _root(distance[:, 1:], -np.inf), lower[part])
        if len(full):
            for o in range(0, len(full), _ROWS):
                at = full[o:o + _ROWS]
                new, _ = compare_all(rows[at], entries, b)
                near[at], upper[at], lower[at], outer[at] = new.near, new.upper, new.lower, new.outer
    return Bounds(near, upper, lower, outer), need


def is_whole(vector: Column) -> Column:
    """Whether no component is null or not finite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


_STATE = [
    T.StructField("q", T.BinaryType()), T.StructField("near", T.BinaryType()), T.StructField("bounds", T.BinaryType()),
    T.StructField("entry", T.IntegerType()), T.StructField("total", T.ArrayType(T.LongType())),
    T.StructField("need", T.ArrayType(T.LongType()))]
_NAMES = ["row", *[f.name for f in _STATE]]


def _binary(a: np.ndarray) -> pa.Array:
    """One binary value per row."""
    a = np.ascontiguousarray(a)
    width = a.nbytes // max(len(a), 1)
    offsets = np.arange(len(a) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(offsets), pa.py_buffer(a)])


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """The equal-sized binary values of a column as rows."""
    if not len(column):
        return np.zeros((0, 0), dtype)
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data.view(np.uint8).reshape(len(column), -1).view(dtype)


def _quantised(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    q = np.floor(values * SCALE)
    if len(q) and np.abs(q).max() >= LIMIT:
        raise ValueError(f"a component is outside of the supported range of {LIMIT // SCALE}")
    return q.astype(np.int64)


def _packed(row: pa.Array, q: np.ndarray, parts: list[Bounds]) -> pa.RecordBatch:
    n = len(q)
    near = np.stack([p.near for p in parts], 1)
    bounds = np.stack([np.concatenate([_up(p.upper)[:, None], _down(p.lower), _down(p.outer)[:, None]], 1) for p in parts], 1)
    nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(
        [row, _binary(q.astype(np.int32)), _binary(near), _binary(bounds.astype(np.float32)), *nothing], _NAMES)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, list[Bounds]]:
    q = _matrix(batch.column("q"), np.int32).astype(np.int64)
    near = _matrix(batch.column("near"), np.uint8).reshape(len(q), PARTS, -1)
    bounds = _matrix(batch.column("bounds"), np.float32).astype(np.float64).reshape(len(q), PARTS, -1)
    return q, [Bounds(near[:, p], bounds[:, p, 0], bounds[:, p, 1:-1], bounds[:, p, -1]) for p in range(PARTS)]


def _round(source: DataFrame, books: np.ndarray, moved: np.ndarray | None, b: int) -> DataFrame:
    """One assignment of all rows: their new state, and per task the sums of each entry's parts and the needs."""
    _, k, size = books.shape

    def run(batches):
        sums, counts = np.zeros((PARTS * k, size), np.int64), np.zeros(PARTS * k, np.int64)
        needs = np.zeros(b + 2, np.int64)
        kind = None
        for batch in batches:
            kind = batch.column("row").type
            for o in range(0, batch.num_rows, _ROWS):
                cut = batch.slice(o, _ROWS)
                if moved is None:
                    q = _quantised(cut.column("embedding"), PARTS * size)
                    old = [None] * PARTS
                else:
                    q, old = _unpacked(cut)
                parts = []
                for p in range(PARTS):
                    own = q[:, p * size:(p + 1) * size]
                    if old[p] is None:
                        state, _ = compare_all(own, books[p], b)
                    else:
                        state, need = reassign(own, books[p], moved[p], old[p], b)
                        needs += np.bincount(np.minimum(need, b + 1), minlength=b + 2)
                    parts.append(state)
                    entry = p * k + state.near[:, 0].astype(np.int64)
                    np.add.at(sums, entry, own)
                    counts += np.bincount(entry, minlength=PARTS * k)
                yield _packed(cut.column("row"), q, parts)
        if kind is None:
            return
        used = np.flatnonzero(counts)
        rows = len(used) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(rows, kind), *[pa.nulls(rows, pa.binary())] * 3,
             pa.array([*used, None], pa.int32()),
             pa.array([*np.concatenate([sums[used], counts[used, None]], 1).tolist(), None], pa.list_(pa.int64())),
             pa.array([*[None] * len(used), needs.tolist()], pa.list_(pa.int64()))], _NAMES)

    return source.mapInArrow(run, T.StructType([T.StructField("row", source.schema["row"].dataType), *_STATE]))


def _totals(state: DataFrame, name: str) -> DataFrame:
    """Sums over all tasks, position by position."""
    return state.where(F.col(name).isNotNull()).select("entry", F.posexplode(name).alias("at", "value")).groupBy(
        "entry", "at").agg(F.sum("value").alias("value"))


def _moved_books(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next codebooks (floor of the mean, unused entries stay) and how far each entry moved, rounded up."""
    parts, k, size = books.shape
    sums, new = np.zeros((parts * k, size + 1), np.int64), books.copy().reshape(parts * k, size)
    for r in _totals(state, "total").collect():
        sums[r["entry"], r["at"]] = r["value"]
    used = sums[:, size] > 0
    # Floor division goes down for negative sums too.
    new[used] = sums[used, :size] // sums[used, size:]
    new = new.reshape(books.shape)
    return new, np.where((new == books).all(2), 0.0, _root(((new - books) ** 2).sum(2), np.inf))


def next_tracked(needs: np.ndarray, b: int) -> int:
    """The fewest tracked entries that spare all but ``FULL_SHARE`` of the parts the comparison with all entries."""
    beyond = needs.sum() - np.cumsum(needs)
    fits = np.flatnonzero(beyond[:b + 1] <= FULL_SHARE * needs.sum())
    return int(min(b, max(LEAST_TRACKED, fits[0] if len(fits) else b)))


def compress(vectors: DataFrame, column: str = "embedding", keep: list[str] = [], rounds: int = ROUNDS,
             tracked: int = TRACKED) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, code, error)`` and the columns of ``keep`` of every row that takes part, and the codebooks
    ``[part, entry, position]``.

    ``code`` holds one byte per part.  Only codebooks (a fixed number of integers), their sums and counts of needed
    entries come to the driver; rows stay in their partitions, and each round's state is written once.

    Defined cases: rows whose vector is null, empty, holds null or non-finite components, or has another length than
    the kept row with the smallest vec_id (one that the parts divide) are left out; a null vec_id comes after all
    others; repeated rows are rows of their own; fewer rows than entries give a smaller codebook; an empty table gives
    no rows; an integer component of 2^27 or more raises ``ValueError``; other columns are ignored.
    """
    spark = vectors.sparkSession
    row = F.struct(F.col("vec_id").cast("long").alias("vec_id"), *keep)
    whole = vectors.select(row.alias("row"), F.col(column).cast("array<double>").alias("embedding")).where(
        is_whole(F.col("embedding")) & (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0))
    order = [F.asc_nulls_last("row.vec_id"), F.col("embedding")]
    first = whole.orderBy(*order).limit(1).select(F.size("embedding").alias("n")).first()
    if first is None:
        return whole.select("row.*", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((PARTS, 0, 0), np.int64)
    width = first["n"]
    whole = whole.where(F.size("embedding") == width)
    seeds = pa.array([r["embedding"] for r in whole.orderBy(*order).limit(ENTRIES).collect()], pa.list_(pa.float64()))
    size = width // PARTS
    books = np.ascontiguousarray(_quantised(seeds, width).reshape(-1, PARTS, size).transpose(1, 0, 2))
    state = materialize(_round(whole, books, None, tracked))
    b = min(tracked, books.shape[1])
    for _ in range(rounds - 1):
        books, moved = _moved_books(state, books)
        new = materialize(_round(state.where(F.col("q").isNotNull()), books, moved, b))
        needs = np.zeros(b + 2, np.int64)
        for r in _totals(new, "need").collect():
            needs[r["at"]] = r["value"]
        discard(state)
        state, b = new, next_tracked(needs, b)
    books, moved = _moved_books(state, books)

    def final(batches):
        for batch in batches:
            for o in range(0, batch.num_rows, _ROWS):
                cut = batch.slice(o, _ROWS)
                q, old = _unpacked(cut)
                code, error = np.zeros((len(q), PARTS), np.uint8), np.zeros(len(q), np.int64)
                for p in range(PARTS):
                    own = q[:, p * size:(p + 1) * size]
                    now, _ = reassign(own, books[p], moved[p], old[p], b)
                    code[:, p] = now.near[:, 0]
                    error += ((own - books[p][code[:, p]]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([cut.column("row"), _binary(code), pa.array(error)], ["row", "code", "error"])

    last = state.where(F.col("q").isNotNull()).select("row", "q", "near", "bounds")
    out = last.mapInArrow(final, T.StructType([
        state.schema["row"], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]))
    return out.select("row.*", "code", "error"), books


def with_group_error(coded: DataFrame, group: str) -> DataFrame:
    """``group_error``: the errors of all rows with an equal ``group`` added up, nulls together."""
    coded = materialize(coded)
    sums = materialize(coded.groupBy(group).agg(F.sum("error").alias("group_error")).withColumnRenamed(group, "_group"))
    return coded.join(sums, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
