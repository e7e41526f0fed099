"""Approximate nearest neighbours with a forest of random-projection trees (operator 5)."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roispark.session import materialize

NEIGHBOURS = 5
TREES = 16
# Rows, at most, that the trees' planes are chosen on; every row is indexed.
SAMPLE_ROWS = 10_000
# Sample rows in a leaf, at most.
LEAF = 48
# Leaves of all trees together that a query looks into.
PROBES = 200
# Rows of a leaf that are compared in one block.
BLOCK = 4096
# Difference of two computed cosines below which they may be equal.
ROUNDING = 1e-12
SEED = 11


@dataclass
class Tree:
    """Planes in breadth of creation; a child is a node (>= 0) or a leaf (-1 - leaf number)."""

    normal: np.ndarray
    offset: np.ndarray
    child: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.normal) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = (np.einsum("ij,ij->i", x[inner], self.normal[node]) >= self.offset[node]).astype(int)
            at[inner] = self.child[node, side]
        return -1 - at


def grow(x: np.ndarray, rng: np.random.Generator) -> Tree:
    """Each plane lies half-way between two random rows of its node; unsplittable nodes become leaves."""
    normal, offset, child, leaves = [], [], [], 0
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(x)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) > LEAF:
            for _ in range(4):
                a, b = x[rng.choice(rows, 2, replace=False)]
                plane = a - b
                value = x[rows] @ plane
                middle = np.median(value)
                right = value >= middle
                if right.any() and not right.all():
                    split = plane, middle, right
                    break
        if split is None:
            if parent >= 0:
                child[parent][side] = -1 - leaves
            leaves += 1
            continue
        if parent >= 0:
            child[parent][side] = len(normal)
        norm = np.linalg.norm(split[0])
        normal.append(split[0] / norm)
        offset.append(split[1] / norm)
        child.append([0, 0])
        todo += [(rows[~split[2]], len(normal) - 1, 0), (rows[split[2]], len(normal) - 1, 1)]
    n = len(normal)
    return Tree(np.array(normal).reshape(n, x.shape[1]), np.array(offset), np.array(child, np.int64).reshape(n, 2), max(leaves, 1))


def probes(forest: list[Tree], q: np.ndarray, count: int) -> list[tuple[int, int]]:
    """``(tree, leaf)`` by one priority queue over all trees, the most promising side first."""
    queue = [(-np.inf, t, 0 if len(tree.normal) else -1) for t, tree in enumerate(forest)]
    heapq.heapify(queue)
    values = [tree.normal @ q - tree.offset for tree in forest]
    out = []
    while queue and len(out) < count:
        cost, t, at = heapq.heappop(queue)
        while at >= 0:
            margin = values[t][at]
            side = int(margin >= 0)
            heapq.heappush(queue, (max(cost, abs(margin)), t, int(forest[t].child[at, 1 - side])))
            at = int(forest[t].child[at, side])
        out.append((t, -1 - at))
    return out


def _vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, digest, vec)``: usable vectors as double-precision bytes, and a name for equal ones."""

    def run(batches):
        for batch in batches:
            ids, out = batch.column("vec_id"), ([], [], [])
            for i, v in enumerate(batch.column("embedding")):
                values = v.as_py()
                if values is None or any(e is None for e in values):
                    continue
                x = np.array(values, np.float64)
                if len(x) and np.isfinite(x).all() and np.any(x):
                    data = (x + 0.0).tobytes()
                    out[0].append(i)
                    out[1].append(xxhash.xxh3_128_digest(data))
                    out[2].append(data)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
                ["vec_id", "digest", "vec"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id is not null").mapInArrow(run, "vec_id long, digest binary, vec binary")


def _unit(data) -> np.ndarray:
    x = np.stack([np.frombuffer(d, np.float64) for d in data])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def build(classes: DataFrame, width: int) -> list[Tree]:
    sample = classes.orderBy(F.xxhash64("digest", F.lit(SEED))).limit(SAMPLE_ROWS).select("vec").toPandas()
    if not len(sample):
        return []
    x, rng = _unit(sample["vec"]), np.random.default_rng(SEED)
    return [grow(x, rng) for _ in range(TREES)]


def nearest(rows: DataFrame, queries: str = "vec_id % 50 = 0", k: int = NEIGHBOURS, count: int = PROBES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every query row its ``k`` nearest other rows found, by cosine.

    ``rows(vec_id, embedding)``; ``queries`` is a condition on ``vec_id``.  Equal vectors are one class: of each
    only the ``k + 1`` smallest ids can be among the nearest, so the others are never compared.  The index holds
    every class once per tree; a query looks into ``count`` leaves, chosen over all trees together, and all rows
    there are compared exactly in double precision.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    rows without vec_id or of another length than most; rows with the query's own id are not its neighbours; ties
    go to the smaller vec_id; an empty table gives no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    vectors = materialize(_vectors(rows))
    widths = vectors.groupBy(F.length("vec").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(1).collect()
    width = widths[0]["w"] if widths else 0
    vectors = vectors.where(F.length("vec") == width)
    # Repeated rows count once, so that they cannot fill the places of a class.
    first = vectors.select("digest", "vec_id").distinct().withColumn(
        "_r", F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))).where(f"_r <= {k + 1}")
    ids = first.groupBy("digest").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = materialize(vectors.groupBy("digest").agg(F.min("vec").alias("vec")).join(ids, "digest"))
    asked = vectors.where(queries).select(F.col("vec_id").alias("query_id"), "digest").distinct()
    forest = spark.sparkContext.broadcast(build(classes, width))

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                data = batch.column("vec").to_pylist()
                x = _unit(data)
                for t, tree in enumerate(forest.value):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t), pa.int32()), pa.array(tree.leaf_of(x), pa.int32()),
                         batch.column("digest"), batch.column("vec"), pa.array([False] * len(x))],
                        ["tree", "leaf", "digest", "vec", "asks"])

    def route(batches):
        for batch in batches:
            if batch.num_rows:
                for digest, data, q in zip(batch.column("digest"), batch.column("vec"), _unit(batch.column("vec").to_pylist())):
                    found = probes(forest.value, q, count)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t for t, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int32()),
                         pa.array([digest.as_py()] * len(found), pa.binary()), pa.array([data.as_py()] * len(found), pa.binary()),
                         pa.array([True] * len(found))], ["tree", "leaf", "digest", "vec", "asks"])

    schema = "tree int, leaf int, digest binary, vec binary, asks boolean"
    held = classes.select("digest", "vec").mapInArrow(index, schema)
    # A leaf of many rows is dealt out in blocks; as many rows as trees and leaves tell how many.
    blocks = held.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_b"))
    blocks = materialize(blocks)
    held = held.join(blocks, ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("digest"), F.col("_b")).cast("int")).drop("_b")
    ask = classes.join(asked.select("digest").distinct(), "digest", "left_semi").select("digest", "vec").mapInArrow(route, schema)
    ask = ask.join(blocks, ["tree", "leaf"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))).drop("_b")
    work = held.unionByName(ask).repartition("tree", "leaf", "block").sortWithinPartitions("tree", "leaf", "block", "asks")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        x, q = group[~asks], group[asks]
        if not len(x) or not len(q):
            return None
        a, b = (np.stack([np.frombuffer(d, np.float64) for d in part["vec"]]) for part in (q, x))
        na, nb = (np.sqrt(np.einsum("ij,ij->i", v, v)) for v in (a, b))
        score = (a @ b.T) / (na[:, None] * nb[None, :])
        keep = min(k + 1, len(x))
        # Everything that may tie with the last place goes on.
        least = np.partition(score, len(x) - keep, axis=1)[:, len(x) - keep]
        i, j = np.nonzero(score >= least[:, None] - ROUNDING)
        # Digits of a matrix product depend on its block; a pair's own product does not.
        exact = np.concatenate([np.einsum("ij,ij->i", a[i[o:o + BLOCK]], b[j[o:o + BLOCK]]) for o in range(0, len(i), BLOCK)])
        return pd.DataFrame({"query": q["digest"].to_numpy()[i], "digest": x["digest"].to_numpy()[j],
                             "score": exact / (na[i] * nb[j])})

    def run(frames):
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            group = frame[["tree", "leaf", "block"]]
            start = np.flatnonzero((group != group.shift()).any(axis=1).to_numpy())
            rest = frame.iloc[start[-1]:] if len(start) else None
            found = [f for a, b in zip(start[:-1], start[1:]) if (f := compare(frame.iloc[a:b])) is not None]
            if found:
                yield pd.concat(found, ignore_index=True)
        if rest is not None and (f := compare(rest)) is not None:
            yield f

    found = work.mapInPandas(run, "query binary, digest binary, score double")
    # A pair met in several trees has the same score in each.
    pairs = found.groupBy("query", "digest").agg(F.max("score").alias("score"))
    near = pairs.join(classes.select("digest", "ids"), "digest").withColumn("_r", F.row_number().over(
        Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0]))).where(f"_r <= {k + 1}")
    each = materialize(near.select(F.col("query").alias("digest"), "score", F.explode("ids").alias("vec_id")))
    answers = asked.join(each, "digest").where("vec_id <> query_id").withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(f"rank <= {k}")
    return answers.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
