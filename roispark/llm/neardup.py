"""MinHash near-duplicates by a multi-index Hamming join (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import fresh
from roispark.llm.text import SPACED, mix, slices
from roispark.operators.graph import connected_components
from roispark.session import materialize

SHINGLE = 5
SIMILARITY = 80
# A signature is CHUNKS x WIDTH values of 16 bits.  Signatures that differ in at most
# CHUNKS * (ERRORS + 1) - 1 = 13 of 28 values share a chunk with at most one differing value.
CHUNKS, WIDTH = 7, 4
# Documents per side of one block comparison.
BLOCK = 512

_U = np.uint64
_MULTIPLIERS = np.random.Generator(np.random.PCG64(77)).integers(
    1, 2**63, CHUNKS * WIDTH, dtype=np.uint64) * _U(2) + _U(1)


def _document_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted distinct shingle hashes of every row."""
    for part in slices(column, SPACED):
        value, start = part.shingles(k)
        for i, row in enumerate(part.rows):
            yield row, np.unique(value[start[i]:start[i + 1]])


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, digest, n_shingles, signature)`` per row of ``docs(doc_id, text)``.

    ``digest`` (128 bits) names the shingle set; rows without words have a null digest and signature.
    """

    def run(batches):
        for batch in batches:
            digests, sizes, sketches = [], [], []
            for part in slices(batch.column("text"), SPACED):
                value, start = part.shingles(shingle)
                full = np.flatnonzero(np.diff(start))
                low = np.zeros((len(part.rows), CHUNKS * WIDTH), np.uint16)
                if len(full):
                    for j, a in enumerate(_MULTIPLIERS):
                        low[full, j] = (mix(np.minimum.reduceat(value * a, start[full])) >> _U(48)).astype(np.uint16)
                for i in range(len(part.rows)):
                    own = np.unique(value[start[i]:start[i + 1]])
                    sizes.append(len(own))
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                    sketches.append(low[i].tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())],
                ["doc_id", "digest", "n_shingles", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, digest binary, n_shingles long, signature binary")


def chunk_keys(classes: DataFrame) -> DataFrame:
    """``(key, slot, node)``: every chunk with each of its values left out, so one differing value is allowed."""
    keys = []
    for c in range(CHUNKS):
        piece = [F.substring("signature", 2 * (c * WIDTH + j) + 1, 2) for j in range(WIDTH)]
        for out in range(WIDTH):
            keys.append(F.xxhash64(F.lit(c * WIDTH + out), *(p for j, p in enumerate(piece) if j != out)))
    return classes.select(F.posexplode(F.array(*keys)).alias("slot", "key"), "node")


def _shared(keys: DataFrame) -> DataFrame:
    """The keys' rows that at least two classes share."""
    busy = keys.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key")
    return keys.join(busy, "key")


def _star(rows: DataFrame) -> DataFrame:
    """One leader per key against the key's other members: ``(a, b)``, as many rows as members."""
    rank = F.struct(F.xxhash64("node", F.lit(0)).alias("h"), F.col("node").alias("id"))
    leader = rows.groupBy("key").agg(F.min(rank).alias("_l")).select("key", F.col("_l.id").alias("leader"))
    return rows.join(leader, "key").where("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")).distinct()


def _confirmed(pairs: DataFrame, members: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Pairs whose full sets are similar enough; ``members`` has one text per class."""
    half = members.select(F.col("node").alias("a"), F.col("text").alias("_ta")), members.select(
        F.col("node").alias("b"), F.col("text").alias("_tb"))

    def run(batches):
        for batch in batches:
            left = _document_sets(batch.column("_ta"), shingle)
            right = _document_sets(batch.column("_tb"), shingle)
            keep = [similar(x, y, similarity) for (_, x), (_, y) in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(half[0], "a").join(half[1], "b").select("a", "b", "_ta", "_tb").mapInArrow(
        run, "u binary, v binary")


def similar(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``similarity`` per cent or more."""
    if min(len(x), len(y)) * 100 < similarity * max(len(x), len(y)):
        return False
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= similarity * (len(x) + len(y) - both)


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, slot, node, comp)`` of the keys whose members are not yet all connected."""
    known = rows.join(labels.select("node", "component"), "node", "left").select(
        "key", "slot", "node", F.coalesce("component", "node").alias("comp"))
    open_keys = known.groupBy("key").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).where(
        "_x <> _y").select("key")
    return known.join(open_keys, "key")


def _remaining_pairs(rows: DataFrame, members: DataFrame, similarity: int) -> DataFrame:
    """``(u, v)``: members of one key that are not connected but similar, confirmed on their full sets.

    The members outside the key's largest component meet every member, in blocks of ``BLOCK``: a task
    compares two blocks at a time.  A pair is looked at for the first key that it shares only.
    """
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("_n"))
    top = sizes.groupBy("key").agg(F.max(F.struct("_n", "comp")).alias("_m"), F.sum("_n").alias("_all")).select(
        "key", F.col("_m.comp").alias("_top"), F.ceil(F.col("_all") / BLOCK).cast("int").alias("_blocks"),
        F.ceil((F.col("_all") - F.col("_m._n")) / BLOCK).cast("int").alias("_probes"))
    placed = rows.join(top, "key").withColumn("rest", F.col("comp") != F.col("_top"))
    block = F.xxhash64("node", F.lit(5))
    # The rest's blocks meet all blocks of the key: probe block i, member block j.
    left = placed.where("rest").select(
        "key", "slot", "node", "comp", "rest", F.lit(True).alias("probe"), F.pmod(block, F.col("_probes")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("j"))
    right = placed.select(
        "key", "slot", "node", "comp", "rest", F.lit(False).alias("probe"),
        F.explode(F.sequence(F.lit(0), F.col("_probes") - 1)).alias("i"), F.pmod(block, F.col("_blocks")).cast("int").alias("j"))
    work = left.unionByName(right).join(members.select("node", "n_shingles", "signature", "hashes"), "node")
    def compare(pdf: pd.DataFrame) -> list[tuple[bytes, bytes]]:
        probe = pdf["probe"].to_numpy()
        mine, theirs = np.flatnonzero(probe), np.flatnonzero(~probe)
        if not len(mine) or not len(theirs):
            return []
        node, size = pdf["node"].to_numpy(), pdf["n_shingles"].to_numpy()
        code = pd.factorize(pdf["comp"])[0]
        order = pd.Series(node).rank(method="dense").to_numpy()
        rest = pdf["rest"].to_numpy()
        n, m = size[mine][:, None], size[theirs][None, :]
        good = (code[mine][:, None] != code[theirs][None, :]) & (100 * np.minimum(n, m) >= similarity * np.maximum(n, m))
        # Two probes meet in both orders: one is enough.
        good &= ~rest[theirs][None, :] | (order[mine][:, None] < order[theirs][None, :])
        x, y = np.nonzero(good)
        signature = np.frombuffer(b"".join(pdf["signature"]), np.uint16).reshape(len(pdf), CHUNKS, WIDTH)
        slot = int(pdf["slot"].iloc[0])
        for o in range(0, len(x), 4096):
            u, v = x[o:o + 4096], y[o:o + 4096]
            differ = signature[mine[u]] != signature[theirs[v]]
            many = differ.sum(axis=2)[:, :, None]
            # Slot (c, out) is shared if chunk c agrees everywhere but perhaps at `out`.
            shared = ((many == 0) | ((many == 1) & differ)).reshape(len(u), CHUNKS * WIDTH)
            good[u, v] = shared.argmax(axis=1) == slot
        used = np.flatnonzero(good.any(axis=0))
        if not len(used):
            return []
        good, theirs = good[:, used], theirs[used]
        sets = [np.frombuffer(h, np.uint64) for h in pdf["hashes"]]
        value, owner = np.concatenate([sets[t] for t in theirs]), np.repeat(np.arange(len(theirs)), size[theirs])
        by = np.argsort(value, kind="stable")
        value, owner = value[by], owner[by]
        out = []
        for p in np.flatnonzero(good.any(axis=1)):
            lo, hi = np.searchsorted(value, sets[mine[p]], "left"), np.searchsorted(value, sets[mine[p]], "right")
            span = hi - lo
            at = np.repeat(lo - np.cumsum(span) + span, span) + np.arange(span.sum())
            both = np.bincount(owner[at], minlength=len(theirs))
            alike = good[p] & (100 * both >= similarity * (size[theirs] + size[mine[p]] - both))
            # Links are final, so the first to each component that the probe meets joins them.
            hit = np.flatnonzero(alike)
            for t in hit[np.unique(code[theirs[hit]], return_index=True)[1]]:
                out.append((node[mine[p]], node[theirs[t]]))
        return out

    def run(frames):
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            group = frame[["key", "i", "j"]]
            start = np.flatnonzero((group != group.shift()).any(axis=1).to_numpy())
            held = frame.iloc[start[-1]:] if len(start) else None
            pairs = [p for a, b in zip(start[:-1], start[1:]) for p in compare(frame.iloc[a:b])]
            yield pd.DataFrame(pairs, columns=["u", "v"])
        if held is not None:
            yield pd.DataFrame(compare(held), columns=["u", "v"])

    dealt = work.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInPandas(run, "u binary, v binary")


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _members(source: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``(node, text, n_shingles, signature, hashes)``: one text for each wanted class ``(node, first, signature)``.

    The row is found by the class's smallest doc_id; rows that only share that doc_id are left out.
    ``hashes`` holds the whole set, so that comparisons of it are final.
    """

    def run(batches):
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            keep, size, sets = [], [], []
            for row, own in _document_sets(batch.column("text"), shingle):
                same = len(own) > 0 and xxhash.xxh3_128_digest(own.tobytes()) == nodes[row]
                keep.append(same)
                size.append(len(own))
                sets.append(own.tobytes() if same else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("text"), pa.array(size, pa.int64()), batch.column("signature"),
                 pa.array(sets, pa.binary())],
                ["node", "text", "n_shingles", "signature", "hashes"]).filter(pa.array(keep, pa.bool_()))

    found = source.join(wanted, source["doc_id"].eqNullSafe(wanted["first"])).select("node", "text", "signature")
    return found.mapInArrow(
        run, "node binary, text string, n_shingles long, signature binary, hashes binary").dropDuplicates(["node"])


def _class_components(source: DataFrame, sketch: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """``(node, first, component)`` of every class of equal shingle sets."""
    classes = materialize(
        sketch.where("digest is not null").groupBy(F.col("digest").alias("node")).agg(
            F.min("doc_id").alias("first"), F.min("signature").alias("signature")))
    shared = materialize(_shared(chunk_keys(classes)))
    wanted = classes.join(shared.select("node").distinct(), "node", "left_semi")
    members = materialize(_members(source, wanted, shingle))
    links = materialize(_confirmed(_star(shared), members, shingle, similarity))
    labels = connected_components(links, [])
    apart = materialize(_mixed(shared, labels))
    more = _remaining_pairs(apart, members, similarity)
    # The components found so far are the nodes of a much smaller graph.
    for side in ("u", "v"):
        known = labels.select(F.col("node").alias(side), F.col("component").alias("_c"))
        more = more.join(known, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")
    merged = connected_components(more, []).select(F.col("node").alias("part"), F.col("component").alias("whole"))
    named = classes.select("node", "first").join(labels, "node", "left").select(
        "node", "first", F.coalesce("component", "node").alias("part"))
    return named.join(merged, "part", "left").select("node", "first", F.coalesce("whole", "part").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Rows with equal shingle sets form a class.  Classes are linked when ``100 * intersection >=
    similarity * union`` on their full sets; candidates come from the Hamming join of their MinHash
    signatures.  ``component_id`` is the smallest doc_id that links reach, ``kept`` says it is the row's own.

    Candidates of one key are never paired with each other.  Every key first confirms its members
    against one leader; members that are then still apart from the others of their key are compared
    with all of them, block by block, so no component is lost.

    Defined cases: null, empty or blank texts are linked with nothing (``n_shingles`` 0, own component,
    kept); a null doc_id names a component only if all of its members have none; repeated rows are
    members of the same class; an empty table gives an empty result; other columns are ignored.
    """
    source = _source(docs)
    sketch = materialize(signatures(source, shingle))
    classes = materialize(_class_components(source, sketch, shingle, similarity))
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(smallest, "component").select(F.col("node").alias("digest"), "component_id")
    return sketch.select("doc_id", "digest", "n_shingles").join(named, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id").eqNullSafe(F.col("component_id")) | F.col("digest").isNull(), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest doc_id, and all columns.

    Defined cases: rows without words all stay; among rows that repeat the smallest doc_id of their group
    with the same words one stays; a row without doc_id stays only if its whole group has none.
    """
    source = _source(docs)
    sketch = materialize(signatures(source, shingle))
    classes = materialize(_class_components(source, sketch, shingle, similarity))
    best = classes.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "node")).alias("_b"))
    digest, first, part, rank = (fresh(docs, stem=x) for x in ("digest", "first", "part", "rank"))
    best = best.select(F.col("_b.node").alias(digest), F.col("_b.first").alias(first), F.lit(True).alias(rank))

    def run(batches):
        for batch in batches:
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                       for _, s in _document_sets(batch.column("text").cast(pa.string()), shingle)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, digest])

    schema = T.StructType([*docs.schema.fields, T.StructField(digest, T.BinaryType())])
    rows = docs.mapInArrow(run, schema).join(best, digest, "left").where(
        F.col(digest).isNull() | (F.col(rank) & F.col("doc_id").eqNullSafe(F.col(first))))
    # Rows without words are alone in their partition; the others repeat one doc_id.
    # The rows lie by digest already, so the texts are not moved again.
    rows = rows.withColumn(part, F.when(F.col(digest).isNull(), F.monotonically_increasing_id()))
    order = Window.partitionBy(digest, part).orderBy(F.col("text").asc_nulls_last())
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)
