"""Content-addressed Merkle manifest of a dataset (operator 12)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roispark.functions.ranking import ranked
from roispark.session import materialize

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
# Children of a node, and levels of the tree that one stored record covers.
FAN = 3
STEP = 5
SPAN = FAN ** STEP


def written(value: Column) -> Column:
    """One field of a leaf: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[written(v) for v in values]), 256)


def joined_digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def height(n: Column) -> Column:
    """Levels above ``n`` leaves: the least h with FAN^h >= n."""
    return sum(((n > F.lit(FAN ** k)).cast("int") for k in range(1, 40)), (n > 1).cast("int"))


def _above(level: Column) -> Column:
    """The parents of consecutive nodes: each run of FAN, the last one with what is left."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: joined_digest(F.slice(level, i * FAN + 1, FAN)))


def _records(level: Column, above: Column) -> Column:
    """``(digest, children)`` of every parent."""
    return F.transform(above, lambda d, i: F.struct(d.alias("digest"), F.slice(level, i * FAN + 1, FAN).alias("children")))


@dataclass
class Forest:
    """The trees over ``(tree, pos, n, digest)``: nodes by round, stored records by round, one root per tree."""

    nodes: list[DataFrame]
    stores: list[DataFrame]
    roots: DataFrame


def build(leaves: DataFrame) -> Forest:
    """Trees of all groups in lockstep, ``STEP`` levels a round.

    A unit holds ``SPAN`` consecutive nodes at most, so no group grows with its tree.  Units of a tree with several
    units are raised ``STEP`` levels, the only unit of a tree until one node is left.  Each unit gives one record to
    the store, under its top digest: the map from digest to children of the nodes it covers.
    """
    nodes, stores, finished = [leaves], [], []
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        here = nodes[-1] if len(nodes) == 1 else nodes[-1].where("n > 1")
        units = here.groupBy("tree", "n", F.expr(f"pos div {SPAN}").alias("pos")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("_members"))
        steps = F.least(F.lit(STEP), height(F.col("n")))
        units = units.select("tree", "n", "pos", steps.alias("steps"), F.transform("_members", lambda m: m["digest"]).alias("_0"))
        for k in range(1, STEP + 1):
            units = units.withColumn(f"_{k}", F.when(F.col("steps") >= k, _above(F.col(f"_{k - 1}"))))
        entries = F.flatten(F.filter(F.array(*[_records(F.col(f"_{k - 1}"), F.col(f"_{k}")) for k in range(1, STEP + 1)]),
                                     lambda x: x.isNotNull()))
        top = F.coalesce(*[F.col(f"_{k}") for k in range(STEP, -1, -1)])[0]
        raised = materialize(units.select(
            "tree", "pos", F.ceil(F.col("n") / SPAN).cast("long").alias("n"), top.alias("digest"), "steps",
            # Equal subtrees have equal digests and are stored once.
            F.map_from_entries(F.array_distinct(entries)).alias("children")))
        stores.append(raised.groupBy("digest", "steps").agg(F.any_value("children").alias("children")))
        nodes.append(raised.select("tree", "pos", "n", "digest"))
        finished.append(nodes[-1].where("n = 1").select("tree", "digest"))
        largest = -(-largest // SPAN)
        if largest <= 1:
            break
    roots = finished[0]
    for more in finished[1:]:
        roots = roots.unionByName(more)
    return Forest(nodes, stores, roots)


def _descent(digest: Column, children: Column, rank: Column, steps: Column) -> Column:
    """From ``digest`` down by the ``steps`` base-FAN digits of ``rank``: the unselected children, lowest level first."""
    digits = F.transform(
        F.filter(F.array(*[F.lit(k) for k in range(STEP - 1, -1, -1)]), lambda k: k < steps),
        lambda k: F.pmod(F.floor(rank / F.pow(F.lit(float(FAN)), k)), F.lit(FAN)).cast("int"))
    nothing = F.array().cast("array<struct<before:string,after:string>>")

    def down(state: Column, digit: Column) -> Column:
        # The one-element transform binds the children, which would be looked up three times otherwise.
        return F.transform(F.array(children[state["digest"]]), lambda kids: F.struct(
            kids[digit].alias("digest"),
            F.concat(state["path"], F.array(F.struct(
                F.array_join(F.slice(kids, 1, digit), "").alias("before"),
                F.array_join(F.slice(kids, digit + 2, FAN), "").alias("after")))).alias("path")))[0]

    start = F.struct(digest.alias("digest"), nothing.alias("path"))
    return F.reverse(F.aggregate(digits, start, down)["path"])


def paths(forest: Forest, leaves: DataFrame, starts: DataFrame) -> DataFrame:
    """``leaves`` with ``path`` and the columns of ``starts(tree, path, ...)``.

    Requests descend from the roots, one record a round: those with a common prefix travel as one until they part,
    and a unit's record meets the ``SPAN`` requests below it only.  ``path`` holds, from the leaf to the root, the
    joined digests of the siblings before and after each node; the path of the tree's start follows that of the tree.
    """
    carried = [c for c in starts.columns if c not in ("tree", "path")]
    requests = None
    for r in range(len(forest.stores) - 1, -1, -1):
        begin = forest.nodes[r + 1].where("n = 1").join(starts, "tree").select("tree", "pos", "digest", "path", *carried)
        requests = begin if requests is None else requests.unionByName(begin)
        opened = requests.join(forest.stores[r], "digest").select(
            "tree", F.col("pos").alias("_unit"), F.col("digest").alias("_top"), "steps", "children", F.col("path").alias("_rest"), *carried)
        rows = leaves if r == 0 else forest.nodes[r].where("n > 1")
        below = rows.withColumn("_unit", F.expr(f"pos div {SPAN}")).join(opened, ["tree", "_unit"])
        inner = _descent(F.col("_top"), F.col("children"), F.col("pos") % SPAN, F.col("steps"))
        requests = below.withColumn("path", F.concat(inner, F.col("_rest"))).drop("_unit", "_top", "steps", "children", "_rest")
        if r:
            requests = materialize(requests.select("tree", "pos", "digest", "path", *carried))
    return requests


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings of all levels, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(docs: DataFrame, candidate: Column | None = None) -> DataFrame:
    """``(doc_id, source, pos, n, leaf, candidate, subroot, root, path)`` for every row of ``docs``.

    ``pos`` is the row's place among the ``n`` leaves of its source.  ``candidate`` is the leaf digest that shall be
    verified (an expression over the columns of ``docs``; by default the leaf itself).  Places come from a
    range-partitioned sort, so a source of any size is spread over tasks; sources are a tree of their own, so their
    number is free too.

    Defined cases: null fields are written as ``-``; a null doc_id comes before all others of its source, a null
    source before all other sources; rows with equal doc_id follow in the order of their digests; an empty text is
    ``0:``; an empty table gives no rows; columns other than the five fields are ignored.
    """
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    # The source as a key that is never null.
    plain = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", written(F.col("source")).alias("tree"), leaf.alias("leaf"),
        (leaf if candidate is None else candidate).alias("candidate")))
    leaves = ranked(plain, ["tree"], ["doc_id", "leaf"], rank="_rank", total="n").withColumn("pos", F.col("_rank") - 1).drop("_rank")
    leaves = materialize(leaves)
    trees = build(leaves.select("tree", "pos", "n", F.col("leaf").alias("digest")))
    sources = leaves.select("tree", "source").distinct()
    placed = ranked(materialize(trees.roots.join(sources, "tree").select(F.lit(0).alias("all"), "source", "tree", "digest")),
                    ["all"], ["source"], rank="_rank", total="n")
    subroots = materialize(placed.select(
        F.lit("root").alias("tree"), (F.col("_rank") - 1).alias("pos"), "n", "digest", F.col("tree").alias("source_tree")))
    top = build(subroots.select("tree", "pos", "n", "digest"))
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    starts = top.roots.select("tree", F.col("digest").alias("root"), nothing.alias("path"))
    per_source = paths(top, subroots, starts).select(
        F.col("source_tree").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    return paths(trees, leaves, materialize(per_source)).select(
        "doc_id", "source", "pos", "n", "leaf", "candidate", "subroot", "root", "path")


def verify(found: DataFrame) -> DataFrame:
    """``manifest`` with the proof's digest, the root folded from the candidate, and whether it is the root."""
    return found.select("*", proof_digest(F.col("path")).alias("proof_sha256"),
                        fold(F.col("candidate"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
