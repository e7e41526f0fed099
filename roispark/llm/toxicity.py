"""Toxicity by class-conditional Kneser-Ney models (operator 3).

The models predict the bytes inside words.  Orders ``OWN`` to ``ORDER`` have counts of their own class;
lower orders share one set of backoff counts, so a rare word is explained alike by both classes and
only expressions that a class was seen to use move the comparison.

An n-gram of up to seven bytes is its own key (``codes``), so no two share a count.  The models are never in one
place: blocks of texts send their distinct n-grams to shards, which count, and get back one ratio for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import fresh, released, text_of
from roispark.llm.text import ALNUM, SLICE, Slice, mix, slices
from roispark.session import materialize, own, scratch_dir, settled

ORDER, OWN = 7, 4
DISCOUNT = 0.75
# Words per passage whose likelihoods are compared besides the whole text's.
PASSAGE = 32
# Labelled rows, at most, that the final logistic step is fitted on.
CALIBRATION_ROWS = 20_000
# Bytes of text in a block (at least one row), and the shards that the second- and third-last bytes of n-grams are dealt to.
BLOCK = 16 << 20
SHARDS = 512
_U = np.uint64


def symbols(part: Slice, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``^word$`` of the given words (by number) as bytes, and each byte's place in its word."""
    size = (part.end - part.begin)[words] + 2
    start = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(start, size)
    at = np.repeat(part.begin[words] - 1, size) + place
    text = part.data[np.clip(at, 0, max(len(part.data) - 1, 0))].astype(np.uint64) if len(part.data) else at.astype(np.uint64)
    text = np.where((text >= 65) & (text <= 90), text + _U(32), text)
    text[start] = 1
    text[start + size - 1] = 2
    return text, place


def codes(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The longest n-gram that ends at each symbol, its bytes as one number, the last lowest; no byte is 0."""
    out = text.copy()
    for k in range(1, ORDER):
        back = np.concatenate([np.zeros(k, np.uint64), text])[:len(text)]
        out |= np.where(place >= k, back << _U(8 * k), _U(0))
    return out.view(np.int64)


def _cut(code: np.ndarray, k: int) -> np.ndarray:
    """The last ``k`` symbols."""
    return code & ((1 << 8 * k) - 1)


def _has(code: np.ndarray, k: int) -> np.ndarray:
    return code >= 1 << 8 * (k - 1)


def shard_of(code: np.ndarray) -> np.ndarray:
    """All n-grams of three symbols or more that one is compared with are in its shard."""
    return (mix((code.view(np.uint64) >> _U(8)) & _U(0xFFFF)) % _U(SHARDS)).astype(np.int32)


def _word_codes(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct words: which each word is, how often each occurs, their sizes, and their n-grams, size - 1 each."""
    _, first, which, count = np.unique(part.word, return_index=True, return_inverse=True, return_counts=True)
    text, place = symbols(part, first)
    return which.ravel(), count, (part.end - part.begin)[first] + 2, codes(text, place)[place > 0]


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, which = np.unique(code, return_inverse=True)
    return own, np.bincount(which.ravel(), n, minlength=len(own))


def _find(sorted_: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each code (any place if absent), and whether it is there."""
    if not len(sorted_):
        return np.zeros(len(code), np.int64), np.zeros(len(code), bool)
    at = np.minimum(np.searchsorted(sorted_, code), len(sorted_) - 1)
    return at, sorted_[at] == code


def _level(code: np.ndarray, n: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of one order's n-grams; its contexts and their backoff weights."""
    context, which = np.unique(code >> 8, return_inverse=True)
    which = which.ravel()
    total, kinds = np.bincount(which, n, minlength=len(context)), np.bincount(which, minlength=len(context))
    p = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds[which] * lower) / np.maximum(total[which], 1)
    return p, context, np.log(np.clip(DISCOUNT * kinds / np.maximum(total, 1), 1e-9, 1))


class Base:
    """The shared orders 1 and 2, dense: every byte and pair of bytes has its own place."""

    def __init__(self, pair: np.ndarray, n: np.ndarray) -> None:
        """``n`` of a pair: as a word's beginning its occurrences, else how many symbols it was seen after."""
        last, kinds = _summed(_cut(pair, 1), np.ones(len(pair)))
        self.p1, self.p2, self.weight = np.full(256, np.nan), np.full(1 << 16, np.nan), np.zeros(256)
        self.p1[last] = np.maximum(kinds, DISCOUNT) / max(kinds.sum(), 1)
        self.p2[pair], context, weight = _level(pair, n, self.p1[_cut(pair, 1)])
        self.weight[context] = weight


class Shard:
    """The orders from 3 on of the n-grams of one shard."""

    def __init__(self, base: Base, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``counts``: distinct longest n-grams and their occurrences, of the ordinary and of the toxic class."""
        self.base, self.levels = base, {}
        found: dict = {}
        for k in range(ORDER, 2, -1):
            owners = (0, 1) if k >= OWN else (-1,)
            for owner in owners:
                mine = counts if owner < 0 else [counts[owner]]
                own = [(code[only], n[only]) for code, n in mine for only in [_has(code, k) & ~_has(code, k + 1)]]
                if k < ORDER:
                    longer = found[owner, k + 1][0] if (owner, k + 1) in found else np.unique(np.concatenate([found[o, k + 1][0] for o in (0, 1)]))
                    own.append((_cut(longer, k), np.ones(len(longer))))
                found[owner, k] = _summed(np.concatenate([c for c, _ in own]), np.concatenate([n for _, n in own]))
        for k in range(3, ORDER + 1):
            for owner in (0, 1) if k >= OWN else (-1,):
                code, n = found[owner, k]
                if k == 3:
                    lower = base.p2[_cut(code, 2)]
                else:
                    below = self.levels.get((owner, k - 1), self.levels.get((-1, k - 1)))
                    lower = below[1][_find(below[0], _cut(code, k - 1))[0]] if len(code) else np.zeros(0)
                self.levels[owner, k] = (code, *_level(code, n, lower))

    def ratios(self, code: np.ndarray) -> np.ndarray:
        """log-likelihood ratio (toxic to ordinary) of the last symbol after those before it."""
        out = np.zeros(len(code))
        for label, sign in ((1, 1.0), (0, -1.0)):
            value, open_ = np.zeros(len(code)), np.ones(len(code), bool)
            for k in range(ORDER, 0, -1):
                fits = open_ & _has(code, k)
                gram = _cut(code, k)
                if k > 2:
                    own, p, context, weight = self.levels[label if k >= OWN else -1, k]
                    at, known = _find(own, gram)
                    p = p[at] if len(p) else np.ones(len(code))
                    at, some = _find(context, gram >> 8)
                    back = np.where(some, weight[at], 0) if len(weight) else np.zeros(len(code))
                else:
                    p = self.base.p2[gram] if k == 2 else self.base.p1[gram]
                    known = ~np.isnan(p)
                    back = self.base.weight[gram >> 8] if k == 2 else np.zeros(len(code))
                known = known & fits
                value += np.where(known, np.log(np.maximum(np.where(known, p, 1), 1e-12)), np.where(fits, back, 0))
                open_ &= ~known
            value[open_] -= 8.0
            out += sign * value
        return out


def _cuts(size: np.ndarray, begin: int, end: int, most: int) -> Iterator[tuple[int, int]]:
    """The rows from ``begin`` to ``end`` in runs of at most so many bytes (at least one row); ``size`` is where rows begin."""
    while begin < end:
        stop = min(end, max(begin + 1, int(np.searchsorted(size, size[begin] + most, "right")) - 1))
        yield begin, stop
        begin = stop


def _blocks(rows: DataFrame) -> DataFrame:
    """``(block, ids, body)``: the rows in blocks, written once; joins by ``block`` leave them where they are.

    A body is a stream of pieces of about ``SLICE`` bytes of text, so that readers need not hold it whole.
    """
    spark, kind = rows.sparkSession, rows.schema["doc_id"].dataType

    def run(batches):
        task, number, ids, held = TaskContext.get().partitionId(), 0, [], 0

        def block():
            out.close()
            return pa.RecordBatch.from_arrays([
                pa.array([task << 32 | number], pa.int64()), pa.array([ids], pa.list_(of)),
                pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "ids", "body"])

        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.schema.field("doc_id").type
            size = np.frombuffer(text_of(batch).buffers()[1], np.int64)[batch.column("text").offset:][:batch.num_rows + 1]
            for a, b in _cuts(size, 0, batch.num_rows, min(SLICE, BLOCK)):
                if ids and held + size[b] - size[a] > BLOCK:
                    yield block()
                    number, ids, held = number + 1, [], 0
                if not ids:
                    sink = pa.BufferOutputStream()
                    out = pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3)))
                out.write_batch(batch.slice(a, b - a))
                ids += batch.column("doc_id").slice(a, b - a).to_pylist()
                held += size[b] - size[a]
        if ids:
            yield block()

    made = rows.mapInArrow(released(run), T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("body", T.BinaryType())]))
    name = f"t_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark).rstrip('/')}/{name}"
    # Bodies are compressed already.
    made.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option("path", path).option(
        "compression", "none").format("parquet").saveAsTable(name)
    found = spark.table(name)
    found.schema
    spark.sql(f"DROP TABLE {name}")  # the name only; the files go with their owner
    return own(found, path)


def _pieces(value: pa.Scalar) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(value.as_buffer()) as source:
        yield from source


def _body(value: pa.Scalar) -> pa.RecordBatch:
    return pa.Table.from_batches(_pieces(value)).combine_chunks().to_batches()[0]


def _chosen(value: pa.Scalar, places: list[int]) -> Iterator[pa.Array]:
    """The texts at some places of a body, piece by piece."""
    begin, places = 0, np.sort(np.array(places, np.int64))
    for piece in _pieces(value):
        a, b = np.searchsorted(places, [begin, begin + piece.num_rows])
        yield text_of(piece).take(pa.array(places[a:b] - begin))
        begin += piece.num_rows


def _codes_of(texts: Iterable[pa.Array]) -> np.ndarray:
    """The distinct n-grams of texts that come piece by piece."""
    own = [np.unique(_word_codes(part)[3]) for piece in texts for part in slices(piece, ALNUM) if len(part.word)]
    return np.unique(np.concatenate([np.zeros(0, np.int64), *own]))


def _pack(values: np.ndarray) -> bytes:
    """Numbers as their size in bytes and their compressed byte planes, the lowest bytes first."""
    plane = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(plane).to_bytes(8, "little") + pa.compress(plane, "zstd", asbytes=True)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    plane = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(plane.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _unpack_codes(column: pa.Array) -> list[np.ndarray]:
    return [np.cumsum(_unpack(data, np.int64)) for data in column.to_pylist()]


def _unpack_counts(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(_unpack(data, np.int64) for data in column.to_pylist())])


def _dealt(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of distinct codes by shard, the shards there, and where each begins."""
    shard = shard_of(code)
    order = np.argsort(shard, kind="stable")
    own, start = np.unique(shard[order], return_index=True)
    return order, own, np.append(start, len(code))


_SENT = "shard int, kind int, block long, codes binary, n binary"
_SENT_NAMES = [f.split()[0] for f in _SENT.split(", ")]


def _send(kind: int, block: int, code: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
    """Ascending codes travel as their differences."""
    order, own, start = _dealt(code)
    code = code[order]
    n = None if n is None else n[order].astype(np.int64)
    parts = list(zip(start[:-1], start[1:]))
    return pa.RecordBatch.from_arrays([
        pa.array(own, pa.int32()), pa.array([kind] * len(own), pa.int32()), pa.array([block] * len(own), pa.int64()),
        pa.array([_pack(np.diff(code[a:b], prepend=0)) for a, b in parts], pa.binary()),
        pa.array([None if n is None else _pack(n[a:b]) for a, b in parts], pa.binary())], _SENT_NAMES)


def asked(blocks: DataFrame) -> DataFrame:
    """The distinct n-grams of every block, by shard."""

    def run(batches):
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body")):
                code = _codes_of(map(text_of, _pieces(body)))
                if len(code):
                    yield _send(4, block, code)

    return blocks.select("block", "body").mapInArrow(released(run), _SENT)


def taught(blocks: DataFrame, labelled: DataFrame) -> DataFrame:
    """Occurrences of n-grams in the rows ``labelled(block, place, toxic, held)``; ``kind`` is toxic + 2 held."""

    def run(batches):
        for batch in batches:
            for block, body, marks in zip(batch.column("block").to_pylist(), batch.column("body"), batch.column("marks").to_pylist()):
                for kind in range(4):
                    own = []
                    for texts in _chosen(body, [m["place"] for m in marks if m["toxic"] + 2 * m["held"] == kind]):
                        for part in slices(texts, ALNUM):
                            if len(part.word):
                                _, count, size, code = _word_codes(part)
                                own.append(_summed(code, np.repeat(count, size - 1)))
                    if own:
                        yield _send(kind, block, *_summed(np.concatenate([c for c, _ in own]), np.concatenate([n for _, n in own])))

    marks = labelled.groupBy("block").agg(F.collect_list(F.struct("place", "toxic", "held")).alias("marks"))
    return blocks.select("block", "body").join(marks.hint("shuffle_hash"), "block").mapInArrow(released(run), _SENT)


def base(sent: DataFrame, kinds: tuple[int, ...]) -> Base:
    """Orders 1 and 2 of the rows of these kinds; at most one row for each pair of bytes comes to the driver."""

    def run(batches):
        for batch in batches:
            code = np.concatenate([np.zeros(0, np.int64), *_unpack_codes(batch.column("codes"))])
            n = _unpack_counts(batch.column("n"))
            own, n = _summed(_cut(code, 3), np.where(_has(code, 3), 0, n))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n.astype(np.int64))], ["code", "n"])

    three = sent.where(F.col("kind").isin(*kinds)).select("codes", "n").mapInArrow(released(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    pairs = three.groupBy(F.col("code").bitwiseAND(0xFFFF).alias("code")).agg(
        F.sum(F.col("n") + (F.col("code") > 0xFFFF).cast("long")).alias("n")).toPandas()
    return Base(pairs["code"].to_numpy(np.int64), pairs["n"].to_numpy(np.float64))


def answered(sent: DataFrame, models: list[tuple[Base, tuple[int, ...]]]) -> DataFrame:
    """``(block, shard, kind, r0, r1)``: the ratios of the n-grams that a block sent a shard, in their order.

    A model counts the rows of its kinds.  The first answers the questions; the second, if given, counts no held
    rows and answers what they taught.  A task holds the distinct n-grams of one shard; questions stream past.
    """
    names = ["block", "shard", "kind", *(f"r{i}" for i in range(len(models)))]

    def run(batches):
        at, counts, shards = None, {}, {}
        for batch in batches:
            shard, kind = np.asarray(batch.column("shard")), np.asarray(batch.column("kind"))
            cut = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]))) if len(shard) else []
            for a, b in zip(cut, [*cut[1:], len(shard)]):
                if shard[a] != at:
                    at, counts, shards = shard[a], {}, {}
                code = _unpack_codes(batch.column("codes").slice(a, b - a))
                flat = np.concatenate(code)
                if kind[a] < 4:
                    n = _unpack_counts(batch.column("n").slice(a, b - a))
                    old = counts.get(kind[a], (flat[:0], n[:0]))
                    counts[kind[a]] = _summed(np.concatenate([old[0], flat]), np.concatenate([old[1], n]))
                which = 0 if kind[a] == 4 else 1
                if which >= len(models) or kind[a] < 2:
                    continue
                # Kinds ascend within a shard, so all that this model counts has come.
                if which not in shards:
                    none = (np.zeros(0, np.int64), np.zeros(0))
                    mine = [[counts.get(k, none) for k in models[which][1] if k % 2 == label] for label in (0, 1)]
                    shards[which] = Shard(models[which][0], [_summed(*(np.concatenate([none[i], *(c[i] for c in own)]) for i in (0, 1))) for own in mine])
                own, place = np.unique(flat, return_inverse=True)
                ratio = np.split(shards[which].ratios(own).astype(np.float32)[place.ravel()], np.cumsum([len(c) for c in code])[:-1])
                told = pa.array([_pack(r) for r in ratio], pa.binary())
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(name).slice(a, b - a) for name in names[:3]),
                    *(told if i == which else pa.nulls(b - a, pa.binary()) for i in range(len(models)))], names)

    dealt = sent.repartition("shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(released(run), ", ".join(["block long", "shard int", "kind int", *(f"{n} binary" for n in names[3:])]))


def features(part: Slice, code: np.ndarray, ratio_of: np.ndarray) -> np.ndarray:
    """Per row: ratio per symbol of the whole text, of its most toxic passage, whether it has words, and the text's ratio."""
    ratio, size = np.zeros(0), np.zeros(0, np.int64)
    if len(part.word):
        which, _, long, own = _word_codes(part)
        value = ratio_of[np.searchsorted(code, own)]
        ratio, size = np.add.reduceat(value, np.cumsum(long - 1) - (long - 1))[which], (long - 1)[which]
    total = np.concatenate([[0.0], np.cumsum(ratio)])
    length = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros((len(part.rows), 4))
    lo, hi = part.first[:-1], part.first[1:]
    some = hi > lo
    out[some, 3] = total[hi[some]] - total[lo[some]]
    out[some, 0] = out[some, 3] / (length[hi[some]] - length[lo[some]])
    out[:, 2] = some
    if len(ratio):
        # Passage i: PASSAGE words from word i on, cut at its text's end and counted as full.
        row = np.repeat(np.arange(len(lo)), hi - lo)
        end = np.minimum(np.arange(len(ratio)) + PASSAGE, hi[row])
        best = (total[end] - total[:-1]) / np.maximum(length[end] - length[:-1], 4 * PASSAGE)
        out[some, 1] = np.maximum.reduceat(best, lo[some])
    return out


def _told(code: np.ndarray, got: list[dict] | None) -> np.ndarray:
    """The ratios of a block's distinct n-grams, as its shards have sent them."""
    ratio = np.zeros(len(code))
    sent = sorted(got or [], key=lambda g: g["shard"])
    ratio[_dealt(code)[0]] = np.concatenate([np.zeros(0, np.float32), *(_unpack(g["r"], np.float32) for g in sent)])
    return ratio


def _features_of(texts: pa.Array, code: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros((0, 4)), *(features(part, code, ratio) for part in slices(texts, ALNUM))])


def _block_features(texts: pa.Array, got: list[dict] | None) -> np.ndarray:
    """Features of texts by the ratios sent for all their n-grams."""
    code = _codes_of([texts])
    return _features_of(texts, code, _told(code, got))


def _logistic(x: np.ndarray, y: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Ridge-regularised Newton steps over rows of the given mass; the intercept is the last weight."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-4] * x.shape[1] + [1e-9])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (mass * p * (1 - p))[:, None]) + ridge, a.T @ (mass * (y - p)) - ridge @ w)
        w += np.clip(step, -5 / np.maximum(np.abs(a).max(axis=0), 1e-9), 5 / np.maximum(np.abs(a).max(axis=0), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return w


FOLDS = 5


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS


class Scorer:
    """Scores of rows by models of their own labels, and the map from likelihood ratios to a probability.

    Labels of rows whose crc32(doc_id) modulo 5 is 0 are never seen.  All others are counted.  The final logistic
    step is fitted on at most ``CALIBRATION_ROWS`` rows of remainder 1, as many of each class as there are up to
    half of them, whose ratios are those of models that have not counted them.
    """

    def __init__(self, rows: DataFrame, labels: DataFrame) -> None:
        self.rows, self.weights, self.blocks = rows, None, None
        marks = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(_fold() > 0)
        shares = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        self.prior = shares.get(1, 0) / max(sum(shares.values()), 1)
        if len(shares) < 2:
            return
        half = [marks.where((_fold() == 1) & (F.col("toxic") == label)).orderBy(F.xxhash64("doc_id")).limit(CALIBRATION_ROWS // 2) for label in (0, 1)]
        held = half[0].unionByName(half[1]).select("doc_id", F.lit(1).alias("held"))
        marks = materialize(marks.join(held, "doc_id", "left").select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.coalesce("held", F.lit(0)).alias("held")))
        self.blocks = blocks = _blocks(rows)
        labelled = materialize(blocks.select("block", F.posexplode("ids").alias("place", "doc_id")).join(marks, "doc_id").select("block", "place", "toxic", "held"))

        def found() -> DataFrame:
            lessons = materialize(taught(blocks, labelled))
            every, others = (0, 1, 2, 3), (0, 1)
            return answered(lessons.unionByName(asked(blocks)), [(base(lessons, kinds), kinds) for kinds in (every, others)])

        self.found = settled(found)
        mass = {(r["toxic"], r["held"]): r["n"] for r in labelled.groupBy("toxic", "held").agg(F.count("*").alias("n")).collect()}
        if len(mass) == 4:
            self._calibrate(labelled, mass)

    def _ratios(self, name: str) -> DataFrame:
        told = self.found.where(F.col(name).isNotNull())
        return told.groupBy("block").agg(F.collect_list(F.struct("shard", "kind", F.col(name).alias("r"))).alias("got")).hint("shuffle_hash")

    def _calibrate(self, labelled: DataFrame, mass: dict) -> None:
        def run(batches):
            for batch in batches:
                for body, marks, got in zip(batch.column("body"), batch.column("marks").to_pylist(), batch.column("got").to_pylist()):
                    for toxic in (0, 1):
                        mine = pa.concat_arrays(list(_chosen(body, [m["place"] for m in marks if m["toxic"] == toxic])))
                        x = _block_features(mine, [g for g in got or [] if g["kind"] == toxic + 2])
                        yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(x), pa.int32()), *(pa.array(x[:, i]) for i in range(3))], ["toxic", *names])

        names = ["x0", "x1", "x2"]
        marks = labelled.where("held = 1").groupBy("block").agg(F.collect_list(F.struct("place", "toxic")).alias("marks"))
        chosen = self.blocks.select("block", "body").join(marks.hint("shuffle_hash"), "block").join(self._ratios("r1"), "block", "left")
        held = chosen.select("body", "marks", "got").mapInArrow(released(run), "toxic int, x0 double, x1 double, x2 double").limit(2 * CALIBRATION_ROWS).toPandas()
        x, y = held[names].to_numpy(), held["toxic"].to_numpy()
        # Each class weighs what it does among all labelled rows.
        share = np.array([sum(n for (toxic, _), n in mass.items() if toxic == label) for label in (0, 1)]) / sum(mass.values())
        scale = np.maximum(x.std(axis=0), 1e-9)
        size = np.maximum(np.bincount(y, minlength=2), 1)
        self.weights = _logistic(x / scale, y, (share / size)[y] * len(y)) / np.append(scale, 1.0)

    def score(self) -> tuple[DataFrame, str]:
        """The rows with a column of scores, and its name."""
        rows, out = self.rows, fresh(self.rows, stem="score")
        if self.blocks is None:
            return rows.withColumn(out, F.lit(float(self.prior))), out
        weights = self.weights
        # Without both classes to fit on: the odds of the classes times the text's likelihood ratio.
        if weights is None:
            weights = np.array([0.0, 0.0, 0.0, 1.0, np.log(self.prior / (1 - self.prior))])
        else:
            weights = np.insert(weights, 3, 0.0)
        names = [*rows.columns, out]

        def run(batches):
            for batch in batches:
                for body, got in zip(batch.column("body"), batch.column("got").to_pylist()):
                    code = _codes_of(map(text_of, _pieces(body)))
                    ratio = _told(code, got)
                    for own in _pieces(body):
                        x = _features_of(text_of(own), code, ratio)
                        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))], names)

        told = self.blocks.select("block", "body").join(self._ratios("r0"), "block", "left")
        return told.select("body", "got").mapInArrow(released(run), T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())])), out


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``.

    Defined cases: null, empty and wordless texts are scored as texts without evidence; a null doc_id is
    scored and not held out; labels other than 0 and 1 are no labels, of repeated label rows the larger
    counts; without labels of both classes every score is the share of toxic labels; repeated rows are
    rows of their own; other columns are ignored.
    """
    rows, score = Scorer(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels).score()
    return rows.select(
        "doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), F.col(score).alias("score"),
        (F.col(score) >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; same cases as ``toxicity``."""
    rows, score = Scorer(docs, labels).score()
    return rows.where(F.col(score) < threshold).select(*docs.columns)
