"""Best-fit decreasing packing of tokenised documents into fixed windows (operator 2)."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import released, text_of
from roispark.llm.text import utf8
from roispark.session import materialize

WINDOW = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
# Rows per shard whose pieces are numbered together; bounds every window function.
SHARD_ROWS = 50_000
# Chunks in each half of a worker's cache: when the younger half is full it replaces the older one.
_CACHE = 50_000
# Words that go to the tokenizer in one call.
_JOIN = 64
_STOPS = ".,;:!?%$&#*|)"
# Bytes of text that are looked up together (at least one whole text).
_SLICE = 8 << 20


class Encoder:
    """Ids of whole texts, little-endian unsigned 32-bit, by chunks between ASCII white space.

    The tokenizer drops white space and never joins characters across it, so the ids of a text are those
    of its chunks in order.  Arrow splits and tells the distinct chunks of a slice; their ids are gathered
    by position.  Letters followed by plain punctuation are two of the tokenizer's words, so they are
    encoded apart; every other chunk goes to the tokenizer as it is.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The ids that end a word.
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _encode(self, chunks: list[str]) -> None:
        """Words of letters are one word for the tokenizer and go to it many at a time; others one by one."""
        words = [c for c in chunks if c.isalpha() and c.lower().isalpha()]
        found = self.tokenizer.encode_batch_fast(
            [" ".join(words[o:o + _JOIN]) for o in range(0, len(words), _JOIN)], add_special_tokens=False)
        for o, one in zip(range(0, len(words), _JOIN), found):
            ids = np.array(one.ids, "<u4")
            data, ends = ids.tobytes(), (np.flatnonzero(self.last[ids]) * 4 + 4).tolist()
            self.cache.update(zip(words[o:o + _JOIN], [data[x:y] for x, y in zip([0, *ends], ends)]))
        rest = list(set(chunks).difference(words))
        for chunk, one in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.cache[chunk] = np.array(one.ids, "<u4").tobytes()

    def _parts(self, chunk: str) -> list[str]:
        stem = chunk.rstrip(_STOPS)
        if stem and len(stem) < len(chunk) and stem.isalpha() and stem.lower().isalpha():
            return [stem, chunk[len(stem):]]
        return [chunk]

    def _recall(self, chunks: list[str]) -> list[str]:
        """The chunks that neither half knows; what only the older half knows moves to the younger."""
        unknown = [c for c in chunks if c not in self.cache]
        if self.older:
            known = [c for c in unknown if c in self.older]
            self.cache.update((c, self.older[c]) for c in known)
            unknown = [c for c in unknown if c not in self.cache]
        return unknown

    def _ids(self, chunks: list[str]) -> list[bytes]:
        parts = {c: self._parts(c) for c in self._recall(chunks)}
        self._encode(self._recall(list({p for ps in parts.values() for p in ps})))
        for chunk, ps in parts.items():
            if len(ps) > 1:
                self.cache[chunk] = b"".join([self.cache[p] for p in ps])
        return [self.cache[c] for c in chunks]

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text begins."""
        if len(self.cache) > _CACHE:
            self.older, self.cache = self.cache, {"": b""}
        column = column.fill_null("")
        # Special tokens are spelled in lower case: only then does case matter.
        column = pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column))
        chunks = pc.ascii_split_whitespace(column)
        named = chunks.flatten().dictionary_encode()
        known = self._ids(named.dictionary.to_pylist())
        data = np.frombuffer(b"".join(known), "<u4")
        length = np.array([len(k) for k in known], np.int64) // 4
        first = np.cumsum(length) - length
        chunk = np.asarray(named.indices)
        size = length[chunk]
        end = np.concatenate([[0], np.cumsum(size)])
        ids = data[np.repeat(first[chunk] - end[:-1], size) + np.arange(end[-1])]
        bounds = np.asarray(chunks.offsets)
        return ids, end[bounds - bounds[0]]


_encoders: dict[str, Encoder] = {}

PIECE_FIELDS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def pieces(docs: DataFrame, path: str | None = None, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """``(row, doc_id, start, length, doc_tokens, ids_crc32[, ids])``: every row's ids and the end id, cut into full windows.

    ``row`` tells rows with equal doc_id apart; ``ids`` are little-endian unsigned 32-bit, ``ids_crc32`` is their checksum.
    """
    spark = docs.sparkSession

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        name = path
        if name is None:
            import public_tokenizers

            name = public_tokenizers.path(VOCABULARY)
        if name not in _encoders:
            _encoders[name] = Encoder(name)
        encoder = _encoders[name]
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            column, ids, numbers = text_of(batch), batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            offsets = utf8(column)[1]
            o = 0
            while o < batch.num_rows:
                stop = max(o + 1, int(np.searchsorted(offsets, offsets[o] + _SLICE, "right")) - 1)
                out = []
                found, begin = encoder.texts(column.slice(o, stop - o))
                for k in range(o, stop):
                    data = found[begin[k - o]:begin[k - o + 1]].tobytes() + end
                    total = len(data) // 4
                    for start in range(0, total, window):
                        part = data[4 * start:4 * (start + window)]
                        out.append((numbers[k], ids[k], start, len(part) // 4, total, zlib.crc32(part), part))
                o = stop
                columns = list(zip(*out))[:len(fields)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.binary()])], fields.names)
        # A worker is used again by other stages: the chunks do not outlive their task.
        encoder.cache, encoder.older = {"": b""}, {}

    fields = T.StructType([*PIECE_FIELDS, T.StructField("ids", T.BinaryType())]) if with_ids else PIECE_FIELDS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(released(run), fields)


class Capacities:
    """Segment tree over remaining capacities 0 .. window: which still have open windows."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.tree = np.zeros(2 * self.size, bool)

    def set(self, capacity: int, open_: bool) -> None:
        at = capacity + self.size
        self.tree[at] = open_
        while at > 1:
            at >>= 1
            self.tree[at] = self.tree[2 * at] or self.tree[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that has an open window."""
        at = length + self.size
        if self.tree[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def layout(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``{length: count}``: runs ``(length, rank, windows, each, sequence, offset)``.

    A run puts the items of this length with ranks from ``rank`` on into ``windows`` consecutive sequences from
    ``sequence`` on, ``each`` per sequence, the first at ``offset``.  Items of equal length are alike, and equally
    full windows too, so whole runs move at once: the work follows the number of distinct lengths, not of items.
    """
    open_: dict[int, deque] = {}
    tree, runs, made = Capacities(window), [], 0

    def put(capacity: int, first: int, count: int) -> None:
        if count and capacity:
            open_.setdefault(capacity, deque()).append((first, count))
            tree.set(capacity, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                each = window // length
                count = max(left // each, 1)
                first, have, capacity = made, count, window
                made += count
            else:
                first, have = open_[capacity].popleft()
                if not open_[capacity]:
                    tree.set(capacity, False)
            # Best fit keeps filling one window of this capacity before it opens the next.
            each = min(capacity // length, left)
            count = min(have, left // each)
            runs.append((length, rank, count, each, first, window - capacity))
            put(capacity, first + count, have - count)
            put(capacity - each * length, first, count)
            rank, left = rank + each * count, left - each * count
    return runs


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """``(row, doc_id, start, length, doc_tokens, ids_crc32[, ids], sequence_id, offset)``: every piece in its sequence.

    A document's ids end with the end id.  Documents longer than a window are cut into full windows, each a
    sequence of its own; the rests are packed by best-fit decreasing over the whole table.  The driver plans on
    the number of rests of each length only (at most ``window`` numbers); pieces find their places by their rank
    among the rests of their length, which is counted per shard of bounded size.

    Defined cases: null and empty texts consist of the end id; a null doc_id stays null; repeated rows are packed
    each; an empty table gives no pieces; other columns are ignored.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, path, window, with_ids))
    rows = cut.select("row", "start", "length")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    rows = rows.withColumn("shard", shard)
    counts = materialize(rows.groupBy("length", "shard").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = histogram.pop(window, 0)
    runs = layout(histogram, window)
    made = max((s + c for _, _, c, _, s, _ in runs), default=0)
    if full:
        runs.append((window, 0, full, 1, made, 0))
    # Offsets of each shard among the items of a length: one row per length and shard.
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("length", "shard").orderBy("row", "start")
    ranked = rows.withColumn("inside", F.row_number().over(inside) - 1).join(counts, ["length", "shard"]).withColumn(
        "rank", F.col("base") + F.col("inside"))

    table_ = {}
    for length, rank, count, each, first, offset in runs:
        table_.setdefault(length, []).append((rank, count, each, first, offset))
    plan = spark.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in table_.items()})

    def place(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                run = plan.value[size]
                own = run[np.searchsorted(run[:, 0], rank[at], "right") - 1]
                inner = rank[at] - own[:, 0]
                sequence[at] = own[:, 3] + inner // own[:, 2]
                offset[at] = own[:, 4] + inner % own[:, 2] * size
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("start"), pa.array(sequence), pa.array(offset)],
                ["row", "start", "sequence_id", "offset"])

    placed = ranked.select("row", "start", "length", "rank").mapInArrow(
        place, "row long, start long, sequence_id long, offset long")
    return cut.join(placed, ["row", "start"])


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, input_ids, lengths, n_tokens)``: the filled windows, padded to ``window``.

    A window filled to a power of two is left as it is.
    """
    parts = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    whole = F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")
    used = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    exact = F.bit_count(used) == 1
    return parts.select(
        "sequence_id", used.alias("n_tokens"), F.transform("p", lambda x: x["length"]).alias("lengths"),
        F.unhex(F.concat(whole, F.when(exact, F.lit("")).otherwise(
            F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (F.lit(window) - used).cast("int"))))).alias("input_ids"))
