"""Benchmark decontamination with suffix arrays over training shards (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import append_columns, fresh, text_of
from roispark.llm.text import ALNUM, Slice, slices
from roispark.session import materialize

WINDOW = 10
# Item words that one pass over the documents searches for; this bounds what is broadcast.
PASS_WORDS = 1 << 20
# Bytes of text in one shard.
SHARD = 1 << 21
# Codes of 21 bits, three to a key.
_BITS, _PER_KEY = 21, 3

MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType()),
    T.StructField("word", T.LongType()), T.StructField("words", T.LongType())]))


class Suffixes:
    """All distinct windows of some items, each the head of a test suffix, with the items they come from."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int) -> None:
        self.window, self.keys = window, -(-window // _PER_KEY)
        words = np.concatenate([w for _, w in items]) if items else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(words)
        self.names = [n for n, _ in items]
        rows, owner, offset, length = [], [], [], []
        for i, (_, w) in enumerate(items):
            code, size = self.code(w), min(window, len(w))
            for j in range(len(w) - size + 1):
                rows.append(np.pad(code[j:j + size], (0, window - size)))
                owner.append(i)
                offset.append(j)
                length.append(size)
        codes = np.array(rows, np.int64).reshape(len(rows), window)
        self.codes, which = np.unique(codes, axis=0, return_inverse=True) if len(rows) else (codes, np.zeros(0, np.int64))
        by = np.argsort(which.ravel(), kind="stable")
        self.owner, self.offset = np.array(owner, np.int64)[by], np.array(offset, np.int64)[by]
        self.start = np.searchsorted(which.ravel()[by], np.arange(len(self.codes) + 1))
        self.length = np.count_nonzero(self.codes, axis=1)
        self.lower, self.upper = pack(self.codes), pack(np.where(self.codes == 0, (1 << _BITS) - 1, self.codes))
        n = len(self.vocabulary) + 1
        two = self.length > 1
        self.pairs = np.unique(self.codes[two, 0] * n + self.codes[two, 1]) if window > 1 else np.zeros(0, np.int64)
        self.singles = np.unique(self.codes[~two, 0])

    def code(self, words: np.ndarray) -> np.ndarray:
        """1 + place in the vocabulary, or 0."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)


def pack(codes: np.ndarray) -> list[np.ndarray]:
    """Codes, one suffix a row, as integers that compare like the suffixes."""
    keys = []
    for a in range(0, codes.shape[1], _PER_KEY):
        key = np.zeros(len(codes), np.int64)
        for j in range(a, min(a + _PER_KEY, codes.shape[1])):
            key = (key << _BITS) | codes[:, j]
        keys.append(key)
    return keys


def bound(array: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search of many suffixes at once: how many of ``array`` are smaller (or, ``after``, not larger)."""
    low = np.zeros(len(wanted[0]), np.int64)
    high = np.full(len(wanted[0]), len(array[0]), np.int64)
    while len(array[0]) and (open_ := low < high).any():
        middle = np.minimum((low + high) >> 1, len(array[0]) - 1)
        less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
        for have, want in zip(array, wanted):
            less |= same & (have[middle] < want)
            same &= have[middle] == want
        right = open_ & (less | same if after else less)
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)
    return low


def _found(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(wanted), bool)
    return values[np.minimum(np.searchsorted(values, wanted), len(values) - 1)] == wanted


def longest_matches(shard: Slice, tests: Suffixes) -> tuple[np.ndarray, ...]:
    """Maximal verbatim matches in a shard: row, item, first item word, first document word, words.

    The shard's suffix array holds the suffixes that begin like some test window; every other suffix
    matches no test suffix far enough.
    """
    rows, words = len(shard.rows), len(shard.word)
    row = np.repeat(np.arange(rows), np.diff(shard.first))
    at = np.arange(words) + row
    text = np.zeros(words + rows + tests.window, np.int64)
    text[at] = tests.code(shard.word)
    head = at[text[at] > 0]
    n = len(tests.vocabulary) + 1
    head = head[_found(tests.pairs, text[head] * n + text[head + 1]) | _found(tests.singles, text[head])]
    keys = pack(text[head[:, None] + np.arange(tests.window)])
    order = np.lexsort(keys[::-1])
    array, suffix = [k[order] for k in keys], head[order]
    low, high = bound(array, tests.lower, False), bound(array, tests.upper, True)
    hit = np.flatnonzero(high > low)
    span = (high - low)[hit]
    place = suffix[np.repeat(low[hit] - np.cumsum(span) + span, span) + np.arange(span.sum())]
    window = np.repeat(hit, span)
    # Every item that a window comes from.
    many = np.diff(tests.start)[window]
    entry = np.repeat(tests.start[window] - np.cumsum(many) + many, many) + np.arange(many.sum())
    item, offset = tests.owner[entry], tests.offset[entry]
    place, size = np.repeat(place, many), np.repeat(tests.length[window], many)
    if not len(item):
        return (np.zeros(0, np.int64),) * 5
    by = np.lexsort((offset, place - offset, item))
    item, offset, place, size = item[by], offset[by], place[by], size[by]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (place[1:] - offset[1:] != place[:-1] - offset[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(item)) - 1
    starts = shard.first[:-1] + np.arange(rows)
    owner = np.searchsorted(starts, place[first], "right") - 1
    return owner, item[first], offset[first], place[first] - starts[owner], offset[last] - offset[first] + size[first]


def _passes(items: DataFrame, window: int) -> Iterator[Suffixes]:
    """The items in passes of at most ``PASS_WORDS`` words (or one item); at least one pass."""
    held, size, some = [], 0, False
    for r in items.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).toLocalIterator():
        words = next(slices(pa.array([r["t"] or ""], pa.large_string()), ALNUM)).word
        if held and size + len(words) > PASS_WORDS:
            yield Suffixes(held, window)
            held, size, some = [], 0, True
        if len(words):
            held.append((r["i"], words))
            size += len(words)
    if held or not some:
        yield Suffixes(held, window)


def _scan(docs: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, str, str]:
    """``docs`` with a column of matches and one of word counts, and their names."""
    spark, found, out = docs.sparkSession, [], docs
    count = fresh(docs, stem="words")
    for tests in _passes(items, window):
        if found:
            out = materialize(out)
        known, name = spark.sparkContext.broadcast(tests), fresh(out, stem="matches")
        first = not found

        def work(batch, known=known, first=first):
            tests = known.value
            counts, parts = [], []
            for shard in slices(text_of(batch), ALNUM, SHARD):
                counts.append(np.diff(shard.first))
                row, *rest = longest_matches(shard, tests)
                parts.append((row + shard.rows.start, *rest))
            row, item, offset, place, size = (
                (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 5)
            by = np.lexsort((offset, item, place, row))
            values = pa.StructArray.from_arrays(
                [pa.array([tests.names[i] for i in item[by]], pa.string()),
                 *(pa.array(x[by], pa.int64()) for x in (offset, place, size))], fields=list(_ARROW))
            ends = np.searchsorted(row[by], np.arange(batch.num_rows + 1)).astype(np.int32)
            arrays = [pa.ListArray.from_arrays(pa.array(ends), values)]
            if first:
                arrays.append(pa.array(np.concatenate(counts) if counts else [], pa.int64()))
            return arrays

        fields = [T.StructField(name, MATCHES)] + [T.StructField(count, T.LongType())] * first
        out = append_columns(out, work, fields)
        found.append(name)
    name = found[0]
    if len(found) > 1:
        name = fresh(out, stem="all")
        out = out.withColumn(name, F.concat(*found)).drop(*found)
    return out, name, count


_ARROW = [pa.field("item_id", pa.string()), pa.field("item_word", pa.int64()), pa.field("word", pa.int64()),
          pa.field("words", pa.int64())]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, matches, contaminated)`` for every row of ``docs(doc_id, text)``.

    ``items(item_id, text)`` are the benchmark.  A document word is hit if it lies in an occurrence of
    ``window`` consecutive item words (of a whole shorter item).  ``matches`` are the longest verbatim
    matches with their places in item and document, in words; ``items`` the ids that match.

    Each task builds suffix arrays over shards of its documents and binary-searches all test suffixes in
    them; nothing is shuffled.  The benchmark is searched in passes of bounded size.

    Defined cases: null, empty or wordless texts have no words and no hits; an item without words matches
    nothing; an item without item_id hits words but is not listed; repeated rows are rows of their own;
    empty tables give no rows or no hits; other columns are ignored.
    """
    rows, found, count = _scan(docs.select("doc_id", F.col("text").cast("string").alias("text")), items, window)
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m["word"].alias("s"), (m["word"] + m["words"]).alias("e"))))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("e")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["e"]))).cast("long").alias("n"),
            F.greatest(acc["e"], x["e"]).alias("e")), lambda acc: acc["n"])
    named = F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda m: m["item_id"]), lambda i: i.isNotNull())))
    return rows.select(
        "doc_id", F.col(count).alias("n_words"), covered.alias("n_hit"), named.alias("items"),
        F.col(found).alias("matches"), (F.size(found) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any match, with all their columns; same cases as ``contamination``."""
    rows, found, _ = _scan(docs, items, window)
    return rows.where(F.size(found) == 0).select(*docs.columns)
