"""Personal data: anchored patterns and a skip-chain conditional random field (operator 8).

Tokens with a digit or an at-sign are the field's nodes; every other token can only be ordinary, so nothing
is lost by leaving it out.  Neighbouring nodes share chain potentials, repeated or similar ones further apart
share skip potentials, and loopy belief propagation makes their labels agree across the document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import append_columns, fresh, text_of
from roispark.llm.secrets import span_array

# Kinds in output order, and their expressions.
KINDS = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CLUE = re.compile(r"[0-9@]")
_NODE = re.compile(r"[0-9@]\S*")
_OTHER = re.compile(r"[^0-9]+")
_EDGE = ".,;:!?\"'%$&*#<>[]{}|"

LABELS = 1 + len(KINDS)
# Nodes, at most, that the potentials are fitted on, and about how many documents they come from.
TRAINING_NODES = 40_000
TRAINING_ROWS = 4_000
ROUNDS, DAMPING, CERTAIN = 12, 0.3, 0.95


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the patterns, leftmost and non-overlapping per kind, by start and kind."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            out.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _OTHER.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_OTHER.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


@dataclass
class Graph:
    """Nodes of one document, their features and labels by the patterns, chain and skip edges."""

    bounds: list[tuple[int, int]]
    x: np.ndarray
    label: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


_BUCKETS = [0, 1, 3, 7, 9, 12, 13, 15, 16, 19]
_WIDTH = len(_BUCKETS) + 1 + 13


def graph_of(text: str, spans: list[tuple[int, int, int]]) -> Graph:
    bounds, tokens = [], []
    for m in _NODE.finditer(text):
        start, end = m.start(), m.end()
        while start and not text[start - 1].isspace():
            start -= 1
        while end > start + 1 and text[end - 1] in _EDGE:
            end -= 1
        while start < end - 1 and text[start] in _EDGE:
            start += 1
        if not bounds or start >= bounds[-1][1]:
            bounds.append((start, end))
            tokens.append(text[start:end])
    n = len(tokens)
    label, x, s = np.zeros(n, np.int64), np.zeros((n, _WIDTH)), 0
    digits = [_OTHER.sub("", t) for t in tokens]
    near = [i + 1 < n and bounds[i + 1][0] - bounds[i][1] <= 2 for i in range(n)]
    for i, (token, number) in enumerate(zip(tokens, digits)):
        start, end = bounds[i]
        while s < len(spans) and spans[s][2] <= start:
            s += 1
        over = [k for a, k, b in spans[s:s + 4] if a < end and b > start]
        label[i] = 1 + over[0] if over else 0
        x[i, int(np.searchsorted(_BUCKETS, len(number)))] = 1
        x[i, len(_BUCKETS) + 1:] = (
            1, "@" in token, "@" in token and "." in token.rpartition("@")[2], token.count(".") == 3 and not _OTHER.sub("", token.replace(".", "")) == "" and token.replace(".", "").isdigit(),
            token[0] == "+", "(" in token, "-" in token, token.isdigit(), 14 <= len(number) <= 19 and luhn(number),
            any(c.isalpha() for c in token), i > 0 and near[i - 1], near[i], i > 0 and near[i - 1] and tokens[i - 1][0] == "+")
    chain = np.array([(i, i + 1) for i in range(n - 1) if near[i]], np.int64).reshape(-1, 2)
    # A node is linked with the last one of the same digits, and with the last of the same final seven.
    skip, last = [], {}
    for i, number in enumerate(digits):
        keys = {tokens[i].lower(), number} | ({"~" + number[-7:]} if len(number) >= 7 else set())
        before = {last[k] for k in keys if len(k) > 3 and k in last}
        skip += [(j, i) for j in sorted(before) if not (j == i - 1 and near[j])]
        last.update({k: i for k in keys})
    return Graph(bounds, x, label, chain, np.array(skip, np.int64).reshape(-1, 2))


@dataclass
class Field:
    """Unary weights and log potentials of chain and skip edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, g: Graph) -> np.ndarray:
        """Loopy sum-product beliefs of every node."""
        local = g.x @ self.unary
        local -= local.max(axis=1, keepdims=True)
        edges = np.concatenate([g.chain, g.skip])
        if len(edges):
            table = np.concatenate([np.repeat(self.chain[None], len(g.chain), 0), np.repeat(self.skip[None], len(g.skip), 0)])
            source = np.concatenate([edges[:, 0], edges[:, 1]])
            target = np.concatenate([edges[:, 1], edges[:, 0]])
            table = np.concatenate([table, table.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            message = np.zeros((len(source), LABELS))
            for _ in range(ROUNDS):
                belief = local.copy()
                np.add.at(belief, target, message)
                out = (belief[source] - message[back])[:, :, None] + table
                top = out.max(axis=1)
                new = np.log(np.exp(out - top[:, None, :]).sum(axis=1)) + top
                new -= new.max(axis=1, keepdims=True)
                if np.abs(new - message).max() < 1e-4:
                    break
                message = DAMPING * message + (1 - DAMPING) * new
            local = local.copy()
            np.add.at(local, target, message)
        p = np.exp(local - local.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def fit_field(docs: DataFrame) -> Field:
    """Piecewise training on what the patterns find in a bounded sample of rows.

    About ``TRAINING_ROWS`` rows with clues, by a hash of the text, and at most ``TRAINING_NODES`` nodes.
    """
    total = docs.count()
    share = min(1.0, TRAINING_ROWS / max(total, 1))
    sample = docs.select(F.col("text").cast("string").alias("text")).where(
        F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000)).where("text rlike '[0-9@]'")

    def run(batches):
        for batch in batches:
            rows = []
            for text in text_of(batch).to_pylist():
                g = graph_of(text, base_spans(text))
                rows += [(0, int(a), 0, x.astype(np.float32).tobytes()) for a, x in zip(g.label, g.x)]
                rows += [(1, int(g.label[a]), int(g.label[b]), None) for a, b in g.chain]
                rows += [(2, int(g.label[a]), int(g.label[b]), None) for a, b in g.skip]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int32()] * 3 + [pa.binary()])], ["t", "a", "b", "x"])

    seen = sample.mapInArrow(run, "t int, a int, b int, x binary").orderBy(F.xxhash64("t", "a", "b", "x")).limit(
        TRAINING_NODES).toPandas()
    nodes = seen[seen.t == 0]
    x = np.frombuffer(b"".join(nodes.x), np.float32).reshape(-1, _WIDTH).astype(float)
    y = np.eye(LABELS)[nodes.a.to_numpy()] if len(nodes) else np.zeros((0, LABELS))
    w = np.zeros((_WIDTH, LABELS))
    w[len(_BUCKETS) + 1, 0] = 3.0
    if len(nodes):
        # Ridge-regularised softmax regression by accelerated gradient steps.
        step, momentum = 2.0 / max(np.linalg.norm(x, 2) ** 2 / len(x), 1e-9), np.zeros_like(w)
        for _ in range(600):
            ahead = w + 0.9 * momentum
            z = x @ ahead
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            momentum = 0.9 * momentum - step * (x.T @ (p - y) / len(x) + 1e-4 * ahead)
            w = w + momentum

    def potential(kind: int, prior: np.ndarray) -> np.ndarray:
        pairs = seen[seen.t == kind]
        count = prior.copy()
        np.add.at(count, (pairs.a.to_numpy(), pairs.b.to_numpy()), 1)
        joint = count / count.sum()
        return np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)))

    # Before any evidence neighbours are unrelated, and repeated tokens agree.
    return Field(w, potential(1, np.ones((LABELS, LABELS))), potential(2, np.ones((LABELS, LABELS)) + 20 * np.eye(LABELS)))


def find_pii(text: str, field: Field) -> list[tuple[int, int, int]]:
    """The patterns' spans, and spans that the field is certain of and no pattern touches, by start and kind."""
    if not _CLUE.search(text):
        return []
    spans = base_spans(text)
    g = graph_of(text, spans)
    if not len(g.bounds):
        return spans
    belief = field.marginals(g)
    best = belief.argmax(axis=1)
    linked = {int(a) for a, _ in g.chain}
    extra, i = [], 0
    while i < len(best):
        j = i
        while best[i] and j in linked and best[j + 1] == best[i]:
            j += 1
        start, end = g.bounds[i][0], g.bounds[j][1]
        if best[i] and belief[i:j + 1, best[i]].min() >= CERTAIN and not any(a < end and b > start for a, _, b in spans):
            extra.append((start, int(best[i]) - 1, end))
        i = j + 1
    return sorted(spans + extra)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))


def scan_pii(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` for every row of ``docs(doc_id, text)``: kind, start, end in code points, and whether a
    pattern found it.

    Defined cases: null and empty texts have no spans; without any row to learn from the field adds nothing
    certain; repeated rows are rows of their own; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(fit_field(rows))

    def work(batch):
        texts = text_of(batch).to_pylist()
        base = [base_spans(t) if t and _CLUE.search(t) else [] for t in texts]
        found = [find_pii(t, known.value) if b or (t and _CLUE.search(t)) else [] for t, b in zip(texts, base)]
        every = span_array(found, KINDS)
        own = [s in set(b) for b, f in zip(base, found) for s in f]
        values = pa.StructArray.from_arrays(
            [*every.values.flatten(), pa.array(own, pa.bool_())],
            fields=[*every.values.type, pa.field("base", pa.bool_())])
        return [pa.ListArray.from_arrays(every.offsets, values)]

    return append_columns(rows, work, [T.StructField(name := fresh(rows, stem="spans"), SPANS)]).select(
        "doc_id", F.col(name).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in brackets; overlapping spans become one.

    All other columns stay, null texts stay null; same cases as ``scan_pii``.
    """
    known = docs.sparkSession.sparkContext.broadcast(fit_field(docs))
    place = docs.columns.index("text")

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, end = [], 0
        for a, kind, b in find_pii(text, known.value):
            if a >= end:
                out += [text[end:a], f"[{KINDS[kind].upper()}]"]
            end = max(end, b)
        return "".join([*out, text[end:]]) if end else text

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = pa.array([clean(t) for t in columns[place].cast(pa.string()).to_pylist()], batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    rows = docs.withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(run, rows.schema)
