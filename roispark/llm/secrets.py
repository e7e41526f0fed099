"""Secret scans: keyword automaton, anchored expressions near its hits, embedded checksums (operator 4)."""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roispark.llm.common import append_columns, fresh, text_of

# Kinds in output order; keywords (lower case) that lead to each; the expression tried at a hit.
KINDS = ["assign", "access", "hex", "github", "npm", "slack", "google", "stripe", "jwt", "pem"]
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
    "slack": ["xoxb-", "xoxp-", "xoxa-", "xoxr-", "xoxs-"],
    "google": ["aiza"],
    "stripe": ["sk_live_", "rk_live_"],
    "jwt": ["eyj"],
    "pem": ["-----begin "],
}
EXPRESSIONS = {
    "assign": r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
              r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "github": r"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
    "npm": r"npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
    "slack": r"xox[abprs]-[0-9A-Za-z]+(?:-[0-9A-Za-z]+){1,4}",
    "google": r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])",
    "stripe": r"[sr]k_live_[0-9A-Za-z]{24,}",
    "jwt": r"(eyJ[0-9A-Za-z_-]+)\.eyJ[0-9A-Za-z_-]+\.[0-9A-Za-z_-]+",
    "pem": r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----[A-Za-z0-9+/=\s:,-]+?-----END \1PRIVATE KEY-----",
}
LEAST = {"assign": 12, "access": 18, "hex": 16}
# A run of hexadecimal digits shows as a hit of some HEX_GRAM of them.
HEX_GRAM = 4
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_compiled = {k: re.compile(e) for k, e in EXPRESSIONS.items()}
_automaton: list = []


def automaton():
    """Keywords of all kinds and every run of HEX_GRAM hexadecimal digits, built once a worker."""
    if not _automaton:
        import ahocorasick

        found: dict[str, list] = {}
        for kind, words in KEYWORDS.items():
            for word in words:
                found.setdefault(word, []).append((kind, len(word)))
        for i in range(16 ** HEX_GRAM):
            found.setdefault(f"{i:0{HEX_GRAM}x}", []).append(("hex", HEX_GRAM))
        machine = ahocorasick.Automaton()
        for word, uses in found.items():
            machine.add_word(word, tuple(uses))
        machine.make_automaton()
        _automaton.append(machine)
    return _automaton[0]


def checksum62(body: str) -> str:
    """CRC32 of the body, six base-62 digits: the tail of tokens that carry their own checksum."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out


def _valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= LEAST[kind]
    if kind in LEAST:
        return len(match[0]) >= LEAST[kind]
    if kind in ("github", "npm"):
        body = match[0][4:]
        return checksum62(body[:-6]) == body[-6:]
    if kind == "jwt":
        try:
            head = json.loads(base64.urlsafe_b64decode(match[1] + "=" * (-len(match[1]) % 4)))
        except (ValueError, binascii.Error):
            return False
        return isinstance(head, dict) and "alg" in head
    return True


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in code points, by start and kind."""
    low = text.lower() if text.isascii() else text.encode(errors="surrogatepass").lower().decode(errors="surrogatepass")
    starts: dict[str, list[int]] = {}
    for last, uses in automaton().iter(low):
        for kind, length in uses:
            starts.setdefault(kind, []).append(last - length + 1)
    out = []
    for kind, places in starts.items():
        number, match, end = KINDS.index(kind), _compiled[kind].match, 0
        if kind != "hex":
            places.sort()
        for start in places:
            # Matches of a kind do not overlap; a match that fails its check is used up all the same.
            if start >= end and (m := match(text, start)):
                end = m.end()
                if _valid(kind, m):
                    out.append((start, number, end))
    return sorted(out)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))
SPAN_FIELDS = [pa.field("kind", pa.string()), pa.field("start", pa.int64()), pa.field("end", pa.int64())]


def span_array(rows: list[list[tuple[int, int, int]]], kinds: list[str]) -> pa.Array:
    flat = [s for row in rows for s in row]
    ends = [0]
    for row in rows:
        ends.append(ends[-1] + len(row))
    values = pa.StructArray.from_arrays(
        [pa.array([kinds[k] for _, k, _ in flat], pa.string()), pa.array([a for a, _, _ in flat], pa.int64()),
         pa.array([b for _, _, b in flat], pa.int64())], fields=SPAN_FIELDS)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` for every row of ``docs(doc_id, text)``: kind, start, end in code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are found wherever they occur; tokens with a checksum of their own
    (``github``, ``npm``) and headers (``jwt``) only if it holds.

    Defined cases: null and empty texts have no spans; repeated rows are rows of their own; an empty table
    gives no rows; other columns are ignored.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def work(batch):
        return [span_array([find_secrets(t) if t else [] for t in text_of(batch).to_pylist()], KINDS)]

    return append_columns(rows, work, [T.StructField(name := fresh(rows, stem="spans"), SPANS)]).select(
        "doc_id", F.col(name).alias("spans"))
