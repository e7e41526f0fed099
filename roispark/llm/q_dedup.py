"""Queries of the duplicate and contamination operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from roispark.llm import merkle
from roispark.llm.blocknames import exact_duplicates
from roispark.llm.common import table
from roispark.llm.decontam import contamination
from roispark.llm.neardup import near_duplicates


def near_documents(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, similarity=80)


def contaminated_documents(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def exact_documents(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


EXACT_SQL = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
    sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""


def verified_documents(spark, sf_dir):
    """Every second document (by the checksum of its number) is checked against a text without its line feeds."""
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    candidate = merkle.leaf_digest([text if c == "text" else F.col(c) for c in merkle.FIELDS])
    found = merkle.verify(merkle.manifest(table(spark, sf_dir, "documents"), candidate))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _manifest_sql(levels: int = 22, source_levels: int = 12) -> str:
    """The levels written out (3^22 leaves, 3^12 sources); a finished tree stays as it is."""
    def leaf(text):
        fields = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in merkle.FIELDS]
        return "sha256(concat(" + ", ".join(
            f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}), ':', {c}) END" for c in fields) + "))"

    # CRC-32 bit by bit: -1 shifts, other list entries are bytes.
    crc = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""
    steps = [f"""plain AS (SELECT doc_id, coalesce(source, '') AS src, source IS NOT NULL AS named, {leaf('text')} AS leaf,
        CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS candidate FROM documents)""",
        """leaves AS (SELECT row_number() OVER (PARTITION BY named, src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY named, src) AS n, * FROM plain)""",
        "s0 AS (SELECT named, src, pos, n, leaf AS h FROM leaves)"]
    grow = """{name}{k} AS (SELECT {keys} CASE WHEN n > 1 THEN pos // 3 ELSE pos END AS pos,
        any_value(CASE WHEN n > 1 THEN (n + 2) // 3 ELSE 1 END) AS n,
        CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
        FROM {name}{b} GROUP BY {keys} CASE WHEN n > 1 THEN pos // 3 ELSE pos END)"""
    for k in range(1, levels + 1):
        steps.append(grow.format(name="s", k=k, b=k - 1, keys="named, src,"))
    steps.append(f"""r0 AS (SELECT named, src, row_number() OVER (ORDER BY named, encode(src)) - 1 AS pos, count(*) OVER () AS n, h FROM s{levels})""")
    for k in range(1, source_levels + 1):
        steps.append(grow.format(name="r", k=k, b=k - 1, keys=""))
    around = """string_agg(CASE WHEN b.pos < a.pos THEN b.h END, '' ORDER BY b.pos) AS before,
        string_agg(CASE WHEN b.pos > a.pos THEN b.h END, '' ORDER BY b.pos) AS after"""
    for name, count, keys in (("s", levels, "named, src,"), ("r", source_levels, "")):
        for k in range(count):
            using = f"USING ({keys} run)"
            side = f"(SELECT *, pos // 3 AS run FROM {name}{k} WHERE n > 1)"
            steps.append(f"""{name}x{k} AS (SELECT {keys} pos, coalesce(before, '') AS before, coalesce(after, '') AS after FROM (
                SELECT {keys.replace('named', 'a.named').replace('src', 'a.src')} a.pos AS pos, {around}
                FROM {side} a JOIN {side} b {using} GROUP BY ALL))""")
    # Each leaf climbs level by level; where a tree is finished nothing is added.
    steps.append("c0 AS (SELECT doc_id, named, src, pos AS own, pos, leaf, candidate AS f, '' AS proof FROM leaves)")
    at = 0
    for name, count in (("s", levels), ("r", source_levels)):
        if name == "r":
            steps.append(f"c{at + 1} AS (SELECT c.* REPLACE (r0.pos AS pos) FROM c{at} c JOIN r0 USING (named, src))")
            at += 1
        join = "x.named = c.named AND x.src = c.src AND x.pos = c.pos" if name == "s" else "x.pos = c.pos"
        for k in range(count):
            steps.append(f"""c{at + 1} AS (SELECT c.* REPLACE (CASE WHEN x.pos IS NULL THEN c.pos ELSE c.pos // 3 END AS pos,
                CASE WHEN x.pos IS NULL THEN f ELSE sha256(concat(x.before, f, x.after)) END AS f,
                concat(proof, x.before, x.after) AS proof) FROM c{at} c LEFT JOIN {name}x{k} x ON {join})""")
            at += 1
    parts = ", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)
    return f"""WITH {parts} SELECT doc_id, leaf, s{levels}.h AS subroot, r{source_levels}.h AS root, sha256(proof) AS proof_sha256,
        f AS folded_root, f = r{source_levels}.h AS verified FROM c{at} JOIN s{levels} USING (named, src), r{source_levels}"""


QUERIES = {
    "op9_minhash_near_dedup": near_documents,
    "op10_benchmark_decontamination": contaminated_documents,
    "op11_exact_dedup": exact_documents,
    "op12_merkle_manifest": verified_documents,
}
SQL: dict[str, str] = {"op11_exact_dedup": EXACT_SQL, "op12_merkle_manifest": _manifest_sql()}
