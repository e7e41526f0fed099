"""Queries of the text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from roispark.llm import pii, secrets
from roispark.llm.common import table
from roispark.llm.licences import scan_licences
from roispark.llm.linededup import dedup_units
from roispark.llm.packing import pack
from roispark.llm.resample import resample
from roispark.llm.toxicity import toxicity


def _written(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def licence_paragraphs(spark, sf_dir):
    return scan_licences(table(spark, sf_dir, "documents"))


def packed_pieces(spark, sf_dir):
    packed = pack(table(spark, sf_dir, "documents"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def toxic_documents(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def secret_spans(spark, sf_dir):
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        *(_count("spans", k) for k in ("assign", "access", "hex")),
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def pii_spans(spark, sf_dir):
    found = pii.scan_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *(_count(base, k) for k in pii.KINDS),
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def deduplicated_units(spark, sf_dir):
    found = dedup_units(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), "removed_words", "removed")


def resampled_documents(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_licence_scan": licence_paragraphs,
    "op2_packing": packed_pieces,
    "op3_toxicity": toxic_documents,
    "op4_secret_scan": secret_spans,
    "op6_substring_dedup": deduplicated_units,
    "op7_importance_resampling": resampled_documents,
    "op8_pii": pii_spans,
}
SQL: dict[str, str] = {}
