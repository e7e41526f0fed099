import random

import numpy as np
from data import documents, prose
from test_decontam import brute as windows
from test_neardup import brute as components
from test_neardup import edited
from test_spans import plain_pii

import corpus_pipeline
from roispark.llm import packing, toxicity


def test_stages_match_brute_force(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng, rows, labels, items = random.Random(6), [], [], [(1, prose(900, 30)), (2, prose(901, 6))]
    for i in range(400):
        words = prose(i, 50).split()
        if bad := i % 5 == 0:
            words[3:3] = words[30:30] = ["grobnit", "vlerk", "grobnat", "vlerk"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [(500 + i, edited(rows[i][1], 0.02, i)) for i in range(1, 60, 7)]
    rows += [(600, prose(31, 20) + " " + items[0][1]), (601, prose(32, 20) + " mail a.b@c.de or +1 (555) 010-9999"), (602, None), (603, "")]
    rng.shuffle(rows)
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    kept = [(d, t) for d, t in rows if scores[d] < 0.5]
    assert sum(scores[d] >= 0.5 for d, t in rows if t and "vlerk" in t) > 70
    kept_ids = {c for _, _, c in components(kept, 5)}
    kept = [(d, t) for d, t in kept if d in kept_ids and not windows(t, items)[1]]
    assert 600 not in dict(kept)
    clean = {}
    for d, text in kept:
        out, end = "", 0
        for a, kind, b in plain_pii(text or ""):
            if a >= end:
                out += text[end:a] + ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"][kind]
            end = max(end, b)
        clean[d] = out + (text or "")[end:]

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    found = {}
    for r in sorted(got, key=lambda r: r.start):
        found.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert found == {d: tokenizer.encode(t, add_special_tokens=False).ids + [1] for d, t in clean.items()}


def test_all_but_the_last_stage_return_the_columns_of_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.names == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_python_workers_get_batches_of_bounded_bytes(spark, tmp_path):
    import pyarrow as pa

    documents(spark, [(i, "x" * 100_000) for i in range(100)]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")

    @corpus_pipeline.stage
    def sizes(spark, docs, sf_dir):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

        return docs.mapInArrow(run, "n long")

    got = [r.n for r in sizes(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()]
    assert sum(got) >= 10_000_000 and max(got) < 1.2 * corpus_pipeline.BATCH_BYTES
