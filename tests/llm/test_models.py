import random

import numpy as np
import pytest
from data import AWKWARD, documents, prose

from roispark.llm import forest, licences, linededup, resample, toxicity
from roispark.session import collecting


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 60).split()
        bad = i % 4 == 0
        for _ in range(4 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["grobnit", "grobnat", "vlerk"])
        rows.append((100 + i, " ".join(words)))
        labels.append((100 + i, int(i % 5 > 0), int(bad)))
    return documents(spark, rows + AWKWARD), spark.createDataFrame(labels + [(None, 1, 1), (100, None, None)], "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    got = toxicity.toxicity(docs, labels).join(labels.where("doc_id is not null and toxic is not null"), "doc_id").where("held_out").collect()
    assert len(got) > 80
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.95
    every = toxicity.toxicity(docs, labels).collect()
    assert len(every) == docs.count() and all(0 <= r.score <= 1 for r in every)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns


def plain_ratios(taught, asked):
    """log-likelihood ratio of each word by Kneser-Ney models of full order over dictionaries."""
    own, shared, top = ({0: {}, 1: {}}, {}, toxicity.ORDER)
    for text, toxic in taught:
        for word in text.lower().split():
            w = f"^{word}$"
            for i in range(1, len(w)):
                g = w[max(0, i + 1 - top):i + 1]
                own[toxic][g] = own[toxic].get(g, 0) + 1
    levels = {}
    for k in range(top, 0, -1):
        for o in (0, 1) if k >= toxicity.OWN else (-1,):
            tables, found = [own[o]] if o >= 0 else [own[0], own[1]], {}
            for table in tables:
                for g, n in table.items():
                    if len(g) == k:
                        found[g] = found.get(g, 0) + n
            for g in {g for x in ((0, 1) if o < 0 and k + 1 >= toxicity.OWN else (o,)) for g in levels.get((x, k + 1), {})}:
                found[g[1:]] = found.get(g[1:], 0) + 1
            levels[o, k] = found
    d, ctx = toxicity.DISCOUNT, {}
    for at, found in levels.items():
        for g, n in found.items():
            total, kinds = ctx.get((at, g[:-1]), (0, 0))
            ctx[at, g[:-1]] = (total + n, kinds + 1)

    def p(o, g):
        k = len(g)
        at = (o if k >= toxicity.OWN else -1, k)
        total, kinds = ctx.get((at, g[:-1]), (0, 0))
        if g in levels[at]:
            n = levels[at][g]
            return max(n, d) / total if k == 1 else (max(n - d, 0) + d * kinds * p(o, g[1:])) / total
        back = np.exp(-8.0) if k == 1 else p(o, g[1:])
        return back * (max(d * kinds / total, 1e-9) if total and k > 1 else 1)

    def ratio(word):
        w = f"^{word}$"
        grams = [w[max(0, i + 1 - top):i + 1] for i in range(1, len(w))]
        return sum(np.log(p(1, g)) - np.log(p(0, g)) for g in grams)

    return {w: ratio(w) for w in asked}


def test_toxicity_models_match_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 2_000)
    # Words that differ by six and more symbols only, so shorter n-grams are the same in both classes.
    odd = ["xabcdefy", "zabcdefw", "xabcdefw", "zabcdefy"]
    rows = [(i, f"{prose(i, 12)} {odd[i % 2 + 2 * (i % 3 == 0)]} {prose(i % 7, 3)}") for i in range(90)]
    toxic = {i: int(i % 3 == 0) for i, _ in rows}
    blocks = toxicity._blocks(documents(spark, rows).select("doc_id", "text"))
    assert blocks.count() > 4
    marks = spark.createDataFrame([(i, t, int(i % 4 == 1)) for i, t in toxic.items()], "doc_id long, toxic int, held int")
    labelled = blocks.selectExpr("block", "posexplode(ids) as (place, doc_id)").join(marks, "doc_id").select("block", "place", "toxic", "held")
    lessons = toxicity.taught(blocks, labelled)
    for kinds, taught in (((0, 1, 2, 3), rows), ((0, 1), [r for r in rows if r[0] % 4 != 1])):
        model = toxicity.base(lessons, kinds)
        words = sorted({w for _, t in rows for w in t.split()} | {"xabcdefg", "ünsëen", "q"})
        want = plain_ratios([(t, toxic[i]) for i, t in taught], words)
        ask = toxicity._blocks(documents(spark, [(n, w) for n, w in enumerate(words)]).select("doc_id", "text"))
        got = toxicity.answered(lessons.unionByName(toxicity.asked(ask)), [(model, kinds)])
        told = got.groupBy("block").agg({"*": "count"}).count()
        assert told == ask.count()
        by = {}
        for r in got.collect():
            by.setdefault(r.block, []).append({"shard": r.shard, "r": r.r0})
        for b in ask.collect():
            x = toxicity._block_features(toxicity.text_of(toxicity._body(toxicity.pa.scalar(bytes(b.body)))), by[b.block])
            for n, (total, has) in zip(b.ids, x[:, [3, 2]]):
                assert has == 1 and abs(total - want[words[n]]) < 1e-3, words[n]
    assert want["xabcdefy"] != want["xabcdefw"]


def test_toxicity_packs_numbers():
    for values in (np.array([], np.int64), np.array([3, -1, 2**62, 0]), np.array([0.5, -2, np.inf], np.float32)):
        assert toxicity._unpack(toxicity._pack(values), values.dtype.type).tolist() == values.tolist()


def test_toxicity_moves_each_ngram_in_few_bytes(monkeypatch):
    monkeypatch.setattr(toxicity, "SHARDS", 4)  # in this process only
    texts = toxicity.pa.array([prose(i, 80) for i in range(200)], toxicity.pa.large_string())
    code = np.unique(np.concatenate([toxicity._word_codes(part)[3] for part in toxicity.slices(texts, toxicity.ALNUM)]))
    sent = toxicity._send(4, 0, code).column("codes").to_pylist()
    assert len(sent) == 4 and sum(map(len, sent)) < 5 * len(code)


def test_toxicity_answers_the_second_model_for_held_rows_only(spark):
    rows = [(i, f"{prose(i, 12)} {'grobnit' if i % 3 == 0 else 'vlerk'}") for i in range(60)]
    toxic, held = {i: int(i % 3 == 0) for i, _ in rows}, {i for i, _ in rows if i % 4 == 1}
    blocks = toxicity._blocks(documents(spark, rows).select("doc_id", "text"))
    marks = spark.createDataFrame([(i, t, int(i in held)) for i, t in toxic.items()], "doc_id long, toxic int, held int")
    labelled = blocks.selectExpr("block", "posexplode(ids) as (place, doc_id)").join(marks, "doc_id").select("block", "place", "toxic", "held")
    lessons = toxicity.taught(blocks, labelled)
    models = [(toxicity.base(lessons, kinds), kinds) for kinds in ((0, 1, 2, 3), (0, 1))]
    got = toxicity.answered(lessons.unionByName(toxicity.asked(blocks)), models).collect()
    assert {r.kind for r in got if r.r0 is not None} == {4} and {r.kind for r in got if r.r1 is not None} == {2, 3}
    words = sorted({w for _, t in rows for w in t.split()})
    want = plain_ratios([(t, toxic[i]) for i, t in rows if i not in held], words)
    texts = dict(rows)
    for b in blocks.collect():
        for kind in (2, 3):
            mine = [texts[i] for i in b.ids if i in held and toxic[i] == kind - 2]
            told = [{"shard": r.shard, "r": r.r1} for r in got if r.block == b.block and r.kind == kind]
            x = toxicity._block_features(toxicity.pa.array(mine, toxicity.pa.large_string()), told)
            assert np.allclose(x[:, 3], [sum(want[w] for w in t.split()) for t in mine], atol=1e-2)


def test_toxicity_reads_blocks_in_pieces_and_keeps_no_lessons(labelled, monkeypatch):
    docs, labels = labelled
    want = {(r.doc_id, r.held_out): r.score for r in toxicity.toxicity(docs, labels).where("doc_id >= 100").collect()}
    monkeypatch.setattr(toxicity, "SLICE", 1_000)
    blocks = toxicity._blocks(docs.coalesce(1).select("doc_id", "text")).collect()
    assert max(len(list(toxicity._pieces(toxicity.pa.scalar(bytes(b.body))))) for b in blocks) > 10
    kept = []
    with collecting(kept):
        got = {(r.doc_id, r.held_out): r.score for r in toxicity.toxicity(docs, labels).where("doc_id >= 100").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert kept and not any("codes" in t.columns for t in kept)


def test_toxicity_blocks_gather_small_batches(spark):
    rows = documents(spark, [(i, prose(i, 40)) for i in range(300)]).coalesce(1).select("doc_id", "text")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 4_000)
    try:
        blocks = toxicity._blocks(rows).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert len(blocks) == 1 and len(list(toxicity._pieces(toxicity.pa.scalar(bytes(blocks[0].body))))) > 5
    assert sorted(blocks[0].ids) == list(range(300))
    places = [250, 3, 100]
    got = [t for piece in toxicity._chosen(toxicity.pa.scalar(bytes(blocks[0].body)), places) for t in piece.to_pylist()]
    assert got == [prose(blocks[0].ids[p], 40) for p in sorted(places)]


def test_words_are_hashed_in_little_memory():
    import tracemalloc

    from roispark.llm.text import SPACED, slices

    texts = toxicity.pa.array([prose(i, 2_000) for i in range(300)], toxicity.pa.large_string())
    size = texts.buffers()[2].size
    tracemalloc.start()
    try:
        words = [len(part.word) for part in slices(texts, SPACED, 1 << 22)]
        assert sum(words) == 600_000 and tracemalloc.get_traced_memory()[1] < 24 * size
    finally:
        tracemalloc.stop()


def test_toxicity_counts_all_rows_and_needs_no_second_class(spark):
    """Every toxic label is in the fold that fits the last step, or none is: the models still reject."""
    import zlib

    for fold in (1, 2):
        rows, labels = [], []
        for i in range(400):
            mine = zlib.crc32(str(i).encode()) % 5
            bad = mine == fold and i % 2 == 0
            show = bad or (mine == 0 and i % 2 == 0)
            rows.append((i, prose(i, 40) + " grobnitvlerk" * (6 * show)))
            labels.append((i, 1, int(bad)))
        got = {r.doc_id: r for r in toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
        assert all(got[i].predicted == 1 for i, text in rows if "vlerk" in text)
        assert np.mean([got[i].predicted == 0 for i, text in rows if "vlerk" not in text]) > 0.9


def test_toxicity_without_labels(spark):
    docs = documents(spark, AWKWARD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    assert toxicity.toxicity(documents(spark, []), none).count() == 0


def test_sample_prefers_the_target(labelled, spark):
    docs, labels = labelled
    got = resample.resample(docs, labels).collect()
    assert len(got) == docs.count()
    assert abs(sum(r.kept for r in got) - len(got) / 2) <= 2
    keys = sorted((r.gumbel_key for r in got), reverse=True)
    assert all(r.kept == (r.gumbel_key >= keys[round(len(got) / 2) - 1]) for r in got)
    assert resample.resample(documents(spark, []), labels).count() == 0


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(resample, "_FEW", 5)
    values = [random.Random(1).gauss(0, 50) for _ in range(500)] + [3.0] * 40
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 250, 540):
        assert resample.kth_largest(rows, "v", k) == sorted(values, reverse=True)[k - 1]


def test_units_are_kept_once(spark):
    shared = "This very sentence is in every text. Yes. It is followed by another shared sentence."
    rows = [(i, f"{prose(i, 9)}. {shared} {prose(50 + i, 7)}.\nA line that all of them have\nshort") for i in range(20)] + AWKWARD
    got = {(r.doc_id, r.text): r for r in linededup.dedup_units(documents(spark, rows)).collect()}
    by = {}
    for (d, _), r in got.items():
        by.setdefault(d, []).append(r)
    assert by[0][0].text == rows[0][1] and by[0][0].removed == []
    for i in range(1, 20):
        r, text = by[i][0], rows[i][1]
        assert "every text" not in r.text and "Yes." not in r.text and "all of them" not in r.text and prose(i, 9) in r.text
        gone = "".join(text[s.start:s.end] for s in r.removed)
        assert len(gone) + len(r.text) == len(text)
    assert linededup.dedup_units(documents(spark, [])).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 1500)] + 0.3 * rng.normal(size=(1500, 16))
    x[200:260] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [
        (2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [1.0]), (2200, []), (2250, [None] * 16), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in forest.nearest(table).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 50))
    unit, hits = x / np.linalg.norm(x, axis=1, keepdims=True), 0
    for q, found in got.items():
        score = np.round(unit @ unit[q], 12)
        score[q] = -9
        want = np.lexsort((np.arange(1500), -score))[:5]
        hits += len(set(want) & {v for _, v, _ in found})
        assert sorted(r for r, _, _ in found) == [1, 2, 3, 4, 5]
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in found)
    assert hits / (5 * len(got)) >= 0.9
    assert [v for _, v, _ in sorted(got[200])] == [0, 201, 202, 203, 204]
    assert forest.nearest(table.limit(0)).count() == 0


def test_repeated_query_rows_do_not_fill_a_class(spark):
    v, w = [1.0, 2.0, 0.5], [2.0, -1.0, 0.0]
    # 9 and 10 point the way of 0 and 8: equal scores, the smaller id first.
    rows = [(0, v)] * 9 + [(7, v), (8, v), (10, [4.0, 8.0, 2.0]), (9, [0.5, 1.0, 0.25]), (11, w)]
    found = forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [7, 8, 9, 10, 11]
    assert {r.query_id for r in found} == {0} and [r["rank"] for r in sorted(found, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]


def test_licences(spark):
    rows = AWKWARD + [(50, prose(1, 20) + "\nLicensed under the Apache License, Version 2.0.\n" + prose(2, 5)),
                      (51, "She asked for permission to renew her driving license."), (52, "Released under the MIT License.")]
    docs = documents(spark, rows)
    model = licences.train(docs)
    got = {r.doc_id: r for r in licences.scan_licences(docs, model).collect()}
    assert got[50].family == "apache" and got[52].family == "mit" and got[51].family == "unknown"
    assert rows[-3][1][got[50].start:got[50].end] == "Licensed under the Apache License, Version 2.0."
    texts = documents(spark, [(i, t) for i, (_, t) in enumerate(licences.TEMPLATES)])
    assert {r.doc_id: r.family for r in licences.scan_licences(texts, model).collect()} == {
        i: f for i, (f, _) in enumerate(licences.TEMPLATES)}
    assert licences.scan_licences(documents(spark, []), model).count() == 0


def test_wrapped_licences(spark):
    import textwrap

    texts = [t for _, t in licences.TEMPLATES if len(t) > 90]
    rows = []
    for i, t in enumerate(texts):
        leader = [" * ", "# ", "// ", "", "REM "][i % 5]
        wrapped = textwrap.wrap(t, 40)
        rows.append((i, "\n".join([prose(i, 8), *(leader + line for line in wrapped), prose(i + 50, 7)])))
    rows.append((100, prose(3, 9) + "\nLicensed under CC BY-NC 4.0.\n" + prose(4, 8)))
    model = licences.train(documents(spark, rows))
    got = {}
    for r in licences.scan_licences(documents(spark, rows), model).collect():
        got.setdefault(r.doc_id, []).append(r)
    family = {t: f for f, t in licences.TEMPLATES}
    for i, t in enumerate(texts):
        assert [r.family for r in got[i]] == [family[t]], t
        assert rows[i][1][got[i][0].start:got[i][0].end].split("\n") == rows[i][1].split("\n")[1:-1]
        assert got[i][0].paragraph == 1
    assert [(r.family, rows[-1][1][r.start:r.end]) for r in got[100]] == [("cc-by-nc", "Licensed under CC BY-NC 4.0.")]
