"""Operators 6 and 7 against plain versions of themselves."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from data import documents, prose

from roispark.llm import linededup, resample
from roispark.llm.text import ALNUM, slices


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_units(text):
    """(start, end, words) of every unit with words, in order."""
    starts = sorted({0, *(m.end() for m in re.finditer(r"\n|(?<=[.!?])[\x20\x09-\x0D]", text))} - {len(text)})
    bounds = zip(starts, [*starts[1:], len(text)])
    return [(a, b, tuple(words(text[a:b]))) for a, b in bounds if words(text[a:b])]


def plain_dedup(rows):
    places = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        found = plain_units(text or "")
        for u, (a, b, w) in enumerate(found):
            if len(w) >= linededup.LEAST_WORDS:
                places[w].append((doc, u, i, a, b))
            elif u:
                places[found[u - 1][2], w].append((doc, u, i, a, b))
    gone = defaultdict(list)
    for found in places.values():
        for _, _, i, a, b in sorted(found)[1:]:
            gone[i].append((a, b))
    return gone


def test_units_equal_plain_version(spark):
    rng = random.Random(8)
    parts = [prose(900 + i, rng.choice([2, 3, 4, 5, 6, 9])) + rng.choice([".", "!", "?", "", ","]) for i in range(40)]
    parts += ["Ünïcode wörter über alles hinaus.", "UPPER words IN a LINE here", "...", "ok", "5.5 and 3.2 are numbers of it."]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(parts) + rng.choice(["\n", " ", "\n\n", "\t", "  "]) for _ in range(rng.randrange(12)))
        rows.append((i * 3 % 151, text if i % 9 else text.swapcase()))
    rows += [(500, rows[3][1]), (501, "ok"), (502, "ok\nok\nok"), (503, None)]
    want = plain_dedup(rows)
    got = {r.doc_id: r for r in linededup.dedup_units(documents(spark, rows)).collect()}
    assert len(got) == len(rows) and sum(map(len, want.values())) > 100
    for i, (doc, text) in enumerate(rows):
        spans = sorted(want[i])
        assert [(s.start, s.end) for s in got[doc].removed] == spans, (doc, text)
        if text is not None:
            kept = "".join(c for at, c in enumerate(text) if not any(a <= at < b for a, b in spans))
            assert got[doc].text == kept
            assert got[doc].removed_words == sum(len(words(text[a:b])) for a, b in spans)


def bucket(gram):
    """The bucket of one gram by itself."""
    part = next(iter(slices(pa.array([" ".join(gram)]), ALNUM)))
    return int(resample.grams(part)[0][-1])


def test_weights_equal_plain_version(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice((GOOD if i % 3 else BAD) if rng.random() < 0.3 else COMMON) for _ in range(rng.randrange(40))))
            for i in range(300)] + [(900, "Word"), (901, ""), (902, None)]
    quality = {i: int(i % 3 > 0) for i in range(0, 200)}
    labels = spark.createDataFrame([(i, q, 0) for i, q in quality.items()], "doc_id long, quality int, toxic int")
    grams = {i: [(w,) for w in words(t or "")] + list(zip(words(t or ""), words(t or "")[1:])) for i, t in rows}
    at = {g: bucket(g) for g in {g for gs in grams.values() for g in gs}}
    raw, target = (np.full(resample.BUCKETS, resample.SMOOTHING) for _ in range(2))
    for i, gs in grams.items():
        for g in gs:
            raw[at[g]] += 1
            target[at[g]] += quality.get(i, 0)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in resample.resample(docs, labels).collect()}
    # Without a target all weights are 0: the keys are the noise, which labels do not change.
    noise = {r.doc_id: r for r in resample.resample(docs, labels.where("quality > 1")).collect()}
    for i, gs in grams.items():
        assert got[i].n_grams == len(gs) and got[i].log_weight == pytest.approx(sum(ratio[at[g]] for g in gs), abs=1e-9)
        assert noise[i].log_weight == 0 and got[i].gumbel_key == pytest.approx(got[i].log_weight + noise[i].gumbel_key, abs=1e-9)
    best = sorted(got, key=lambda i: -got[i].gumbel_key)[:round(len(rows) / 2)]
    assert {i for i, r in got.items() if r.kept} == set(best)
    # Unlabelled documents like the target weigh more and are kept more often.
    for column in ("log_weight", "kept"):
        poor, fine = (np.mean([getattr(got[i], column) for i in range(200, 300) if (i % 3 > 0) == good]) for good in (False, True))
        assert fine > poor
    values = [r.gumbel_key for r in noise.values()]
    assert abs(np.mean(values) - 0.5772) < 0.25 and abs(np.var(values) - np.pi**2 / 6) < 0.6


GOOD, BAD, COMMON = ([f"{stem}{i}" for i in range(12)] for stem in ("fine", "poor", "word"))
