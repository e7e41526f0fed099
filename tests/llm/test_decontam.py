import re

from data import AWKWARD, documents, prose

from roispark.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        v = words(item)
        n = min(10, len(v))
        for j in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[j:j + n]:
                    hit |= set(range(p, p + n))
                    names.add(name)
    return len(w), len(hit), sorted(str(n) for n in names if n is not None)


ITEMS = [(1, prose(1, 40)), (2, prose(2, 12).upper() + "!"), (3, "Short item."), (4, prose(1, 25)), (5, None), (6, ""), (7, "zzz"),
         (None, prose(3, 15)), (2, prose(5, 11))]


def test_hits_match_brute_force(spark, monkeypatch):
    long = prose(1, 40).split()
    rows = [(20, prose(9, 50) + " " + prose(1, 40) + ". " + prose(8, 30)), (21, " ".join(long[5:15])), (22, " ".join(long[5:14])),
            (23, "a short ITEM here, zzz and short-item"), (24, prose(2, 12) + " " + prose(2, 12)), (25, prose(3, 15)),
            (26, prose(5, 11))] + [r for r in AWKWARD if r[0] != 7]
    docs, items = documents(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = sorted(((d, *brute(t, ITEMS)) for d, t in rows), key=str)
    for size in (decontam.PASS_WORDS, 30):
        monkeypatch.setattr(decontam, "PASS_WORDS", size)
        got = decontam.contamination(docs, items).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == expected
        kept = decontam.decontaminate(docs, items)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _, n, _ in expected if not n), key=str)
    whole = next(r for r in got if r.doc_id == 20)
    assert (50, 40) in {(m.word, m.words) for m in whole.matches if m.item_id == "1"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(documents(spark, []), none).count() == 0
    assert [r.n_hit for r in decontam.contamination(documents(spark, [(1, "a b")]), none).collect()] == [0]
