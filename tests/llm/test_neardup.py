import random

from data import AWKWARD, documents, prose

from roispark.llm.neardup import drop_near_duplicates, near_duplicates


def brute(rows, k):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(d)
    least = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return sorted(((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def edited(text, share, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = "new" + str(rng.randrange(10**6))
    return " ".join(words)


def test_components_match_brute_force(spark):
    base = [prose(s, 120) for s in range(6)]
    rows = [(n, edited(base[n % 6], (n % 9) / 60, n)) for n in range(90)] + [(200 + n, base[0]) for n in range(5)] + AWKWARD
    for k in (2, 5):
        got = near_duplicates(documents(spark, rows), k).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, k)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.component_id is not None)


def test_one_of_each_group_stays_with_all_columns(spark):
    rows = [(300 + n, edited(prose(1, 200), 0.02, n)) for n in range(40)] + AWKWARD
    docs = documents(spark, rows)
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns
    ids = sorted((r.doc_id for r in out.collect()), key=str)
    kept = {c for _, _, c in brute(rows, 5)}
    assert set(ids) == kept and len(ids) == len(set(ids))


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert drop_near_duplicates(documents(spark, [])).count() == 0
