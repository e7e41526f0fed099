"""Operators 11 to 13 against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from data import AWKWARD, documents, prose

from pyspark.sql import functions as F
from roispark.llm import blocknames, codes, merkle

LONG = prose(3, 9000)
TEXTS = AWKWARD + [
    (20, "one"), (21, " one"), (22, "\tone  "), (23, " one "), (None, "one"), (None, "only\nunknown"), (None, "only unknown"),
    (24, LONG), (25, LONG.replace(" ", " \n ")), (26, LONG + "x"), (27, LONG[:-1]), (28, "x" + LONG), (29, "a b"), (30, "a b"),
    (31, "abcabcabc"), (32, "abcabcabcabc"), (33, "abcabc"), (34, "🙂🙂🙂🙂"), (35, "🙂🙂🙂")]


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("block", [blocknames.BLOCK, 3])
def test_exact_duplicates_equal_brute_force(spark, block):
    # A block of three characters needs many rounds; the longest texts are left out there.
    rows = [r for r in TEXTS if block > 3 or len(r[1] or "") < 1000] + [(50, prose(1, 90)), (51, prose(1, 90) + " "), (52, prose(1, 91))]
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    found = blocknames.exact_duplicates(documents(spark, rows), block).collect()
    assert len(found) == len(rows)
    by_hash = defaultdict(list)
    for r in found:
        by_hash[r["text_sha256"]].append(r)
    assert set(by_hash) == {hashlib.sha256(t.encode()).hexdigest() for t in groups}
    for text, ids in groups.items():
        own = by_hash[hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        assert sorted(map(str, (r["doc_id"] for r in own))) == sorted(map(str, ids))
        assert {(r["keep_id"], r["group_size"]) for r in own} == {(min(known) if known else None, len(ids))}
        assert [r["doc_id"] for r in own if r["kept"]] == [min(known) if known else None]


def test_names_do_not_rest_on_hashes(spark):
    """With one hash for all blocks the texts themselves decide."""
    blocks = spark.createDataFrame(
        [(i, i, "s", 1, 0, t, 7) for i, t in enumerate(["a", "b", "a", "c", ""])],
        "row long, doc_id long, sha string, n int, pos int, block string, hash long")
    names = {r["row"]: r["name"] for r in blocknames._block_names(blocks).collect()}
    assert names[0] == names[2] and len(set(names.values())) == 4


def test_exact_empty_and_drop(spark):
    assert blocknames.exact_duplicates(documents(spark, TEXTS).limit(0)).count() == 0
    left = blocknames.drop_exact_duplicates(documents(spark, [(1, "a b"), (2, "a  b"), (3, "c"), (None, "c")]))
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 3]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def climb(tree, pos):
    """The siblings before and after each node on the way up."""
    for level in tree[:-1]:
        run = pos // 3 * 3
        yield "".join(level[run:pos]), "".join(level[pos + 1:run + 3])
        pos //= 3


def test_manifest_equals_brute_force(spark):
    rows = [(i, f"t{i}\nx", "big", "en") for i in range(700)] + [(i, "n", None, None) for i in range(5)] + [
        (None, None, "big", "de"), (None, "", "lone", None), (7, "t7\nx", "big", "en"), (7, "other", "big", "en"), (9, "é\n", "é", "fr"),
        *[(i, prose(i, 20_000 if i == 800 else 3), f"s{i % 90}", "") for i in range(800, 1100)]]
    docs = spark.createDataFrame([(i, t, s, g, len(t or ""), "x", 1) for i, t, s, g in rows],
                                 "doc_id long, text string, source string, lang string, n_chars long, tree string, pos int")
    text = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    candidate = merkle.leaf_digest([text if c == "text" else F.col(c) for c in merkle.FIELDS])
    found = merkle.verify(merkle.manifest(docs, candidate)).collect()

    def leaf(r, t):
        i, _, s, g = r
        return sha("".join(map(field, [i, s, g, len(r[1] or ""), t])))

    sources = defaultdict(list)
    for r in rows:
        own = leaf(r, r[1])
        changed = leaf(r, r[1].replace("\n", "") if r[0] is not None and r[0] % 2 == 0 and r[1] is not None else r[1])
        sources[r[2]].append((r[0] is not None, r[0] or 0, own, changed))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(sources[s])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    expected = []
    for k, s in enumerate(names):
        for pos, (known, i, own, changed) in enumerate(sorted(sources[s])):
            f, proof = changed, ""
            for before, after in [*climb(trees[s], pos), *climb(top, k)]:
                f, proof = sha(before + f + after), proof + before + after
            expected.append((i if known else None, own, trees[s][-1][0], top[-1][0], sha(proof), f, f == top[-1][0]))
    got = [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert {r["verified"] for r in found} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_small_manifests(spark, n):
    docs = documents(spark, [(i, f"t{i}") for i in range(n)])
    found = merkle.verify(merkle.manifest(docs)).collect()
    tree = levels([sha("".join(map(field, [i, None, "en", 1, f"t{i}"]))) for i in range(n)]) if n else []
    assert {r["root"] for r in found} == ({tree[-1][0]} if n else set())
    assert len(found) == n and all(r["verified"] for r in found)


def trained(vectors, rounds=codes.ROUNDS):
    """Plain rounds over all entries, in Python integers."""
    q = [[int(np.floor(1024 * float(x))) for x in v] for v in vectors]
    size = len(q[0]) // 4
    parts = [np.array([v[p * size:(p + 1) * size] for v in q], np.int64) for p in range(4)]
    books = [p[:256].copy() for p in parts]

    def nearest(p):
        d = ((parts[p][:, None] - books[p][None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        for p in range(4):
            at, _ = nearest(p)
            for e in set(at.tolist()):
                own = parts[p][at == e]
                books[p][e] = [int(s) // len(own) for s in own.sum(0)]
    last = [nearest(p) for p in range(4)]
    return np.stack([a for a, _ in last], 1), sum(d for _, d in last), np.stack(books)


@pytest.mark.parametrize("n,dims,tracked", [(3000, 16, 16), (900, 8, 5), (90, 4, 16), (1, 4, 16), (1500, 8, 300)])
def test_codes_equal_plain_rounds(spark, n, dims, tracked):
    rng = np.random.default_rng(n)
    # Coarse values make ties; a third of the rows are copies.
    x = np.round(rng.normal(size=(n, dims)) * 8) / 8 - 0.01
    x[rng.random(n) < 0.33] = x[0]
    good = [(i, x[i].tolist(), i % 3 if i % 7 else None) for i in range(n)]
    bad = [(-1, None, 1), (-2, [], 1), (-3, [None] + [1.0] * (dims - 1), 1), (-4, [float("nan")] * dims, 1),
           (-5, [float("inf")] * dims, 1), (n + 9, [1.0] * (dims + 4), 1), (n + 8, [1.0], 1)]
    df = spark.createDataFrame([(*r, "q", 3) for r in bad + good[::-1]],
                               "vec_id long, embedding array<double>, label int, near string, entry int").repartition(3)
    coded, books = codes.compress(df, keep=["label"], tracked=tracked)
    got = {r["vec_id"]: r for r in codes.with_group_error(coded, "label").collect()}
    code, error, expected = trained(x)
    assert (books == expected).all()
    assert sorted(got) == list(range(n))
    group = defaultdict(int)
    for i, _, label in good:
        group[label] += int(error[i])
    for i, _, label in good:
        assert (bytes(got[i]["code"]), got[i]["error"], got[i]["group_error"]) == (bytes(code[i].tolist()), error[i], group[label])


def test_bounds_spare_comparisons_and_stay_safe():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(300, 16)) * 900
    rows = (centres[rng.integers(0, 300, 4000)] + rng.normal(size=(4000, 16)) * 60).astype(np.int64)
    books = rows[:256].copy()
    state, _ = codes.compare_all(rows, books, 16)
    for _ in range(3):
        new = books.copy()
        for e in range(256):
            own = rows[state.near[:, 0] == e]
            new[e] = own.sum(0) // len(own) if len(own) else books[e]
        moved = codes._root(((new - books) ** 2).sum(1), np.inf)
        state, need = codes.reassign(rows, new, moved, state, 16)
        books = new
        d = np.sort(codes.squared(rows, books), 1)
        assert (state.near[:, 0] == codes.squared(rows, books).argmin(1)).all()
        assert (state.upper >= np.sqrt(d[:, 0])).all()
        inside = np.take_along_axis(codes.squared(rows, books), state.near[:, 1:].astype(int), 1)
        assert (state.lower <= np.sqrt(inside)).all()
    # On rows in clusters the bounds settle most parts, and few need all entries.
    assert (need == 0).mean() > 0.5 and (need > 16).mean() < 0.2
    assert codes.next_tracked(np.bincount(need, minlength=18), 16) <= 16


def test_codes_of_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0] * 4, 1)] * 5 + [(None, [2.0] * 4, None)], "vec_id long, embedding array<float>, label int")
    coded, books = codes.compress(df)
    assert books.shape == (4, 6, 1) and coded.count() == 6 and {r["error"] for r in coded.collect()} == {0}
    coded, books = codes.compress(df.limit(0), keep=["label"])
    assert codes.with_group_error(coded, "label").count() == 0 and books.size == 0
    with pytest.raises(ValueError):
        codes._quantised(__import__("pyarrow").array([[1e9] * 4]), 4)
