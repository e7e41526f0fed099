import bisect
import random
from collections import Counter

import numpy as np
from data import AWKWARD, documents, prose

from roispark.llm import packing


def greedy(lengths, window):
    """Best-fit decreasing one item at a time; the remaining capacities."""
    left = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(left, n)
        c = left.pop(i) if i < len(left) else window
        bisect.insort(left, c - n)
    return left


def test_layout_is_best_fit_decreasing():
    for seed in range(30):
        rng = random.Random(seed)
        lengths = [rng.randint(1, 63) for _ in range(rng.randint(0, 400))]
        runs, used, seen = packing.layout(Counter(lengths), 64), Counter(), Counter()
        for length, rank, count, each, first, offset in runs:
            assert rank == seen[length]
            seen[length] += count * each
            for i in range(count):
                assert used[first + i] == offset
                used[first + i] += length * each
        assert seen == Counter(lengths)
        assert sorted(64 - u for u in used.values()) == greedy(lengths, 64)


def test_pieces_hold_every_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = AWKWARD + [(30 + n, prose(n, 5 + 37 * n)) for n in range(20)] + [
        (60, "It's 3.5% <|endoftext|> <|ENDOFTEXT|> ΣΑΣ. é!  x\x1cy")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    packed = packing.pack(documents(spark, rows)).collect()
    texts = {}
    for d, t in rows:
        texts.setdefault(d, t)
    parts = {}
    for r in packed:
        parts.setdefault(r.row, []).append(r)
    assert len(parts) == len(rows)
    for own in parts.values():
        ids = b"".join(bytes(r.ids) for r in sorted(own, key=lambda r: r.start))
        want = tokenizer.encode(texts[own[0].doc_id] or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert all(r.doc_tokens == len(want) and r.length * 4 == len(r.ids) for r in own)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    filled = packing.sequences(packing.pack(documents(spark, rows))).collect()
    for r in filled:
        size = len(r.input_ids) // 4
        assert size == packing.WINDOW or (size == r.n_tokens and size & (size - 1) == 0)


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).count() == 0
