"""The random field of operator 8 by itself."""

import itertools
import random

import numpy as np
import pytest
from data import documents, prose

from roispark.llm import pii


def plain_marginals(field, g):
    """Beliefs by enumeration of all labellings."""
    n, local = len(g.x), g.x @ field.unary
    total = np.zeros((n, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        score = sum(local[i, a] for i, a in enumerate(labels))
        score += sum(field.chain[labels[i], labels[j]] for i, j in g.chain) + sum(field.skip[labels[i], labels[j]] for i, j in g.skip)
        total[range(n), labels] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("chain,skip", [([(0, 1), (1, 2)], [(0, 3), (3, 4)]), ([], [(0, 4), (1, 4), (2, 4), (3, 4)]), ([], []),
                                        ([(0, 1), (1, 2), (2, 3), (3, 4)], [])])
def test_messages_give_exact_beliefs_on_trees(chain, skip):
    rng = np.random.default_rng(len(chain))
    x = rng.normal(size=(5, 3))
    field = pii.Field(rng.normal(size=(3, pii.LABELS)), *(rng.normal(size=(pii.LABELS, pii.LABELS)) for _ in range(2)))
    edges = [np.array(e, np.int64).reshape(-1, 2) for e in (chain, skip)]
    g = pii.Graph([(i, i + 1) for i in range(5)], x, np.zeros(5, np.int64), *edges)
    assert np.allclose(field.marginals(g), plain_marginals(field, g), atol=2e-3)


def test_distant_repeats_share_their_label(spark):
    rng = random.Random(2)
    rows, places = [], []
    for i in range(400):
        number = f"{rng.randint(200, 999)}555{rng.randint(1000, 9999)}"
        head = f"{prose(i, 6)} +1{number} {prose(i + 1, 8)} "
        places.append((len(head), len(head) + len(number)) if i % 4 == 0 else None)
        rows.append((i, head + (number if i % 4 == 0 else f"{rng.randint(10**9, 10**10 - 1)}") + f" {prose(i + 3, 4)}"))
    field = pii.fit_field(documents(spark, rows))
    gain, phone = [], 1 + pii.KINDS.index("phone")
    for (_, text), place in zip(rows, places):
        g = pii.graph_of(text, pii.base_spans(text))
        at = len(g.bounds) - 1
        assert (len(g.skip) == 1) == (place is not None) or len(g.bounds) < 2
        if place:
            assert g.bounds[at] == place and g.label[at] == 0
            alone = pii.Graph(g.bounds, g.x, g.label, g.chain, g.skip[:0])
            gain.append(field.marginals(g)[at, phone] - field.marginals(alone)[at, phone])
    # The link alone, not the token's own features, moves the belief towards the kind of the number that it repeats.
    assert len(gain) == 100 and min(gain) > 0
