import random

import numpy as np
import pytest
from frames import ODD, docs_frame, passages
from test_parity import shingles

from riskframe.llm import links, parity


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    out = []
    for i, (doc, _) in enumerate(rows):
        if doc is None:
            out.append((None, None, None, None))
            continue
        like = [j for j, (d, _) in enumerate(rows) if d is not None and j != i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
        cls = min([doc, *(rows[j][0] for j in like if sets[j] == sets[i])])
        out.append((doc, len(sets[i]), cls, len(like)))
    return sorted(out, key=str)


def counted(df, **settings):
    return sorted((tuple(r) for r in links.link_counts(df, **settings).select("doc_id", "n_shingles", "class_id", "n_links").collect()), key=str)


@pytest.mark.parametrize("small,sets", [(8, 512), (2, 4)])
def test_counts(spark, monkeypatch, small, sets):
    monkeypatch.setattr(parity, "SMALL_GROUP", small)
    monkeypatch.setattr(links, "BLOCK_SETS", sets)
    rows = passages(11, docs=80) + ODD + passages(11, docs=80)[:4]
    assert counted(docs_frame(spark, rows).repartition(3), part_docs=10) == brute(rows)


def test_family_of_near_copies(spark, monkeypatch):
    """One component whose members are linked to some of the others only, in blocks of few sets and shingles."""
    monkeypatch.setattr(parity, "SMALL_GROUP", 2)
    monkeypatch.setattr(links, "BLOCK_SHINGLES", 3000)
    monkeypatch.setattr(links, "CELLS", 2000)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(40):
        x = base[: rng.choice([300, 330, 400])]
        for _ in range(rng.choice([0, 2, 6, 10, 14])):
            x[rng.randrange(len(x))] = f"e{rng.randrange(9)}"
        rows.append((i, " ".join(x)))
    expected = brute(rows)
    assert len({n for *_, n in expected}) > 5
    assert counted(docs_frame(spark, rows, extra=False).repartition(4)) == expected


def test_intersections(monkeypatch):
    monkeypatch.setattr(links, "CELLS", 64)
    rng = np.random.default_rng(2)
    x, y = ([np.unique(rng.integers(0, 50, rng.integers(0, 40))).astype(np.uint64) for _ in range(n)] for n in (7, 5))
    assert links.intersections(x, y).tolist() == [[len(np.intersect1d(a, b)) for b in y] for a in x]
    assert links.intersections([np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]).tolist() == [[0]]


def test_empty(spark):
    assert links.link_counts(docs_frame(spark, [])).count() == 0
