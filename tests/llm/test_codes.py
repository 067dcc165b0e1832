import math
import random

import numpy as np
import pytest

from riskframe.llm import codes


def slow_nearest(x, entries):
    d = ((x[:, None, :] - entries[None]) ** 2).sum(-1)
    return d.argmin(axis=1), d.min(axis=1)


@pytest.mark.parametrize("k,width,spread", [(1, 1, 5), (3, 2, 4), (64, 3, 6), (65, 8, 300), (256, 16, 200), (256, 16, 1)])
def test_nearest_is_exact_with_ties_to_the_lower_index(k, width, spread):
    rng = np.random.default_rng(k + width)
    entries = rng.integers(-spread, spread + 1, (k, width))
    x = np.concatenate([rng.integers(-3 * spread, 3 * spread + 1, (500, width)), entries, entries + 100 * spread])
    got, apart = codes.Slices(entries).nearest(x)
    want, least = slow_nearest(x, entries)
    assert (got == want).all() and (apart == least).all()


def test_masks_hold_just_the_entries_in_the_box():
    rng = np.random.default_rng(3)
    entries, x = rng.integers(-20, 21, (130, 4)), rng.integers(-20, 21, (40, 4))
    mask = codes.Slices(entries).box(x, np.full(40, 9))
    got = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(bool)
    assert (got == (np.abs(x[:, None] - entries[None]).max(-1) <= 9)).all()


def rows_of(n, width=8, seed=1):
    rng = random.Random(seed)
    return [(i * 7 % 1000, [rng.gauss(0, 0.2) for _ in range(width)], rng.choice([None, 0, 1, 1, 1])) for i in range(n)]


ODD = [(None, [0.1] * 8, None), (5000, None, 3), (5001, [0.1] * 7 + [None], 3), (5002, [float("nan")] * 8, 3), (5003, [float("inf")] + [0.0] * 7, 3), (5004, [], 1),
       (0, [0.5] * 8, 1), (0, [0.5] * 8, 1)]


def slow(rows, k):
    """The contract by hand: Python integers, no masks."""
    kept = [(i, [math.floor(1024 * c) for c in v], lab) for i, v, lab in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted((i, v) for i, v, _ in kept if i is not None)[:k]
    books = [[v[2 * p : 2 * p + 2] for _, v in first] for p in range(4)]
    pick = lambda p, v: min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), j) for j, e in enumerate(books[p]))
    for _ in range(4):
        for p in range(4):
            own = {}
            for _, v, _ in kept:
                own.setdefault(pick(p, v[2 * p : 2 * p + 2])[1], []).append(v[2 * p : 2 * p + 2])
            books[p] = [[sum(c) // len(own[j]) for c in zip(*own[j], strict=True)] if j in own else e for j, e in enumerate(books[p])]
    out = []
    for i, v, lab in kept:
        best = [pick(p, v[2 * p : 2 * p + 2]) for p in range(4)]
        out.append((i, [j for _, j in best], sum(d for d, _ in best), lab))
    return books, out


def test_against_brute_force_with_odd_rows(spark):
    data = rows_of(120) + ODD
    df = spark.createDataFrame([(*r, 1, 2, "x", 9) for r in data], "vec_id long, embedding array<float>, label int, id int, v int, error string, _hot_key int").repartition(5)
    exact = [(r.vec_id, r.embedding, r.label) for r in df.collect()]  # as stored in floats
    books, want = slow(exact, 40)
    got = codes.fit_codebooks(df, entries=40)
    assert [b.tolist() for b in got.entries] == books
    enc = codes.encode(df, got)
    assert enc.columns == ["vec_id", "embedding", "label", "id", "v", "_hot_key", "codes", "error"]
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2], str(t[3]))
    assert sorted([(r.vec_id, r.codes, r.error, r.label) for r in enc.collect()], key=key) == sorted(want, key=key)
    by = {}
    for _, _, e, lab in want:
        by[lab] = by.get(lab, 0) + e
    assert {(r.label, r.label_error) for r in codes.error_by_label(enc.drop("_hot_key")).collect()} == set(by.items())


def test_hot_labels_meet_a_broadcast(spark, monkeypatch):
    from riskframe.llm import hot
    monkeypatch.setattr(hot, "HOT_ROWS", 20)
    df = spark.createDataFrame([(i, 3, None if i % 3 == 0 else "a" if i % 3 == 1 else str(i)) for i in range(120)], "vec_id long, error long, label string")
    got = codes.error_by_label(df).collect()
    assert len(got) == 120 and all(r.label_error == (120 if r.vec_id % 3 < 2 else 3) for r in got)


def test_decode_and_digest():
    b = codes.Codebooks([np.array([[1, -2], [3, 4]]), np.array([[5, 6]])], 4)
    assert b.decode(np.array([[1, 0], [0, 0]])).tolist() == [[3, 4, 5, 6], [1, -2, 5, 6]]
    import hashlib
    assert b.sha256() == hashlib.sha256(b"1,-2,3,4,5,6").hexdigest()


def test_empty_few_and_wrong_widths(spark):
    schema = "vec_id long, embedding array<float>, label int"
    empty = spark.createDataFrame([], schema)
    books = codes.fit_codebooks(empty)
    assert books.entries == [] and codes.error_by_label(codes.encode(empty, books)).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.25, 0.0, -0.1], None)], schema)
    books = codes.fit_codebooks(one)
    r = codes.encode(one, books).first()
    assert r.codes == [0, 0, 0, 0] and r.error == 0 and books.entries[3].tolist() == [[-103]]
    for bad in ([(1, [0.5] * 4, 0), (2, [0.5] * 8, 0)], [(1, [0.5] * 6, 0)], [(1, [1e9] * 4, 0)]):
        with pytest.raises(Exception, match="components|magnitude"):
            codes.encode(spark.createDataFrame(bad, schema), codes.fit_codebooks(spark.createDataFrame(bad, schema))).collect()
