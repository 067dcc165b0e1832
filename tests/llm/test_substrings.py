import hashlib
import random

import numpy as np
import pytest
import xxhash
from frames import ODD, docs_frame, passages

from riskframe.llm import substrings
from riskframe.llm.common import grams
from riskframe.llm.fmindex import FMIndex


def by_window(texts, values, queries, depth, none):
    least = {}
    for t, v in zip(texts, values, strict=True):
        for i in range(len(t) - depth + 1):
            w = tuple(t[i:i + depth])
            least[w] = min(v, least.get(w, v))
    return [least.get(tuple(q[i:i + depth]), none) if i + depth <= len(q) else none for q in queries for i in range(len(q))]


@pytest.mark.parametrize("seed", range(30))
def test_index_against_windows(seed):
    rng = random.Random(seed)
    top, depth = rng.choice([1, 2, 3, 6, 40]), rng.choice([2, 3, 5, 13])
    one = lambda: [rng.randint(1, top) for _ in range(rng.randint(1, 30))]
    texts = [one() for _ in range(rng.randint(1, 25))]
    values = [rng.randint(0, 50) for _ in texts]
    queries = texts + [one() for _ in range(5)]
    index = FMIndex(np.concatenate(texts), np.array(list(map(len, texts))), np.array(values), top, depth)
    got = index.windows(np.concatenate(queries), np.array(list(map(len, queries))), 999)
    assert got.tolist() == by_window(texts, values, queries, depth, 999)


def brute(rows, window=13):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            if i is not None:
                x = tuple(w[k:k + window])
                first[x] = min(i, first.get(x, i))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode() if gone else t))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_remove_repeats(spark, seed):
    rows = passages(seed) + ODD + passages(seed)[:3]
    df = docs_frame(spark, rows).repartition(3)
    got = substrings.remove_repeats(df, part_docs=20)
    assert got.columns == [*df.columns, "n_words", "n_removed", "kept_sha256"]
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got.collect()), key=str)
    assert found == brute(rows)
    assert sum(r[2] for r in found) > 0


def test_same_id_with_two_texts_and_large_group(spark):
    base = " ".join(f"a{i}" for i in range(50))
    rows = [(5, base), (5, base + " more"), *[(i, base) for i in range(100, 160)], *[(i, f"{base} tail{i}") for i in range(200, 260)]]
    got = substrings.remove_repeats(docs_frame(spark, rows, extra=False).repartition(7))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    got = substrings.remove_repeats(docs_frame(spark, []))
    assert got.count() == 0 and "kept_sha256" in got.columns


def test_hot_anchor_is_spread(spark, monkeypatch):
    """A phrase with other words around it in each document fills no part, and results stay."""
    rng = random.Random(5)
    word = lambda: f"v{rng.randrange(10 ** 6)}"
    # of these phrases the one whose hash is least, so that it is the anchor of its windows
    phrase = min((f"the very same phrase{k}".split() for k in range(500)), key=lambda p: grams(np.array([xxhash.xxh3_64_intdigest(w) for w in p], np.uint64), 4)[0])
    texts = [[word() for _ in range(12)] + phrase + [word() for _ in range(12)] for _ in range(300)]
    texts += [list(t) for t in texts[:20]] + [t[5:25] + [word()] for t in texts[20:40]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    monkeypatch.setattr(substrings, "HOT_RUNS", 20, raising=False)
    monkeypatch.setattr(substrings, "HOT_SAMPLE", 1, raising=False)
    sent, meet = [], substrings.meet
    monkeypatch.setattr(substrings, "meet", lambda packed, parts, work, schema: sent.append(packed) or meet(packed, parts, work, schema))
    got = substrings.remove_repeats(docs_frame(spark, rows, extra=False).repartition(3))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.text) for r in got.collect()), key=str) == brute(rows)
    words = {}
    for part, data in sent[1].where(f"kind = {substrings.PAIRS}").select("part", "data").collect():
        words[part] = words.get(part, 0) + sum(len(x.split()) for x in substrings.runs_of(bytes(data))[0])
    assert max(words.values()) < sum(words.values()) / 8
