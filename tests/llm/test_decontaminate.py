import hashlib
import random
import re

import pytest
from frames import ODD, docs_frame

from riskframe.llm import decontaminate

LOWER = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))


def brute(rows, items):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            k = min(10, len(w))
            for x in range(len(w) - k + 1):
                windows.setdefault(tuple(w[x:x + k]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for k in sizes:
            for x in range(len(w) - k + 1):
                if (key := tuple(w[x:x + k])) in windows:
                    hit |= set(range(x, x + k))
                    found |= windows[key]
        ids = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(seed):
    rng = random.Random(seed)
    text = lambda n: [f"{rng.choice('AbcÉß')}{rng.randint(0, 30)}" for _ in range(n)]
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(20)] + [(3, text(12)), (None, text(12))]
    docs = []
    for i in range(60):
        x = text(rng.choice([0, 4, 9, 10, 11, 60, 200]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            y = rng.choice(items)[1]
            s = rng.randint(0, max(0, len(y) - 10))
            at = rng.randint(0, len(x))
            x[at:at] = y[s:s + rng.choice([9, 10, 15, 40])]
        docs.append((i // 2, rng.choice([" ", "-", ", "]).join(x)))
    return docs + ODD, [(i, ". ".join(t)) for i, t in items] + [(50, None), (51, ""), (52, "?!")]


@pytest.mark.parametrize("limit", [500_000, 0])
def test_against_windows(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    rows, items = tables(limit + 1)
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, h string, n int")
    df = docs_frame(spark, rows).repartition(3)
    got = decontaminate.contamination(df, bench).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str)
    assert found == brute(rows, items)
    assert any(r[5] for r in found)


def test_clean_and_empty(spark):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"before {item.upper()} after"), (2, "clean text"), (3, None), (None, f"x {item}"), (2, item)]
    kept = decontaminate.clean(docs_frame(spark, rows), bench)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(2, "clean text"), (3, None)]
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(docs_frame(spark, rows), none).collect()
    assert len(got) == 5 and not any(r.contaminated for r in got)
    assert decontaminate.contamination(docs_frame(spark, []), bench).count() == 0


def test_plan_has_no_python(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    plan = decontaminate.contamination(docs_frame(spark, [(1, "x y")]), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_marker_rows_are_spread(spark, monkeypatch):
    """Where both sides of the fingerprint join shuffle, no task gets a row of every document."""
    from pyspark.sql import functions as F
    frames, keep = [], decontaminate.checkpointed
    monkeypatch.setattr(decontaminate, "checkpointed", lambda df: frames.append(df) or keep(df))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        words = " ".join(f"w{i}" for i in range(12))
        bench = spark.createDataFrame([("a", words)], "item_id string, text string")
        docs = docs_frame(spark, [(i, f"short {i}") for i in range(400)] + [(1000, f"x {words} y")])
        got = decontaminate.contamination(docs, bench).collect()
        joined = frames[1]._jdf.queryExecution().optimizedPlan().children().head().toString()
        assert "coalesce(fp" in joined or "AS at#" in joined
        assert len(got) == 401 and [r.doc_id for r in got if r.contaminated] == [1000]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
