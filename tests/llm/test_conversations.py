import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import conversations as C
from riskframe.llm import hot

SCHEMA = "conv_id long, turn long, role string, text string, depth int, digest string, block int, least int, own string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], SCHEMA).repartition(4)


def slow(rows):
    """The contract by hand, on whole lists of turns."""
    said = lambda r: hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, said(r))):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    words = lambda t: len(t.replace("\t", " ").replace("\n", " ").split(" ")) - (t.replace("\t", " ").replace("\n", " ").split(" ")).count("")
    out = []
    for path, members in nodes.items():
        sub = [p for p in nodes if p[: len(path)] == path]
        ends = sorted(c for c in members if len(full[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), sum(len(p) == len(path) + 1 for p in sub),
                    sum(all(len(full[c]) == len(p) for c in nodes[p]) for p in sub), sum((len(nodes[p]) - 1) * words(p[-1][1]) for p in sub if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=90):
    rng = random.Random(seed)
    turn = lambda: (rng.choice(["user", "bot", None, ""]), rng.choice([None, "", " ", "hi", "a b", "a\tb c", "é ü 漢字", "long " * 30]))
    starts = [[turn() for _ in range(rng.randint(1, 7))] for _ in range(5)]
    rows = []
    for c in rng.sample(range(-40, 400), n):
        x = list(rng.choice(starts))[: rng.randint(1, 7)] + [turn() for _ in range(rng.choice([0, 0, 1, 3]))]
        rows += [(c, rng.choice([i, i, i, i // 2, None]) if rng.random() < 0.1 else i, *t) for i, t in enumerate(x)]
    rows += [(1000, 5, "user", "only"), (1000, 5, "user", "only"), (1001, None, None, None), (None, 1, "user", "nobody")]
    return rows + [(2000 + i, j, "user", f"t{j}") for i in range(2) for j in range(60)]


@pytest.mark.parametrize("seed,width", [(1, None), (2, 8), (3, 64)])
def test_against_brute_force(spark, monkeypatch, seed, width):
    """Also with sketches so narrow that they prove few or no prefixes single."""
    if width:
        monkeypatch.setattr(C, "sketch_width", lambda n: width)
    rows = made(seed)
    got = sorted((tuple(r) for r in C.prefix_trie(frame(spark, rows)).collect()), key=str)
    assert got == slow(rows)


def test_hot_prefixes_and_small_batches(spark, monkeypatch):
    """Hot nodes by broadcast, spans of few ids, batches that cut conversations: the same rows."""
    rows = made(4) + [(3000 + i, 0, "user", "everybody says this") for i in range(80)]
    monkeypatch.setattr(hot, "HOT_ROWS", 10)
    monkeypatch.setattr(C.ends_digests, "__defaults__", (3,))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((tuple(r) for r in C.prefix_trie(frame(spark, rows)).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == slow(rows)


def test_empty_single_and_turnless(spark):
    assert C.prefix_trie(frame(spark, [])).count() == 0
    assert C.prefix_trie(frame(spark, [(None, 0, "user", "x")])).count() == 0
    for rows in ([(20, 0, "user", "alone here")], [(c, 0, "user", "x") for c in range(21, 40)]):
        assert sorted((tuple(r) for r in C.prefix_trie(frame(spark, rows)).collect()), key=str) == slow(rows)


def test_sketch_never_underestimates(spark):
    df = spark.range(3000).select(F.unhex(F.md5((F.col("id") % 2500).cast("string"))).alias("digest"))
    bits = C.count_min(df, 1 << 14)
    import pyarrow as pa
    digests = [r.digest for r in df.collect()]
    alone = C.single(pa.array(digests, pa.binary()), bits)
    n = {d: digests.count(d) for d in set(digests)}
    assert not any(a and n[d] > 1 for a, d in zip(alone, digests, strict=True))
    assert sum(alone) > 0.98 * 2000  # and few false alarms
