import random
import zlib
from collections import Counter

import numpy as np
import pytest
from frames import ODD, docs_frame, passages

from riskframe.llm import packing, token_counts
from riskframe.llm.tokens import default_tokenizer, encoder

BITS = ["a", "Be", " ", "  ", "\n", "\n\n", " \n", "\t", " ", ".", ",", "!!", "'s", "'", "é", "ñu", "12", "\x1c", " ", "<|endoftext|>", "日本", "\0", "...", "\r\n", "&", "́", "Words", "|"]


def whole(texts):
    return [e.ids for e in encoder(default_tokenizer()).tok.encode_batch(texts, add_special_tokens=False)]


def test_cut_texts_encode_as_whole_ones():
    rng = random.Random(1)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 14))) for _ in range(20_000)]
    got = encoder(default_tokenizer()).encode([*texts, None])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [*whole(texts), []]


def test_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr("riskframe.llm.tokens.CACHE_WORDS", 5)
    enc = encoder.__wrapped__(default_tokenizer())
    texts = [f"some words number {i}, and more." for i in range(50)]
    got = [np.frombuffer(g, "<u4").tolist() for t in texts for g in enc.encode([t])]
    assert got == whole(texts)


def test_histogram(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 16)
    rows = passages(3) + ODD
    got = token_counts.length_histogram(token_counts.token_lengths(docs_frame(spark, rows).repartition(3)))
    lengths = [len(x) for x in whole([t or "" for _, t in rows])]
    for r in got.collect():
        n = r.length
        assert r.n_docs == Counter(lengths)[n]
        assert (r.docs_at_least, r.docs_at_most) == (sum(x >= n for x in lengths), sum(x <= n for x in lengths))
        assert r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))
    assert got.count() == len(set(lengths))
    for limit in (0, 1, 100, 10**6):
        assert token_counts.truncated_total(got, limit).first().tokens == sum(min(x, limit) for x in lengths)
    for q in (0.0, 0.3, 0.5, 1.0):
        assert token_counts.length_quantile(got, q).first().length == min(v for v in lengths if sum(x <= v for x in lengths) >= q * len(lengths))


def test_histogram_of_nothing(spark):
    got = token_counts.length_histogram(token_counts.token_lengths(docs_frame(spark, [])))
    assert got.count() == 0
    assert token_counts.truncated_total(got, 5).first().tokens == 0
    assert token_counts.length_quantile(got, 0.5).first().length is None


def test_pieces_and_packing(spark):
    rows = passages(5) + ODD + passages(5)[:4]
    pieces = packing.token_pieces(docs_frame(spark, rows).repartition(3), capacity=64).cache()
    ids = [[*x, 2] for x in whole([t or "" for _, t in rows])]
    expected = []
    for (doc, _), x in zip(rows, ids, strict=True):
        at, k = 0, 0
        while at < len(x):
            size = (len(x) - at) % 64 or 64
            expected.append((doc, k, at, size, zlib.crc32(np.array(x[at:at + size], "<u4").tobytes())))
            at, k = at + size, k + 1
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, pieces.select(key).collect()), key=str) == sorted(expected, key=str)
    got = packing.pack(pieces, capacity=64, shard_pieces=50).toPandas()
    plain = lambda v: None if v is None or v != v else int(v)
    assert sorted((tuple(map(plain, r)) for r in got[key].itertuples(index=False)), key=str) == sorted(expected, key=str)
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x["offset"].tolist() == (x["length"].cumsum() - x["length"]).tolist() and x["length"].sum() <= 64
    pieces.unpersist()


@pytest.mark.parametrize("seed", range(8))
def test_packing_is_tight(seed):
    rng = random.Random(seed)
    size = [rng.choice([rng.randint(1, 100), rng.randint(30, 70)]) for _ in range(300)]
    first = packing.best_fit(size, 100)
    best = packing.improve(first, size, 100)
    for bins in (first, best):
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert all(sum(size[i] for i in b) <= 100 for b in bins)
    square = lambda bins: sum(sum(size[i] for i in b) ** 2 for b in bins)
    assert len(best) <= len(first) and square(best) >= square(first)


def steps_left(bins, size, capacity):
    """Whether any move, swap, two for one or one for two would raise the squares, by trying all."""
    fill = [sum(size[i] for i in b) for b in bins]
    for b, x in enumerate(bins):
        for a, y in enumerate(bins):
            if a != b and capacity > fill[a] >= fill[b]:
                one, back = [size[i] for i in x], [size[i] for i in y]
                pairs = lambda v: [v[i] + v[j] for i in range(len(v)) for j in range(i)]
                for outs, backs in ((one, [0, *back, *pairs(back)]), (pairs(one), [0, *back])):
                    if any(0 < o - k <= capacity - fill[a] for o in outs for k in backs):
                        return True
    return False


@pytest.mark.parametrize("n,low,high,seed,most", [(800, 300, 500, 1, 351), (800, 200, 700, 0, 357), (800, 200, 700, 1, 357), (250, 5, 90, 2, 13)])
def test_the_search_ends_where_no_step_is_left(n, low, high, seed, most):
    rng = random.Random(seed)
    size = [rng.randint(low, high) for _ in range(n)]
    bins = packing.improve(packing.best_fit(size, 1024), size, 1024)
    assert len(bins) <= most and sorted(i for b in bins for i in b) == list(range(n))
    assert all(sum(size[i] for i in b) <= 1024 for b in bins) and not steps_left(bins, size, 1024)


def test_swaps_empty_a_bin():
    size = [6, 5, 5, 4, 4, 3, 3]  # 30 in three bins of 10, but not as they lie
    bins = [[0, 5], [1, 4], [2, 3], [6]]
    assert len(packing.improve(bins, size, 10)) == 3


def test_pack_odd_lengths(spark):
    df = spark.createDataFrame([(1, 5, 9), (2, 0, 9), (3, None, 9)], "x long, length long, offset long")
    got = {r.x: (r.sequence_id, r.offset) for r in packing.pack(df, 10).collect()}
    assert got == {1: (0, 0), 2: (None, None), 3: (None, None)}
    assert packing.pack(df.limit(0), 10).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        packing.pack(spark.createDataFrame([(11,)], "length long"), 10).collect()
