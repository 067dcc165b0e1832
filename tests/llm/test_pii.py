import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from frames import ODD, docs_frame

from riskframe.llm import pii, queries, tagger

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = [int(x) for x in re.findall("[0-9]", m.group())]
            luhn = sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(digits) <= 19 and luhn,
                    "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_base_spans_are_the_plain_patterns():
    rng = random.Random(1)
    pieces = ["a", "b.c", "@", "@x", "x.y", ".", "..", "-", "+", "+1", "7", "12", "255", "256", "0009", " ", "  ", "(", ")", "é", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "me@a.bc",
              "+1 (499) 555-6503", "%", "_", "\n", "００"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert [k for k, *_ in pii.base_spans("4111111111111111 x@y.zz")] == ["card", "email"]


def test_long_runs_take_one_pass():
    n = 400_000
    for text in ("a" * n, "1" * n, "1." * n, "+" * n, "@" * n, "+1" + "(" * n, "a@" * n, "1 " * n, "a@" + "b" * n):
        pii.base_spans(text)


def random_model(labels=4, seed=1):
    rng, m = np.random.default_rng(seed), tagger.fresh(labels, seed)
    for k in m.w:
        m.w[k] = (m.w[k] + rng.normal(0, 0.5, m.w[k].shape)).astype(np.float32)
    return m


def test_gradients_are_numeric_ones():
    rng, m = np.random.default_rng(1), random_model(5)
    codes, size, y = rng.integers(0, tagger.CLASSES, (5, 9)), np.array([9, 9, 4, 1, 7]), rng.integers(0, 5, (5, 9))
    _, g = tagger.loss_and_gradients(m, codes, size, y)
    for k, w in m.w.items():
        flat = w.reshape(-1)
        for i in np.argsort(-np.abs(g[k].reshape(-1)))[:4]:
            old, e = flat[i], 1e-2
            flat[i] = old + e
            a = tagger.loss_and_gradients(m, codes, size, y)[0]
            flat[i] = old - e
            b = tagger.loss_and_gradients(m, codes, size, y)[0]
            flat[i] = old
            assert (a - b) / (2 * e) == pytest.approx(float(g[k].reshape(-1)[i]), abs=2e-3)


def plain_emissions(m, codes):
    """One window, one step at a time."""
    w, H = m.w, tagger.HIDDEN
    bend = lambda x: x / (1 + abs(x))
    both = []
    for s, seq in ((0, codes), (1, codes[::-1])):
        h, c, out = np.zeros(H), np.zeros(H), []
        for x in seq:
            a = w["char"][x] @ w["inp"][s] + w["bias"][s] + w["rec"][s] @ h
            i, f, o = ((1 + bend(a[k * H : (k + 1) * H] / 2)) / 2 for k in range(3))
            c = f * c + i * bend(a[3 * H :])
            h = o * bend(c)
            out.append(h)
        both.append(out if s == 0 else out[::-1])
    return [w["out"] @ np.concatenate(x) + w["out_b"] for x in zip(*both, strict=True)]


def test_decoding_is_the_best_of_all_sequences():
    rng = np.random.default_rng(2)
    for seed in range(6):
        m = random_model(3, seed)
        codes, size = rng.integers(0, tagger.CLASSES, (6, 6)), np.array([6, 6, 6, 5, 2, 1] if seed % 2 else [6] * 6)
        got = m.decode(codes, size)
        for x, n, y in zip(codes, size, got, strict=True):
            emit = plain_emissions(m, x[:n])
            worth = lambda p: m.w["begin"][p[0]] + m.w["end"][p[-1]] + sum(e[k] for e, k in zip(emit, p, strict=True)) + sum(m.w["trans"][a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
            assert worth(y[:n].tolist()) == pytest.approx(max(worth(p) for p in itertools.product(range(3), repeat=int(n))), abs=1e-4)
            assert not y[n:].any()


def test_windows_cover_texts_and_are_put_together():
    for n in [0, 1, 255, 256, 257, 480, 481, 5000]:
        s = pii.window_starts(n)
        seen = np.zeros(n, int)
        for x in s:
            seen[x : x + pii.WINDOW] += 1
        assert (seen > 0).all() and (n < pii.WINDOW or (s + pii.WINDOW <= n).all())
    rng, m = np.random.default_rng(4), random_model(5)
    n = np.array([0, 1, 700, 30, 256, 0, 1000])
    codes = rng.integers(0, tagger.CLASSES, n.sum()).astype(np.uint8)
    got = pii.labels_of(codes, n, m)
    for lo, k in zip(np.cumsum(n) - n, n, strict=True):
        starts = pii.window_starts(int(k))
        own = [m.decode(codes[lo + s : lo + min(s + pii.WINDOW, k)].astype(int)[None], np.array([min(pii.WINDOW, k)]))[0] for s in starts]
        want = []
        for p in range(k):  # the window in which the place is furthest from an edge; the later one on ties
            near = lambda i: min(p - starts[i] if i else 10**6, starts[i] + pii.WINDOW - 1 - p if i + 1 < len(starts) else 10**6)  # noqa: B023, E731
            inside = [i for i, s in enumerate(starts) if s <= p < s + pii.WINDOW]
            want.append(own[max(inside, key=lambda i: (near(i), i))][p - starts[max(inside, key=lambda i: (near(i), i))]])
        assert (got[lo : lo + k] == want).mean() > 0.995 if k else True


def toy(spark, extra=True):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    some = [lambda: f"{word()}@{word()}.com", lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), lambda: "4111 1111 1111 1111", lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"]
    rows = []
    for i in range(400):
        words = [word() for _ in range(rng.randint(5, 60))]
        if i % 2:
            words.insert(rng.randrange(len(words)), rng.choice(some)())
        rows.append((i, " ".join(words)))
    return docs_frame(spark, rows + ODD + [(3000, None), (3001, "abc hefgd +1 (826) 555-4081 190.137.223.20 then"), (3002, "long " * 5000 + "me@here.org" + " tail" * 5000)], extra)


def test_odd_rows_and_what_the_network_adds(spark):
    docs = toy(spark)
    model = pii.fit_personal(docs)
    found = pii.find_personal(docs.repartition(3), model)
    assert found.columns == [*[c for c in docs.columns if c != "spans"], "spans"]
    rows = found.collect()
    assert len(rows) == docs.count()
    right = alone = 0
    for r in rows:
        text = r.text or ""
        base = [(s.kind, s.start, s.end) for s in r.spans if s.base]
        assert base == plain_spans(text)
        assert r.spans == sorted(r.spans, key=lambda s: (s.start, pii.KINDS.index(s.kind)))
        for s in r.spans:
            if not s.base:
                assert re.fullmatch(PLAIN[s.kind], text[s.start : s.end]) and not any(a < s.end and s.start < b for _, a, b in base)
        if r.doc_id is not None and r.doc_id < 400 and base:
            lab = pii.labels_of(tagger.char_classes(text), np.array([len(text)]), model)
            right, alone = right + (list(pii.added_spans(text, lab, [])) == base), alone + 1
    assert alone > 150 and right / alone > 0.85  # the network by itself, without the base spans
    swallowed = next(r for r in rows if r.doc_id == 3001)
    assert ("phone", 10, 27, False) in [tuple(s) for s in swallowed.spans]
    masked = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert masked[3001] == "abc hefgd [phone] [ip] then" and masked[3000] is None and masked[3002].count("[email]") == 1 and masked[901] == ""
    assert pii.find_personal(docs.limit(0), model).count() == 0
    # nothing to learn from: base spans alone
    clean = docs.where("text NOT RLIKE '[0-9@]' OR text IS NULL")
    assert pii.fit_personal(clean) is None and pii.fit_personal(docs.limit(0)) is None
    assert pii.find_personal(clean, None).where("size(spans) > 0").count() == 0


def test_fits_do_not_depend_on_partitions(spark):
    docs = toy(spark, extra=False)
    a, b = (pii.fit_windows(docs.repartition(k), "doc_id", "text", 1000, 5).collect() for k in (2, 7))
    assert sorted(map(str, a)) == sorted(map(str, b))
    n = {}
    for r in a:
        n[r["kind"]] = n.get(r["kind"], 0) + 1
    assert n[-2] >= 10 and all(5 <= n[k] < 20 for k in (1, 2, 4)) and len({r["key"] for r in a if r["kind"] == -2}) == n[-2]


def test_query_columns(spark):
    got = queries.QUERIES["op13_personal"](spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for r in got.itertuples():
        base = plain_spans(docs.text[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in base) for x in PLAIN]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(filter(None, r.spans.split(",")))
