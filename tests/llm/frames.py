"""Small tables for the tests: odd rows, and columns whose names clash with inner ones."""

import random

CLASH = "score double, id long, t string, part int, n long, label int, words string, h string, rank int, spans string, length long, shard long"


def docs_frame(spark, rows, extra=True):
    """(doc_id, text) rows as a documents table, with clashing extra columns."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(*r, 0.5, 7, "t", 1, 2, 1, "w", "h", 3, "s", 4, 5) for r in rows], f"doc_id long, text string, {CLASH}")


ODD = [(None, None), (None, "alone here with a few words that nobody else has at all today my friend"), (900, None), (901, ""), (902, " \n\t "), (903, "x"),
       (903, "x"), (904, "é ü 漢字"), (905, "word " * 3000)]


def passages(seed, docs=60, vocab=400):
    """Random texts with copies, near copies and shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{int(vocab * rng.random() ** 2)}"
    shared = [[word() for _ in range(rng.choice([9, 12, 13, 14, 30, 60]))] for _ in range(6)]
    out = []
    for i in range(docs):
        if out and rng.random() < 0.15:
            out.append(list(rng.choice(out)))
        elif out and rng.random() < 0.4:
            x = list(rng.choice(out))
            for _ in range(rng.randint(1, max(1, len(x) // 25))):
                if x:
                    x[rng.randrange(len(x))] = word()
            out.append(x)
        else:
            x = [word() for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 12, 13, 14, 40, 130, 300, 700]))]
            if rng.random() < 0.6:
                at = rng.randint(0, len(x))
                x[at:at] = rng.choice(shared)
            out.append(x)
    gap = lambda: rng.choice([" ", " ", " ", "\n", "  ", "\t"])
    ids = rng.sample(range(10 * docs), docs)
    return [(i, "".join(w + gap() for w in x)) for i, x in zip(ids, out, strict=True)]
