"""Language of each span of a text: script candidates, word scores, Viterbi.

A word's script narrows the languages it may be in; hashed character n-grams give
it a score per language; a Viterbi pass over the words with a penalty per switch
labels spans. A document's language is the one with most letters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import chunks, held_out
from riskframe.llm.subwords import WordTable, mean_by_owner, subword_ids, words_of

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
#: Documents of each language that a fit takes, in expectation, by hash of the id.
FIT_ROWS = 3000
FOLDS, FOLD = 4, 2
SWITCH = 8.0
UNKNOWN = "und"
# First and last code points of Unicode scripts.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xB5, 0xB5), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
NAMES = [*SCRIPTS, "other"]


def script_of(word: str) -> int:
    """Place in NAMES of the script of a word's first letter; -1 without letters."""
    if word[0].isascii() and word[0].isalpha():
        return 0
    for c in word:
        if c.isalpha():
            x = ord(c)
            for i, ranges in enumerate(SCRIPTS.values()):
                if any(lo <= x <= hi for lo, hi in ranges):
                    return i
            return len(SCRIPTS)
    return -1


@dataclass
class Languages:
    """``names``; log probability of each bucket by language; which scripts each is written in."""

    names: list[str]
    logp: np.ndarray  # buckets x languages
    writes: np.ndarray  # scripts x languages, bool

    def word_values(self, words: list[str]) -> np.ndarray:
        """A word's score per language (0 without letters) and, last, its letters."""
        n, k = len(words), len(self.names)
        script = np.fromiter(map(script_of, words), np.int64, n)
        letters = np.fromiter((len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words), np.float32, n)
        ids, owner = subword_ids([w.lower() for w in words], BUCKETS, SIZES)
        score = mean_by_owner(self.logp[ids], owner, n) * np.sqrt(np.bincount(owner, minlength=n))[:, None]
        score -= score.max(axis=1, keepdims=True, initial=-np.inf) if k else 0
        allowed = self.writes[np.maximum(script, 0)]
        score = np.where(allowed | ~allowed.any(axis=1, keepdims=True), np.maximum(score, -6), -40)
        score[script < 0] = 0
        return np.concatenate([score, letters[:, None]], axis=1).astype(np.float32)


def fit_languages(docs: DataFrame, lang_col: str = "lang", folds: int = FOLDS, fold: int = FOLD, rows: int = FIT_ROWS) -> Languages:
    """Counts n-grams and scripts per language over about ``rows`` documents of each
    (all, if fewer) outside the held-out fold."""
    own = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = own.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id", folds, fold))
    total = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(total)
    if not names:
        return Languages([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(NAMES), 0), bool))
    share = F.create_map(*[F.lit(x) for v in names for x in (v, min(1.0, rows / total[v]))])
    some = own.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def run(batches):
        for b in batches:
            for lo, hi in chunks(b, 1):
                texts, langs = b.column(1).slice(lo, hi - lo).to_pylist(), b.column(0).slice(lo, hi - lo).to_pylist()
                for lang in sorted(set(langs)):
                    words, n = np.unique(np.array([w.lower() for t, v in zip(texts, langs, strict=True) if v == lang for w in t.split()], dtype=object), return_counts=True)
                    if not len(words):
                        continue
                    ids, owner = subword_ids(list(words), BUCKETS, SIZES)
                    script = np.fromiter(map(script_of, words), np.int64, len(words))
                    c = np.concatenate([np.bincount(ids, n[owner], BUCKETS), np.bincount(script + 1, n, len(NAMES) + 1)[1:]])
                    at = np.flatnonzero(c)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(c[at])], ["lang", "at", "n"])

    sums = some.select("lang", "text").mapInArrow(run, "lang string, at long, n double").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    c = np.zeros((BUCKETS + len(NAMES), len(names)))
    got = sums.toPandas()  # buckets times languages at most
    c[got["at"].to_numpy(np.int64), pd.Categorical(got["lang"], names).codes] = got["n"]
    grams, scripts = c[:BUCKETS], c[BUCKETS:]
    logp = np.log(grams + 0.5) - np.log(grams.sum(axis=0) + 0.5 * BUCKETS)
    return Languages(names, logp.astype(np.float32), scripts > 0.005 * np.maximum(scripts.sum(axis=0), 1))


def viterbi(score: np.ndarray, n: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of every word of many documents at once.

    ``score``: words x languages, document after document; ``n``: words of each.
    All documents advance together, one word a step, longest first.
    """
    total, k = score.shape
    label = np.zeros(total, np.int8 if k < 128 else np.int16)
    if not total or not k:
        return label
    order = np.argsort(-n, kind="stable")
    size = n[order]
    first = (np.cumsum(n) - n)[order]
    active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # documents longer than t
    came = np.empty((total, k), bool)  # whether the best way to a language here came by a switch
    best = np.empty(total, label.dtype)  # the best language at each word, so far
    v = score[first[: active[0]]]
    best[first[: active[0]]] = v.argmax(axis=1)
    for t in range(1, len(active)):
        m = active[t]
        v = v[:m]
        top = v.max(axis=1, keepdims=True) - switch
        at = first[:m] + t
        came[at] = top > v
        v = np.maximum(v, top) + score[at]
        v -= v.max(axis=1, keepdims=True)
        best[at] = v.argmax(axis=1)
    last = first + size - 1
    now = best[np.maximum(last, 0)]
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = first[:m] + t
        ends = size[:m] - 1 == t
        cur = np.where(ends, best[at], now[:m])
        label[at] = cur
        if t:
            now[:m] = np.where(came[at, cur], best[at - 1], cur)
    return label


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH,
             spans: bool = False) -> DataFrame:
    """doc_id, lang_pred, score (share of letters in that language), and n_spans.

    With ``spans`` also an array of (lang, first_word, words, letters) per document.
    Null texts and texts without a letter are ``und`` with score 0 and no span;
    ties go to the first name. Repeated rows give one row each; other columns are
    not read. With no language learned every text is ``und``.
    """
    k = len(model.names)

    def run(batches):
        table = WordTable(model.word_values, k + 1)
        for b in batches:
            langs, scores, counts, lists = [], [], [], []
            for lo, hi in chunks(b, 1, 8 << 20):
                words, n = words_of(b.column(1).slice(lo, hi - lo).to_pylist())
                place = table.index(words)
                values = table.rows[place]
                label, letters = viterbi(values[:, :k], n, switch), values[:, k]
                doc = np.repeat(np.arange(len(n)), n)
                mass = np.zeros((len(n), max(k, 1)))
                np.add.at(mass, (doc, label.astype(np.int64)), letters)
                start = np.ones(len(label), bool)
                start[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
                total = mass.sum(axis=1)
                pick = mass.argmax(axis=1)
                known = (total > 0) & (k > 0)
                langs += [model.names[p] if ok else UNKNOWN for p, ok in zip(pick, known, strict=True)]
                scores += np.where(known, mass.max(axis=1) / np.maximum(total, 1), 0.0).tolist()
                at = np.flatnonzero(start)
                per = np.where(known, np.bincount(doc[at], minlength=len(n)), 0)
                counts += per.tolist()
                if spans:
                    long = np.diff(np.append(at, len(label)))
                    mine = np.add.reduceat(letters, at) if len(at) else letters
                    begin = np.cumsum(n) - n
                    own = [[] for _ in range(len(n))]
                    for i, s in enumerate(at.tolist()):
                        if known[doc[s]]:
                            own[doc[s]].append({"lang": model.names[label[s]], "first_word": int(s - begin[doc[s]]), "words": int(long[i]), "letters": int(mine[i])})
                    lists += own
            out = {"doc_id": b.column(0), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()), "n_spans": pa.array(counts, pa.int64())}
            if spans:
                out["spans"] = pa.array(lists, pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("letters", pa.int64())])))
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, n_spans long"
    if spans:
        schema += ", spans array<struct<lang:string,first_word:long,words:long,letters:long>>"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
