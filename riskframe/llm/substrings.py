"""Removing passages of 13 words or more that an earlier document has.

1. Each window of 13 words is known by its anchor, the least hash of four
   consecutive words in it; equal windows have equal anchors. Anchors that two
   documents have are found by a shuffle of (anchor, document) pairs.
2. Runs of windows of one anchor that more documents have are cut out of the texts
   and meet in the anchor's shard. Windows of an anchor with very many different runs
   (told from a sample of the documents) go one by one, each to the shard of its own
   hash, so that no anchor fills a shard.
3. Each shard builds a compressed FM-index of its different runs and streams them
   through it by backward search, which gives each window the least document that
   has it.
4. Words that windows of earlier documents cover are removed from the texts.

A task settles what it sees itself before anything is sent: of the documents with
the same anchor or run it sends one. A group that holds a third of all rows is so
sent once per batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.blobs import BLOB, blob_batch, meet, split_parts
from riskframe.llm.common import Words, chunks, grams, mix, parts_for, run_starts
from riskframe.llm.fmindex import FMIndex

WINDOW, GRAM = 13, 4
#: Windows of a run; longer ones are cut, so that a shard's texts stay short.
RUN_WINDOWS = 32
#: Documents whose anchors a part holds, on average.
PART_DOCS = 4000
#: Different runs of an anchor beyond which its windows are dealt one by one, and the share
#: of documents (one in so many) in which they are counted.
HOT_RUNS, HOT_SAMPLE = 4000, 64
PAIRS, SETTLED = 0, 1


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def anchors(h: np.ndarray, sizes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of the window that starts at each word, and whether there is a whole window."""
    total = len(h)
    ends = np.repeat(np.cumsum(sizes), sizes)
    whole = np.arange(total) + window <= ends
    g = grams(h, gram)
    low, width, span = g, 1, window - gram + 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
        width *= 2
    rest = span - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:]) if len(low) > rest else low[:0]
    out = np.zeros(total, np.uint64)
    out[: len(low)] = low
    return out, whole


def hash_words(batch: pa.RecordBatch, column: int, seen: Words, lower: bool = False):
    """(rows lo..hi, words of each row, all hashes, word counts) for chunks of a batch; ``lower``: A-Z lower-cased."""
    for lo, hi in chunks(batch, column):
        seen.trim()
        texts = [t or b"" for t in batch.column(column).slice(lo, hi - lo).to_pylist()]
        words = [t.lower().split() for t in texts] if lower else [t.split() for t in texts]
        flat = [w for x in words for w in x]
        yield lo, hi, words, seen.of(flat, np.uint64), np.fromiter(map(len, words), np.int64, len(words))


def pairs_blob(keys: np.ndarray, docs: np.ndarray) -> bytes:
    order = np.lexsort((keys, docs))
    return np.int64(len(keys)).tobytes() + keys[order].tobytes() + docs[order].tobytes()


def pairs_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    return np.frombuffer(data, np.uint64, n, 8), np.frombuffer(data, np.int64, n, 8 + 8 * n)


def shared_anchors(docs: DataFrame, parts: int, window: int, gram: int) -> DataFrame:
    """(id, keys): the anchors of each document that another document has, in several rows."""

    def pack(batches):
        seen = Words(xxhash.xxh3_64_intdigest)
        for b in batches:
            ids = b.column(0).to_numpy()
            keys, own = [], []
            for lo, _, _, h, sizes in hash_words(b, 1, seen):
                a, whole = anchors(h, sizes, window, gram)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                first = whole.copy()
                first[1:] &= ~whole[:-1] | (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(first)
                keys.append(a[at])
                own.append(ids[lo + doc[at]])
            if not keys:
                continue
            k, d = np.concatenate(keys), np.concatenate(own)
            order = np.lexsort((d, k))
            k, d = k[order], d[order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
            k, d = k[new], d[new]
            start = run_starts(k)
            many = np.diff(np.append(start, len(k))) > 1
            here = np.repeat(many, np.diff(np.append(start, len(k))))
            rows = [(p, PAIRS, pairs_blob(k[start[i]], d[start[i]])) for p, i in split_parts((k[start] % np.uint64(parts)).astype(np.int64), parts)]
            if here.any():
                # dealt by document, so that one hot anchor doesn't fill a part
                kk, dd = k[here], d[here]
                rows += [(p, SETTLED, pairs_blob(kk[i], dd[i])) for p, i in split_parts(dd % parts, parts)]
            yield blob_batch(rows)

    def work(items):
        settled = [pairs_of(x) for kind, x in items if kind == SETTLED]
        pairs = [pairs_of(x) for kind, x in items if kind == PAIRS]
        if pairs:
            k, d = (np.concatenate(c) for c in zip(*pairs, strict=True))
            order = np.argsort(k, kind="stable")
            k, d = k[order], d[order]
            start = run_starts(k)
            size = np.diff(np.append(start, len(k)))
            many = np.repeat(np.minimum.reduceat(d, start) != np.maximum.reduceat(d, start), size)
            settled.append((k[many], d[many]))
        if settled:
            k, d = (np.concatenate(c) for c in zip(*settled, strict=True))
            order = np.lexsort((k, d))
            k, d = k[order], d[order]
            start = run_starts(d)
            edge = np.append(start, len(d))
            yield pa.RecordBatch.from_arrays([pa.array(d[start]), pa.array([k[s:e].tobytes() for s, e in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], ["id", "keys"])

    return meet(docs.select("id", "t").mapInArrow(pack, BLOB), parts, work, "id long, keys binary")


def hot_anchors(docs: DataFrame, window: int, gram: int) -> np.ndarray:
    """Anchors with about ``HOT_RUNS`` different runs or more, sorted. Only says where windows
    meet, so a sample of the documents serves; it has ``HOT_RUNS / HOT_SAMPLE`` runs of each."""

    def count(batches):
        seen = Words(xxhash.xxh3_64_intdigest)
        for b in batches:
            for _, _, _, h, sizes in hash_words(b, 1, seen):
                a, whole = anchors(h, sizes, window, gram)
                full = grams(h, window)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                first = whole.copy()
                first[1:] &= ~whole[:-1] | (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
                last = whole.copy()
                last[:-1] &= ~whole[1:] | (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
                s, e = np.flatnonzero(first), np.flatnonzero(last)
                run = mix(full[s] ^ mix(full[e] + np.uint64(1)))
                yield pa.RecordBatch.from_arrays([pa.array(a[s].view(np.int64)), pa.array(run.view(np.int64))], ["anchor", "run"])

    some = docs.where(F.pmod(F.xxhash64("id", F.lit("hot")), F.lit(HOT_SAMPLE)) == 0).select("id", "t")
    runs = some.mapInArrow(count, "anchor long, run long").distinct().groupBy("anchor").count()
    hot = runs.where(F.col("count") >= max(2, HOT_RUNS // HOT_SAMPLE)).select("anchor").collect()
    return np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64))


def run_blob(segments: list[bytes], docs: np.ndarray, texts: np.ndarray, starts: np.ndarray) -> bytes:
    """Runs of words with their document, text hash and first word; compressed, as most words come several times."""
    order = sorted(range(len(segments)), key=segments.__getitem__)
    head = np.array([len(segments)], np.int64)
    data = head.tobytes() + docs[order].tobytes() + texts[order].tobytes() + starts[order].tobytes() + b"\n".join([segments[i] for i in order])
    return zstandard.ZstdCompressor(level=3).compress(data)


def runs_of(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    d, t, s = (np.frombuffer(data, np.int64, n, 8 + 8 * n * i) for i in range(3))
    return data[8 + 24 * n :].split(b"\n") if n else [], d, t, s


def spans_blob(docs: np.ndarray, texts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return np.int64(len(docs)).tobytes() + np.concatenate([docs, texts, starts, ends]).astype(np.int64).tobytes()


def repeated_spans(docs: DataFrame, parts: int, window: int, gram: int, hot: np.ndarray) -> DataFrame:
    """(id, th, spans): words of each document (by id and text) that windows of earlier ones cover.
    Windows of ``hot`` anchors are dealt by their own hash."""
    flagged = shared_anchors(docs, parts, window, gram).groupBy("id").agg(F.collect_list("keys").alias("keys"))  # bounded by the document's length
    near = docs.join(flagged, "id").select("id", "th", "t", "keys")

    def pack(batches):
        seen = Words(xxhash.xxh3_64_intdigest)
        for b in batches:
            ids, ths = b.column(0).to_numpy(), b.column(1).to_numpy()
            keys = b.column(3)
            met: dict[bytes, int] = {}
            seg, doc_of, text_of, start_of, key_of = [], [], [], [], []
            for lo, _, words, h, sizes in hash_words(b, 2, seen):
                a, whole = anchors(h, sizes, window, gram)
                alone = np.isin(a, hot) if len(hot) else np.zeros(len(a), bool)
                deal = a
                if alone.any():
                    # words too near the end to start a window are never looked up
                    full = np.zeros(len(a), np.uint64)
                    full[: max(0, len(a) - window + 1)] = grams(h, window)
                    deal = np.where(alone, full, a)
                at = 0
                for i, (w, n) in enumerate(zip(words, sizes.tolist(), strict=True)):
                    mine, one, to = a[at : at + n], alone[at : at + n], deal[at : at + n]
                    ok = whole[at : at + n] & np.isin(mine, np.frombuffer(b"".join(keys[lo + i].as_py()), np.uint64))
                    at += n
                    place = np.flatnonzero(ok)
                    if not len(place):
                        continue
                    new = np.ones(len(place), bool)
                    new[1:] = (np.diff(place) > 1) | (mine[place[1:]] != mine[place[:-1]]) | one[place[1:]]
                    edge = np.append(np.flatnonzero(new), len(place)).tolist()
                    for s, e in zip(edge[:-1], edge[1:], strict=True):
                        for x in range(s, e, RUN_WINDOWS):
                            y = min(e, x + RUN_WINDOWS)
                            first = int(place[x])
                            text = b" ".join(w[first : int(place[y - 1]) + window])
                            seg.append(met.setdefault(text, len(met)))
                            doc_of.append(ids[lo + i])
                            text_of.append(ths[lo + i])
                            start_of.append(first)
                            key_of.append(to[first])
            if not seg:
                continue
            texts = list(met)
            seg, doc_of, text_of, start_of, key_of = np.array(seg), np.array(doc_of, np.int64), np.array(text_of, np.int64), np.array(start_of, np.int64), np.array(key_of, np.uint64)
            order = np.lexsort((text_of, doc_of, seg))
            seg, doc_of, text_of, start_of, key_of = (c[order] for c in (seg, doc_of, text_of, start_of, key_of))
            edge = run_starts(seg)
            # a run that an earlier document of the batch has too is covered whole; one document is sent for all
            least = np.repeat(doc_of[edge], np.diff(np.append(edge, len(seg))))
            later = np.flatnonzero(doc_of > least)
            sent = np.flatnonzero(doc_of == least)
            rows = []
            if len(later):
                count = np.array([t.count(b" ") + 1 for t in texts], np.int64)
                rows += [(p, SETTLED, spans_blob(*(c[later[i]] for c in (doc_of, text_of, start_of)), start_of[later[i]] + count[seg[later[i]]]))
                         for p, i in split_parts(doc_of[later] % parts, parts)]
            for p, i in split_parts((key_of[sent] % np.uint64(parts)).astype(np.int64), parts):
                j = sent[i]
                rows.append((p, PAIRS, run_blob([texts[x] for x in seg[j]], doc_of[j], text_of[j], start_of[j])))
            yield blob_batch(rows)

    def work(items):
        settled = []
        for kind, data in items:
            if kind == SETTLED:
                n = int(np.frombuffer(data, np.int64, 1)[0])
                settled.append(np.frombuffer(data, np.int64, 4 * n, 8).reshape(4, n))
        number: dict[bytes, int] = {}
        which, doc, text, start = [], [], [], []
        for kind, data in items:
            if kind == PAIRS:
                s, d, t, b = runs_of(data)
                which.append(np.fromiter((number.setdefault(x, len(number)) for x in s), np.int64, len(s)))
                doc.append(d)
                text.append(t)
                start.append(b)
        if number:
            which, doc, text, start = map(np.concatenate, (which, doc, text, start))
            least = np.full(len(number), np.iinfo(np.int64).max)
            np.minimum.at(least, which, doc)
            words: dict[bytes, int] = {}
            size = np.fromiter((x.count(b" ") + 1 for x in number), np.int64, len(number))
            flat = np.fromiter((words.setdefault(w, len(words) + 1) for x in number for w in x.split(b" ")), np.int64, int(size.sum()))
            number.clear()
            top = len(words)
            words.clear()
            index = FMIndex(flat, size, least, top, window)
            first = index.windows(flat, size, np.iinfo(np.int64).max)  # the least document with each window
            begin = np.cumsum(size) - size
            # windows of every occurrence, one after the other
            count = size[which] - window + 1
            occ = np.repeat(np.arange(len(which)), count)
            k = np.arange(len(occ)) - np.repeat(np.cumsum(count) - count, count)
            hit = np.flatnonzero(first[begin[which[occ]] + k] < doc[occ])
            if len(hit):
                o, k = occ[hit], k[hit]
                new = np.ones(len(o), bool)
                new[1:] = (o[1:] != o[:-1]) | (k[1:] != k[:-1] + 1)
                s = np.flatnonzero(new)
                e = np.append(s[1:], len(o)) - 1
                settled.append(np.stack([doc[o[s]], text[o[s]], start[o[s]] + k[s], start[o[s]] + k[e] + window]))
        if settled:
            x = np.concatenate(settled, axis=1)
            x = x[:, np.lexsort((x[2], x[1], x[0]))]
            new = np.ones(x.shape[1], bool)
            new[1:] = (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])
            s = np.flatnonzero(new)
            edge = np.append(s, x.shape[1])
            spans = [np.ascontiguousarray(x[2:, i:j].T).astype(np.int32).tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x[0, s]), pa.array(x[1, s]), pa.array(spans, pa.binary())], ["id", "th", "spans"])

    found = meet(near.mapInArrow(pack, BLOB), parts, work, "id long, th long, spans binary")
    return found.groupBy("id", "th").agg(F.collect_list("spans").alias("spans"))  # bounded by the document's length


def covered_words(n: int, spans: list[bytes] | None) -> np.ndarray:
    """True for the words of a text of n that its spans cover."""
    gone = np.zeros(n + 1, np.int64)
    if spans:
        x = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
        np.add.at(gone, x[:, 0], 1)
        np.add.at(gone, x[:, 1], -1)
    return np.cumsum(gone)[:n] > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   part_docs: int = PART_DOCS) -> DataFrame:
    """Every input row and column, the text without the words that earlier documents cover,
    plus n_words, n_removed and kept_sha256 (of the kept words, joined by one space).

    A word goes if a window of ``window`` consecutive words over it also starts in a
    document with a smaller id; all windows are taken from the input. Texts that lose
    nothing stay as they are, others become their kept words with one space between.
    A null text has no words and stays null. Rows with a null id lose nothing and
    cover nothing; rows with the same id don't cover one another. An empty table
    stays empty; columns with the names of the new ones are replaced.
    """
    kept = docs.drop("n_words", "n_removed", "kept_sha256")
    names = kept.columns
    n = docs.count()
    parts = parts_for(n, part_docs)
    own = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("th"), F.col(text_col).cast("binary").alias("t")).where("id IS NOT NULL")
    hot = hot_anchors(own, window, gram) if n > HOT_RUNS else np.zeros(0, np.uint64)
    spans = repeated_spans(own, parts, window, gram, hot).select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("spans").alias("__spans"))
    rows = kept.join(spans, (F.col(id_col).cast("long") == F.col("__id")) & (text_key(F.col(text_col)) == F.col("__th")), "left").drop("__id", "__th")
    at, text_type = names.index(text_col), docs.schema[text_col].dataType

    def run(batches):
        for b in batches:
            for lo, hi in chunks(b, at):
                part = b.slice(lo, hi - lo)
                texts, n, gone, sha = [], [], [], []
                for t, s in zip(part.column(at).to_pylist(), part.column(len(names)).to_pylist(), strict=True):
                    words = (t or "").encode().split()
                    drop = covered_words(len(words), s) if s else None
                    left = [w for w, x in zip(words, drop.tolist(), strict=True) if not x] if s else words
                    whole = b" ".join(left)
                    texts.append(whole.decode() if len(left) < len(words) else t)
                    n.append(len(words))
                    gone.append(len(words) - len(left))
                    sha.append(hashlib.sha256(whole).hexdigest())
                cols = [pa.array(texts, pa.string()) if i == at else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                                                 [*names, "n_words", "n_removed", "kept_sha256"])

    if text_type.simpleString() != "string":
        raise ValueError("the text column must hold strings")
    out = kept.withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept_sha256": F.lit("")})
    return rows.mapInArrow(run, out.schema)
