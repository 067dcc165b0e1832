"""Personal data: base patterns, and spans that a character network adds.

The network (``tagger``) learns from windows around the patterns' matches and around other
digits and at signs. It reads every window of every whole text; windows overlap, each
decodes its own labels, and a text's labels are put together from the window in which a
character lies furthest from the edge, before spans are read off the whole text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import tagger
from riskframe.llm.common import checkpointed, chunks
from riskframe.llm.tagger import Tagger, char_classes

KINDS = ["email", "ip", "card", "phone"]
WINDOW, OVERLAP = 256, 32
#: Longest span that the network adds.
MOST = 64
#: Windows that the network learns from.
FIT_WINDOW = 96
#: A fit reads about this many documents, by a hash of their ids, and takes at most so many windows of each kind.
FIT_DOCS, FIT_WINDOWS = 20_000, 300
CHUNK = 1 << 20

# Patterns that find the same matches as the plain ones in one pass over any text: where a plain pattern
# would try every start of a long run, these look behind or start at the sign that a match must have.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]")
_SIGNS = re.compile(r"[0-9@]")
_NUMBER = frozenset("0123456789")
_PARTS = re.compile(r"[^\s,;:]+")
_WHOLE = {"email": _MAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def holds(kind: str, part: str) -> bool:
    """Whether a match of the kind's pattern is one of the kind."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in part.split("."))
    if kind == "card":
        digits = part.replace(" ", "").replace("-", "")
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(_DIGITS.findall(part)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns' matches, by start, then kind as listed."""
    out = []
    after = 0  # where the last address ended
    for m in _HOST.finditer(text):
        start = m.start()
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append(("email", start, m.end()))
            after = m.end()
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if holds(kind, m.group())]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def window_starts(n: int, window: int = WINDOW) -> np.ndarray:
    """Starts of the windows of a text of ``n`` characters; the last one ends with the text."""
    if n <= window:
        return np.zeros(min(n, 1), np.int64)
    return np.append(np.arange(0, n - window, window - OVERLAP), n - window)


def labels_of(codes: np.ndarray, n: np.ndarray, model: Tagger) -> np.ndarray:
    """Label of every character of texts laid end to end, ``n`` characters each."""
    out = np.zeros(len(codes), np.uint8)
    begin = np.cumsum(n) - n
    starts = [window_starts(int(k)) for k in n]
    start = np.concatenate([s + b for s, b in zip(starts, begin, strict=True)]) if starts else np.zeros(0, np.int64)
    many = np.array([len(s) for s in starts])
    size = np.repeat(np.minimum(n, WINDOW), many)
    # a window's own part: from the middle of the overlap with the one before to that with the next
    place = np.arange(len(start))
    first = place == np.repeat(np.cumsum(many) - many, many)
    last = place == np.repeat(np.cumsum(many) - 1, many)
    before = np.concatenate(([0], start[:-1]))
    low = np.where(first, 0, (before + WINDOW - start) // 2)
    high = np.where(last, size, np.concatenate((low[1:] + start[1:], [0])) - start)
    order = np.argsort(size, kind="stable")
    for i in range(0, len(order), tagger.BATCH):
        w = order[i : i + tagger.BATCH]
        steps = int(size[w].max())
        at = start[w][:, None] + np.minimum(np.arange(steps), size[w][:, None] - 1)
        got = model.decode(codes[at].astype(np.int64), size[w])
        own = (np.arange(steps) >= low[w][:, None]) & (np.arange(steps) < high[w][:, None])
        out[at[own]] = got[own]
    return out


def added_spans(text: str, labels: np.ndarray, base: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Runs of one label, or the longest rows of their words, that are of its kind and that no base span touches.

    A run that ends inside a number takes in the whole number. Rows of words have ``MOST`` characters at most, more
    than the forms need; an address is one word.
    """
    edges = np.flatnonzero(np.diff(labels)) + 1
    after = 0
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(labels)], strict=True):
        if not labels[lo]:
            continue
        kind = KINDS[labels[lo] - 1]
        while lo > after and text[lo - 1] in _NUMBER and text[lo] in _NUMBER:
            lo -= 1
        while hi < len(text) and text[hi - 1] in _NUMBER and text[hi] in _NUMBER:
            hi += 1
        words = [m.span() for m in _PARTS.finditer(text, max(lo, after), hi)]
        for i, (s, _) in enumerate(words):
            # the longest row of words from here that is of the kind
            for _, e in reversed([w for w in words[i : i + MOST] if w[1] - s <= MOST]) if s >= after else ():
                while e > s and text[e - 1] in ".,;:":
                    e -= 1
                part = text[s:e]
                if _WHOLE[kind].fullmatch(part) and holds(kind, part) and not any(x < e and s < y for _, x, y in base):
                    yield kind, s, e
                    after = e
                    break


def fit_windows(docs: DataFrame, id_col: str, text_col: str, documents: int, windows: int) -> DataFrame:
    """(kind, key, codes, labels): the different windows with the least hashes, ``windows`` or a few more, around
    spans of each kind, and twice as many around other digits and signs and at other places (kinds -1 and -2)."""
    n = docs.count()
    least = -(1 << 63) + min((1 << 64) - 1, int((1 << 64) * min(1.0, documents / max(1, n))))
    some = docs.select(F.col(text_col).alias("t")).where((F.xxhash64(F.col(id_col)) <= least) & F.col(text_col).isNotNull())

    def run(batches):
        held: dict[int, dict[bytes, tuple]] = {}

        def add(kind, codes, labels):
            key = hashlib.blake2b(codes.tobytes(), digest_size=8).digest()
            group = held.setdefault(kind, {})
            group[key] = (codes.tobytes(), labels.tobytes())
            if len(group) > 4 * windows:
                held[kind] = dict(sorted(group.items())[: 2 * windows])

        for b in batches:
            for text in b.column(0).to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                codes, labels = char_classes(text), np.zeros(len(text), np.uint8)
                for kind, lo, hi in spans:
                    labels[lo:hi] = KINDS.index(kind) + 1
                for s in window_starts(len(text), FIT_WINDOW):
                    c, y = codes[s : s + FIT_WINDOW], labels[s : s + FIT_WINDOW]
                    kinds = np.unique(y[y > 0]).tolist()
                    for k in kinds or [-1 if _SIGNS.search(text, s, s + FIT_WINDOW) else -2]:
                        add(k, c, y)
        for kind, group in held.items():
            keys = sorted(group)[: 2 * windows]
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(keys), pa.int32()), pa.array(keys, pa.binary()),
                                              *(pa.array([group[k][i] for k in keys], pa.binary()) for i in (0, 1))], ["kind", "key", "codes", "labels"])

    found = checkpointed(some.mapInArrow(run, "kind int, key binary, codes binary, labels binary").dropDuplicates(["kind", "key"]))
    # hashes are spread evenly: a cut at their first byte leaves about as many as are wanted, and no kind is sorted whole
    byte = F.hex(F.substring("key", 1, 1))
    counts = {(r["kind"], r["b"]): r["n"] for r in found.groupBy("kind", byte.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}  # 256 a kind
    below = F.lit(False)
    for kind in {k for k, _ in counts}:
        seen, wanted = 0, 2 * windows if kind < 0 else windows
        for cut in sorted(b for k, b in counts if k == kind):
            seen += counts[kind, cut]
            if seen >= wanted:
                break
        below |= (F.col("kind") == kind) & (byte <= cut)
    return found.where(below)


def fit_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = FIT_DOCS, windows: int = FIT_WINDOWS) -> Tagger | None:
    """The network, fitted on at most 8 x ``windows`` windows of ``FIT_WINDOW`` characters of about ``documents``
    documents, labelled by the base patterns. None where these find nothing to learn from."""
    found = sorted((r["kind"], bytes(r["key"]), bytes(r["codes"]), bytes(r["labels"])) for r in fit_windows(docs, id_col, text_col, documents, windows).collect())
    rows = [x for kind, group in groupby(found, key=lambda r: r[0]) for x in islice(group, 2 * windows if kind < 0 else windows)]
    if not any(kind > 0 for kind, *_ in rows):
        return None
    size = np.array([len(c) for *_, c, _ in rows])
    codes, y = np.zeros((len(rows), FIT_WINDOW), np.uint8), np.zeros((len(rows), FIT_WINDOW), np.uint8)
    for i, (*_, c, lab) in enumerate(rows):
        codes[i, : len(c)], y[i, : len(c)] = np.frombuffer(c, np.uint8), np.frombuffer(lab, np.uint8)
    return tagger.train(codes, size, y, len(KINDS) + 1)


def find_personal(docs: DataFrame, model: Tagger | None, text_col: str = "text", out: str = "spans") -> DataFrame:
    """Every row and column plus ``spans``: kind, start, end (code points, end exclusive) and
    whether a base pattern found it, by start, then kind as listed.

    What the network adds touches no base span and is of its kind by itself: data that a base pattern's
    longest match ran together with what stood next to it and so lost. Null and
    empty texts have no span; repeated rows get equal ones; a column named ``out`` is replaced; an
    empty table stays empty. A text is never cut: its windows' labels are put together first.
    """
    kept = docs.drop(out)
    at, names = kept.columns.index(text_col), [*kept.columns, out]
    kind = "array<struct<kind:string,start:int,end:int,base:boolean>>"
    schema = kept.withColumn(out, F.lit(None).cast(kind)).schema
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches):
        for b in batches:
            spans: list = []
            for lo, hi in chunks(b, at, CHUNK):
                texts = [t or "" for t in b.column(at).slice(lo, hi - lo).to_pylist()]
                n = np.fromiter(map(len, texts), np.int64, len(texts))
                labels = labels_of(char_classes("".join(texts)), n, model) if model else np.zeros(n.sum(), np.uint8)
                any_ = np.add.reduceat(np.append(labels, 0).astype(np.int64), np.cumsum(n) - n) * (n > 0)
                first = np.cumsum(n) - n
                for i, text in enumerate(texts):
                    base = base_spans(text)
                    more = list(added_spans(text, labels[first[i] : first[i] + n[i]], base)) if any_[i] else []
                    rows = [(*s, True) for s in base] + [(*s, False) for s in more]
                    rows.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                    spans.append([dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in rows])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, struct)], names)

    return kept.mapInArrow(run, schema)


def redact(found: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """The text with each span replaced by its kind in brackets; overlapping spans are one, of the first kind."""

    t, s = found.columns.index(text_col), found.columns.index(spans_col)

    def run(batches):
        for b in batches:
            out = []
            for text, spans in zip(b.column(t).to_pylist(), b.column(s).to_pylist(), strict=True):
                parts, end = [], 0
                for x in spans or [] if text else []:
                    if x["start"] >= end:
                        parts += [text[end : x["start"]], f"[{x['kind']}]"]
                    end = max(end, x["end"])
                out.append(None if text is None else "".join([*parts, text[end:]]))
            cols = list(b.columns)
            cols[t] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return found.mapInArrow(run, found.schema)
