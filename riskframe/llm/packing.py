"""Packing token pieces into sequences: best fit, then local search by swaps."""

from __future__ import annotations

import zlib
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import checkpointed, chunks, parts_for
from riskframe.llm.tokens import TEXT_BYTES, default_tokenizer, encoder

CAPACITY = 1024
#: Pieces that one task packs; each shard can lose at most one partly filled sequence.
SHARD_PIECES = 8192
END_OF_TEXT = 2


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 capacity: int = CAPACITY, end_id: int = END_OF_TEXT) -> DataFrame:
    """Each document's ids plus an end id, cut into pieces only where longer than ``capacity``.

    The first piece takes what is left over, the others are full. Returns doc_id,
    piece, start, length, ids_crc32. Null or empty texts give one piece of one id;
    repeated rows and null ids give pieces of their own. Other columns are not read.
    """
    path = tokenizer or default_tokenizer()
    end = end_id.to_bytes(4, "little")

    def run(batches):
        enc = encoder(path)
        for b in batches:
            for lo, hi in chunks(b, 1, TEXT_BYTES):
                rows = []
                ids = enc.encode(b.column(1).slice(lo, hi - lo).to_pylist())
                for doc, x in zip(b.column(0).slice(lo, hi - lo).to_pylist(), ids, strict=True):
                    x += end
                    n, at, piece = len(x) // 4, 0, 0
                    while at < n:
                        size = (n - at) % capacity or capacity
                        rows.append((doc, piece, at, size, zlib.crc32(x[4 * at : 4 * (at + size)])))
                        at, piece = at + size, piece + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: longest first, each into the fullest bin that still holds it.

    Bins wait by free room; the rooms in use are bits of one number, so the
    smallest room that is enough is found in a step.
    """
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, bins = 0, []
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        n = lengths[i]
        fits = used >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                used ^= 1 << r
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        if r - n:
            room[r - n].append(b)
            used |= 1 << (r - n)
    return bins


class _Open:
    """The underfull bins of a shard, with tables that find what a bin can give back.

    ``one[a, x]`` is the least of 0 and the lengths in bin a that is x or more, ``two[a, x]`` the least sum
    of two of its pieces; ``capacity + 1`` stands for none. So for a length s coming in, the
    exchange that fills bin a most is one lookup at s less its gap, whatever the number of pieces.
    """

    def __init__(self, bins: list[list[int]], size: list[int], capacity: int):
        self.bins, self.size, self.capacity = bins, size, capacity
        self.fill = np.array([sum(size[i] for i in x) for x in bins], np.int64)
        self.one = np.full((len(bins), capacity + 2), capacity + 1, np.int16)
        self.two = self.one.copy()
        for a in range(len(bins)):
            if self.fill[a] < capacity:
                self.note(a)

    def sums(self, a: int) -> tuple[np.ndarray, np.ndarray]:
        """The different lengths in a bin, and the different sums of two of its pieces."""
        n = np.sort(np.array([self.size[i] for i in self.bins[a]], np.int64))
        own = np.unique(n)
        both = np.zeros(self.capacity + 1, bool)
        for v in own.tolist():
            both[(own + v)[(own != v) | (np.searchsorted(n, v, "right") - np.searchsorted(n, v) > 1)]] = True
        return own, np.flatnonzero(both)

    def note(self, a: int) -> None:
        for table, held in zip((self.one, self.two), self.sums(a), strict=True):
            row = np.full(self.capacity + 2, self.capacity + 1, np.int16)
            row[held] = held
            if table is self.one:
                row[0] = 0
            table[a] = np.minimum.accumulate(row[::-1])[::-1]

    def step(self, b: int) -> bool:
        """Takes from bin b, for a bin at least as full, what raises the squared fills most; one piece over, one for
        one, two for one or one for two. A step that closes a bin goes first. False if there is none."""
        others = np.flatnonzero((self.fill >= self.fill[b]) & (self.fill < self.capacity))
        others = others[others != b]
        if not len(others) or not self.bins[b]:
            return False
        gap = self.capacity - self.fill[others]
        own, both = self.sums(b)
        best = (-1, 0, 0, 0, 0)
        for kind, s, tables in ((1, own, (self.one, self.two)), (2, both, (self.one,))):
            if not len(s):
                continue
            low = np.maximum(s[:, None] - gap, 0)
            for give, table in enumerate(tables):
                back = table[others, low].astype(np.int64)
                gain = np.where(back < s[:, None], s[:, None] - back, 0)
                # rise of the squares, 2 x gain x (gap between the fills + gain), after whether it closes the bin
                rise = np.where(gain > 0, 2 * gain * (self.fill[others] - self.fill[b] + gain) + (gain == gap) * (8 * self.capacity**2), -1)
                i = int(np.argmax(rise))
                if rise.flat[i] > best[0]:
                    r, c = divmod(i, len(others))
                    best = (int(rise.flat[i]), int(others[c]), int(s[r]), kind, int(back[r, c]) if not give else -int(back[r, c]))
        if best[0] <= 0:
            return False
        _, a, s, kind, back = best
        out = self.pick(b, s, kind)
        into = self.pick(a, abs(back), 2 if back < 0 else 1) if back else []
        for i in out:
            self.bins[b].remove(i)
        for i in into:
            self.bins[a].remove(i)
        self.bins[a] += out
        self.bins[b] += into
        moved = s - abs(back)
        self.fill[a] += moved
        self.fill[b] -= moved
        self.note(a)
        self.note(b)
        return True

    def pick(self, a: int, total: int, pieces: int) -> list[int]:
        """One or two pieces of a bin with this length in all."""
        if pieces == 1:
            return [next(i for i in self.bins[a] if self.size[i] == total)]
        seen: dict[int, int] = {}
        for i in self.bins[a]:
            if total - self.size[i] in seen:
                return [seen[total - self.size[i]], i]
            seen.setdefault(self.size[i], i)
        raise ValueError("no such pair")


def improve(bins: list[list[int]], size: list[int], capacity: int) -> list[list[int]]:
    """Moves and swaps between underfull bins that raise the sum of squared fills, until there is none.

    From the emptiest bin up, each gives to bins at least as full, one piece over, one for one, two for
    one or one for two, as long as a step exists; every bin, piece and pair is a candidate. Steps raise the sum
    of squares, an integer with a bound, so the search ends. Bins that emptied are left out.
    """
    full = [x for x in bins if sum(size[i] for i in x) >= capacity]
    open_ = _Open([list(x) for x in bins if sum(size[i] for i in x) < capacity], size, capacity)
    changed = True
    while changed:
        changed = False
        for b in np.argsort(open_.fill, kind="stable").tolist():
            while 0 < open_.fill[b] < capacity and open_.step(b):
                changed = True
    return full + [x for x in open_.bins if x]


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, length_col: str = "length") -> DataFrame:
    """Adds sequence_id and offset: pieces side by side from 0 in sequences of at most ``capacity``.

    Pieces are dealt evenly to shards whatever their ids, so copies of a document
    don't meet in one task; each shard is packed alone. Pieces with null, zero or
    negative length take no room: they get null for both. A longer piece than
    ``capacity`` is an error. Columns named sequence_id or offset are replaced; an
    empty table stays empty.
    """
    kept = checkpointed(pieces.drop("sequence_id", "offset"))
    n = kept.count()
    shards = parts_for(n, shard_pieces, 1)
    # rows keep their place once written, so this number is the same when a task runs again
    kept = kept.withColumn("_place", F.monotonically_increasing_id())
    dealt = kept.select("_place", F.col(length_col).cast("long").alias("_size"),
                        F.pmod(F.xxhash64("_place"), F.lit(shards)).alias("_shard"))

    def run(key: Any, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("_place")
        size = x["_size"].tolist()
        if max(size) > capacity:
            raise ValueError(f"a piece of {max(size)} does not fit {capacity}")
        seq, off = [0] * len(size), [0] * len(size)
        for b, members in enumerate(improve(best_fit(size, capacity), size, capacity)):
            at = 0
            for i in members:
                seq[i], off[i] = (int(key[0]) << 32) + b, at
                at += size[i]
        return pd.DataFrame({"_place": x["_place"], "sequence_id": seq, "offset": off})

    placed = dealt.where("_size > 0").groupBy("_shard").applyInPandas(run, "_place long, sequence_id long, offset long")
    return kept.join(placed, "_place", "left").drop("_place")
