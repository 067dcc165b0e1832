"""Hashed words and character n-grams, and a table of per-word values that a task
computes once per different word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from riskframe.llm.common import mix


def subword_ids(words: list[str], buckets: int, sizes: tuple[int, ...] = (3,), whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word and of each character n-gram of ``<word>``: (ids, owner).

    owner is the word's place in ``words``, ascending; every word owns one id at least.
    """
    text = "".join([f"<{w}>" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(start + size, size) - np.arange(len(codes))  # characters to the word's end
    ids, owners = [], []
    if whole or not sizes:
        place = np.arange(len(codes)) - np.repeat(start, size)
        h = np.add.reduceat(mix(codes + mix(place.astype(np.uint64) + np.uint64(7))), start) if len(words) else np.zeros(0, np.uint64)
        ids.append(mix(h))
        owners.append(np.arange(len(words)))
    for k in sizes:
        if len(codes) < k:
            continue
        h = np.full(len(codes) - k + 1, k, np.uint64)
        for i in range(k):
            h = mix(h + codes[i : len(codes) - k + 1 + i])
        ok = left[: len(h)] >= k
        ids.append(h[ok])
        owners.append(owner[: len(h)][ok])
    flat, own = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return (flat[order] % np.uint64(buckets)).astype(np.int64), own[order]


def mean_by_owner(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Mean of the value rows of each owner; owners are ascending and each has a row."""
    if not n:
        return np.zeros((0, *values.shape[1:]), values.dtype)
    first = np.searchsorted(owner, np.arange(n))
    count = np.diff(np.append(first, len(owner)))
    s = np.add.reduceat(values, first, axis=0)
    return s / (count if values.ndim == 1 else count[:, None])


class WordTable:
    """Rows of values by word. ``compute`` makes the rows of the words not met before.

    Holds at most ``limit`` words between calls, so its memory is bounded.
    """

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, limit: int = 300_000):
        self.compute, self.width, self.limit = compute, width, limit
        self._empty()

    def _empty(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, self.width), np.float32)

    def index(self, words: list[str]) -> np.ndarray:
        """Places of the words' rows in ``rows``, valid until the next call."""
        if len(self.place) > self.limit:
            self._empty()
        place, n = self.place, len(self.place)
        new = list({w for w in words if w not in place})
        if new:
            place.update(zip(new, range(n, n + len(new)), strict=True))
            if len(place) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(len(place) - len(self.rows), len(self.rows)), self.width), np.float32)])
            for at in range(0, len(new), 50_000):
                part = new[at : at + 50_000]
                self.rows[n + at : n + at + len(part)] = self.compute(part)
        return np.fromiter(map(place.__getitem__, words), np.int64, len(words))


def words_of(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The space-separated words of all texts, and each text's word count."""
    split = [t.split() if t else [] for t in texts]
    return [w for s in split for w in s], np.fromiter(map(len, split), np.int64, len(split))
