"""Byte-level BPE ids of whole texts.

Pre-tokens of this vocabulary never reach back over a space or line end that
follows a non-space, so a text may be cut there and the cuts encoded apart. Marks
that end a cut after a letter or digit are a pre-token of their own too. Each task
therefore encodes each different cut once, through the tokenizer's own batch call,
and joins the ids. Texts with longer runs of white space are encoded whole.
"""

from __future__ import annotations

import os
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskframe.llm.common import CACHE_WORDS


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Bytes of text encoded at one time; the more, the more often a cut comes again.
TEXT_BYTES = 8 << 20
#: Marks that may close a cut.
MARKS = ".,;:!?"
SEEN = 1 << 22
#: White space other than the space and the line end, in any Unicode version.
OTHER_SPACE = [chr(c) for c in (*range(9, 14), *range(28, 32), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000) if c != 10]
#: The last letter up to which every Unicode version agrees on what is a letter.
LATIN = "\u024f"


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    """Ids as little-endian 32-bit bytes; keeps at most ``CACHE_WORDS`` different cuts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.kept: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)  # by hash, whether a cut may have come before
        self.id_bytes = [pack("<I", i) for i in range(self.tok.get_vocab_size())]
        # how this vocabulary writes a byte: printable Latin-1 as itself, the others as letters from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.lead = self.letters[32]

    def _ids(self, texts: list[str]) -> list[bytes]:
        one = self.id_bytes
        return [b"".join([one[i] for i in e.ids]) for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def _mark(self, end: str) -> bytes:
        if end not in self.marks:
            self.marks[end] = self._ids([end])[0]
        return self.marks[end]

    def _learn(self, cuts: list[str]) -> dict[str, bytes]:
        """The ids of new cuts. Letters after a space are one pre-token: its bytes, in the
        vocabulary's letters, go straight to the model. All other cuts are encoded.

        Most words of a corpus come once; only cuts met in an earlier call too are kept."""
        one, merge, lead = self.id_bytes, self.tok.model.tokenize, self.lead
        rest, fresh = [], {}
        for c in cuts:
            core = c.rstrip(MARKS)
            if not core.isalpha() or not core.isascii() and max(core) > LATIN:
                rest.append(c)
                continue
            end = c[len(core) :]
            if end and (ids := self.kept.get(core)):
                fresh[c] = ids + self._mark(end)
                continue
            word = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([one[t.id] for t in merge(lead + word)])
            fresh[c] = ids + self._mark(end) if end else ids
        # a line's first cut has its line end, all others follow a space
        fresh.update(zip(rest, self._ids([c if c[0] == "\n" else " " + c for c in rest]), strict=True))
        seen, kept = self.seen, self.kept
        for c, ids in fresh.items():
            at = hash(c) % SEEN
            if seen[at]:
                kept[c] = ids
            else:
                seen[at] = 1
        return fresh

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; null and empty texts have none."""
        whole, out = [], [b""] * len(texts)
        if len(self.kept) > CACHE_WORDS:
            self.kept.clear()
            self.marks.clear()
        cut = []
        for i, t in enumerate(texts):
            if t:
                # a cut that is empty or ends in white space would share its pre-token with the next
                odd = "  " in t or "\n\n" in t or " \n" in t or "\n " in t or t[-1].isspace() or any(c in t for c in OTHER_SPACE)
                (whole if odd else cut).append(i)
        if cut:
            ids, edge = self._encode_cuts([texts[i] for i in cut])
            for i, s, e in zip(cut, edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                out[i] = ids[s:e].tobytes()
        for i, ids in zip(whole, self._ids([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return out

    def _encode_cuts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin. Cuts are told apart
        in Arrow, so that Python sees each different one of the call once."""
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        offset = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        names, which = words.dictionary.to_pylist(), words.indices.to_numpy().astype(np.int64)
        heads = self._ids([names[i] for i in which[offset[:-1]]])  # a text's first cut follows nothing
        which[offset[:-1]] = len(names) + np.arange(len(texts))
        used = np.bincount(which, minlength=len(names))[: len(names)].tolist()
        ids = [self.kept.get(c) if n else b"" for c, n in zip(names, used, strict=True)]
        fresh = self._learn([c for c, x in zip(names, ids, strict=True) if x is None])
        ids = [fresh[c] if x is None else x for c, x in zip(names, ids, strict=True)] + heads
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        count = size[which]
        end = np.cumsum(count)
        return flat[np.repeat(first[which] - end + count, count) + np.arange(end[-1])], np.append(0, end)[offset]
