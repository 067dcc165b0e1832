"""Conversation prefix trie, with count-min screening of prefix digests.

Every prefix of a conversation has a 128-bit digest. A count-min sketch of all digests has
counters that stop at two; an estimate of one proves that a single conversation has the
prefix, and with it every longer one, so those tails are emitted where they are. Only prefixes
that may be shared are shuffled and grouped exactly.

Sums over subtrees need no walk over the levels: a node belongs to its smallest member, so
along a conversation the nodes that it owns are all from some depth on (``own``). Each node
of a subtree is then counted once, by its owner, in a sum over members:
children are the next nodes owned, leaves the owned ends that nobody passes, and saved
words, members times words less the words of all nodes, are the words from the node to ``own``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.blobs import BLOB, blob_batch, split_parts
from riskframe.llm.common import checkpointed, mix, run_starts
from riskframe.llm.hot import join_hot

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations are rebuilt in blocks of this many ids, with up to ``HEAD - 1`` turns of the block's first.
BLOCK, HEAD = 20, 4
#: Sketch: rows of counters, and how many counters a row has.
SKETCH_ROWS, MAX_WIDTH, MIN_WIDTH = 3, 1 << 25, 1 << 10
SEGMENT = 1 << 18
#: Ids joined to one string at one time, of members that end at a node.
ID_SPAN = 512
OUT_ROWS = 8192
ROOT = bytes(16)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

PREFIX = "conv_id long, depth long, digest binary, before long, through long, is_end boolean"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODE_COLS = [c.split()[0] for c in NODE.split(", ")]


def turn_digests(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, said, words): a 128-bit digest of role and text, and the text's number of words.

    Null roles and texts count as empty. Rows without a conversation id belong to none and go.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # the role's length sets apart ("a", "bc") and ("ab", "c")
    said = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), said.alias("said"),
                     F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).where("conv_id IS NOT NULL")


def own_head(conv_id: int) -> int:
    """How many first turns of its block's first conversation a conversation takes over."""
    return zlib.crc32(str(conv_id).encode()) % HEAD


def rebuilt_prefixes(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv_id, depth, digest, before, through, is_end): every prefix of every rebuilt conversation.

    A conversation is its block's first one's first ``own_head`` turns and its own later ones;
    turns go by number, null first, equal numbers by their digest. ``before`` and ``through`` count the
    words up to the prefix's last turn, without and with it. Depth 0 is the root, which
    turnless conversations have as their end. Only digests are shuffled; a block's rows are
    sorted, with spilling, and pass through a task one by one, however long a conversation is.
    """
    block = (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("block")
    keys = ["block", "later", "conv_id", "turn", "said"]
    rows = turns.select(block, (F.col("conv_id") % BLOCK != 0).alias("later"), "conv_id", "turn", "said", "words")
    rows = (rows.repartition(parts, "block") if parts else rows.repartition("block")).sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])

    def run(batches):
        out = Rows(["conv_id", "depth", "digest", "before", "through", "is_end"], [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()])
        at: int | None = None  # the conversation being read
        block, head = None, []  # the first turns of the block's first conversation
        skip, depth, digest, before, through = 0, 0, ROOT, 0, 0

        def add(said: bytes, words: int) -> None:
            nonlocal depth, digest, before, through
            out.add(at, depth, digest, before, through, False)
            digest = hashlib.blake2b(digest + said, digest_size=16).digest()
            depth, before, through = depth + 1, through, through + words

        def begin(conv: int, first: bool) -> None:
            nonlocal at, skip, depth, digest, before, through
            at, depth, digest, before, through = conv, 0, ROOT, 0, 0
            skip = 0 if first else own_head(conv)
            for said, words in head[:skip]:
                add(said, words)

        for b in batches:
            for base, later, conv, said, words in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if base != block:
                    block, head = base, []
                if conv != at:
                    if at is not None:
                        out.add(at, depth, digest, before, through, True)
                    begin(conv, not later)
                if not later and len(head) < HEAD - 1:
                    head.append((said, words))
                if skip:
                    skip -= 1  # an own turn whose place the head has taken
                else:
                    add(said, words)
            yield from out.full()
        if at is not None:
            out.add(at, depth, digest, before, through, True)
        yield from out.rest()

    return rows.select("block", "later", "conv_id", "said", "words").mapInArrow(run, PREFIX)


class Rows:
    """Rows gathered until there are enough for an Arrow batch."""

    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.names, self.types = names, types
        self.rows: list[tuple] = []

    def add(self, *row) -> None:
        self.rows.append(row)

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= OUT_ROWS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.rows), OUT_ROWS):
            cols = zip(*self.rows[lo : lo + OUT_ROWS], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, self.types, strict=True)], self.names)
        self.rows = []


def halves(digests: pa.Array) -> np.ndarray:
    """The two 64-bit halves of each 16-byte digest."""
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 2)


def places(half: np.ndarray, width: int) -> np.ndarray:
    """Counter of each digest in each row of the sketch (rows x digests); the second half steps the first."""
    k = np.arange(SKETCH_ROWS, dtype=np.uint64)[:, None]
    return (mix(half[:, 0][None] + k * (half[:, 1][None] | np.uint64(1))) % np.uint64(width)).astype(np.int64)


def sketch_width(prefixes: int) -> int:
    """Counters a row: four or more for each prefix, up to ``MAX_WIDTH``.

    Beyond that the sketch proves fewer singletons and more prefixes are grouped exactly; results stay.
    """
    return int(min(MAX_WIDTH, max(MIN_WIDTH, 1 << (4 * prefixes - 1).bit_length())))


def count_min(prefixes: DataFrame, width: int) -> np.ndarray:
    """Which counters (rows x width, as bits) were met more than once.

    A task counts its own digests, up to two, and sends for each segment of the sketch the
    counters it met once and more than once; segments are added up in parallel. The driver
    gets and broadcasts their bits alone, SKETCH_ROWS x MAX_WIDTH / 8 bytes (12 MB) at most.
    """
    size = min(SEGMENT, width)
    per_row = width // size
    parts = SKETCH_ROWS * per_row

    def count(batches):
        met = np.zeros((SKETCH_ROWS, width), np.uint8)
        for b in batches:
            if b.num_rows:
                for row, at in enumerate(places(halves(b.column(0)), width)):
                    at, n = np.unique(at, return_counts=True)
                    met[row, at] = np.minimum(2, met[row, at] + n)
        for row in range(SKETCH_ROWS):
            for times in (1, 2):
                at = np.flatnonzero(met[row] == times)
                for p, i in split_parts(at // size, per_row):
                    yield blob_batch([(row * per_row + p, times, (at[i] % size).astype(np.uint32).tobytes())])

    def add(batches):
        met: dict[int, np.ndarray] = {}
        for b in batches:
            for part, times, data in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                m = met.setdefault(part, np.zeros(size, np.uint8))
                at = np.frombuffer(data, np.uint32)
                m[at] = np.minimum(2, m[at] + times)
        for part, m in met.items():
            yield blob_batch([(part, 0, np.packbits(m == 2, bitorder="little").tobytes())])

    out = np.zeros((parts, size // 8), np.uint8)
    for r in prefixes.select("digest").mapInArrow(count, BLOB).repartition(parts, "part").mapInArrow(add, BLOB).collect():
        out[r["part"]] = np.frombuffer(r["data"], np.uint8)
    return out.reshape(SKETCH_ROWS, width // 8)


def single(digests: pa.Array, bits: np.ndarray) -> np.ndarray:
    """True where the sketch's estimate, the least of a digest's counters, is one."""
    at = places(halves(digests), 8 * bits.shape[1])
    return ((bits[np.arange(len(bits))[:, None], at >> 3] >> (at & 7)) & 1).min(axis=0) == 0


def marked(batches, bits: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, tail, start) of a partition's prefixes in order: ``tail`` where the sketch proves the
    prefix or a shorter one of its conversation single, ``start`` at the first such one."""
    carry = None  # the conversation whose tail the last batch ended in
    for b in batches:
        if not b.num_rows:
            continue
        conv, alone = b.column(0).to_numpy(), single(b.column(2), bits)
        first = run_starts(conv)
        inside = conv[0] == carry
        alone[0] |= inside
        seen = np.cumsum(alone)
        tail = seen - np.repeat(seen[first] - alone[first], np.diff(np.append(first, len(conv)))) > 0
        after = np.concatenate(([inside], tail[:-1] & (conv[1:] == conv[:-1])))
        carry = conv[-1] if tail[-1] else None
        yield b, tail, tail & ~after


def shared_prefixes(prefixes: DataFrame, bits) -> DataFrame:
    """The prefixes that other conversations may have too; ``bits`` is a broadcast of ``count_min``."""

    def run(batches):
        for b, tail, _ in marked(batches, bits.value):
            yield b.filter(pa.array(~tail))

    return prefixes.mapInArrow(run, PREFIX)


def tails(prefixes: DataFrame, bits, first: bool) -> DataFrame:
    """Nodes of the prefixes that ``shared_prefixes`` leaves out, one member each.

    ``first`` asks for those whose parent may be shared; their parent_conv_id is still the
    conversation itself. The others' parent is a tail too.
    """

    def run(batches):
        for b, tail, start in marked(batches, bits.value):
            b = b.filter(pa.array(start if first else tail & ~start))
            conv, end = b.column(0), b.column(5).to_numpy(zero_copy_only=False)
            ends = [hashlib.sha256(str(c).encode()).hexdigest() if e else EMPTY_SHA for c, e in zip(conv.to_pylist(), end, strict=True)]
            one = np.ones(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([conv, b.column(1), conv, *(pa.array(x) for x in (one, 1 - end.astype(np.int64), one, 0 * one)), pa.array(ends, pa.string())], NODE_COLS)

    return prefixes.mapInArrow(run, NODE)


def ends_digests(shared: DataFrame, span: int = ID_SPAN) -> DataFrame:
    """(digest, ends_sha256) of the prefixes at which conversations end.

    Ids are joined to strings by spans of ``span`` ids in parallel; a prefix's strings then go
    through one digest in order, read one after the other and never held together.
    """
    ends = shared.where("is_end").select("digest", F.expr(f"conv_id DIV {span}").alias("span"), "conv_id")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    strings = ends.groupBy("digest", "span").agg(ids.alias("ids"))

    def run(batches):
        out = Rows(["digest", "ends_sha256"], [pa.binary(), pa.string()])
        key, h = None, None
        for b in batches:
            for digest, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if digest != key:
                    if key is not None:
                        out.add(key, h.hexdigest())
                    key, h = digest, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(text.encode())
            yield from out.full()
        if key is not None:
            out.add(key, h.hexdigest())
        yield from out.rest()

    ordered = strings.repartition("digest").sortWithinPartitions("digest", "span")
    return ordered.select("digest", "ids").mapInArrow(run, "digest binary, ends_sha256 string")


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; rows with a null id go; null turns come first, rows with
    equal turns go by their digest and repeated rows are turns of their own; other columns aren't read. An
    empty table has no nodes. Common prefixes (a first turn of a third of all conversations) are
    grouped after partial aggregation and joined by broadcast (``join_hot``).
    """
    prefixes = checkpointed(rebuilt_prefixes(turn_digests(df, conv_col, turn_col, role_col, text_col)))
    spark = df.sparkSession
    bits = spark.sparkContext.broadcast(count_min(prefixes, sketch_width(prefixes.count())))
    shared = checkpointed(shared_prefixes(prefixes, bits))
    node = checkpointed(shared.groupBy("digest").agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("members"), F.min("is_end").alias("all_end")))
    total = shared.count()
    met = checkpointed(join_hot(shared, node, "digest", "members", total))
    foreign = F.max(F.when(F.col("least") != F.col("conv_id"), F.struct("depth", "least", "through")))
    passed = F.max(F.col("is_end") & ((F.col("least") != F.col("conv_id")) | ~F.col("all_end")))
    own = met.groupBy("conv_id").agg(foreign.alias("f"), passed.alias("passed"), F.count(F.lit(1)).alias("own_rows"))
    own = checkpointed(own.select("conv_id", "passed", "own_rows", F.coalesce(F.col("f.depth") + 1, F.lit(0)).alias("own"), F.col("f.least").alias("own_parent"),
                                  F.coalesce("f.through", F.lit(0)).alias("before_own")))
    parent = F.when(F.col("depth") == F.col("own"), F.col("own_parent")).otherwise(F.col("conv_id"))
    number = lambda c: F.sum(c.cast("long"))
    nodes = join_hot(met, own, "conv_id", "own_rows", total).groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max(F.when(F.col("least") == F.col("conv_id"), parent)).alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"),
        number(~F.col("is_end") & (F.col("depth") + 1 >= F.col("own"))).alias("n_children"), number(~F.col("passed")).alias("n_leaves"),
        F.sum(F.when(F.col("depth") < F.col("own"), F.col("before_own") - F.col("before")).otherwise(0)).alias("saved_tokens"))
    nodes = nodes.join(ends_digests(shared), "digest", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
    begun = tails(prefixes, bits, first=True).join(own.select("conv_id", "own", "own_parent"), "conv_id", "left")
    begun = begun.withColumn("parent_conv_id", F.when(F.col("depth") == 0, F.lit(None)).otherwise(parent))
    return nodes.select(NODE_COLS).unionAll(begun.select(NODE_COLS)).unionAll(tails(prefixes, bits, first=False))
