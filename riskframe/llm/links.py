"""Link counts of the similarity join: for each document, how many others are similar.

Components need only enough links to join them; a count needs all. Pairs that met in
small groups are verified as rows. Sets that rely on large groups are counted in the
tasks where blocks of their family meet: a task multiplies the membership of its two
blocks' shingles, which gives every intersection exactly, and returns a sum per class,
so a family of close copies sends no pairs.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Words, checkpointed, chunks, parts_for
from riskframe.llm.graph import components
from riskframe.llm.parity import CANDIDATE, COPY, PART_DOCS, PERCENT, SHINGLE, large_ties, met_sets, shingle_set, verified, within_reach

#: Classes of a block, and shingles of a block; a longer set is a block's only one.
BLOCK_SETS = 512
BLOCK_SHINGLES = 1_000_000
#: Cells of a membership matrix that a task multiplies at one time.
CELLS = 1 << 22


def intersections(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The size of every intersection of a set in ``x`` with one in ``y`` (sets of distinct values)."""
    sizes = np.array([len(s) for s in (*x, *y)])
    out = np.zeros((len(x), len(y)))
    if not sizes.sum():
        return out
    _, code, count = np.unique(np.concatenate([*x, *y]), return_inverse=True, return_counts=True)
    keep = np.flatnonzero(count[code] > 1)  # the others are in no intersection
    row, code = np.repeat(np.arange(len(sizes)), sizes)[keep], (np.cumsum(count > 1) - 1)[code[keep]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    wide = max(1, CELLS // len(sizes))
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, wide):
        at = slice(*np.searchsorted(code, [lo, lo + wide]))
        m = np.zeros((len(sizes), wide), np.float32)
        m[row[at], code[at] - lo] = 1
        out += m[: len(x)] @ m[len(x) :].T
    return out


def family_counts(members: DataFrame, percent: int) -> DataFrame:
    """(cls, links): for each member (family, cls, weight, n, shingles), the weights of the similar others of its family.

    A family is cut by size, each band a third larger than the one before, so that similar sets lie
    in one band or in neighbours, and a band by hash into blocks of bounded sets and shingles. Each
    two blocks of near bands meet in one task. A family of similar sets costs the square of its size
    in arithmetic and its texts' shingles once per other block; rows of pairs are never made.
    """
    members = members.withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent))).cast("int"))
    sized = members.groupBy("family", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = checkpointed(members.join(sized, ["family", "band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).drop("blocks"))
    # blocks, not rows, meet here
    one = placed.select("family", "band", "block").distinct()
    two = one.select(F.col("family").alias("f2"), F.col("band").alias("band2"), F.col("block").alias("block2"))
    near = (F.col("family") == F.col("f2")) & (F.col("band2") - F.col("band")).between(0, 1) & ((F.col("band") < F.col("band2")) | (F.col("block") <= F.col("block2")))
    meets = checkpointed(one.join(two, near).select("family", "band", "block", "band2", "block2"))
    key = ["family", "band", "block", "band2", "block2"]
    own = ["cls", "weight", "n", "shingles"]
    left = meets.join(placed, ["family", "band", "block"]).select(*key, F.lit(0).alias("side"), *own)
    other = placed.withColumnsRenamed({"band": "band2", "block": "block2"})
    right = meets.where("band < band2 OR block < block2").join(other, ["family", "band2", "block2"]).select(*key, F.lit(1).alias("side"), *own)

    def count(_: Any, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("cls")
        a, b = t[t.side == 0], t[t.side == 1]
        same = not len(b)
        b = a if same else b
        sets = [[np.frombuffer(v, np.uint64) for v in s.shingles] for s in (a, b)]
        both = intersections(*sets)
        n, m = a.n.to_numpy()[:, None], b.n.to_numpy()[None]
        ok = 100 * both >= percent * (n + m - both)
        ok &= a.cls.to_numpy()[:, None] != b.cls.to_numpy()[None]
        out = [pd.DataFrame({"cls": a.cls, "links": ok @ b.weight.to_numpy()})]
        if not same:
            out.append(pd.DataFrame({"cls": b.cls, "links": a.weight.to_numpy() @ ok}))
        out = pd.concat(out)
        return out[out.links > 0]

    sums = left.unionAll(right).groupBy(*key).applyInPandas(count, "cls long, links long")
    return sums.groupBy("cls").agg(F.sum("links").alias("links"))


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT, part_docs: int = PART_DOCS) -> DataFrame:
    """doc_id, n_shingles, class_id and n_links per row: how many other rows have a similar text.

    Similar is as in ``parity.similar_documents``; equal sets are. class_id is the smallest id with
    the same set. Every row counts by itself: rows that repeat an id are different rows here, so a
    repeated row is one link more. Empty sets (null, empty and blank texts) have no links and a class
    of their own. Rows with a null id take no part: their other columns are null. Other columns are
    not read; an empty table gives no rows.
    """
    rows = checkpointed(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("t")))
    own = rows.where("doc IS NOT NULL").select(F.col("row").alias("id"), "t")
    met, sets = met_sets(own, parts_for(rows.count(), part_docs), k, percent)

    # the class (first row with that set) and its size, of every row
    copy = met.where(F.col("kind") == COPY).select(F.col("a").alias("row"), "n", F.col("b").alias("head"))
    head = sets.select(F.col("id").alias("head"), F.col("first").alias("cls"))
    of = copy.join(head, "head", "left").select("row", "n", F.coalesce("cls", "row").alias("cls")).unionAll(sets.select("id", "n", "first"))
    of = checkpointed(of.join(rows.select("row", "doc"), "row"))
    classes = checkpointed(of.groupBy("cls").agg(F.count(F.lit(1)).alias("weight"), F.first("n").alias("n"), F.min("doc").alias("class_id")))

    # families of sets tied by large groups are counted in blocks
    ties = large_ties(met, sets)
    family = components(ties.select(F.col("lead").alias("a"), F.col("id").alias("b"))).select("id", F.col("component").alias("family"))
    member = checkpointed(family.join(sets.select("id", "first"), "id").select("family", F.col("first").alias("cls")).distinct())

    def shingled(batches):
        seen = Words(xxhash.xxh3_64_intdigest)
        for b in batches:
            for lo, hi in chunks(b, 1):
                seen.trim()
                part = b.slice(lo, hi - lo)
                found = [np.unique(shingle_set(t, seen, k)).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["cls", "shingles"])

    texts = own.withColumnRenamed("id", "cls").join(member.select("cls").distinct(), "cls", "left_semi").select("cls", "t")
    full = member.join(classes.select("cls", "weight", "n"), "cls").join(texts.mapInArrow(shingled, "cls long, shingles binary"), "cls")
    counted = family_counts(full, percent)

    # all other links are between sets that met in a small group
    near = within_reach(met.where(F.col("kind") == CANDIDATE).select("a", "b").distinct(), sets, percent)
    side = lambda c: member.select(F.col("cls").alias(c), F.col("family").alias(f"{c}_family"))
    near = near.join(side("a"), "a", "left").join(side("b"), "b", "left")
    near = near.where("NOT coalesce(a_family = b_family, false)").select("a", "b").distinct()
    linked = verified(near, own, k, percent)
    ways = linked.select(F.col("a").alias("cls"), F.col("b").alias("to")).unionAll(linked.select("b", "a"))
    size = classes.select(F.col("cls").alias("to"), "weight")
    total = ways.join(size, "to").groupBy("cls").agg(F.sum("weight").alias("links")).unionAll(counted).groupBy("cls").agg(F.sum("links").alias("links"))

    known = classes.join(total, "cls", "left").select(F.col("cls").alias("c"), "weight", "class_id", F.coalesce("links", F.lit(0)).alias("links"))
    out = of.join(known, F.col("cls") == F.col("c")).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "class_id", F.when(F.col("n") > 0, F.col("weight") - 1 + F.col("links")).otherwise(0).cast("long").alias("n_links"))
    none = F.lit(None).cast("long")
    return out.unionAll(rows.where("doc IS NULL").select(F.col("doc").alias("doc_id"), none, none, none))
