"""Deterministic sampling, splitting and folds.

Every draw is a function of ``key_hash(key, seed)`` (see
:mod:`riskframe.functions.hashing`), never of row position or partition, so
results are identical in any partitioning, after recomputation, and in DuckDB.

Exact-size samples take, per stratum, the rows with the smallest
(hash, key). Rows are counted per (stratum, hash prefix); the one bucket per
stratum that straddles the cut is refined by further prefix bits until it is
small, and only it is ranked. The result is a literal threshold tuple per
stratum, so the sample is a plain predicate ``(hash, key) <= threshold``:
no union or join, and chained samples keep a small plan. A stratum holding
most rows is spread over its hash buckets like any other.

With more than ``LITERAL_STRATA`` strata, or where rows with one key lie across
the cut, rows are numbered in (hash, key) order per stratum instead and compared
with the stratum's target by a join; rows with one key are told apart by a
number that is written to the checkpoint folder first. Sizes are then exact too,
but which of several rows with one key is taken depends on how they are stored.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import HASH_BITS, hash_below, key_hash
from riskframe.operators.prefix import sequential_id
from riskframe.session import cut_lineage

# Each refinement level splits a hash-prefix bucket into 4096 sub-buckets;
# a cut bucket at or below RANK_LIMIT rows per stratum is ranked directly.
LEVEL_BITS = 12
RANK_LIMIT = 200_000
# Strata whose thresholds are kept as literals; beyond, they stay in Spark.
LITERAL_STRATA = 64


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _stratum_cond(strata: list[str], values: tuple):
    cond = F.lit(True)
    for c, v in zip(strata, values):
        cond = cond & F.col(c).eqNullSafe(F.lit(v))
    return cond


def _prefix_cond(bits: int, prefix: int):
    return F.shiftright(F.col("_rf_h"), HASH_BITS - bits) == F.lit(prefix).cast("bigint")


def smallest_thresholds(df: DataFrame, key, seed, fraction: float | None = None, n: int | None = None,
                        strata: Sequence[str] = ()) -> dict:
    """Per stratum: 'all', 'none', or the (hash, key...) tuple of the last row
    taken when rows are ordered by (hash, key); 'tie' where the next row has
    that tuple too. The target per stratum is ``n`` or ``floor(f * n_s + 0.5)``.

    Rows are counted per 12-bit hash prefix (a few thousand small rows per
    stratum reach the driver); the bucket holding the cut is refined by the
    next 12 bits until it holds at most RANK_LIMIT rows, and only that
    bucket is ranked. Each level is one pass over a narrow projection."""
    keys, strata = _keys(key), list(strata)
    x = df.select(*strata, *keys, key_hash(keys, seed).alias("_rf_h"))
    rows = (x.groupBy(*strata, F.shiftright("_rf_h", HASH_BITS - LEVEL_BITS).alias("_rf_b"))
             .agg(F.count(F.lit(1)).alias("_rf_c")).collect())
    per: dict = {}
    for r in rows:
        per.setdefault(tuple(r[c] for c in strata), []).append((r["_rf_b"], r["_rf_c"]))
    result, open_ = {}, {}
    for st, buckets in per.items():
        total = sum(c for _, c in buckets)
        target = int(n) if n is not None else math.floor(float(fraction) * total + 0.5)
        if target <= 0:
            result[st] = "none"
        elif target >= total:
            result[st] = "all"
        else:
            open_[st] = (0, 0, target, buckets)  # (prefix, bits, need, sub-bucket counts)
    while open_:
        rank_now, refine = {}, {}
        for st, (prefix, bits, need, buckets) in open_.items():
            before = 0
            for b, c in sorted(buckets):
                if before + c >= need:
                    nbits, npref = bits + LEVEL_BITS, (prefix << LEVEL_BITS) | b
                    tgt = rank_now if (c <= RANK_LIMIT or nbits + LEVEL_BITS > HASH_BITS) else refine
                    tgt[st] = (npref, nbits, need - before)
                    break
                before += c
        if rank_now:
            cond = None
            for st, (pref, bits, _) in rank_now.items():
                k = _stratum_cond(strata, st) & _prefix_cond(bits, pref)
                cond = k if cond is None else cond | k
            w = Window.partitionBy(*strata).orderBy("_rf_h", *keys)
            ranked = x.where(cond).withColumn("_rf_rn", F.row_number().over(w))
            want = None
            for st, (_, _, need) in rank_now.items():
                k = _stratum_cond(strata, st) & F.col("_rf_rn").between(need, need + 1)
                want = k if want is None else want | k
            for r in sorted(ranked.where(want).collect(), key=lambda r: r["_rf_rn"]):
                st, tup = tuple(r[c] for c in strata), tuple([r["_rf_h"]] + [r[k] for k in keys])
                result[st] = "tie" if result.get(st) == tup else result.get(st, tup)
        open_ = {}
        if refine:
            cond = None
            for st, (pref, bits, _) in refine.items():
                k = _stratum_cond(strata, st) & _prefix_cond(bits, pref)
                cond = k if cond is None else cond | k
            bits_now = {b for _, b, _ in refine.values()}.pop()
            sub = (x.where(cond).groupBy(*strata, F.shiftright("_rf_h", HASH_BITS - bits_now - LEVEL_BITS)
                                         .bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).alias("_rf_b"))
                   .agg(F.count(F.lit(1)).alias("_rf_c")).collect())
            got: dict = {}
            for r in sub:
                got.setdefault(tuple(r[c] for c in strata), []).append((r["_rf_b"], r["_rf_c"]))
            for st, (pref, bits, need) in refine.items():
                open_[st] = (pref, bits, need, got.get(st, []))
    return result


def smallest_predicate(df: DataFrame, key, seed, thresholds: dict, strata: Sequence[str] = ()):
    """Boolean Column from :func:`smallest_thresholds`: a literal comparison
    of (hash, key...) per stratum, so the plan stays a projection."""
    keys, strata = _keys(key), list(strata)
    types = {f.name: f.dataType for f in df.schema.fields}
    h = key_hash(keys, seed)
    tup = F.struct(h.alias("h"), *[F.col(k).alias(k) for k in keys])
    expr = None
    for st, thr in thresholds.items():
        if thr == "none":
            continue
        cond = _stratum_cond(strata, st)
        if thr != "all":
            lit = F.struct(F.lit(thr[0]).cast("bigint").alias("h"),
                           *[F.lit(v).cast(types[k]).alias(k) for k, v in zip(keys, thr[1:])])
            cond = cond & (tup <= lit)
        expr = cond if expr is None else expr | cond
    return F.coalesce(expr, F.lit(False)) if expr is not None else F.lit(False)


def mark_smallest(df: DataFrame, key, seed, fraction: float | None = None, n: int | None = None,
                  strata: Sequence[str] = (), out: str = "selected", counted: DataFrame | None = None) -> DataFrame:
    """Add boolean ``out``: the row is among the ``n`` (or ``floor(f*n_s+0.5)``
    per stratum) rows with the smallest (hash, key). ``counted`` has the keys and
    strata of the same rows: the passes that look for the cut read it, where ``df`` is wide."""
    wide, df = df, df if counted is None else counted
    few = not strata or df.select(*strata).distinct().limit(LITERAL_STRATA + 1).count() <= LITERAL_STRATA
    thr = smallest_thresholds(df, key, seed, fraction, n, strata) if few else {}
    if few and "tie" not in thr.values():
        return wide.withColumn(out, smallest_predicate(wide, key, seed, thr, strata))
    return _mark_by_number(wide, _keys(key), seed, fraction, n, list(strata), out)


def _mark_by_number(df, keys, seed, fraction, n, strata, out) -> DataFrame:
    """:func:`mark_smallest` by numbering each stratum's rows; any number of
    strata, null strata included, and any number of rows per key."""
    x = cut_lineage(df.withColumns({"_rf_h": key_hash(keys, seed), "_rf_row": F.monotonically_increasing_id()}))
    numbered = sequential_id(x, ["_rf_h", *keys, "_rf_row"], out="_rf_no", partition_cols=strata)
    sizes = x.groupBy(*[F.col(c).alias(f"{c}_rf_st") for c in strata]).agg(F.count(F.lit(1)).alias("_rf_size"))
    target = F.lit(int(n)) if n is not None else F.floor(F.lit(float(fraction)) * F.col("_rf_size") + 0.5)
    sizes = sizes.withColumn("_rf_take", target).drop("_rf_size")
    on = [F.col(c).eqNullSafe(F.col(f"{c}_rf_st")) for c in strata]
    marked = numbered.join(sizes, on, "inner") if strata else numbered.crossJoin(F.broadcast(sizes))  # one row
    marked = marked.withColumn(out, F.col("_rf_no") < F.col("_rf_take"))
    return marked.select(*[c for c in df.columns if c != out], out)


def sample_fraction(df: DataFrame, fraction: float, key, seed, exact: bool = False, counted: DataFrame | None = None) -> DataFrame:
    """About (map-only hash filter) or exactly ``floor(f*n + 0.5)`` rows."""
    if not exact:
        return df.where(hash_below(_keys(key), seed, fraction))
    return mark_smallest(df, key, seed, fraction=fraction, out="_rf_sel", counted=counted).where("_rf_sel").drop("_rf_sel")


def sample_n(df: DataFrame, n: int, key, seed) -> DataFrame:
    """Exactly ``n`` rows (all when fewer) without replacement."""
    return mark_smallest(df, key, seed, n=n, out="_rf_sel").where("_rf_sel").drop("_rf_sel")


def sample_with_replacement(df: DataFrame, n: int, key, seed, draw_col: str = "draw",
                            total: int | None = None) -> DataFrame:
    """D3: ``n`` draws; draw ``i`` takes the row whose key-order number is
    ``hash(i, seed) mod N``. An equi-join on the row number (no hot key: the
    draws are uniform)."""
    keys = _keys(key)
    numbered = sequential_id(df, keys, out="_rf_rowno")
    N = total if total is not None else df.count()
    if N == 0 or n <= 0:
        return numbered.limit(0).drop("_rf_rowno").withColumn(draw_col, F.lit(0).cast("bigint"))
    slots = df.sparkSession.range(int(n)).select(
        F.col("id").alias(draw_col), F.pmod(key_hash(["id"], seed), F.lit(N)).alias("_rf_rowno"))
    return numbered.join(slots, "_rf_rowno", "inner").drop("_rf_rowno")


def resize_to(df: DataFrame, n: int, key, seed, source_col: str = "source_key",
              copy_col: str = "copy_no") -> DataFrame:
    """Top up with draws with replacement, or cut with an exact sample;
    keeps ``source_key`` (the original key) and a copy number."""
    keys = _keys(key)
    base = df.withColumn(source_col, F.col(keys[0])).withColumn(copy_col, F.lit(0).cast("bigint"))
    N = df.count()
    if N == n:
        return base
    if N > n:
        return sample_n(base, n, keys, seed)
    extra = sample_with_replacement(df, n - N, keys, seed, draw_col="_rf_draw", total=N)
    extra = extra.withColumn(source_col, F.col(keys[0])).withColumn(copy_col, F.col("_rf_draw") + 1).drop("_rf_draw")
    return base.unionByName(extra)


def duplicate_rows(df: DataFrame, fraction: float, key, seed, copy_col: str = "copy_no", counted: DataFrame | None = None) -> DataFrame:
    """Append copies of an exact sample; originals get copy 0, copies 1."""
    orig = df.withColumn(copy_col, F.lit(0))
    copies = sample_fraction(df, fraction, key, seed, exact=True, counted=counted).withColumn(copy_col, F.lit(1))
    return orig.unionByName(copies)


def stratified_split(df: DataFrame, label: str, test_fraction: float, key, seed,
                     out: str = "split") -> DataFrame:
    """Per class, ``floor(f*n_class + 0.5)`` rows go to 'test', the rest
    to 'train'. One column, no row leaves the frame."""
    marked = mark_smallest(df, key, seed, fraction=test_fraction, strata=[label], out="_rf_sel")
    return marked.withColumn(out, F.when(F.col("_rf_sel"), "test").otherwise("train")).drop("_rf_sel")


def kfold(df: DataFrame, k: int, key, seed, out: str = "fold") -> DataFrame:
    """Shuffled, equal-size folds: number rows in hash order, mod k."""
    keys = _keys(key)
    x = df.withColumn("_rf_h", key_hash(keys, seed))
    return (sequential_id(x, ["_rf_h", *keys], out="_rf_i")
            .withColumn(out, F.pmod(F.col("_rf_i"), F.lit(k)).cast("int")).drop("_rf_h", "_rf_i"))


def stratified_kfold(df: DataFrame, label: str, k: int, key, seed, out: str = "fold", shuffle: bool = True) -> DataFrame:
    """Stratified folds: rank within class in hash order, mod k. Without ``shuffle``
    each class is cut into k runs of rows in key order."""
    keys = _keys(key)
    if not shuffle:
        sizes = df.groupBy(F.col(label).alias("_rf_class")).agg(F.count(F.lit(1)).alias("_rf_size"))
        ranked = sequential_id(df, keys, out="_rf_i", partition_cols=[label])
        ranked = ranked.join(sizes, ranked[label].eqNullSafe(sizes["_rf_class"]))
        fold = F.floor(F.col("_rf_i") * F.lit(k) / F.col("_rf_size")).cast("int")
        return ranked.withColumn(out, fold).drop("_rf_i", "_rf_class", "_rf_size")
    x = df.withColumn("_rf_h", key_hash(keys, seed))
    return (sequential_id(x, ["_rf_h", *keys], out="_rf_i", partition_cols=[label])
            .withColumn(out, F.pmod(F.col("_rf_i"), F.lit(k)).cast("int")).drop("_rf_h", "_rf_i"))


def permute_column(df: DataFrame, col: str, key, seed) -> DataFrame:
    """Shuffle one column: the row of key rank i takes ``col`` from the
    row of hash rank i (two bucketed numberings and an equi-join)."""
    keys = _keys(key)
    by_key = sequential_id(df.drop(col), keys, out="_rf_i")
    by_hash = sequential_id(df.select(*keys, col).withColumn("_rf_h", key_hash(keys, seed)),
                            ["_rf_h", *keys], out="_rf_i").select("_rf_i", col)
    return by_key.join(by_hash, "_rf_i", "inner").drop("_rf_i")


def permute_columns(df: DataFrame, cols: Sequence[str], key, seeds: Sequence[int], rep: str = "_rf_rep", prefix: str = "_rf_p_") -> DataFrame:
    """D9 for several columns and seeds: every row once per seed, numbered in ``rep``, with
    ``prefix + c`` holding what :func:`permute_column` of ``c`` with that seed gives the row. The numbering by key
    serves all seeds, that by hash all columns."""
    keys = _keys(key)
    by_key = cut_lineage(sequential_id(df, keys, out="_rf_i"))
    out = None
    for r, seed in enumerate(seeds):
        by_hash = sequential_id(df.select(*keys, *[F.col(c).alias(prefix + c) for c in cols]).withColumn("_rf_h", key_hash(keys, seed)),
                                ["_rf_h", *keys], out="_rf_i").select("_rf_i", *[prefix + c for c in cols])
        part = by_key.join(by_hash, "_rf_i", "inner").drop("_rf_i").withColumn(rep, F.lit(r))
        out = part if out is None else out.unionByName(part)
    return out


def sample_grid(grid: dict, n: int = 50, seed: int = 42, limit: int = 100) -> list[dict]:
    """All combinations when the grid has at most ``limit``, else ``n``
    drawn without replacement (driver-side; grids are tiny)."""
    import itertools
    names = list(grid)
    combos = [dict(zip(names, vals)) for vals in itertools.product(*[grid[k] for k in names])]
    if len(combos) <= limit:
        return combos
    return random.Random(seed).sample(combos, n)
