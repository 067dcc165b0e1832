"""Benchmark decontamination by winnowing, in DataFrame functions alone.

A text's fingerprints are the least hash of four consecutive words in each run of
seven, so every ten words in a row leave one, wherever they stand. Fingerprints of
documents and benchmark items are joined; only documents with a hit are then
compared window by window and their hits extended to words. Items shorter than a
window are one window of their own length, matched by its hash directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import checkpointed

WINDOW, GRAM = 10, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark windows (24 bytes each) up to which they are sent to every task; beyond, both sides shuffle.
BROADCAST_WINDOWS = 500_000


def item_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    plain = F.octet_length(text) == F.char_length(text)  # for ASCII, lower() does the same and faster
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def windows_of(h: Column, n: Column, size: int) -> Column:
    """Starts 0.. of all runs of ``size`` among ``n`` values; none if there are fewer."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def hashed(df: DataFrame, text: str) -> DataFrame:
    """Adds n, the words, and h, a hash of each word, in place of the text."""
    df = df.withColumn("words", item_words(F.col(text))).drop(text)
    return df.select(*[c for c in df.columns if c != "words"], F.size("words").alias("n"),
                     F.transform("words", lambda w: F.xxhash64(w)).alias("h"))


def run_hash(h: Column, i: Column, size: int, salt: int = 0) -> Column:
    return F.xxhash64(F.lit(size + 1000 * salt), *[h[i + k] for k in range(size)])


def fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """Replaces h by fps: winnowed hashes, and hashes of all runs of the ``short`` lengths."""
    h, n = F.col("h"), F.col("n")
    df = df.withColumn("g", F.transform(windows_of(h, n, GRAM), lambda i: run_hash(h, i, GRAM)))
    g, span = F.col("g"), WINDOW - GRAM + 1
    least = F.transform(windows_of(g, F.size(g), span), lambda i: F.least(*[g[i + k] for k in range(span)]))
    runs = lambda k: F.transform(windows_of(h, n, k), lambda i: run_hash(h, i, k, 1))
    fps = F.array_distinct(F.concat(least, *map(runs, short)))
    return df.withColumn("fps", fps).drop("g", "h")


def window_rows(df: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """A row (size, pos, a, b) for each window of the given lengths; a and b are its 128-bit hash."""
    h, n = F.col("h"), F.col("n")
    one = lambda k: F.transform(windows_of(h, n, k), lambda i: F.struct(
        F.lit(k).alias("size"), i.alias("pos"), run_hash(h, i, k, 2).alias("a"), run_hash(h, i, k, 3).alias("b")))
    return df.select(*keep, F.inline(F.concat(*[one(k) for k in lengths])))


def covered(spans: Column) -> Column:
    """Words that a set of (pos, size) spans covers together."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("words"))

    def add(acc, s):
        end = (s["pos"] + s["size"]).cast("long")
        new = F.greatest(F.lit(0).cast("long"), end - F.greatest(s["pos"].cast("long"), acc["end"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["words"] + new).alias("words"))

    return F.aggregate(F.array_sort(spans), start, add, lambda acc: acc["words"])


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans per document.

    A word is hit inside any occurrence of a window of any item. Null and empty texts
    have no words and no hit; items without words or id take no part; items with the
    same id count as one. Documents are told apart by id and text, so a repeated row
    gives a row each time and a null id is an id of its own. Other columns are not
    read; an empty table gives no rows, an empty benchmark no hit.
    """
    b = hashed(bench.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("t")), "t")
    b = checkpointed(b.where(F.col("item").isNotNull() & (F.col("n") > 0)))
    sizes = b.groupBy(F.least("n", F.lit(WINDOW)).alias("size")).agg(F.sum(F.greatest(F.lit(1), F.col("n") - WINDOW + 1)).alias("k")).collect()  # WINDOW rows at most
    lengths = sorted(r["size"] for r in sizes)
    short = [k for k in lengths if k < WINDOW]
    small = sum(r["k"] for r in sizes) <= BROADCAST_WINDOWS
    send = F.broadcast if small else (lambda df: df)

    key = ["id", "th"]
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("t"))
    # items give the runs of their own length only, long ones none
    own = fingerprints(b.where(F.col("n") >= WINDOW), []).select(F.explode("fps").alias("fp"))
    for k in short:
        own = own.unionAll(b.where(F.col("n") == k).select(run_hash(F.col("h"), F.lit(0), k, 1).alias("fp")))
    own = own.distinct().select(F.col("fp").alias("own_fp"), F.lit(True).alias("hit"))
    # a row without fingerprint stands for the document itself, so that none is lost; it goes
    # by the document's hash into the join, where it matches nothing
    prints = fingerprints(hashed(d, "t"), short).select(*key, "n", F.explode(F.concat(F.array(F.lit(None).cast("long")), "fps")).alias("fp"))
    prints = prints.withColumn("at", F.coalesce("fp", F.xxhash64(*key)))
    seen = prints.join(send(own), (F.col("at") == F.col("own_fp")) & F.col("fp").isNotNull(), "left").where(F.col("fp").isNull() | F.col("hit"))
    seen = checkpointed(seen.groupBy(*key).agg(
        F.max("n").alias("n"), F.count_if(F.col("fp").isNull()).alias("times"), F.coalesce(F.bool_or("hit"), F.lit(False)).alias("hit")))

    found = seen.where("hit").select(F.col("id").alias("fid"), F.col("th").alias("fth"))
    near = d.join(found, F.col("id").eqNullSafe(F.col("fid")) & (F.col("th") == F.col("fth")), "left_semi")
    mine = window_rows(hashed(near, "t"), key, lengths) if lengths else window_rows(hashed(near, "t"), key, [WINDOW])
    theirs = [window_rows(b.where(F.col("n") >= WINDOW), ["item"], [WINDOW])]
    theirs += [window_rows(b.where(F.col("n") == k), ["item"], [k]) for k in short]
    items = theirs[0]
    for t in theirs[1:]:
        items = items.unionAll(t)
    items = items.drop("pos").distinct()
    hits = mine.join(send(items), ["size", "a", "b"])
    # both sets are bounded: by the document's windows, and by the items there are
    per = hits.groupBy(*key).agg(F.collect_set(F.struct("pos", "size")).alias("spans"), F.collect_set("item").alias("items"))
    per = per.select(F.col("id").alias("hid"), F.col("th").alias("hth"), covered(F.col("spans")).alias("n_hit"), F.array_sort("spans").alias("spans"), F.array_sort("items").alias("items"))
    out = seen.join(per, F.col("id").eqNullSafe(F.col("hid")) & (F.col("th") == F.col("hth")), "left")
    none = F.array().cast("array<string>")
    return out.withColumn("_row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.col("th").alias("text_hash"), "spans")


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with no hit, all columns kept."""
    bad = contamination(docs, bench, id_col, text_col).where("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("_bad_id")) & (F.xxhash64(F.col(text_col)) == F.col("_bad_text")), "left_anti")
