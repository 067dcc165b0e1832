"""Scalar feature functions (F1-F6, F8-F17). All are native Column
expressions, so they stay inside whole-stage codegen; the two relational
ones (F16 one-hot, F17 standardize) read a bounded one-row aggregate first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- F1, F2
def bmi(weight="weight_kg", height="height_cm") -> Column:
    """weight / (height/100)^2; height 0 gives null (ANSI-safe)."""
    return F.try_divide(_c(weight).cast("double"), F.pow(_c(height) / F.lit(100.0), 2))


def safe_ratio(num, den, scale: float = 1.0, eps: float = 0.0) -> Column:
    """num / (den*scale + eps); a zero denominator gives null."""
    return F.try_divide(_c(num).cast("double"), _c(den) * F.lit(float(scale)) + F.lit(float(eps)))


# ---------------------------------------------------------------- F3, F4
def cut(col, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """right-closed bins (b0,b1], (b1,b2], ...; null outside and for null."""
    assert len(labels) == len(bounds) - 1
    x = _c(col)
    expr = None
    for lo, hi, lab in zip(bounds[:-1], bounds[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


def cut_open(col, uppers: Sequence[float], labels: Sequence[str]) -> Column:
    """``<= u1`` -> l1, ``<= u2`` -> l2, ..., else the last label (also
    for null, where every comparison is false)."""
    assert len(labels) == len(uppers) + 1
    x = _c(col)
    expr = None
    for u, lab in zip(uppers, labels[:-1]):
        cond = x <= F.lit(u)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


# ---------------------------------------------------------------- F5, F6
def ordinal(col, mapping: dict, default: int = 0) -> Column:
    """category to points; unknown or null gives ``default``."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, _c(col)), F.lit(default))


def map_lookup(col, mapping: dict, default=None) -> Column:
    """J3 for a small literal mapping (same as :func:`ordinal`, any value type)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, _c(col)), F.lit(default))


# The four lifestyle ordinals.
SMOKING_POINTS = {"Never": 0, "Former": 1, "Current": 2}
ALCOHOL_POINTS = {"Never": 0, "Moderate": 1, "High": 2}
ACTIVITY_POINTS = {"High": 0, "Medium": 1, "Low": 2}
DIET_POINTS = {"Good": 0, "Average": 1, "Poor": 2}

LIFESTYLE_PARTS = (
    ("smoking_status", SMOKING_POINTS),
    ("alcohol_consumption", ALCOHOL_POINTS),
    ("physical_activity_level", ACTIVITY_POINTS),
    ("diet_quality", DIET_POINTS),
)


def lifestyle_score(parts=LIFESTYLE_PARTS) -> Column:
    """sum of the category ordinals (0..8 for the fixed parts)."""
    total = None
    for col, mapping in parts:
        term = ordinal(col, mapping)
        total = term if total is None else total + term
    return total


# Age bins for training (right-closed) and scoring (open ends).
AGE_BOUNDS = (0, 30, 50, 70, 100)
AGE_UPPERS = (30, 50, 70)
AGE_LABELS = ("Young", "Middle-aged", "Senior", "Elderly")


# ---------------------------------------------------------------- F8-F15
def round_half_even(col, d: int = 0) -> Column:
    """F8: banker's rounding, as NumPy/Python round."""
    return F.bround(_c(col), d)


def risk_tier(p, low: float = 0.3, high: float = 0.7) -> Column:
    """< low Low, < high Medium, else High (null also High)."""
    x = _c(p)
    return F.when(x < low, "Low").when(x < high, "Medium").otherwise("High")


# Advice text per tier.
RECOMMENDATIONS = (
    "Routine screening is recommended based on this profile.",
    "Further clinical investigation is advised.",
    "Urgent specialist consultation and diagnostic testing required.",
)


def recommendation(p, low: float = 0.3, high: float = 0.7) -> Column:
    """advice text by the same limits as :func:`risk_tier`."""
    x = _c(p)
    return (F.when(x < low, RECOMMENDATIONS[0]).when(x < high, RECOMMENDATIONS[1])
            .otherwise(RECOMMENDATIONS[2]))


_SPLIT = 134217729.0  # 2^27 + 1, Dekker's splitting constant


def _split(v: float) -> tuple[float, float]:
    t = _SPLIT * v
    hi = t - (t - v)
    return hi, v - hi


def round_exact(col, decimals: int) -> Column:
    """Round the exact binary value of a double to ``decimals`` places, ties
    to even, as Python's ``format`` does (0.2105 -> 0.210 because the double
    lies below the tie; 21.05 -> 21.1 because it lies above). The scaled value
    is formed as an error-free product (Dekker), so the direction is decided
    on the true value, not on the rounded product. All JVM-side arithmetic."""
    x = _c(col).cast("double")
    c = float(10 ** decimals)
    ch, cl = _split(c)
    p = x * F.lit(c)
    t = x * F.lit(_SPLIT)
    xh = t - (t - x)
    xl = x - xh
    err = ((xh * F.lit(ch) - p) + xh * F.lit(cl) + xl * F.lit(ch)) + xl * F.lit(cl)
    f = F.floor(p).cast("double")
    frac = p - f
    up = (F.when(frac > 0.5, 1.0).when(frac < 0.5, 0.0)
          .when(err > 0, 1.0).when(err < 0, 0.0)
          .when(F.pmod(f, F.lit(2.0)) == 0, 0.0).otherwise(1.0))
    res = (f + up) / F.lit(c)
    return F.when((x < 0) & (res == 0), F.lit(-0.0)).otherwise(res)  # Python keeps "-0"


def format_metric(col, decimals: int = 4, pct: bool = False) -> Column:
    """fixed decimals as text, rounded like Python's ``f"{x:.4f}"``;
    ``pct`` multiplies by 100 first and adds '%'."""
    x = _c(col).cast("double")
    if pct:
        x = x * F.lit(100.0)
    text = F.format_string(f"%.{decimals}f", round_exact(x, decimals))
    return F.concat(text, F.lit("%")) if pct else text


def slug(col) -> Column:
    """lower case, spaces to underscores."""
    return F.lower(F.regexp_replace(_c(col), " ", "_"))


def stamp() -> Column:
    """current time as ISO text."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def logspace(lo: float, hi: float, n: int) -> Column:
    """array of n powers of ten from 10^lo to 10^hi."""
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.pow(F.lit(10.0), F.lit(float(lo)) + i * F.lit(step)))


def signed_diff(a, b) -> Column:
    """a - b (tuned minus baseline, PCA minus none, train minus test)."""
    return _c(a) - _c(b)


# ---------------------------------------------------------------- F16, F17
MAX_ONE_HOT_LEVELS = 1000


def category_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_ONE_HOT_LEVELS) -> dict:
    """Sorted distinct levels per column from one aggregate. The level count
    is checked (``max_levels``) before anything reaches the driver."""
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    for c in cols:
        if counts[c] > max_levels:
            raise ValueError(f"{c} has {counts[c]} levels; above {max_levels} use one_hot_vector, which makes one sparse column")
    row = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols]).first()
    return {c: list(row[c]) for c in cols}


def one_hot(df: DataFrame, cols: Sequence[str], levels: dict | None = None,
            keep_source: bool = False) -> DataFrame:
    """F16: a 0/1 column ``col_level`` per sorted level, none dropped; unknown
    levels (not in ``levels``) give all zeros."""
    levels = levels or category_levels(df, cols)
    new = {}
    for c in cols:
        for lev in levels[c]:
            new[f"{c}_{lev}"] = F.coalesce((F.col(c) == F.lit(lev)).cast("int"), F.lit(0))
    out = df.withColumns(new)
    return out if keep_source else out.drop(*cols)


def one_hot_vector(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F16 for any number of levels: a sparse 0/1 vector ``col_oh`` per column in place of
    a column per level; levels in alphabetical order, none dropped, null and unknown all 0.

    Levels are numbered in Spark and joined to the rows, so no task and no driver holds them all;
    ``vector_place`` reads a vector's level back."""
    from pyspark.ml.feature import OneHotEncoder

    from riskframe.operators.prefix import sequential_id
    from riskframe.session import cut_lineage
    spark = df.sparkSession
    for c in cols:
        levels = cut_lineage(df.select(F.col(c).cast("string").alias("_rf_level")).where("_rf_level IS NOT NULL").distinct())
        n = levels.count()
        places = sequential_id(levels, ["_rf_level"], out="_rf_place")
        df = df.join(places, F.col(c).cast("string") == F.col("_rf_level"), "left")
        # a place beyond the last is an unknown level, whose slot dropLast removes
        df = df.withColumn("_rf_place", F.coalesce("_rf_place", F.lit(max(n, 1))).cast("double"))
        size = spark.range(1).select(F.lit(float(max(n, 1) - 1)).alias("_rf_place"))
        encoder = OneHotEncoder(inputCols=["_rf_place"], outputCols=[f"{c}_oh"], dropLast=True, handleInvalid="keep")
        df = encoder.fit(size).transform(df).drop("_rf_level", "_rf_place")
    return df


def vector_place(col) -> Column:
    """The place of the first stored entry of a sparse vector, -1 if it has none; the vector isn't made dense."""
    places = F.unwrap_udt(col).getField("indices")
    return F.when(F.unwrap_udt(col).isNotNull(), F.coalesce(F.get(places, F.lit(0)), F.lit(-1)))


def standardize(df: DataFrame, cols: Sequence[str], stats: dict | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column gives 0. ``stats``
    ({col: (mean, std)}) lets a fit on one frame be applied to another."""
    if stats is None:
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
        stats = {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}
    new = {}
    for c in cols:
        m, s = stats[c]
        if s is None or s == 0:
            new[c] = F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.lit(0.0))
        else:
            new[c] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(new)
