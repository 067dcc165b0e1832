"""additive scorecards compiled to one Column expression.

A scorecard is a list of rules; each rule yields points and the score is the
sum. Conditions are Column expressions or SQL strings, so the whole card is a
single codegen'd projection with no Python per row.

Rule kinds
  tiers        first matching (op, threshold, points) of a column, else 0
  flag         points when col == value (default 1)
  linear       sum of col * weight (null propagates, as NaN does in pandas)
  first_match  first matching (condition, points), else 0
  any_of       points when any condition holds
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {
    ">": lambda x, t: x > t, ">=": lambda x, t: x >= t,
    "<": lambda x, t: x < t, "<=": lambda x, t: x <= t,
    "==": lambda x, t: x == t,
}


def _cond(c) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rule_points(rule: dict) -> Column:
    kind = rule["kind"]
    if kind == "tiers":
        x, op = _col(rule["col"]), _OPS[rule.get("op", ">")]
        expr = None
        for t, pts in rule["tiers"]:
            cond = op(x, F.lit(t))
            expr = F.when(cond, F.lit(pts)) if expr is None else expr.when(cond, F.lit(pts))
        return expr.otherwise(F.lit(0))
    if kind == "flag":
        return F.when(_col(rule["col"]) == F.lit(rule.get("value", 1)), F.lit(rule["points"])).otherwise(0)
    if kind == "linear":
        total = None
        for col, w in rule["terms"]:
            term = _col(col) * F.lit(w)
            total = term if total is None else total + term
        return total
    if kind == "first_match":
        expr = None
        for cond, pts in rule["cases"]:
            c = _cond(cond)
            expr = F.when(c, F.lit(pts)) if expr is None else expr.when(c, F.lit(pts))
        return expr.otherwise(F.lit(0))
    if kind == "any_of":
        conds = [_cond(c) for c in rule["conds"]]
        anyc = conds[0]
        for c in conds[1:]:
            anyc = anyc | c
        return F.when(anyc, F.lit(rule["points"])).otherwise(0)
    raise ValueError(f"unknown rule kind {kind!r}")


def scorecard(rules: list[dict]) -> Column:
    """The summed score of all rules as one Column."""
    total = None
    for r in rules:
        p = rule_points(r)
        total = p if total is None else total + p
    return total


# The clinical risk scorecard, rule by rule in its natural order.
CLINICAL_RULES = [
    {"kind": "tiers", "col": "age", "tiers": [(50, 3), (40, 2), (30, 1)]},
    {"kind": "flag", "col": "family_history_cancer", "points": 4},
    {"kind": "flag", "col": "unexplained_weight_loss", "points": 3},
    {"kind": "flag", "col": "lump_presence", "points": 4},
    {"kind": "flag", "col": "persistent_fatigue", "points": 2},
    {"kind": "flag", "col": "chronic_pain", "points": 2},
    {"kind": "flag", "col": "abnormal_bleeding", "points": 3},
    {"kind": "flag", "col": "persistent_cough", "points": 2},
    {"kind": "linear", "terms": [("diabetes", 1), ("hypertension", 1), ("cardiac_disease", 2)]},
    {"kind": "tiers", "col": "lifestyle_risk_score", "tiers": [(6, 3), (4, 2), (2, 1)]},
    {"kind": "tiers", "col": "tumor_marker_level", "tiers": [(50, 3), (25, 2), (10, 1)]},
    {"kind": "tiers", "col": "tumor_size_cm", "tiers": [(5, 4), (2, 2), (0.5, 1)]},
    {"kind": "flag", "col": "imaging_abnormality", "points": 3},
    {"kind": "first_match", "cases": [
        ("hemoglobin_level < 12 AND gender = 'Female'", 2),
        ("hemoglobin_level < 13.5 AND gender = 'Male'", 2)]},
    {"kind": "any_of", "conds": ["platelet_count > 400000", "platelet_count < 150000"], "points": 1},
]
