"""All registered queries and oracles, gathered from the plan modules."""

from __future__ import annotations


def _load():
    from riskframe.plans import registry  # noqa: F401  (registers on import)
    for mod in ("riskframe.plans.composites", "riskframe.plans.learning", "riskframe.plans.streams",
                "riskframe.plans.checks"):
        try:
            __import__(mod)
        except ModuleNotFoundError as e:
            if e.name != mod:
                raise
    return registry


def all_queries():
    return _load().QUERIES


def all_oracles():
    return _load().ORACLE
