"""DuckDB text for the oracles that mirror keyed generation and hashing.

Only the oracle side uses these: they spell the same (key, seed) hashing in
DuckDB so that the Spark results can be checked value for value."""

from __future__ import annotations

from riskframe.sources.generate import PATIENT_SPEC


def sql_hash(keys: list[str], seed) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"('0x' || substr(md5(concat_ws(':', {parts}, '{seed}')), 1, 15))::BIGINT"


def sql_unit(key: str, seed, slot: int) -> str:
    h = f"md5(concat_ws(':', CAST({key} AS VARCHAR), '{seed}/{slot // 2}'))"
    start = 1 + 13 * (slot % 2)
    return f"(CAST(('0x' || substr({h}, {start}, 13))::BIGINT AS DOUBLE) / 4503599627370496.0::DOUBLE)"


def sql_column(key: str, seed, slot: int, kind: str, **p) -> str:
    u = sql_unit(key, seed, slot)
    if kind == "offset":
        return f"CAST({key} + {p.get('start', 0)} AS BIGINT)"
    if kind == "int":
        t = {"int": "INTEGER", "double": "DOUBLE", "bigint": "BIGINT"}[p.get("type", "int")]
        return f"CAST({p['lo']} + floor({u} * {float(p['hi'] - p['lo'] + 1)}::DOUBLE) AS {t})"
    if kind == "choice":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in p["values"])
        return f"([{vals}])[CAST(floor({u} * {float(len(p['values']))}::DOUBLE) AS BIGINT) + 1]"
    if kind == "weighted":
        items = list(p["weights"].items())
        acc, parts = 0.0, []
        for v, w in items[:-1]:
            acc += w
            parts.append(f"WHEN {u} < {acc!r}::DOUBLE THEN {v}")
        return f"CASE {' '.join(parts)} ELSE {items[-1][0]} END"
    if kind == "grid":
        scale = 10 ** p["decimals"]
        lo, hi = round(p["lo"] * scale), round(p["hi"] * scale)
        return f"(CAST({lo} + floor({u} * {float(hi - lo + 1)}::DOUBLE) AS DOUBLE) / {float(scale)}::DOUBLE)"
    raise ValueError(kind)


def patients_sql(table: str, key: str, seed=42) -> str:
    cols = ",\n  ".join(f"{sql_column(key, seed, i, k, **p)} AS {n}" for i, (n, k, p) in enumerate(PATIENT_SPEC))
    return f"SELECT\n  {cols}\nFROM {table}"


def mark_sql(keys: list[str], seed, fraction: float, strata: list[str] | None = None) -> str:
    """Boolean text: row is among the floor(f*n_s + 0.5) smallest (hash, keys)."""
    part = f"PARTITION BY {', '.join(strata)} " if strata else ""
    order = ", ".join([sql_hash(keys, seed)] + keys)
    return (f"(row_number() OVER ({part}ORDER BY {order}) <= "
            f"floor({fraction!r}::DOUBLE * count(*) OVER ({part.strip()}) + 0.5))")
