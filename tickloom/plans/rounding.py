"""Shared output-rounding policy for registered queries and their SQL oracles.

Doubles are rounded in both engines the same way so that order-of-summation
noise (≈1e-13 relative) never flips a value-hash:

* x + 10^-(d+3), its shortest decimal representation rounded half-up to d
  decimals (Spark's ``round``; the SQL side casts through VARCHAR and DECIMAL to
  do the same);
* compounded back-test values (``COMPOUNDED``) from 1e4 up: x·(1 + 1e-11), eight
  significant digits via ``%.7e`` formatting and back.  They reach 1e30 and carry
  ~1e-14 relative engine noise, so no fixed decimal fits them.  Sums, counts and
  prices never lose units.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that compound over steps.
COMPOUNDED = {
    "value", "cost", "avg_cost", "max_value", "final_value", "bench_final_value", "value_ratio", "cumulative_return",
    "total_return", "bench_total_return", "total_return_percentage", "outperformance", "annual_return",
    "bench_annual_return", "rolling_annual_return", "sharpe", "bench_sharpe", "sharpe_rf", "sharpe_ratio", "sortino",
    "calmar", "calmar_ratio", "peak_value", "first_value", "mean_value",
}
BIG = 1e4
SIG = "%.7e"  # eight significant digits
REL = 1.0 + 1e-11  # relative nudge: exact ties (nice prices) break the same way


def nudge(d: int) -> float:
    """A constant far below the rounding grid but far above summation noise:
    exact decimal ties (common with 'nice' prices) then break the same way in
    both engines even when they reach the tie from opposite sides by 1 ulp."""
    return 10.0 ** -(d + 3)


def round_col(c: str, d: int):
    x = F.col(c)
    fixed = F.round(x + F.lit(nudge(d)), d)
    if c in COMPOUNDED:
        fixed = F.when(F.abs(x) >= BIG, F.format_string(SIG, x * F.lit(REL)).cast("double")).otherwise(fixed)
    return fixed.alias(c)


def round_df(df: DataFrame, digits: dict | None = None, default: int = 6) -> DataFrame:
    digits = digits or {}
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(round_col(f.name, digits.get(f.name, default)))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def round_expr_sql(q: str, d: int) -> str:
    x = f"CAST({q} AS DOUBLE)"
    fixed = f"CAST(ROUND(CAST(CAST({x} + {nudge(d)!r} AS VARCHAR) AS DECIMAL(38, 15)), {d}) AS DOUBLE)"
    if q.strip('"') not in COMPOUNDED:
        return fixed
    return f"CASE WHEN abs({x}) >= {BIG!r} THEN CAST(printf('{SIG}', {x} * {REL!r}) AS DOUBLE) ELSE {fixed} END"


def round_sql(inner: str, columns: list[str], doubles: set[str], digits: dict | None = None,
              default: int = 6) -> str:
    """Wrap ``inner`` so the listed double columns are rounded like ``round_df``."""
    digits = digits or {}
    sel = []
    for c in columns:
        q = f'"{c}"'
        sel.append(f"{round_expr_sql(q, digits.get(c, default))} AS {q}" if c in doubles else q)
    return f"SELECT {', '.join(sel)} FROM ({inner}) AS _r"
