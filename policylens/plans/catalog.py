"""Registry of named queries: each takes (spark, sf_dir) and returns a DataFrame.

The queries read the adapter views over the given test tables, so their
work grows with the tables. Doubles are rounded at the output only (the
library functions keep full precision) so that a result compares equal to
an independent SQL oracle whose floating-point summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policylens.sources.tables import LOG_AS_OF, POLICY_AS_OF, Fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; ``oracle`` is the equivalent DuckDB SQL, if any."""
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def rnd(sql: str, cols, digits: int = 6, per_col: dict | None = None) -> str:
    """Oracle side of ``rounded``: round the named double columns of ``sql``.

    ``+ 0.0`` turns a negative zero into 0.0 (see ``round_half_away``).
    """
    per_col = per_col or {}
    rep = ", ".join(f'ROUND("{c}", {per_col.get(c, digits)}) + CAST(0 AS DOUBLE) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS _q"


def round_half_away(c, digits: int):
    """Round a double half away from zero on its binary value: x*10^d is
    rounded to an integer and divided back, the rule SQL engines apply to
    doubles. Never yields -0.0."""
    p = F.lit(float(10 ** digits))
    return (F.when(c >= 0, F.floor(c * p + F.lit(0.5))).otherwise(-F.floor(-c * p + F.lit(0.5)))
            .cast("double") / p)


def round_sql(name: str, digits: int) -> str:
    """SQL text of ``round_half_away`` for one column."""
    q = f"`{name}`"
    p = f"{float(10 ** digits)!r}D"
    return (f"CAST(CASE WHEN {q} >= 0 THEN floor({q} * {p} + 0.5D) ELSE -floor(-{q} * {p} + 0.5D) END "
            f"AS DOUBLE) / {p} AS `{name}`")


def rounded(df: DataFrame, digits: int = 6, big_digits: dict | None = None) -> DataFrame:
    """Round every double column (``big_digits`` overrides per column), as
    one projection built from SQL text."""
    big_digits = big_digits or {}
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(round_sql(f.name, big_digits.get(f.name, digits)))
        else:
            exprs.append(f"`{f.name}`")
    return df.selectExpr(*exprs)


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(spark, sf_dir)


def policy_as_of():
    return POLICY_AS_OF


def log_as_of():
    return LOG_AS_OF
