"""Incremental cursor reads of stored result tables (SRC5).

The reader keeps a cursor (the greatest key it has seen) and asks for rows
with a greater key: all of them, or at most ``max_rows``, the smallest keys,
where a refresh has a budget.  No row is missed or read twice as long as keys are unique and
grow with arrival (the table sinks write ``(_batch, _row)``).  A null
cursor is a full reload.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _literal(value, dtype: str) -> Column:
    """A literal of the key column's own type.  A TIMESTAMP_NTZ value comes
    back to Python as a naive wall-clock datetime; it is passed as text and
    cast, so no session or process time zone can shift it."""
    if value is None:
        return F.lit(None).cast(dtype)
    if dtype == "timestamp_ntz":
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value).cast(dtype)


def after(keys: list[str], cursor: tuple | None, dtypes: dict | None = None) -> Column | None:
    """Lexicographic ``(keys) > cursor`` plus ``keys[0] >= cursor[0]``, which
    the scan can push down for row-group pruning."""
    if cursor is None:
        return None
    dtypes = dtypes or {}
    lit = [_literal(v, dtypes.get(k, "string")) if k in dtypes else F.lit(v)
           for k, v in zip(keys, cursor)]
    terms = []
    for i, k in enumerate(keys):
        eq = [F.col(keys[j]) == lit[j] for j in range(i)]
        terms.append(reduce(lambda a, b: a & b, eq + [F.col(k) > lit[i]]))
    lex = reduce(lambda a, b: a | b, terms)
    return (F.col(keys[0]) >= lit[0]) & lex


def fetch_new(df: DataFrame, keys: list[str], cursor: tuple | None = None,
              max_rows: int | None = None) -> DataFrame:
    """Rows after ``cursor``: a pushed-down filter, in no order; with
    ``max_rows`` the first so many in key order (a refresh's budget)."""
    cond = after(keys, cursor, dict(df.dtypes))
    src = df if cond is None else df.where(cond)
    return src if max_rows is None else src.orderBy(*keys).limit(max_rows)


def next_cursor(rows: DataFrame, keys: list[str], cursor: tuple | None = None) -> tuple | None:
    """The greatest key among ``rows`` (one-row aggregate); unchanged if none."""
    r = rows.agg(F.max(F.struct(*keys)).alias("m")).first()
    if r is None or r["m"] is None:
        return cursor
    return tuple(r["m"][k] for k in keys)
