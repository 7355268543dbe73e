"""Scalar column expressions (FN1-FN23).

All of them are built-in Catalyst expressions: they stay inside whole-stage
codegen and run unchanged on batch and streaming DataFrames.  Under ANSI
mode (Spark 4 default) the plain parse / divide functions throw, so the
``try_`` forms are used wherever the original pipeline turned bad input
into null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (HIGH_RISK_MERCHANTS, LARGE_AMOUNT, NIGHT_HOURS,
                      ONLINE_CHANNEL, TIMESTAMP_FORMAT, WEEKEND_DAYS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text accepted by the pattern yyyy-MM-dd'T'HH:mm:ss.SSSSSS (1 to 6
# fraction digits; no fraction or date only -> null).
TIMESTAMP_TEXT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]{1,6}$"


def parse_event_time(c="timestamp", fmt: str = TIMESTAMP_FORMAT) -> Column:
    """FN1/FN12: parse by pattern; unparseable -> null.

    The result is TIMESTAMP_NTZ, the wall-clock value of the text, with no
    time zone involved (a local time inside a daylight-saving gap is kept
    as written), so window bounds and hour/day features are the same in
    every session.  The default pattern is checked by a regular expression
    and converted with a zone-free cast (impossible dates -> null); other
    patterns go through ``try_to_timestamp``.
    """
    col = _c(c)
    if fmt == TIMESTAMP_FORMAT:
        return F.when(col.rlike(TIMESTAMP_TEXT), col.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def format_event_time(c) -> Column:
    """Inverse of ``parse_event_time`` for TIMESTAMP_NTZ values, zone-free:
    yyyy-MM-dd'T'HH:mm:ss.SSSSSS (from the NTZ text form, whose fraction
    drops trailing zeros: right-pad it back to 6 digits)."""
    s = _c(c).cast("string")
    return F.concat(F.substring(s, 1, 10), F.lit("T"), F.substring(s, 12, 8), F.lit("."),
                    F.rpad(F.substring(s, 21, 6), 6, "0"))


def _listed(values) -> str:
    return ", ".join(repr(v) for v in values)


#: FN3-FN8: what each flag asks of a transaction with an ``event_time``
FLAGS = {
    "is_night": "hour(event_time) BETWEEN {} AND {}".format(*NIGHT_HOURS),
    "is_weekend": f"dayofweek(event_time) IN ({_listed(WEEKEND_DAYS)})",
    "is_online_channel": f"payment_channel = {ONLINE_CHANNEL!r}",
    "high_risk_merchant": f"merchant_category IN ({_listed(HIGH_RISK_MERCHANTS)})",
    "is_large_amount": f"amount > {LARGE_AMOUNT}",
    "sender_equals_receiver": "sender_account = receiver_account",
}
HOUR = ("hour_of_day", "hour(event_time)")  # FN2


def flag_sql(name: str) -> str:
    """A flag as 1 or 0, an unknown answer counting as 0."""
    return f"int(coalesce({FLAGS[name]}, false)) AS {name}"


def bool_to_int(cond: Column) -> Column:
    """FN9: boolean cast, null stays null (the older feature variant)."""
    return cond.cast("int")


def safe_div(n, d) -> Column:
    """FN17: d > 0 ? n / d : 0.0; null -> 0.0 (text input: see to_number)."""
    nd = _c(n).cast("double")
    dd = _c(d).cast("double")
    return F.when(dd > 0, F.coalesce(nd / dd, F.lit(0.0))).otherwise(F.lit(0.0))


def to_number(c, default: float | None = 0.0) -> Column:
    """FN11: coercing number parse; bad -> null -> default."""
    v = _c(c).cast("string").try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def high_amount(c="amount", threshold: float = 1000.0) -> Column:
    """FN21: coalesce(amount, 0) >= threshold (non-strict)."""
    return F.coalesce(_c(c).cast("double"), F.lit(0.0)) >= F.lit(float(threshold))


def non_blank(c) -> Column:
    """FN22: value present and not whitespace only."""
    return _c(c).isNotNull() & (F.trim(_c(c).cast("string")) != F.lit(""))


def empty_to_null(c) -> Column:
    """FN13: empty text -> null."""
    return F.nullif(_c(c), F.lit(""))


def text_bool(c) -> Column:
    """FN13: producer boolean coercion, true for 'True', 'true' or '1'."""
    return F.coalesce(_c(c).isin("True", "true", "1"), F.lit(False))


def vector_element(c, i: int = 1) -> Column:
    """FN16: element i of an ML vector column (fraud probability)."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(_c(c)).getItem(i)


def threshold_decision(p, threshold: float) -> Column:
    """FN15: when(p >= threshold, 1.0).otherwise(0.0)."""
    return F.when(_c(p) >= F.lit(threshold), F.lit(1.0)).otherwise(F.lit(0.0))
