"""Pure ``Column`` rules of the transform layer.

Every function takes and returns ``pyspark.sql.Column`` objects built from
``pyspark.sql.functions`` only, so the rules stay inside whole-stage codegen.
Missing values follow SQL: NULL, never NaN/inf (``try_divide`` replaces x/0).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def as_date(x) -> Column:
    """Coerce to DATE; unparsable text becomes NULL."""
    return _c(x).try_cast("date")


def trim_default(x, default: str | None) -> Column:
    """Strip blanks; missing becomes ``default``."""
    t = F.trim(_c(x).cast("string"))
    return t if default is None else F.coalesce(t, F.lit(default))


def flag_equals(x, value) -> Column:
    """1 iff the value equals ``value`` else 0, NULL included."""
    return F.when(_c(x) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def flag_or_zero(x) -> Column:
    """Missing/unparsable flag -> 0, else the flag as INT."""
    return F.coalesce(_c(x).try_cast("int"), F.lit(0))


def days_between(end, start) -> Column:
    """Signed whole days ``end - start`` on calendar dates."""
    return F.datediff(as_date(end), as_date(start))


def delay_days(real, planned) -> Column:
    """Non-negative delay ``max(0, real - planned)``; 0 if either is missing."""
    return F.coalesce(F.greatest(days_between(real, planned), F.lit(0)), F.lit(0)).cast("int")


def changed_flag(planned, real) -> Column:
    """Real date exists and differs from the plan in either direction."""
    p, r = as_date(planned), as_date(real)
    return r.isNotNull() & ~p.eqNullSafe(r)


def any_changed(*pairs: tuple) -> Column:
    """1 if any (planned, real) pair changed, else 0."""
    cond = F.lit(False)
    for planned, real in pairs:
        cond = cond | changed_flag(planned, real)
    return cond.cast("int")


def date_key_clamped(d, base, null_value: int | None = None, upper=None) -> Column:
    """Date -> key ``days since base + 1`` floored at 1 (B7), optional upper clamp.

    ``base`` and ``upper`` may be literals or columns (e.g. from a one-row
    calendar summary joined in).  Missing dates give ``null_value``.
    """
    key = F.greatest(F.datediff(as_date(d), as_date(_lit(base))) + 1, F.lit(1))
    if upper is not None:
        key = F.least(key, _lit(upper))
    out = F.when(as_date(d).isNull(), F.lit(null_value)).otherwise(key)
    return out.cast("int")


def date_key_ranged(d, base, hi, out_of_range: int = 1, null_value: int = 0) -> Column:
    """Date -> key if it lies in ``1..hi`` else ``out_of_range``; missing -> ``null_value``."""
    key = F.datediff(as_date(d), as_date(_lit(base))) + 1
    ok = (key >= 1) & (key <= _lit(hi))
    out = (F.when(as_date(d).isNull(), F.lit(null_value))
           .when(ok, key).otherwise(F.lit(out_of_range)))
    return out.cast("int")


def bin_right_closed(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed, left-open bins ``(e_i, e_i+1]`` -> label; outside/missing -> NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    v = _c(x)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = v > F.lit(float(lo))
        if hi != float("inf"):
            cond = cond & (v <= F.lit(float(hi)))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def code_label(x, mapping: Mapping) -> Column:
    """Code -> label map; codes outside the map give NULL."""
    v = _c(x)
    out = None
    for code, label in mapping.items():
        cond = v == F.lit(code)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def sign_label(x, negative: str, positive: str, otherwise: str) -> Column:
    """<0 / >0 / anything else (zero or missing) -> three labels."""
    v = _c(x)
    return F.when(v < 0, F.lit(negative)).when(v > 0, F.lit(positive)).otherwise(F.lit(otherwise))


def quarter_label(year, month) -> Column:
    """``yyyy-Qn``; NULL when year or month is missing."""
    y, m = _c(year), _c(month)
    q = F.floor((m.cast("int") - 1) / 3).cast("int") + 1
    return F.when(y.isNotNull() & m.isNotNull(),
                  F.concat(y.cast("int").cast("string"), F.lit("-Q"), q.cast("string")))


def safe_div(num, den) -> Column:
    """num / den with NULL instead of an error or inf for a zero denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def capped(x, cap: float) -> Column:
    """``min(cap, x)`` keeping NULL as NULL."""
    v = _c(x)
    return F.when(v.isNotNull(), F.least(v, F.lit(float(cap))))


def pct_indicator(cond: Column) -> Column:
    """100 when the condition holds, else 0; a NULL condition counts as 0."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(100.0)).otherwise(F.lit(0.0))


def status_class(value, direction: str, good: float, bad: float) -> Column:
    """Traffic light: 'bueno' / 'malo' / 'regular' (K13); missing -> 'regular'."""
    from portacube.schemas import KPI_BAD, KPI_GOOD, KPI_REGULAR
    v = _c(value)
    if direction == "higher":
        is_good, is_bad = v >= F.lit(good), v < F.lit(bad)
    elif direction == "lower":
        is_good, is_bad = v <= F.lit(good), v > F.lit(bad)
    else:
        raise ValueError(f"unknown direction {direction!r}")
    return (F.when(F.coalesce(is_good, F.lit(False)), F.lit(KPI_GOOD))
            .when(F.coalesce(is_bad, F.lit(False)), F.lit(KPI_BAD))
            .otherwise(F.lit(KPI_REGULAR)))


EXACT_SUM_TYPE = "decimal(38,9)"


def exact_sum(x) -> Column:
    """Sum of a DOUBLE measure on DECIMAL(38,9), returned as DOUBLE.

    Decimal addition is associative, so the result does not depend on how
    the rows are partitioned or in which order partial sums are merged —
    floating-point sums of the same rows differ in the last bits between
    runs and engines.  Values are rounded to 1e-9 before summing.
    """
    return F.sum(_c(x).cast(EXACT_SUM_TYPE)).cast("double")


def exact_mean(x) -> Column:
    """Mean as ``exact_sum / count`` (NULL for no values); see ``exact_sum``."""
    return F.try_divide(exact_sum(x), F.count(_c(x)).cast("double"))
