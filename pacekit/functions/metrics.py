"""Column-level metric functions (all JVM-side expressions, no UDFs).

Rounding rule used everywhere: divide in DOUBLE, then round through
``DECIMAL(28,10)`` so ties go half-away-from-zero exactly like a
``numeric`` round, independent of the binary representation of the double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must match the documented behaviour):
#   dbt_utils surrogate-key placeholder for NULL parts, and its separator.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, digits: int) -> Column:
    """round(x, digits) with numeric (half-away-from-zero) tie rule, as DOUBLE."""
    return F.round(_c(x).cast("double").cast("decimal(28,10)"), digits).cast("double")


def nullif_zero(x) -> Column:
    x = _c(x)
    return F.when(x == 0, F.lit(None)).otherwise(x)


def safe_ratio(num, den, digits: int | None = None) -> Column:
    """num / nullif(den, 0) in DOUBLE, optionally rounded."""
    r = _c(num).cast("double") / nullif_zero(_c(den)).cast("double")
    return round_half_up(r, digits) if digits is not None else r


def intensity_factor(np_watts, threshold_watts) -> Column:
    """IF = round(NP / nullif(FTP, 0), 3)."""
    return safe_ratio(np_watts, threshold_watts, 3)


def training_stress(seconds, np_watts, threshold_watts) -> Column:
    """TSS = round(t * NP * NP / (FTP * FTP * 3600) * 100, 2).

    Evaluated in DOUBLE in that operator order; a NULL or zero threshold gives NULL.
    """
    thr = nullif_zero(_c(threshold_watts)).cast("double")
    np_ = _c(np_watts).cast("double")
    v = (_c(seconds).cast("double") * np_ * np_) / (thr * thr * F.lit(3600.0)) * F.lit(100.0)
    return round_half_up(v, 2)


def guarded_ratio(num, den, digits: int, require=None) -> Column:
    """CASE WHEN den > 0 [AND require IS NOT NULL] THEN round(num/den, d) END."""
    cond = _c(den) > 0
    if require is not None:
        cond = cond & _c(require).isNotNull()
    return F.when(cond, round_half_up(_c(num).cast("double") / _c(den).cast("double"), digits))


def watts_per_bpm(avg_power, avg_hr) -> Column:
    return guarded_ratio(avg_power, avg_hr, 2)


def efficiency_factor(np_watts, avg_hr) -> Column:
    return guarded_ratio(np_watts, avg_hr, 3, require=np_watts)


def exact_sum(x, scale: int = 6) -> Column:
    """Sum in DECIMAL so the total does not depend on row order, as DOUBLE."""
    return F.sum(_c(x).cast(f"decimal(38,{scale})")).cast("double")


def weighted_mean(x, w, digits: int, skip_null_weight: bool = False) -> Column:
    """round(sum(x*w) / nullif(sum(w), 0), digits).

    ``skip_null_weight=False`` is the faithful form: a NULL ``x`` drops its
    product from the numerator but keeps its weight in the denominator.
    ``True`` only counts weights of rows where ``x`` is present.
    Sums are exact decimals; the division is DOUBLE.
    """
    x, w = _c(x), _c(w)
    num = F.sum(x.cast("decimal(18,6)") * w.cast("decimal(18,6)")).cast("double")
    wsel = F.when(x.isNotNull(), w) if skip_null_weight else w
    den = F.sum(wsel.cast("decimal(18,6)")).cast("double")
    return round_half_up(num / F.when(den == 0, F.lit(None)).otherwise(den), digits)


def surrogate_key(*cols) -> Column:
    """md5 of the '-'-joined text of the parts, NULL parts replaced by a placeholder."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def padded_day_name(d) -> Column:
    """to_char(d, 'day'): lower-case English day name blank-padded to 9."""
    return F.rpad(F.lower(F.date_format(_c(d), "EEEE")), 9, " ")


def padded_month_name(d) -> Column:
    """to_char(d, 'month'): lower-case English month name blank-padded to 9."""
    return F.rpad(F.lower(F.date_format(_c(d), "MMMM")), 9, " ")


def day_number(d) -> Column:
    """Days since 1970-01-01; an integer ordering key for RANGE frames."""
    return F.unix_date(_c(d).cast("date"))
