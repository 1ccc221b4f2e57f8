"""String and calendar column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from ._util import as_col, lit_map


def std_region(c, mapping: dict | None = None, unknown: str = K.UNKNOWN_REGION) -> Column:
    """Standardise a region name: alias lookup on the trimmed value, the
    trimmed value itself when unmapped, ``unknown`` when NULL."""
    mapping = K.REGION_ALIASES if mapping is None else mapping
    t = F.trim(as_col(c))
    if not mapping:
        return F.coalesce(t, F.lit(unknown))
    return F.coalesce(lit_map(mapping)[t], t, F.lit(unknown))


def matches_any(c, keywords) -> Column:
    """Case-insensitive substring match against any keyword (no regex)."""
    low = F.lower(as_col(c))
    cond = None
    for k in keywords:
        term = low.contains(k.lower())
        cond = term if cond is None else (cond | term)
    return cond


def commodity_family(c, families=K.COMMODITY_FAMILIES) -> Column:
    """First matching family keyword -> canonical column name, else NULL."""
    low = F.lower(as_col(c))
    out = None
    for kw, name in families:
        out = (F.when(low.contains(kw), F.lit(name)) if out is None
               else out.when(low.contains(kw), F.lit(name)))
    return out


def flag_pattern(c, pattern: str = K.FLOOD_EVENT_PATTERN) -> Column:
    """1 when the lower-cased text contains the regex, 0 otherwise or NULL."""
    return F.coalesce(F.lower(as_col(c)).rlike(pattern), F.lit(False)).cast("int")


def period_label(year="year", month="month") -> Column:
    """Zero-padded ``YYYY-MM``."""
    return F.format_string("%d-%02d", as_col(year), as_col(month))


def month_short_name(month="month") -> Column:
    return F.date_format(F.make_date(F.lit(2000), as_col(month), F.lit(1)), "MMM")


def month_year_title(year="year", month="month") -> Column:
    """``December 2024``."""
    return F.date_format(F.make_date(as_col(year), as_col(month), F.lit(1)), "MMMM yyyy")


def fractional_year(year="year", month="month") -> Column:
    return as_col(year) + (as_col(month) - F.lit(1)) / F.lit(12.0)


def text_bar(pct, char: str = "█", per: float = 2.0) -> Column:
    """``char`` repeated int(pct / per) times."""
    return F.repeat(F.lit(char), (as_col(pct) / F.lit(per)).cast("int"))


def fixed(c, digits: int, sign: bool = False, width: int = 0) -> Column:
    """fixed-point text rounded from the exact binary value, ties to even, as
    ``format(x, '.1f')`` does (``3.15`` -> ``3.1``, for its double lies below the tie).

    ``x * 10^digits`` is taken as a double ``p`` and the error of that product: with
    ``x`` split in halves of 26 bits all parts are exact, so the sum of both is the exact
    product, and the error decides where ``p`` falls on a tie.  A missing value is
    ``nan``.  Products of 4.6e18 or more, beyond the integers used here, are left to
    ``format_string``.  ``width`` pads to the right."""
    x = as_col(c).cast("double")
    a, scale = F.abs(x), F.lit(float(10 ** digits))
    high = a * 134217729.0 - (a * 134217729.0 - a)  # the upper 26 bits
    p = a * scale
    error = (high * scale - p) + (a - high) * scale
    k = F.floor(F.least(p, F.lit(4.6e18)))
    part = p - k
    up = (F.when(part == 0.0, F.rint(error).cast("long"))  # beyond 2^52 the error is a whole number and more
          .when((part > 0.5) | ((part == 0.5) & ((error > 0.0) | ((error == 0.0) & (k % 2 == 1)))), F.lit(1))
          .otherwise(F.lit(0)))
    n = k + up
    unit = 10 ** digits
    whole = F.call_function("div", n, F.lit(unit)) if digits else n
    body = F.concat(whole.cast("string"), F.lit("."), F.lpad((n % unit).cast("string"), digits, "0")) if digits else whole.cast("string")
    large = F.format_string(f"%.{digits}f", a)
    text = F.when(a == float("inf"), F.lit("inf")).when(x.isNull() | F.isnan(x), F.lit("nan")).when(
        p >= 4.6e18, large).otherwise(body)
    minus = F.coalesce(x.cast("string").startswith("-"), F.lit(False))  # of -0.0 too
    text = F.concat(F.when(minus, F.lit("-")).otherwise(F.lit("+" if sign else "")), text)
    return F.when(F.char_length(text) < width, F.lpad(text, width, " ")).otherwise(text) if width else text


def signed_pct(c, digits: int = 1) -> Column:
    """``+3.2`` style."""
    return fixed(c, digits, sign=True)
