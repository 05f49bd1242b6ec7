"""Cleaning rules for raw payment rows, as native Column expressions.

Every function maps one Column to one Column, stays inside whole-stage
codegen and never raises under ANSI mode (``try_*`` forms everywhere).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default missing-value markers of the pandas CSV reader,
# which turns these exact cell texts into NULL even for string columns.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Day-first date layouts accepted for the payment date, most usual first.
DATE_LAYOUTS = ("d/M/yyyy", "d/M/yy", "d-M-yyyy", "d.M.yyyy", "d-M-yy", "d.M.yy", "yyyy-M-d", "yyyy/M/d", "yyyyMMdd",
                "d-MMM-yyyy", "d-MMM-yy", "d MMM yyyy", "d MMM yy", "d-MMMM-yyyy", "d-MMMM-yy", "d MMMM yyyy", "d MMMM yy")
# A time after the date: hours and minutes, then maybe seconds, their decimals and the zero zone.
_TIME = r"[ T](?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{1,9})?)?Z?$"
# The first layout's texts, without spaces around them.
_USUAL_DATE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"
_DIGITS = "0123456789"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def shapes(layout: str) -> list[str]:
    """The shapes that texts of a layout can have, digits as 9 and letters as a: day and month with one digit or
    two, full month names with four letters to nine."""
    widths = {"d": (1, 2), "M": (1, 2), "MM": (2,), "dd": (2,), "yy": (2,), "yyyy": (4,), "MMM": (3,), "MMMM": range(4, 10)}
    out = [""]
    for part in re.findall(r"d+|M+|y+|.", layout):
        ends = [("a" if part in ("MMM", "MMMM") else "9") * n for n in widths[part]] if part in widths else [part]
        out = [x + e for x in out for e in ends]
    return out


#: Money: exact sums of amounts up to 26 digits before the point.
MONEY = "decimal(28,2)"
#: Two-digit years up to this one lie in the 2000s, later ones in the 1900s.
LAST_SHORT_YEAR = 2068
# Shape of a plain decimal number (what the money cast accepts).
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Whitespace exactly as Python's ``str.strip()`` / ``re`` ``\s`` see it (NBSP,
# which latin-1 files hold, included), derived from the rule, not listed.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_WS_RUN = r"(?U)[\s\x1c-\x1f]+"  # Unicode \s plus the separators Python also counts


def null_tokens(c: Column) -> Column:
    """Missing-value markers -> NULL (exact, case-sensitive match)."""
    return F.when(~c.isin(*NA_TOKENS), c)


def strip_ws(c: Column) -> Column:
    """Strip any Unicode whitespace at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def parse_amount(c: Column) -> Column:
    """Remove thousands separators, strip, parse as money or NULL.

    ``1,234.50`` -> 1234.50, `` -5 `` -> -5.00; ``£5``, ``(5)``, ``12d`` -> NULL.
    Parsed straight into DECIMAL so sums are exact and order-independent; further decimals are
    rounded half-up (:func:`is_rounded` tells which cells had any).
    """
    s = _number_text(c)
    return F.when(s.rlike(_NUMBER), s.try_cast(MONEY))


def is_rounded(c: Column) -> Column:
    """Whether :func:`parse_amount` rounds the cell: its number has more than two decimals that count.

    Told from the digits themselves, so no number is too small or too large: decimals written, less the exponent,
    less zeros at the end.
    """
    s = _number_text(c)
    digits = F.regexp_replace(F.regexp_replace(s, "[eE].*$", ""), r"[^\d]", "")
    written = F.length(F.regexp_extract(s, r"\.(\d*)", 1))
    exponent = F.coalesce(F.regexp_extract(s, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    counting = F.rtrim(digits, F.lit("0"))
    decimals = written - exponent - (F.length(digits) - F.length(counting))
    # only numbers with a third decimal or an exponent need the closer look
    return F.coalesce(F.when(s.rlike(r"\.\d{3}|[eE]") & parse_amount(c).isNotNull(), (counting != "") & (decimals > 2)),
                      F.lit(False))


def _number_text(c: Column) -> Column:
    return strip_ws(F.replace(c, F.lit(","), F.lit("")))


def parse_uk_date(c: Column) -> Column:
    """Day-first date text -> DATE; unparseable (``31/02/2015``, ``abc``) -> NULL.

    A time of day after the date is checked and dropped. The rest is reduced to its shape once, which
    tells the only layout that it can have; that layout is parsed and no other. A two-digit year lies between 1969 and 2068,
    whenever the file is loaded (``1/4/95`` -> 1995, ``1/4/15`` -> 2015).
    """
    s = strip_ws(c)
    s = F.when(F.contains(s, F.lit(":")), F.when(s.rlike(_TIME), F.regexp_replace(s, _TIME, ""))).otherwise(s)
    shape = F.translate(s, _DIGITS + _LETTERS, "9" * len(_DIGITS) + "a" * len(_LETTERS))
    # the most usual texts are told by themselves: nothing to strip, no shape to work out
    out = F.when(c.rlike(_USUAL_DATE), F.try_to_date(c, DATE_LAYOUTS[0]))
    for layout in DATE_LAYOUTS:
        parsed = F.try_to_date(s, layout)
        if layout.endswith("yy") and not layout.endswith("yyyy"):
            parsed = _short_year(parsed)
        fits = shape.isin(*shapes(layout))
        out = out.when(fits, parsed)
    return out


def _short_year(d: Column) -> Column:
    """Dates parsed as 20yy, moved back a century after ``LAST_SHORT_YEAR``."""
    return F.when(F.year(d) > LAST_SHORT_YEAR, F.add_months(d, -1200)).otherwise(d)


def refund_flag(amount: Column) -> Column:
    """``amount < 0``; NULL and zero amounts are not refunds."""
    return F.coalesce(amount < 0, F.lit(False))


def normalize_supplier(c: Column) -> Column:
    """Grouping form of a supplier name.

    Strip, upper-case, whole-word LIMITED -> LTD, collapse whitespace runs to
    one space, strip again. NULL stays NULL.
    """
    s = F.upper(strip_ws(c))
    s = F.regexp_replace(s, r"(?U)\bLIMITED\b", "LTD")
    s = F.regexp_replace(s, _WS_RUN, " ")
    return strip_ws(s)


def title_case(c: Column) -> Column:
    """Strip, then capitalise every run of letters (``it's 3rd`` -> ``It'S 3Rd``).

    Unlike ``initcap`` (which splits on spaces only) every non-letter ends a
    word, so ``non-pay`` becomes ``Non-Pay``.
    """
    runs = F.regexp_extract_all(strip_ws(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.initcap(w)), "")


def split_group(c: Column) -> tuple[Column, Column]:
    """Split on the first `` - ``: (group, subgroup); no separator -> subgroup NULL."""
    parts = F.split(c, " - ", 2)
    return strip_ws(F.get(parts, 0)), strip_ws(F.get(parts, 1))
