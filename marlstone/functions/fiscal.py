"""Fiscal years: FY22-23 ends on 31 March 2023."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a year is printed, and how its last year is read off: group 1 is the end year, or group 2 its last two digits.
PATTERNS = (
    r"(?i)(?:march|mar\.?)\s*31\s*,?\s*((?:19|20)\d{2})",
    r"(?i)31(?:st)?\s*(?:march|mar\.?)\s*,?\s*((?:19|20)\d{2})",
    r"31[./-]0?3[./-]((?:19|20)\d{2})",
    r"(?i)\bFY\s*-?\s*((?:19|20)\d{2})\b(?!\s*-\s*\d{2})",
)
_SPAN = r"(?:19|20)\d{2}\s*-\s*(\d{2})\b"


def fy_label(end: Column) -> Column:
    return F.format_string("FY%02d-%02d", F.pmod(end - 1, F.lit(100)).cast("int"), F.pmod(end, F.lit(100)).cast("int"))


def fy_end(label: Column) -> Column:
    two = F.regexp_extract(label, r"-(\d{2})$", 1).try_cast("int")
    return F.when(two >= 90, 1900 + two).otherwise(2000 + two)


def end_years(text: Column) -> Column:
    """All end years that a text names, in 1990 to 2100, with repeats."""
    direct = F.concat(*(F.transform(F.regexp_extract_all(text, F.lit(p), 1), lambda y: y.try_cast("int")) for p in PATTERNS))
    spans = F.transform(F.regexp_extract_all(text, F.lit(_SPAN), 1), lambda y: 2000 + y.try_cast("int"))
    return F.filter(F.concat(direct, spans), lambda y: y.between(1990, 2100))


def year_tokens(end: Column) -> Column:
    """Spellings of a fiscal year in column heads, lower case and without blanks."""
    y, y2 = end.cast("string"), F.lpad(F.pmod(end, F.lit(100)).cast("string"), 2, "0")
    b, b2 = (end - 1).cast("string"), F.lpad(F.pmod(end - 1, F.lit(100)).cast("string"), 2, "0")
    c = F.concat
    return F.array(
        c(F.lit("march31,"), y), c(F.lit("31march"), y), c(F.lit("31stmarch"), y), c(F.lit("31.03."), y), c(F.lit("31-03-"), y), c(F.lit("31/03/"), y), c(F.lit("mar-"), y2), c(F.lit("mar"), y),
        c(F.lit("fy"), y), c(F.lit("fy"), y2), c(b, F.lit("-"), y2), c(b, F.lit("-"), y), c(b2, F.lit("-"), y2), c(F.lit("fy"), b2, F.lit("-"), y2), c(F.lit("march"), y), y,
    )


def token_end(c: Column) -> Column:
    """End year of one column head token: 2022-23, 2023, FY23, 31.03.2023, Mar-23."""
    two = F.coalesce(F.nullif(F.regexp_extract(c, r"^\s*(?:19|20)\d{2}\s*-\s*(\d{2})\s*$", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"(?i)^\s*(?:FY|Mar)\s*-?\s*'?(\d{2})\s*$", 1), F.lit("")))
    four = F.nullif(F.regexp_extract(c, r"(?i)^\s*(?:FY\s*|31[./-]0?3[./-])?((?:19|20)\d{2})\s*$", 1), F.lit(""))
    return F.coalesce(2000 + two.try_cast("int"), four.try_cast("int"))
