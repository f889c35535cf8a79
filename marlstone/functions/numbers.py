"""Numbers and units of printed reports, as Column -> Column functions. Two rule profiles: package and single."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of nothing disclosed.
NIL = ("", "-", "--", "---", "–", "—", "nil", "n.a.", "na", "n/a", "nd", "not applicable", "not disclosed", "——")
NIL_SINGLE = ("", "-", "--", "–", "—", "nil", "na")
#: Scale words, longest first, and what they come to in crore.
SCALES = (
    ("lakh crore", r"\b(?:lakh|lac)s?\s+crores?\b", 1e5),
    ("trillion", r"\btrillions?\b|\btn\b", 1e5),
    ("billion", r"\bbillions?\b|\bbn\b", 1e2),
    ("million", r"\bmillions?\b|\bmn\b|\bmm\b", 1e-1),
    ("crore", r"\bcrores?\b|\bcr\.?\b|\bcrs\.?\b", 1.0),
    ("lakh", r"\b(?:lakh|lac)s?\b", 1e-2),
    ("thousand", r"\bthousands?\b|'\s?0{3}s?|\bin\s+0{3}s?\b", 1e-4),
    ("hundred", r"\bhundreds?\b", 1e-5),
    ("rupee", r"\bin\s+rupees\b|\bin\s+absolute\s+terms\b", 1e-7),
)
#: Marks of foreign currencies, of the rupee, of footnotes.
FOREIGN = r"(?i)(\bUSD\b|\bUS\s*\$|\bU\.S\.\s*\$|\$\s*(?:mn|million|bn)|\bEUR\b|\bJPY\b|\bGBP\b|\bSDR\b)"
_RUPEE = r"(?i)₹|\bRs\b\.?|\bINR\b|\bRupees\b"
_MARKS = "[*†‡^#~º°¹²³⁰-₟]+"
PLAIN = r"^\d+(?:(?:,\d{2,3})*,\d{3})?(?:\.\d+)?$"
_CAPTION = r"(?i)\([^)]*\b(crore|lakh|million|billion|thousand)s?\b[^)]*\)|(?:₹|\bRs\.?|\bINR)\s+in\s+(?:crore|lakh|million|billion|thousand)s?"


def let(value: Column, f) -> Column:
    """f(value), with value evaluated once: what uses it many times stays small in the plan and in generated code."""
    return F.element_at(F.transform(F.array(value), f), 1)


def clean(c: Column) -> Column:
    """Dashes and blanks made alike, runs of blanks to one."""
    return F.trim(F.regexp_replace(F.translate(c, "–—−‐‑‒   ", "------   "), r"\s+", " "))


def is_nil(c: Column, words: tuple[str, ...] = NIL) -> Column:
    return F.coalesce(F.lower(clean(c)).isin(*{clean_text(w) for w in words}), F.lit(True))


def clean_text(s: str) -> str:
    return s.translate(str.maketrans("–—−", "---")).strip().lower()


def _strip_units(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(c, _RUPEE, " "), FOREIGN, " ")
    for _, pattern, _ in SCALES:
        c = F.regexp_replace(c, f"(?i){pattern}", " ")
    return clean(F.regexp_replace(c, "[$€£¥%]", " "))


def parse_number(c: Column) -> Column:
    """The number in a cell or null: footnote marks go first, brackets mean minus, one comma before one or two digits is a decimal comma."""

    def sized(s: Column) -> Column:
        bracket = s.rlike(r"\(\s*[\d,.]+\s*\)")
        plain = _strip_units(F.regexp_replace(s, r"\(\s*([\d,.]+)\s*\)", "$1"))
        body = F.regexp_replace(F.trim(F.regexp_extract(plain, r"[-+]?\d[\d,.\s]*", 0)), " ", "")
        return F.when(~is_nil(s), let(body, lambda b: signed(bracket | b.startswith("-"), F.regexp_replace(b, r"^[-+]+", ""))))

    def signed(minus: Column, digits: Column) -> Column:
        digits = let(digits, lambda x: F.when(x.rlike(r"^\d{1,3},\d{1,2}$"), F.regexp_replace(x, ",", ".")).otherwise(F.regexp_replace(x, ",", "")))
        digits = F.regexp_replace(F.regexp_replace(digits, r"\.{2,}", "."), r"^\.+|\.+$", "")
        value = let(digits, lambda x: F.when(x.rlike(r"^\d*\.?\d+$"), x.try_cast("double")))
        return let(value, lambda v: F.when(minus, -v).otherwise(v))

    # most cells are plain: digits with grouping commas, the last group of three; and without a digit there is no number
    plain = F.when(c.rlike(PLAIN), F.translate(c, ",", "").try_cast("double"))
    return F.coalesce(plain, F.when(c.rlike(r"\d"), let(clean(F.regexp_replace(c, _MARKS, "")), sized)))


def parse_number_single(c: Column) -> Column:
    """The simpler profile: the whole cell must be one number; commas always group."""
    s = clean(F.regexp_replace(c, _MARKS, ""))
    bracket = s.rlike(r"^\(.*\)$")
    body = F.regexp_replace(F.regexp_replace(s, _RUPEE, ""), r"[(),%₹\s]", "")
    value = F.when(body.rlike(r"^-?\d+(\.\d+)?$"), body.try_cast("double"))
    return F.when(~is_nil(s, NIL_SINGLE), F.when(bracket, -value).otherwise(value))


def scale_name(c: Column) -> Column:
    """Name of the first scale word, longest names first; null without one."""
    return F.coalesce(*(F.when(c.rlike(f"(?i){p}"), F.lit(n)) for n, p, _ in SCALES))


def factor(name: Column) -> Column:
    """What a unit of the scale comes to in crore."""
    return F.coalesce(*(F.when(name == n, F.lit(f)) for n, _, f in SCALES))


def caption_scale(c: Column) -> Column:
    """Scale of a real caption, in brackets or after a currency sign; prose doesn't count."""
    return scale_name(F.when(c.rlike(_CAPTION), F.regexp_extract(c, _CAPTION, 0)))


def is_foreign(c: Column) -> Column:
    return F.coalesce(c.rlike(FOREIGN), F.lit(False))


def to_crore(cell: Column, context: Column) -> Column:
    """Amount of a cell in crore: its own scale word, else the context's, else crore (inferred)."""
    return F.round(parse_number(cell) * factor(F.coalesce(scale_name(cell), scale_name(context), F.lit("crore"))), 6)


def same_value(a: Column, b: Column, tolerance: float = 0.005) -> Column:
    """Within the tolerance of the larger magnitude; two zeros are the same."""
    most = F.greatest(F.abs(a), F.abs(b))
    return (most == 0) | (F.abs(a - b) <= tolerance * most)


def close_to(own: Column, other: Column) -> Column:
    """The single profile's sameness: half a percent of the first, 0.01 at least."""
    return F.abs(own - other) <= F.greatest(F.lit(0.01), 0.005 * F.abs(own))


def in_range(v: Column, low: Column, high: Column, without: bool = True) -> Column:
    return F.when(low.isNull() | high.isNull(), F.lit(without)).otherwise(v.between(low, high))


def lacks_decimal(v: Column, low: Column, high: Column) -> Column:
    """Out of range, but a hundredth of it is in range."""
    return ~in_range(v, low, high) & in_range(v / 100, low, high)


def signature(v: Column) -> Column:
    """Text by which equal printed values are matched: an integer, or four decimals without trailing zeros."""
    text = F.round(v, 4).cast("decimal(28,4)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"0+$", ""), r"\.$", "")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def general(v: Column) -> Column:
    """A number as short text: no trailing zeros."""
    return signature(v)


def any_of(*conditions: Column) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions)


#: Report snapshots print values such as ₹6,589 crore, 1.04 Lakh, 45.00%, ND.
def report_value(c: Column) -> Column:
    """Struct (number, unit): unit is a scale name, percent or plain; number is null where nothing is given."""
    nothing = is_nil(c) | F.lower(F.trim(c)).isin("not found", "nd")
    unit = F.when(c.contains("%"), F.lit("percent")).otherwise(F.coalesce(scale_name(c), F.lit("plain")))
    return F.struct(F.when(~nothing, parse_number(c)).alias("number"), F.when(~nothing, unit).alias("unit"))
