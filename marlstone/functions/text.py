"""Names, labels and fuzzy ratios. Ratios are Arrow UDFs: no built-in has them, and they run on what exact rules left over."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import clean


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility form; nulls stay."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def _ratio(a: str, b: str) -> float:
    """Twice the matched length over both lengths, longest common subsequence based, in percent."""
    if not a or not b:
        return 0.0
    at: dict[str, int] = {}
    for j, y in enumerate(b):
        at[y] = at.get(y, 0) | 1 << j
    whole = rest = (1 << len(b)) - 1  # one bit a letter of b; those that the longest common subsequence takes are 0 in the end
    for x in a:
        taken = rest & at.get(x, 0)
        rest = ((rest + taken) | (rest - taken)) & whole
    return 200.0 * (len(b) - rest.bit_count()) / (len(a) + len(b))


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter text against equally long windows of the longer one."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    if short in long:
        return 100.0
    return max(_ratio(short, long[i : i + len(short)]) for i in range(max(1, len(long) - len(short) + 1)))


def token_set(a: str, b: str) -> float:
    """Best ratio among the common words and the common words with either side's rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = (f"{both} {' '.join(sorted(z))}".strip() for z in (x - y, y - x))
    if both and (both == one or both == two):
        return 100.0
    return max(_ratio(both, one), _ratio(both, two), _ratio(one, two))


def _pairwise(f):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else float(f(x, y)) for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(run, T.DoubleType())


partial_ratio = _pairwise(partial)
token_set_ratio = _pairwise(token_set)
sequence_ratio = _pairwise(lambda x, y: difflib.SequenceMatcher(None, x, y).ratio())



def nearest_run(names: list[tuple[int, str]], least: float):
    """Arrow UDF (keys, weights) -> (s, i): the name (i, its key) that the keys' words have nearly: the best of 0.75 x ratio x weight, ratio at least `least`, the smallest i of ties; null without any."""
    by_word: dict[str, list[tuple[int, str, int]]] = {}
    for i, k in names:
        for word in set(k.split()):
            if len(word) >= 4:
                by_word.setdefault(word, []).append((i, k, len(k.split())))

    def runs(key: str):
        words = key.split(" ")
        for at, word in enumerate(words):
            for i, k, n in by_word.get(word, ()):
                for b in range(max(at - n + 1, 0), at + 1):
                    run = " ".join(words[b : b + n])
                    if abs(len(run) - len(k)) <= 1:
                        yield i, k, run

    def search(keys: pd.Series, weights: pd.Series) -> pd.DataFrame:
        known: dict[tuple[str, str], float] = {}
        out = []
        for ks, ws in zip(keys, weights):
            best = None
            for key, weight in zip(ks, ws) if ks is not None else ():
                for i, k, run in set(runs(key)) if key else ():
                    ratio = known.get((k, run))
                    if ratio is None:
                        ratio = known[k, run] = partial(k, run)
                    if ratio >= least:
                        best = max(best or (-1.0, 0), (0.75 * ratio * weight, -i))
            out.append((None, None) if best is None else (best[0], -best[1]))
        return pd.DataFrame(out, columns=["s", "i"]).astype({"s": "float64", "i": "Int32"})

    return F.pandas_udf(search, "s double, i int")


_FORMS = r"\b(?:limited|ltd|pvt|private|corporation|corp|inc|the)\b"


def name_key(c: Column) -> Column:
    """Institution name for comparison: lower case, letters and digits, without legal forms."""
    s = F.regexp_replace(F.lower(clean(c)), r"[^a-z0-9& ]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, _FORMS, " "), r"\s+", " "))


def tidy_name(c: Column) -> Column:
    """Names printed in capitals become title case, of which short joining words stay small."""
    shouting = (c == F.upper(c)) & c.rlike("[A-Z]{4}")
    title = F.initcap(F.lower(clean(c)))
    for w in ("Of", "And", "The"):
        title = F.regexp_replace(title, rf"(?<=\s){w}\b", w.lower())
    return F.when(shouting, title).otherwise(clean(c))


def is_percent_label(c: Column) -> Column:
    return c.contains("%")


def clean_label(c: Column) -> Column:
    """Row label reduced to the words an alias is matched against."""
    part = F.array_sort(F.transform(F.split(c, "/"), lambda s: F.struct((-F.length(F.regexp_replace(s, "[^A-Za-z]", ""))).alias("n"), s.alias("s"))))[0]
    s = F.when(c.contains("/") & (part["n"] <= -3), part["s"]).otherwise(c)
    for pattern in (
        r"(?i)^\s*(?:[ivxlc]+[.)]|[a-z][.)]|\d{1,2}[.)])\s+",  # enumerators
        r"^\s*\d{1,2}\s+(?=[A-Za-z])",  # row numbers
        r"(?i)\s*\((?:schedule\s*\d+|note\s*\d+|refer[^)]*|₹[^)]*|rs[^)]*|in\s+[^)]*)\)",
        r"\s*\(\s*%\s*\)|\s*%",
        r"(?i)\s*\((?:global|domestic|india|overseas|standalone|audited|un-?audited|annuali[sz]ed|figures?|nos?\.?|numbers?)\)",
        r"\s*\(\d+\)(?:\s*[+-]\s*\(\d+\))*\s*$",  # sums of schedule numbers
        r"[*†#^]|\.{2,}|:$",
    ):
        s = F.regexp_replace(s, pattern, "")
    s = F.regexp_replace(F.regexp_replace(s, r"[^\x00-\x7f]+", " "), r"\s+", " ")
    return F.lower(F.regexp_replace(s, r"^[ .-]+|[ .-]+$", ""))


def safe_filename(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_")


def first_line(c: Column) -> Column:
    """Without the line feed and what follows it."""
    return F.regexp_replace(c, r"(?s)\n.*", "")
