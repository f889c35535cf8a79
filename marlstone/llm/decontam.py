"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Words are runs of letters and digits, lower-cased. Fixed masks slide over the words of documents and of benchmark
items; a window's hash takes the words under 1 and ignores those under 0, so a substituted word spoils only the
windows that look at it. Windows of the documents whose hash some item has are joined with that item, and around each
hit (on its diagonal) the item is laid over the document: every equal word counts 1, every other one -1, and the best
run must reach LEAST, or 0.7 of an item that is shorter.

With at most SMALL distinct benchmark hashes the look-up is a set inside the scan, and documents without hits are
never shuffled; beyond it the windows are joined by shuffle, with the same result.

Items of fewer than SHORT words have masks of their own, made so that every overlap that reaches 0.7 of such an item is
hit. Longer ones can miss overlaps with many substitutions; the README says how many.

Rows: null and empty texts give no rows; a null id stays null; repeated rows give
repeated results; repeated items are reported under each id; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MASKS = ("1101011101", "11010011101", "110111")
SHORT = 10
LEAST = 12
SHARE = 0.7
SMALL = 200_000


def _worded(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)
    df = df.select(F.col(id_col).cast("long").alias("id"), words.alias("words"))
    return df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))


def _best(placement) -> int:
    """Best run of equal (1) and other (0) words."""
    run = best = 0
    for x in placement:
        run = max(run, 0) + (1 if x else -1)
        best = max(best, run)
    return best


def _hit(placement, masks) -> bool:
    return any(all(placement[i + k] for k, c in enumerate(m) if c == "1") for m in masks for i in range(len(placement) - len(m) + 1))


@functools.cache
def short_masks(n: int) -> tuple[str, ...]:
    """For items of n words: masks that hit every accepted placement that MASKS do not hit."""
    found: list[str] = []
    for p in sorted(itertools.product((0, 1), repeat=n), key=sum):  # the fewest equal words first
        if (_best(p) >= LEAST or _best(p) >= SHARE * n) and not _hit(p, (*MASKS, *found)):
            found.append("".join(map(str, p)).strip("0"))
    return tuple(found)


def _window(mask: str, i: Column) -> Column:
    return F.xxhash64(*(F.get(F.col("h"), i + k) for k, c in enumerate(mask) if c == "1"), F.lit(mask))


def _hashed(mask: str):
    return lambda i: F.struct(i.alias("pos"), _window(mask, i).alias("hash"))


def _among(mask: str, known: list[int]):
    return lambda i: _window(mask, i).isin(known)


def _starts(mask: str) -> Column:
    span = len(mask)
    return F.when(F.size("h") >= span, F.sequence(F.lit(0), F.size("h") - span)).otherwise(F.array().cast("array<int>"))


def _windows(df: DataFrame, masks: tuple[str, ...], *keep: str, own: bool = False) -> DataFrame:
    """One row (keep, mask, pos, hash) for every window; own: items of fewer than SHORT words get only the masks for their length besides MASKS."""
    nothing = F.array().cast("array<int>")

    def starts(m: str) -> Column:
        if m in MASKS or not own:
            return _starts(m)
        return F.when(F.size("h").isin([n for n in range(1, SHORT) if m in short_masks(n)]), _starts(m)).otherwise(nothing)

    def named(m: str):
        return lambda i: F.struct(F.lit(m).alias("mask"), i.alias("pos"), _window(m, i).alias("hash"))

    every = F.concat(*(F.transform(starts(m), named(m)) for m in masks))
    return df.select(*keep, F.explode(every).alias("w")).select(*keep, "w.mask", "w.pos", "w.hash")


def _overlap() -> Column:
    """Best run of the item (item_words) laid over the document (words) at diagonal: score, and first and last item word."""
    step = F.transform(F.col("item_words"), lambda w, k: F.when(F.get(F.col("words"), k + F.col("diagonal")) == w, F.lit(1)).otherwise(F.lit(-1)))
    zero = F.lit(0)
    state = F.struct(zero.alias("run"), zero.alias("since"), zero.alias("at"), zero.alias("best"), zero.alias("first"), zero.alias("last"))

    def add(s: Column, x: Column) -> Column:
        fresh = s["run"] <= 0
        run = F.when(fresh, x).otherwise(s["run"] + x)
        since = F.when(fresh, s["at"]).otherwise(s["since"])
        better = run > s["best"]
        return F.struct(run.alias("run"), since.alias("since"), (s["at"] + 1).alias("at"), F.greatest(run, s["best"]).alias("best"), F.when(better, since).otherwise(s["first"]).alias("first"), F.when(better, s["at"]).otherwise(s["last"]).alias("last"))

    return F.aggregate(step, state, add)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc id, item id, score, first_word, last_word): word numbers in the document of the best overlap with each item found in it."""
    bench = _worded(items, item_col, item_text)
    every = tuple(dict.fromkeys((*MASKS, *(m for n in range(1, SHORT) for m in short_masks(n)))))
    hashes = written(_windows(bench, every, "id", "words", own=True).select(F.col("id").alias("item_id"), F.col("words").alias("item_words"), "mask", F.col("pos").alias("item_pos"), "hash"), "benchmark")
    some: dict[str, list[int]] = {}
    for r in hashes.select("mask", "hash").distinct().limit(SMALL + 1).collect():
        some.setdefault(r[0], []).append(r[1])
    worded = _worded(docs, id_col, text_col)
    if sum(map(len, some.values())) <= SMALL:
        masks = [m for m in every if m in some] or list(MASKS[:1])
        spots = [F.filter(_starts(m), _among(m, some.get(m, []))) for m in masks]
        # the row number also keeps the filter below from being evaluated a second time beneath this projection
        found = worded.select("id", "words", "h", *(s.alias(f"p{k}") for k, s in enumerate(spots)), F.monotonically_increasing_id().alias("row"))
        found = written(found.where(" or ".join(f"size(p{k}) > 0" for k in range(len(masks)))), "hits")
        each = F.concat(*(F.transform(f"p{k}", _hashed(m)) for k, m in enumerate(masks)))
        hits = found.select("row", F.explode(each).alias("w")).select("row", "w.pos", "w.hash")
    else:
        masks = tuple(r[0] for r in hashes.select("mask").distinct().collect())  # of a fixed number
        found = written(worded.withColumn("row", F.monotonically_increasing_id()), "words")
        hits = _windows(found, masks, "row").drop("mask")
    lines = hits.join(hashes.select("item_id", "item_pos", "hash"), "hash").select("row", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct()
    texts = hashes.select("item_id", "item_words").distinct()
    laid = lines.join(texts, lines["item_id"].eqNullSafe(texts["item_id"])).drop(texts["item_id"]).join(found.select("row", "id", "words"), "row")
    laid = laid.select("row", "id", "item_id", "diagonal", F.size("item_words").alias("n"), _overlap().alias("o"))
    good = laid.where((F.col("o.best") >= LEAST) | (F.col("o.best") >= SHARE * F.col("n")))
    best = good.groupBy("row", "id", "item_id").agg(F.max(F.struct(F.col("o.best").alias("score"), (F.col("diagonal") + F.col("o.first")).alias("first_word"), (F.col("diagonal") + F.col("o.last")).alias("last_word"))).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item_id"), F.col("b.score").alias("score"), F.col("b.first_word").alias("first_word"), F.col("b.last_word").alias("last_word"))


def op10_spaced_seeds(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
