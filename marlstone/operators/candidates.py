"""Candidate values: row labels and text lines against the alias dictionary, names against the institution list, evidence groups.

The alias dictionary is a constant of 197 patterns: they are literals of one projection, which sees every distinct label of a
type once; its hits join the labels by Spark's own size threshold. Fuzzy ratios run only on labels and documents that no pattern or name matches.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import numbers, text
from marlstone.plans import dims
from marlstone.sources import reports
from marlstone.sources.tables import inline, table, values_sql

from . import pages as P


def hits(label: Column, kind: Column) -> Column:
    """Per metric that applies to the type (b, s, n, h, a) the first alias that matches: array of (metric, ord, excess, unit, low, high). All patterns are literals, compiled once."""
    units = {m[0]: m for m in dims.METRICS}

    def first(metric: str, patterns: list[str]) -> Column:
        m = units[metric]
        given = lambda x: F.lit(None if x is None else float(x)).cast("double")
        each = [F.when(label.rlike(f"(?i){p}"), F.struct(F.lit(metric).alias("metric"), F.lit(i).alias("ord"), (F.length(label) - F.length(F.regexp_extract(label, f"(?i){p}", 0))).alias("excess"), F.lit(m[3]).alias("unit"), given(m[6]).alias("low"), given(m[7]).alias("high"))) for i, p in enumerate(patterns)]
        return F.when(F.contains(F.lit(m[4]), kind), F.coalesce(*each))

    return F.filter(F.array(*(first(m, p) for m, p in dims.ALIASES.items())), lambda x: x.isNotNull())


def needed(pattern: str) -> str:
    """The longest text, in lower case, that every match of an alias holds: what is left without groups, classes, escapes and letters that may lack. Looked for before the pattern."""
    for part in (r"\\.[?*+]?", r"\((?:[^()]|\([^()]*\))*\)[?*+]?", r"\[[^\]]*\][?*+]?", r".[?*]", r"[.^$+]"):
        pattern = re.sub(part, "\0", pattern)
    return max(pattern.split("\0"), key=len).lower()


def asked(texts: DataFrame, of: str, *keys: str) -> DataFrame:
    """(keys, of, metric, types, ord, pattern): the aliases that match a text. What they need is asked for first, in one list of constants; only patterns whose need is met are tried."""
    types, every = {m[0]: m[4] for m in dims.METRICS}, {}
    for m, patterns in dims.ALIASES.items():
        for i, p in enumerate(patterns):
            every.setdefault(needed(p), []).append(F.struct(F.lit(m).alias("metric"), F.lit(types[m]).alias("types"), F.lit(i).alias("ord"), F.lit(f"(?i){p}").alias("pattern")))
    needs = F.array(*(F.struct(F.lit(n).alias("needed"), F.array(*ps).alias("aliases")) for n, ps in every.items()))
    met = texts.withColumn("_low", F.lower(of)).select(*keys, of, F.explode_outer(F.filter(needs, lambda x: F.contains(F.col("_low"), x["needed"]))).alias("_met"))
    return met.select(*keys, of, F.explode("_met.aliases").alias("_alias")).select(*keys, of, "_alias.*").where(F.coalesce(F.rlike(of, F.col("pattern")), F.lit(False)))  # coalesced: else "is not null" is asked of every text before they are made distinct


#: Matches of labels that are held in one small table; beyond them they join.
HELD = 20_000


def dictionary(texts: DataFrame, label: str) -> DataFrame:
    """(label, metric, ord, score, unit, low, high): what distinct texts match, of metrics of all types. Looked up at once: up to HELD matches become a small table, so that what is looked up in it need not move; more stay a plan."""
    each = asked(texts.select(label).distinct().withColumn("_clean", text.clean_label(F.col(label))), "_clean", label)
    excess = F.length("_clean") - F.length(F.call_function("regexp_extract", F.col("_clean"), F.col("pattern"), F.lit(0)))
    found = each.groupBy(label, "metric").agg(F.min(F.struct("ord", excess.alias("excess"))).alias("m")).select(label, "metric", "m.*")
    found = found.join(F.broadcast(dims.metrics(texts.sparkSession).select("metric", "unit", "low", "high")), "metric")  # 52 rows
    found = found.where(~F.contains(label, F.lit("%")) | F.col("unit").isin("percent", "ratio"))
    score = F.when(F.col("excess") <= 3, 100.0).otherwise(F.greatest(F.lit(70.0), 100.0 - 1.5 * F.col("excess")))
    found = found.select(label, "metric", "ord", score.alias("score"), "unit", "low", "high")
    few = found.limit(HELD + 1).toArrow()
    return F.broadcast(texts.sparkSession.createDataFrame(few, found.schema)) if few.num_rows <= HELD else found


def matched(labels: DataFrame, label: str, kind: Column, *keys: str, texts: DataFrame | None = None) -> DataFrame:
    """(keys, label, metric, ord, score, unit, low, high): per label and metric the first pattern that matches the cleaned label; 100 for (nearly) the whole label, less for every further character. A % label matches ratios only. Reports print the same labels: each is looked up once. texts: where labels come from, if that is nearer than labels are."""
    each = labels.select(*keys, label, kind.alias("_kind"))
    types = F.create_map(*(F.lit(x) for m in dims.METRICS for x in (m[0], m[4])))
    found = each.join(dictionary(each if texts is None else texts, label), label)
    return found.where(F.contains(F.element_at(types, F.col("metric")), F.col("_kind"))).select(*keys, label, "metric", "ord", "score", "unit", "low", "high")


def fuzzy(labels: DataFrame, metrics: DataFrame, label: str, least: float = 90.0) -> DataFrame:
    """Labels that no pattern matched, against the metrics' headers."""
    pairs = labels.crossJoin(F.broadcast(metrics.select("metric", "header"))).withColumn("ratio", text.partial_ratio(F.lower(label), F.lower("header")))
    return pairs.where(F.col("ratio") >= least).groupBy(label).agg(F.max_by("metric", F.struct("ratio", "metric")).alias("metric"), F.max("ratio").alias("ratio"))


#: Metrics that a bare total may stand for.
TOTALS = ("total_assets", "total_deposits", "gross_advances", "net_worth")


def _scale(*texts: Column) -> Column:
    """(scale, foreign) of the first text that names a unit or a foreign currency; null without one."""
    read = lambda c: numbers.let(F.struct(numbers.scale_name(c).alias("scale"), numbers.is_foreign(c).alias("foreign")), lambda x: F.when(x["scale"].isNotNull() | x["foreign"], x))
    return F.coalesce(*(read(c) for c in texts))


def _top(c: str) -> Column:
    """What stands in the first three rows of a table, sorted."""
    return F.array_join(F.sort_array(F.collect_list(F.when(F.col("r") < 3, F.col(c)))), " ")


def table_scales(cells: DataFrame, pages: DataFrame | None, by: list[str]) -> DataFrame:
    """(by, page, table_id, scale, foreign): the unit of a table by its caption, else by its first three rows, else by the head of its page; a foreign currency ends the search."""
    t = cells.where("r < 3").groupBy(*by, "page", "table_id").agg(F.max("caption").alias("caption"), _top("cell").alias("rows"))
    t = t.withColumn("head", F.lit(None).cast("string")) if pages is None else t.join(pages.select(*by, "page", F.substring("body", 1, 600).alias("head")), [*by, "page"], "left")
    return t.select(*by, "page", "table_id", _scale(F.col("caption"), F.col("rows"), F.col("head")).alias("s")).select(*by, "page", "table_id", "s.scale", F.coalesce("s.foreign", F.lit(False)).alias("foreign"))


def _rows(cells: Column, fy: Column) -> Column:
    """Array of (r, label, vals) of a table's cells: the labelled rows with their numbers (c, raw, y, resolved) of columns that are numeric or have a year."""
    let, named_at = numbers.let, lambda of: F.filter(of, lambda x: x["r"] == F.array_min(F.transform(of, lambda z: z["r"])))
    heads = F.transform(F.filter(cells, lambda x: x["head"].isNotNull()), lambda x: F.struct(x["r"].alias("r"), x["c"].alias("c"), P.head_year(x["head"], fy).alias("y")))
    full = F.filter(cells, lambda x: x["number"].isNotNull())
    size = lambda of, c: F.size(F.filter(of, lambda x: x["c"] == c))
    numeric = let(full, lambda of: let(F.filter(of, lambda x: x["number"]), lambda some: F.sort_array(F.filter(F.array_distinct(F.transform(of, lambda x: x["c"])), lambda c: 2 * size(some, c) >= size(of, c)))))
    column = lambda c, y, resolved: F.struct(c.alias("c"), y.cast("int").alias("y"), resolved.alias("resolved"))

    def columns(named: Column, numeric: Column) -> Column:
        # without heads the first numeric column is the document's year, the second the one before; a lone column is sure of it
        assumed = F.transform(numeric, lambda c, i: column(c, F.when(i < 2, fy - i), (F.size(numeric) == 1)))
        known = F.transform(named, lambda x: column(x["c"], x["y"], F.lit(True)))
        rest = F.filter(numeric, lambda c: ~F.exists(named, lambda x: x["c"] == c))
        return F.when(F.size(named) == 0, assumed).otherwise(F.concat(known, F.transform(rest, lambda c: column(c, F.lit(None), F.lit(False)))))

    def values(columns: Column) -> Column:
        raw = F.transform(F.filter(cells, lambda x: x["raw"].isNotNull()), lambda x: F.struct(x["r"].alias("r"), x["c"].alias("c"), x["raw"].alias("raw"), F.get(F.filter(columns, lambda k: k["c"] == x["c"]), F.lit(0)).alias("k")))
        return F.filter(raw, lambda x: x["k"].isNotNull())

    labels = F.sort_array(F.transform(F.filter(cells, lambda x: x["label"].isNotNull()), lambda x: F.struct(x["r"].alias("r"), x["c"].alias("c"), x["label"].alias("label"))))
    first = let(labels, lambda of: F.filter(of, lambda x, i: (i == 0) | (F.get(of, i - 1)["r"] != x["r"])))
    of_row = lambda vals, r: F.transform(F.filter(vals, lambda v: v["r"] == r), lambda v: F.struct(v["c"].alias("c"), v["raw"].alias("raw"), v["k"]["y"].alias("y"), v["k"]["resolved"].alias("resolved")))
    rows = lambda vals: F.transform(first, lambda x: F.struct(x["r"].alias("r"), x["label"].alias("label"), of_row(vals, x["r"]).alias("vals")))
    named = let(F.filter(heads, lambda x: x["y"].isNotNull()), named_at)
    found = let(named, lambda a: let(numeric, lambda b: let(columns(a, b), lambda k: let(values(k), rows))))
    return F.filter(found, lambda x: F.size(x["vals"]) > 0)


def from_tables(cells: DataFrame, docs: DataFrame, pages: DataFrame | None = None, by: tuple[str, ...] = ("doc_id",), drop_foreign: bool = False, fail_closed: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """One candidate per matched row and column that is numeric or has a year. Amounts are in crore; bare years and blanks are out, and bare totals but for TOTALS.

    docs has kind and fy. drop_foreign: tables in a foreign currency give nothing (else is_foreign says so); fail_closed:
    metrics without a range give nothing. also: columns of docs or pages to keep. Cells are read once and folded per table; what
    the pages say joins by document."""
    cell, body, place = F.col("cell"), F.col("r") > 0, [*by, "page", "table_id"]
    number, label = cell.rlike(r"\d") & ~P.is_bare_year(cell), F.when(body & P.is_label(cell), cell)
    one = F.struct(
        "r", "c", F.when((F.col("r") < 8) & cell.rlike(r"\d"), P.squeezed(cell)).alias("head"), label.alias("label"), F.when(body & number, numbers.parse_number(cell)).alias("raw"), F.when(body & (F.trim("cell") != ""), number).alias("number"),
    )
    # dealt out by document before they are folded: an aggregate would evaluate what a cell says without generated code
    each = cells.select(*place, "section", "caption", F.when(F.col("r") < 3, cell).alias("cell"), "r", one.alias("one")).repartition(*by)
    t = each.groupBy(*place).agg(F.collect_list("one").alias("cells"), F.max("section").alias("section"), F.max(F.when(F.col("r") < 3, F.col("caption"))).alias("caption"), _top("cell").alias("rows"))
    of_page = [c for c in also if pages is not None and c in pages.columns]
    docs = docs.select(*dict.fromkeys([*by, "kind", "fy", *(c for c in also if c not in of_page)]))
    if pages is not None:
        docs = docs.join(pages.groupBy(*by).agg(F.collect_list(F.struct("page", F.substring("body", 1, 600).alias("head"), *of_page)).alias("pages")), list(by), "left")
    t = t.join(docs, list(by))
    t = t.withColumn("on", F.lit(None).cast("struct<head:string>") if pages is None else F.get(F.filter("pages", lambda x: x["page"] == F.col("page")), F.lit(0)))
    kept = [*(F.col(f"on.{c}").alias(c) for c in of_page), *(c for c in also if c not in of_page)]
    t = t.select(*place, "section", "kind", *kept, _scale(F.col("caption"), F.col("rows"), F.col("on.head")).alias("s"), F.explode_outer(_rows(F.col("cells"), F.col("fy"))).alias("x")).where("x is not null")
    t = t.select(*place, "section", "kind", *also, "s.scale", F.coalesce("s.foreign", F.lit(False)).alias("foreign"), "x.*")
    if drop_foreign:
        t = t.where("not foreign")
    out = matched(t, "label", F.col("kind"), *place, "section", *also, "scale", "foreign", "r", "vals", texts=cells.where(label.isNotNull()).select(cell.alias("label")))
    out = out.where(~F.lower(F.trim("label")).isin("total", "grand total") | F.col("metric").isin(*TOTALS))
    if fail_closed:
        out = out.where("low is not null and high is not null")
    out = out.withColumn("v", F.explode("vals"))
    currency = F.col("unit") == "currency"
    return out.select(
        *by, "metric", "page", "section", "table_id", "r", "v.c", "v.y", "v.resolved", "label", "score", F.when(currency, F.col("v.raw") * F.coalesce(numbers.factor(F.col("scale")), F.lit(1.0))).otherwise(F.col("v.raw")).alias("value"),
        "unit", "low", "high", (currency & F.col("foreign")).alias("is_foreign"), (currency & F.col("scale").isNull()).alias("inferred"), *also,
    )


def from_lines(pages: DataFrame, docs: DataFrame, by: tuple[str, ...] = ("doc_id",), also: tuple[str, ...] = ()) -> DataFrame:
    """One candidate per metric and line: the first number within 90 characters after the alias, of the first alias that has one. also: columns of docs or pages to keep."""
    of_page = [c for c in also if c in pages.columns]
    keys = [*by, "page", *of_page, "line_no"]
    upto = F.length(F.call_function("regexp_extract", F.col("line"), F.concat(F.lit("(?s)^(.*?)(?:"), F.col("pattern"), F.lit(")")), F.lit(0)))
    ls = P.lines(pages, "body", *by, "page", *of_page).where(F.col("line").rlike(r"\d"))
    found = asked(ls, "line", *keys).select(*keys, "metric", "types", "ord", F.substring(F.col("line"), upto + 1, F.lit(90)).alias("tail"))
    found = found.join(docs.select(*by, "kind", *(c for c in also if c not in of_page)), list(by)).where(F.contains("types", F.col("kind")))
    found = found.withColumn("value", numbers.parse_number(F.regexp_extract("tail", r"\(?-?\d[\d,]*(?:\.\d+)?\)?", 0))).where("value is not null")
    return found.groupBy(*by, "page", "line_no", "metric", *also).agg(F.min_by("value", "ord").alias("value"))


def evidence(candidates: DataFrame, by: list[str], value: str, order: list[str], tolerance: float = 0.005) -> DataFrame:
    """Greedy groups: a candidate joins the first group whose first member is within the tolerance, in the declared order. A group of by is folded in one row: candidates of a metric and document are few."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("double").alias("v"))))
    none = F.struct(F.array().cast("array<double>").alias("heads"), F.array().cast("array<int>").alias("groups"))

    def place(acc: Column, x: Column) -> Column:
        at = F.array_position(F.transform(acc["heads"], lambda h: numbers.same_value(x["v"], h, tolerance)), F.lit(True)).cast("int")
        group = F.when(at > 0, at - 1).otherwise(F.size(acc["heads"]))
        return F.struct(F.when(at > 0, acc["heads"]).otherwise(F.array_append(acc["heads"], x["v"])).alias("heads"), F.array_append(acc["groups"], group).alias("groups"))

    folded = candidates.groupBy(*by).agg(rows.alias("rows")).select(*by, "rows", F.aggregate("rows", none, place)["groups"].alias("groups"))
    each = folded.select(*by, F.explode(F.arrays_zip("rows", "groups")).alias("x"))
    return each.select(*by, *(F.col(f"x.rows.{c}").alias(c) for c in order), F.col("x.rows.v").alias(value), F.col("x.groups").alias("evidence_group"))


def _names() -> list[tuple[int, str, str]]:
    return [(i, r[0], n) for i, r in enumerate(dims.INSTITUTIONS) for n in [r[0], *r[3].split("|")] if n]


def places(pages: DataFrame, by: list[str]) -> DataFrame:
    """Pages with n, their place, and parts: where a page may name its document's institution, with place, weight and text: the first six pages, up to three of the auditors' report, the first two lines of the first forty. A page's later parts hold nothing that its first does not, and weigh less."""
    w = Window.partitionBy(*by).orderBy("page")
    auditor = F.col("body").rlike(r"(?i)independent\s+auditors?.{0,3}\s+report|to\s+the\s+members\s+of")
    p = pages.select("*", F.row_number().over(w).alias("n"), F.when(auditor, F.sum(auditor.cast("int")).over(w)).alias("a"))
    part = lambda name, weight, cond, x: F.when(cond, F.struct(F.lit(name).alias("place"), F.lit(weight).alias("weight"), x.alias("text")))
    parts = F.array(part("cover", 1.0, F.col("n") <= 6, F.col("body")), part("auditor", 0.9, F.col("a") <= 3, F.col("body")), part("headers", 0.7, F.col("n") <= 40, F.array_join(F.slice(F.split("body", "\n"), 1, 2), "\n")))
    return p.select("*", F.filter(parts, lambda x: x.isNotNull()).alias("parts"))


def _keyed(c: Column) -> Column:
    """The words of a text as names are compared, each between blanks."""
    return F.concat(F.lit(" "), text.name_key(F.regexp_replace(c, "\n", " ")), F.lit(" "))


def _named(place: Column, weight: Column, body: Column) -> Column:
    """Array of (i, s, t): institutions that a text names by number, words or symbol. What is looked for is first asked for as plain text: names by their first word."""
    listed = [(i, f" {_key(n)} ", _key(n).split()) for i, _, n in _names()]
    names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), F.lit(words[0]).alias("first"), F.lit(min(1.0, 0.55 + 0.05 * len(words)) * 90).alias("s")) for i, k, words in listed))
    firsts = F.array(*(F.lit(x) for x in sorted({words[0] for _, _, words in listed})))
    cins = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(dims.CINS[r[0]].lower()).alias("k")) for i, r in enumerate(dims.INSTITUTIONS) if r[0] in dims.CINS))
    marks = lambda low: F.array(*(F.when((place == "cover") & F.contains(low, F.lit(dims.TICKERS[r[0]].lower())) & body.rlike(rf"(?i)\b{re.escape(dims.TICKERS[r[0]])}\b"), F.lit(i)) for i, r in enumerate(dims.INSTITUTIONS) if r[0] in dims.TICKERS))
    hit = lambda i, s, t: F.struct(i.alias("i"), s.alias("s"), F.lit(t).alias("t"))
    within = lambda key: numbers.let(F.array_intersect(F.split(key, " "), firsts), lambda have: F.when(F.size(have) > 0, F.filter(names, lambda x: F.array_contains(have, x["first"]) & F.contains(key, x["k"]))))
    named = F.transform(F.coalesce(numbers.let(_keyed(body), within), F.slice(names, 1, 0)), lambda x: hit(x["i"], x["s"] * weight, 0.0))
    other = lambda low: F.concat(F.transform(F.filter(cins, lambda x: F.contains(low, x["k"])), lambda x: hit(x["i"], F.lit(100.0), 0.0)), F.transform(F.filter(marks(low), lambda x: x.isNotNull()), lambda i: hit(i, F.lit(0.0), 5.0)))
    return F.concat(named, numbers.let(F.lower(body), other))


def identified(pages: DataFrame, by: list[str], fuzzy_names: bool = True, also: Column | None = None) -> DataFrame:
    """(by, institution, category, type, confidence) of every document: a registered number is sure, names count by their words and place, an exchange symbol on the cover adds 5; the best of 45 or more, ties in the list's order.

    Documents without any are looked at for names with a slip (fuzzy_names), and at last take the first fitting line of their first page: a non-bank if it speaks of finance.
    A document's pages meet once: what its few places name is folded in one row, which keeps their texts for the search for slips. also: an array of each page, the n-th of its document; those of a document come out as one."""
    more = [] if also is None else ["also"]
    first = F.get("parts", F.lit(0))
    named = F.when(F.size("parts") > 0, numbers.let(first, lambda p: _named(p["place"], p["weight"], p["text"])))
    guess = F.coalesce(F.get(F.filter(F.split("body", "\n"), lambda x: F.length(F.trim(x)).between(6, 70) & x.rlike("[A-Za-z]")), F.lit(0)), F.lit("unknown"))
    each = places(pages, by).select(*by, "page", guess.alias("guess"), "parts", named.alias("named"), *([] if also is None else [also.alias("also")]))
    each = each.groupBy(*by).agg(F.min_by("guess", "page").alias("guess"), *(F.flatten(F.collect_list(c)).alias(c) for c in ("named", "parts", *more)))
    most = lambda of, i, c: F.array_max(F.transform(F.filter(of, lambda x: x["i"] == i), lambda x: x[c]))
    scores = numbers.let(F.col("named"), lambda of: F.transform(F.array_distinct(F.transform(of, lambda x: x["i"])), lambda i: F.struct((most(of, i, "s") + most(of, i, "t")).alias("score"), (-i).alias("i"))))
    each = each.select(*by, "guess", "parts", *more, F.array_max(scores).alias("b"))
    sure = F.coalesce(F.col("b.score") >= 45, F.lit(False))
    each = each.select(*by, "guess", *more, F.when(~sure, F.col("parts")).alias("parts"), F.when(sure, -F.col("b.i")).alias("i"), F.when(sure, F.least(F.lit(100.0), F.round("b.score", 4))).alias("confidence"))
    if fuzzy_names:
        each = slipped(each, [*by, *more])
    rows = F.array(*(F.struct(*(F.lit(x).alias(c) for c, x in zip(("institution", "category", "type"), r))) for r in dims.INSTITUTIONS))  # 36 rows: a join would keep all of this alive for whoever asks for none of it
    finance, known = F.lower(F.trim("guess")).rlike(r"\bfinance\b"), F.col("i").isNotNull()
    other = lambda c, yes, no: F.when(known, F.col(f"row.{c}")).when(finance, yes).otherwise(no).alias(c)
    each = each.withColumn("row", F.get(rows, F.col("i").cast("int")))
    return each.select(*by, F.when(known, F.col("row.institution")).otherwise(F.trim("guess")).alias("institution"), other("category", "NBFC", "Private Sector Bank"), other("type", "nbfc", "bank"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), *more)


def slipped(docs: DataFrame, by: list[str], least: float = 95.0) -> DataFrame:
    """docs with i and confidence of those that have parts left: names of 12 letters or more that a text, read to its end, has nearly (ratio 95 or more), at 0.75 of the ratio by place. Only runs of as many words that share a word and a length (within one) with the name are compared."""
    names = [(i, _key(n)) for i, _, n in _names() if len(_key(n)) >= 12]
    keys = F.transform("parts", lambda x: F.trim(_keyed(x["text"])))
    best = text.nearest_run(names, least)(keys, F.transform("parts", lambda x: x["weight"]))
    found = docs.withColumn("b", F.when(F.col("parts").isNotNull(), best)).withColumn("near", F.coalesce(F.col("b.s") >= 45, F.lit(False)))
    return found.select(*by, "guess", F.when(F.col("near"), F.col("b.i")).otherwise(F.col("i")).alias("i"), F.when(F.col("near"), F.round("b.s", 4)).otherwise(F.col("confidence")).alias("confidence"))


def nearest_row(names: DataFrame, rows: DataFrame, least: float = 0.85, token_set: bool = False) -> DataFrame:
    """Existing row of a name: equal key, else the best sequence ratio, .90 at least where one holds the other; token_set: else the best token-set ratio of 88 or more. rows are a template's institutions, tens of them."""
    a = names.select("name", text.name_key(F.col("name")).alias("k"))
    b = rows.select("existing", text.name_key(F.col("existing")).alias("e"))
    if token_set:
        pairs = a.crossJoin(F.broadcast(b)).withColumn("ratio", F.when(F.col("k") == F.col("e"), 100.0).otherwise(text.token_set_ratio(F.col("k"), F.col("e"))))
        best = pairs.groupBy("name").agg(F.max(F.struct("ratio", "existing")).alias("b"))
        return best.select("name", F.when(F.col("b.ratio") >= 88, F.col("b.existing")).alias("existing"))
    r = text.sequence_ratio(F.col("k"), F.col("e"))
    pairs = a.crossJoin(b).withColumn("ratio", F.when(F.col("k") == F.col("e"), 1.0).otherwise(F.greatest(r, F.when(F.contains("k", F.col("e")) | F.contains("e", F.col("k")), 0.9).otherwise(0.0))))
    best = pairs.groupBy("name").agg(F.max(F.struct("ratio", "existing")).alias("b"))
    return best.select("name", F.when(F.col("b.ratio") >= least, F.col("b.existing")).alias("existing"))


def first_seen_mode(df: DataFrame, by: str, key: str, pos: str) -> DataFrame:
    """The commonest value of each document; the one seen first wins ties."""
    return df.groupBy(by, key).agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("p")).groupBy(by).agg(F.max_by(key, F.struct("n", (-F.col("p")).alias("q"))).alias("winner"))


def _key(s: str) -> str:
    """name_key of a constant."""
    s = re.sub(r"\b(?:limited|ltd|pvt|private|corporation|corp|inc|the)\b", " ", re.sub("[^a-z0-9& ]", " ", s.lower()))
    return re.sub(r"\s+", " ", s).strip()


_ALIASES = values_sql("metric, ord, pattern", dims.alias_rows())
_METRICS = values_sql("metric, header, band, unit, types, tier, low, high, negative", dims.METRICS)
_CELLS, _DOCS, _PAGES = (f"{x} AS {n}" for x, n in ((reports.CELLS_SQL, "cells_"), (reports.DOCS_SQL, "docs_"), (reports.PAGES_SQL, "pages_")))
#: Labels that match, per type, by the dictionary.
_MATCH = f"""WITH lab AS (SELECT doc_id, kind, fy, page, r, cell AS label FROM {_CELLS} JOIN {_DOCS} USING (doc_id) WHERE r > 0 AND c = 0),
u AS (SELECT DISTINCT label, kind FROM lab),
h AS (SELECT u.label, u.kind, a.metric, a.ord, m.unit, length(u.label) - length(regexp_extract(lower(u.label), a.pattern)) AS excess FROM u JOIN {_ALIASES.replace(' t(', ' a(')} ON regexp_matches(lower(u.label), a.pattern) JOIN {_METRICS.replace(' t(', ' m(')} ON m.metric = a.metric WHERE contains(m.types, u.kind) AND (NOT contains(u.label, '%') OR m.unit IN ('percent', 'ratio'))),
b AS (SELECT label, kind, metric, unit, CAST(arg_min(CASE WHEN excess <= 3 THEN 100 ELSE greatest(70, 100 - 1.5 * excess) END, ord) AS DOUBLE) AS score FROM h GROUP BY ALL)
"""
_TABLES = _MATCH + f""", v AS (SELECT doc_id, page, r, c, CAST(replace(cell, ',', '') AS DOUBLE) AS raw, caption FROM {_CELLS} WHERE r > 0 AND c > 0 AND regexp_matches(cell, '^[0-9,.]+$') AND NOT regexp_matches(cell, '^(19|20)[0-9][0-9]$')),
found AS (SELECT lab.doc_id, b.metric, lab.page, lab.r, v.c, CAST(lab.fy + 1 - v.c AS INTEGER) AS y, lab.doc_id % 5 <> 4 AS resolved, b.score, CASE WHEN b.unit = 'currency' THEN v.raw * CASE WHEN contains(v.caption, 'lakh') THEN CAST(0.01 AS DOUBLE) WHEN contains(v.caption, 'million') THEN CAST(0.1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END ELSE v.raw END AS value
  FROM lab JOIN b ON lab.label = b.label AND lab.kind = b.kind JOIN v ON lab.doc_id = v.doc_id AND lab.page = v.page AND lab.r = v.r)
"""
_NUM = r"\(?-?\d[\d,]*(?:\.\d+)?\)?"
_TEXT = f"""ls AS (SELECT doc_id, kind, page, CAST(i - 1 AS INTEGER) AS line_no, line FROM (SELECT doc_id, kind, page, string_split(body, chr(10)) AS ls FROM {_PAGES}), unnest(ls) WITH ORDINALITY AS t(line, i)),
tx AS (SELECT doc_id, page, line_no, a.metric, a.ord, regexp_extract(substr(line, length(regexp_extract(line, concat('(?s)^(.*?)(?:', a.pattern, ')'), 0)) + 1, 90), '{_NUM}') AS n FROM ls JOIN {_ALIASES.replace(' t(', ' a(')} ON regexp_matches(line, a.pattern) JOIN {_METRICS.replace(' t(', ' m(')} ON m.metric = a.metric WHERE contains(m.types, kind)),
tl AS (SELECT doc_id, page, line_no, metric, arg_min(CAST(replace(n, ',', '') AS DOUBLE), ord) AS value FROM tx WHERE n <> '' GROUP BY ALL)
"""
_NAMED = values_sql("i, institution, category, type, k, words", [(i, n, *dims.INSTITUTIONS[i][1:3], _key(x), len(_key(x).split())) for i, n, x in _names()])
_CINS = values_sql("i, cin", [(i, dims.CINS[r[0]].lower()) for i, r in enumerate(dims.INSTITUTIONS) if r[0] in dims.CINS])
_TICKS = values_sql("i, ticker", [(i, dims.TICKERS[r[0]]) for i, r in enumerate(dims.INSTITUTIONS) if r[0] in dims.TICKERS])
_KEYED = r"' ' || trim(regexp_replace(regexp_replace(regexp_replace(lower(x), '[^a-z0-9& ]', ' ', 'g'), '\b(?:limited|ltd|pvt|private|corporation|corp|inc|the)\b', ' ', 'g'), '\s+', ' ', 'g')) || ' '"
_INSTITUTION = rf"""WITH p AS (SELECT doc_id, page, body, row_number() OVER w AS n, CASE WHEN aud THEN SUM(CASE WHEN aud THEN 1 ELSE 0 END) OVER w END AS a FROM (SELECT *, regexp_matches(body, '(?i)independent\s+auditors?.{{0,3}}\s+report|to\s+the\s+members\s+of') AS aud FROM {_PAGES}) WINDOW w AS (PARTITION BY doc_id ORDER BY page)),
x AS (SELECT doc_id, 1.0 AS w, body AS x FROM p WHERE n <= 6 UNION ALL SELECT doc_id, 0.9, body FROM p WHERE a <= 3 UNION ALL SELECT doc_id, 0.7, array_to_string(string_split(body, chr(10))[1:2], chr(10)) FROM p WHERE n <= 40),
e AS (SELECT doc_id, i, CAST(least(1.0, 0.55 + 0.05 * words) * 90 * w AS DOUBLE) AS s, 0 AS t FROM (SELECT *, {_KEYED} AS key FROM x) JOIN {_NAMED} ON contains(key, ' ' || k || ' ')
  UNION ALL SELECT doc_id, i, 100, 0 FROM x JOIN {_CINS} ON contains(lower(x), cin)
  UNION ALL SELECT doc_id, i, 0, 5 FROM x JOIN {_TICKS} ON w = 1.0 AND regexp_matches(x, '(?i)\b' || regexp_escape(ticker) || '\b')),
g AS (SELECT doc_id, i, MAX(s) + MAX(t) AS score FROM e GROUP BY ALL),
b AS (SELECT doc_id, arg_max(i, (score, -i)) AS i, MAX(score) AS score FROM g GROUP BY doc_id HAVING MAX(score) >= 45),
f AS (SELECT doc_id, trim(list_filter(string_split(body, chr(10)), lambda l: length(trim(l)) BETWEEN 6 AND 70)[1]) AS guess FROM p WHERE n = 1 AND doc_id NOT IN (SELECT doc_id FROM b))
SELECT doc_id, institution, category, type, least(CAST(100 AS DOUBLE), ROUND(score, 4)) AS confidence FROM b JOIN (SELECT DISTINCT i, institution, category, type FROM {_NAMED}) USING (i)
UNION ALL SELECT doc_id, guess, CASE WHEN regexp_matches(lower(guess), '\bfinance\b') THEN 'NBFC' ELSE 'Private Sector Bank' END, CASE WHEN regexp_matches(lower(guess), '\bfinance\b') THEN 'nbfc' ELSE 'bank' END, CAST(0 AS DOUBLE) FROM f"""
#: Candidates near and far from a value.
_NEAR = values_sql("seq, times", [(1, 1.0), (2, 1.002), (3, 1.2), (4, 0.9985), (5, 1.2005), (6, 3.0)])


def _labels(s, d) -> DataFrame:
    return P.row_labels(reports.cells(s, d).where("r > 0")).join(reports.docs(s, d).select("doc_id", "kind", "fy"), "doc_id")


def _near(s, d) -> DataFrame:
    k = F.broadcast(s.sql(f"SELECT * FROM {_NEAR}"))  # six rows
    return reports.values(s, d).where("value > 0 and num > 0").join(k, F.col("doc_id") % 6 + 1 >= F.col("seq")).select("doc_id", "metric", "seq", (F.col("value") * F.col("times")).alias("value"))


QUERIES = {
    "alias_match": (lambda s, d: matched(_labels(s, d), "label", F.col("kind"), "doc_id", "page", "r").select("doc_id", "page", "r", "metric", "score"), _MATCH + "SELECT doc_id, page, r, metric, score FROM lab JOIN b ON lab.label = b.label AND lab.kind = b.kind"),
    "fuzzy_match": (lambda s, d: fuzzy(inline(s, "label", [("Dividend Yields %",), ("zzz",)]), dims.metrics(s), "label"), f"SELECT label, metric, ratio FROM {values_sql('label, metric, ratio', [('Dividend Yields %', 'dividend_yield', 93.75)])}"),
    "cand_table": (lambda s, d: from_tables(reports.cells(s, d), reports.docs(s, d), reports.pages(s, d)).select("doc_id", "metric", "page", "r", "c", "y", "resolved", "score", "value"), _TABLES + "SELECT * FROM found"),
    "cand_text": (lambda s, d: from_lines(reports.pages(s, d), reports.docs(s, d)).select("doc_id", "page", "line_no", "metric", "value"), "WITH " + _TEXT + "SELECT * FROM tl"),
    "cand_union": (lambda s, d: from_tables(reports.cells(s, d), reports.docs(s, d)).select("doc_id", "metric", "page", "value").unionByName(from_lines(reports.pages(s, d), reports.docs(s, d)).select("doc_id", "metric", "page", "value")).distinct(), _TABLES + ", " + _TEXT + "SELECT doc_id, metric, page, value FROM found UNION SELECT doc_id, metric, page, value FROM tl"),
    "evidence_groups": (lambda s, d: evidence(_near(s, d), ["doc_id", "metric"], "value", ["seq"]), f"WITH n AS (SELECT doc_id, metric, seq, value * times AS value FROM {reports.VALUES_SQL} AS v JOIN {_NEAR} ON doc_id % 6 + 1 >= seq WHERE value > 0 AND num > 0), h AS (SELECT a.doc_id, a.metric, a.seq, any_value(a.value) AS value, MIN(b.seq) AS head FROM n a JOIN n b ON a.doc_id = b.doc_id AND a.metric = b.metric AND abs(a.value - b.value) <= 0.005 * greatest(a.value, b.value) GROUP BY ALL) SELECT doc_id, metric, seq, value, CAST(dense_rank() OVER (PARTITION BY doc_id, metric ORDER BY head) - 1 AS INTEGER) AS evidence_group FROM h"),
    "institution_match": (lambda s, d: identified(reports.pages(s, d), ["doc_id"]), _INSTITUTION),
    "fuzzy_row": (lambda s, d: nearest_row(inline(s, "name", [("Kotak Mahindra Bank Limited",), ("Nowhere Rural Bank Limited",)]), inline(s, "existing", [("HDFC Bank",), ("Axis Bank",), ("Kotak Mahindra Bank",)])), f"SELECT name, CAST(existing AS VARCHAR) AS existing FROM {values_sql('name, existing', [('Kotak Mahindra Bank Limited', 'Kotak Mahindra Bank'), ('Nowhere Rural Bank Limited', None)])}"),
    "rating_mode": (lambda s, d: first_seen_mode(table(s, d, "orders"), "o_custkey", "o_orderpriority", "o_orderkey"), "WITH g AS (SELECT o_custkey, o_orderpriority, COUNT(*) AS n, MIN(o_orderkey) AS p FROM orders GROUP BY ALL) SELECT o_custkey, arg_max(o_orderpriority, (n, -p)) AS winner FROM g GROUP BY o_custkey"),
    "applicable_metrics": (lambda s, d: reports.docs(s, d).join(F.broadcast(dims.metrics(s)), F.expr("contains(types, kind)")).select("doc_id", "metric", "tier"), f"SELECT doc_id, metric, tier FROM {_DOCS} JOIN {_METRICS} ON contains(types, kind)"),
    "unmatched_labels": (lambda s, d: _labels(s, d).where(F.size(numbers.let(text.clean_label(F.col("label")), lambda x: hits(x, F.col("kind")))) == 0).select("doc_id", "page", "r", "label"), _MATCH + "SELECT doc_id, page, r, label FROM lab WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.label = lab.label AND h.kind = lab.kind)"),
}
