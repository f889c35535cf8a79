"""Cross-metric checks: ranges, rules, history, peers, reverse look-up, formulas, derivation.

Values are pivoted into one row per document with an explicit metric list (no second pass to find the columns), rules and
identities become columns of that row and are stacked again. A rule with a missing operand is skipped.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import numbers
from marlstone.plans import dims
from marlstone.plans.dims import DOCUMENTED, METRICS, PROPORTIONS, RULES, Profile
from marlstone.sources import reports
from marlstone.sources.tables import inline, table, values_sql

KEYS = [m[0] for m in METRICS if m[3] != "text"]


def wide(values: DataFrame, by: str = "doc_id", value: str = "value") -> DataFrame:
    return values.groupBy(by).pivot("metric", KEYS).agg(F.max(value))


def stacked(df: DataFrame, by: str, name: str, out: dict[str, Column], result: str) -> DataFrame:
    """One row per entry of out whose column isn't null."""
    rows = F.array(*(F.struct(F.lit(k).alias(name), c.alias(result)) for k, c in out.items()))
    return df.select(by, F.explode(rows).alias("x")).select(by, f"x.{name}", f"x.{result}").where(F.col(result).isNotNull())


def rule_results(w: DataFrame, by: str = "doc_id") -> DataFrame:
    """(doc, rule, passed) for every rule whose operands are there."""

    def one(left: str, op: str, right) -> Column:
        a = functools.reduce(lambda x, y: x + y, (F.col(c) for c in left.split(" + ")))
        b = F.col(right) if isinstance(right, str) else F.lit(right)
        return {">": a > b, ">=": a >= b, "<=": a <= b, "~": F.abs(a - b) <= 0.30}[op]

    return stacked(w, by, "rule", {n: one(a, op, b) for n, a, op, b in RULES}, "passed")


def blamed(results: DataFrame, by: str = "doc_id") -> DataFrame:
    """Broken rules per metric: a failure counts against every metric in it."""
    members = [(n, m) for n, a, _, b in RULES for m in [*a.split(" + "), b] if isinstance(m, str)]
    spark = results.sparkSession
    return results.where("not passed").join(F.broadcast(inline(spark, "rule, metric", members)), "rule").groupBy(by, "metric").agg(F.count(F.lit(1)).alias("broken"))


IDENTITIES: dict[str, tuple[str, tuple[str, ...], str]] = {
    "nii": ("amount", ("interest_earned", "interest_expended"), "interest_earned - interest_expended"),
    "crar": ("ratio", ("tier1", "tier2"), "tier1 + tier2"),
    "pcr": ("ratio", ("gnpa_amount", "nnpa_amount"), "try_divide(gnpa_amount - nnpa_amount, gnpa_amount) * 100"),
    "roa": ("ratio", ("pat", "total_assets"), "try_divide(pat, total_assets) * 100"),
    "roe": ("ratio", ("pat", "net_worth"), "try_divide(pat, net_worth) * 100"),
    "cost_to_income": ("ratio", ("opex", "nii", "other_income"), "try_divide(opex, nii + other_income) * 100"),
    "gnpa_amount": ("amount", ("gnpa_ratio", "gross_advances"), "gnpa_ratio * gross_advances / 100"),
    "wholesale_mix": ("ratio", ("retail_mix",), "100 - retail_mix"),
}


def formula_values(w: DataFrame, by: str = "doc_id") -> DataFrame:
    return stacked(w, by, "metric", {k: F.expr(e).cast("double") for k, (_, _, e) in IDENTITIES.items()}, "computed")


def formula_checks(w: DataFrame, by: str = "doc_id", profile: Profile = DOCUMENTED) -> DataFrame:
    """(doc, metric, passed): printed against computed, 1 % of the larger for amounts, 0.1 points for ratios."""

    def ok(k: str) -> Column:
        kind, _, e = IDENTITIES[k]
        a, b = F.col(k), F.expr(e)
        return numbers.same_value(a, b, profile.tolerance) if kind == "amount" else F.abs(a - b) <= profile.tolerance_pp + 1e-9

    return stacked(w, by, "metric", {k: ok(k) for k in IDENTITIES}, "passed")


def formula_score(checks: DataFrame, by: str = "doc_id") -> DataFrame:
    """Per metric that an identity touches: 1 all pass, .25 all fail, .625 mixed; others count .60 where they are used."""
    members = [(k, m) for k, (_, inputs, _) in IDENTITIES.items() for m in (k, *inputs)]
    touched = checks.withColumnRenamed("metric", "identity").join(F.broadcast(inline(checks.sparkSession, "identity, metric", members)), "identity")
    g = touched.groupBy(by, "metric").agg(F.bool_and("passed").alias("every"), F.bool_or("passed").alias("any"))
    return g.select(by, "metric", F.when(F.col("every"), 1.0).when(F.col("any"), 0.625).otherwise(0.25).alias("score"))


def derived(values: DataFrame, by: str = "doc_id", profile: Profile = DOCUMENTED) -> DataFrame:
    """Missing metrics from identities whose inputs reach the floor; results out of range are not taken; one pass, no chaining."""
    both = values.groupBy(by).pivot("metric", KEYS).agg(F.max("value").alias("v"), F.max("confidence").alias("c"))
    w = both.select(by, *(F.col(f"{k}_v").alias(k) for k in KEYS), *(F.col(f"{k}_c").alias(f"c_{k}") for k in KEYS))
    ranges = {m[0]: (m[6], m[7]) for m in METRICS}
    out = {}
    for k, (_, inputs, e) in IDENTITIES.items():
        floor = functools.reduce(lambda a, b: F.least(a, b), (F.col(f"c_{i}") for i in inputs), F.lit(float(profile.derived_cap)))
        good = F.col(k).isNull() & functools.reduce(lambda a, b: a & b, (F.col(f"c_{i}") >= profile.derive_floor for i in inputs)) & F.expr(e).between(*ranges[k])
        out[k] = F.when(good, F.struct(F.expr(e).cast("double").alias("value"), floor.alias("confidence")))
    s = stacked(w, by, "metric", out, "r")
    return s.select(by, "metric", F.round("r.value", 6).alias("value"), "r.confidence")


def range_check(values: DataFrame, by: str = "doc_id") -> DataFrame:
    """Sane range and sign; metrics without a range pass. The dimension has 52 rows."""
    m = F.broadcast(dims.metrics(values.sparkSession).select("metric", "low", "high", "negative"))
    ok = ~((F.col("value") < 0) & ~F.col("negative")) & numbers.in_range(F.col("value"), F.col("low"), F.col("high"))
    return values.join(m, "metric").select(by, "metric", "value", ok.alias("passed"))


def sanity(values: DataFrame, by: str = "doc_id") -> DataFrame:
    """First thing wrong with a value, or null."""
    m = F.broadcast(dims.metrics(values.sparkSession).select("metric", "unit", "low", "high", "negative"))
    v = F.col("value")
    what = F.when((F.col("unit") == "percent") & ~v.between(-100, 1000), "percent out of bounds").when((v < 0) & ~F.col("negative"), "negative").when((F.col("unit") == "count") & (F.abs(v - F.round(v)) > 1e-6), "count with a fraction").when(numbers.lacks_decimal(v, F.col("low"), F.col("high")), "decimal point missing")
    return values.join(m, "metric").select(by, "metric", "value", what.alias("problem"))


def proportions(w: DataFrame, by: str = "doc_id") -> DataFrame:
    return stacked(w, by, "metric", {f"{a}/{b}": F.try_divide(F.col(a), F.col(b)).between(lo, hi) for a, b, lo, hi in PROPORTIONS}, "passed")


def trend(change: Column) -> Column:
    """Score of a relative change: up to 30 % 1, 200 % .90, 500 % .80, else .55; no prior value 1."""
    return F.when(change.isNull() | (change <= 0.3), 1.0).when(change <= 2, 0.9).when(change <= 5, 0.8).otherwise(0.55)


def history(values: DataFrame, past: DataFrame, by: list[str], mode: str = "nearest_earlier") -> DataFrame:
    """Each value against the nearest earlier year's (or the latest other year's): relative change, and whether it is within 30 %."""
    now = values.select(*by, "fy", "value", F.lit(None).cast("double").alias("pv"))
    both = now.unionByName(past.select(*by, "fy", F.lit(None).cast("double").alias("value"), F.col("value").alias("pv")))
    if mode == "nearest_earlier":
        w = Window.partitionBy(*by).orderBy("fy").rangeBetween(Window.unboundedPreceding, -1)
        previous = F.last("pv", ignorenulls=True).over(w)
    else:  # the two latest years, of which one is another than the own
        years = F.max(F.when(F.col("pv").isNotNull(), F.col("fy"))).over(Window.partitionBy(*by))
        both = both.withColumn("latest", years)
        w = Window.partitionBy(*by)
        at = lambda cond: F.max(F.when(cond & F.col("pv").isNotNull(), F.struct("fy", "pv"))).over(w)["pv"]
        previous = F.when(F.col("fy") == F.col("latest"), at(F.col("fy") < F.col("latest"))).otherwise(at(F.col("fy") == F.col("latest")))
    j = both.withColumn("previous", previous).where("value is not null and previous is not null").drop("pv")
    change = F.when(F.col("previous") != 0, F.abs(F.col("value") - F.col("previous")) / F.abs(F.col("previous")))
    return j.withColumn("change", F.round(change, 6)).withColumn("passed", F.coalesce(change <= 0.3, F.lit(True)))


def peers(values: DataFrame, by: list[str]) -> DataFrame:
    """z-score against the other institutions of the group; needs three of them and some spread. Sums over the group minus one's own, no self-join."""
    w = Window.partitionBy(*by)
    n, s, q = F.count("value").over(w) - 1, F.sum("value").over(w) - F.col("value"), F.sum(F.col("value") * F.col("value")).over(w) - F.col("value") * F.col("value")
    df = values.withColumns({"n": n, "mean": F.try_divide(s, n), "square": F.try_divide(q, n)})
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("square") - F.col("mean") * F.col("mean")))
    z = F.when((F.col("n") >= 3) & (sd > 1e-9), F.abs(F.col("value") - F.col("mean")) / sd)
    return df.withColumn("z", F.round(z, 6)).withColumn("passed", F.coalesce(z <= 3, F.lit(True)))


def reverse_hits(chosen: DataFrame, candidates: DataFrame, by: str = "doc_id") -> DataFrame:
    """Chosen amounts and counts that the same page and table print for another metric: penalty 18, 8 more per further one, 65 at most."""
    c = candidates.select(by, F.col("metric").alias("other"), "page", F.col("table_id").alias("other_table"), numbers.signature(F.col("value")).alias("sig"), "label")
    a = chosen.where("unit in ('currency', 'count')").withColumn("sig", numbers.signature(F.col("value"))).drop("label")
    hit = a.join(c, [by, "page", "sig"]).where((F.col("other") != F.col("metric")) & (F.col("table_id").isNull() | F.col("other_table").isNull() | (F.col("table_id") == F.col("other_table"))))
    n = F.count_distinct("other", "label")
    return hit.groupBy(by, "metric").agg(n.alias("hits"), F.least(F.lit(65), 18 + 8 * (n - 1)).cast("int").alias("penalty"))


def magnitude(values: DataFrame, by: list[str]) -> DataFrame:
    """Against the nearest other value that is printed in the same place (by): more than five times away is suspect. A place prints few values."""
    all_ = F.collect_list(F.struct("metric", "value")).over(Window.partitionBy(*by))
    others = F.transform(F.filter(all_, lambda o: o["metric"] != F.col("metric")), lambda o: F.struct(F.abs(o["value"] - F.col("value")).alias("d"), o["value"].alias("o")))
    far = F.greatest(F.abs(F.col("value")), F.abs(F.col("near"))) > 5 * F.least(F.abs(F.col("value")), F.abs(F.col("near")))
    return values.withColumn("near", F.array_min(others)["o"]).select(by[0], "metric", "value", "near", far.alias("suspect"))


def prior_trap(values: DataFrame, verified: DataFrame, by: str = "doc_id") -> DataFrame:
    """Values that equal the verified value of the year before within 0.1 %: last year's column was read."""
    v = verified.select(by, "metric", (F.col("fy") + 1).alias("fy"), F.col("value").alias("before"))
    return values.join(v, [by, "metric", "fy"]).select(by, "metric", "fy", numbers.same_value(F.col("value"), F.col("before"), 0.001).alias("trapped"))


def networth_chain(w: DataFrame, by: str = "doc_id") -> DataFrame:
    """Net worth from capital and reserves first, then return on equity from it."""
    nw = F.coalesce("net_worth", F.col("capital") + F.col("reserves"))
    return w.select(by, nw.alias("net_worth"), F.round(F.try_divide(F.col("pat"), nw) * 100, 2).alias("roe"))


def assets_rescue(candidates: DataFrame, anchors: DataFrame, by: str = "doc_id") -> DataFrame:
    """Smallest candidate for total assets in 1.15 to 1.9 times the document's deposits, else in 1.05 to 4 times its advances; score 74."""
    j = candidates.join(anchors.select(by, "deposits", "advances"), by)
    within = lambda x, lo, hi: F.min(F.when(F.col("value").between(lo * F.col(x), hi * F.col(x)), F.col("value")))
    found = j.groupBy(by).agg(F.coalesce(within("deposits", 1.15, 1.9), within("advances", 1.05, 4.0)).alias("total_assets"))
    return found.withColumn("score", F.when(F.col("total_assets").isNotNull(), 74))


def yearly(s, d) -> DataFrame:
    """Amounts by nation (institution), region (category) and year from the order tables: history and peers at scale."""
    o, c, n = (table(s, d, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.groupBy(F.col("n_regionkey").alias("category"), F.col("n_nationkey").alias("institution"), F.year("o_orderdate").alias("fy")).agg(F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2).alias("value"))


_V = f"{reports.VALUES_SQL} AS t"
_PIVOT = f"WITH v AS (SELECT doc_id, {', '.join(f'MAX(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN value END) AS {m}' for m in KEYS)} FROM {_V} GROUP BY doc_id) "
_M = values_sql("metric, header, band, unit, types, tier, low, high, negative", METRICS)
_RULE_SQL = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS rule, {('abs(' + a + ' - ' + str(b) + ') <= 0.30') if op == '~' else f'{a} {op} {b}'} AS passed FROM v" for n, a, op, b in RULES)
_ID_SQL = {k: e.replace("try_divide(gnpa_amount - nnpa_amount, gnpa_amount)", "((gnpa_amount - nnpa_amount) / nullif(gnpa_amount, 0))").replace("try_divide(pat, total_assets)", "(pat / nullif(total_assets, 0))").replace("try_divide(pat, net_worth)", "(pat / nullif(net_worth, 0))").replace("try_divide(opex, nii + other_income)", "(opex / nullif(nii + other_income, 0))") for k, (_, _, e) in IDENTITIES.items()}
_CHECK_SQL = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS metric, " + (f"abs({k} - ({e})) <= 0.01 * greatest(abs({k}), abs({e}))" if IDENTITIES[k][0] == "amount" else f"abs({k} - ({e})) <= 0.1 + 1e-9") + " AS passed FROM v" for k, e in _ID_SQL.items())
_Y = "WITH y AS (SELECT n_regionkey AS category, n_nationkey AS institution, CAST(year(o_orderdate) AS INTEGER) AS fy, ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL) "
_GIVEN = "metric NOT IN ('nii', 'roe', 'gnpa_amount')"  # what is left out to be derived
_INPUTS = {k: i for k, (_, i, _) in IDENTITIES.items()}
_LEAST = lambda k: "least(90, " + ", ".join(f"c_{i}" for i in _INPUTS[k]) + ")"
_RANGE = {m[0]: (m[6], m[7]) for m in METRICS}
_BOTH = f"WITH v AS (SELECT doc_id, {', '.join(f'MAX(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN value END) AS {m}, MAX(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN confidence END) AS c_{m}' for m in KEYS)} FROM {_V} WHERE {_GIVEN} GROUP BY doc_id) "
_DERIVE_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS metric, CAST(ROUND({e}, 6) AS DOUBLE) AS value, CAST({_LEAST(k)} AS DOUBLE) AS confidence FROM v WHERE {k} IS NULL AND {' AND '.join(f'c_{i} >= 80' for i in _INPUTS[k])} AND ({e}) BETWEEN {_RANGE[k][0]} AND {_RANGE[k][1]}" for k, e in _ID_SQL.items()
)


def _values(s, d) -> DataFrame:
    return reports.values(s, d)


def _shadows(s, d) -> tuple[DataFrame, DataFrame]:
    """Chosen values, and what their pages print: every third report prints the next metric's value under this one's label too."""
    v = _values(s, d).withColumn("unit", F.when(F.col("num") > 0, "currency").otherwise("percent")).withColumn("table_id", F.concat(F.lit("p"), F.col("page").cast("string")))
    again = v.where("doc_id % 3 = 0").withColumn("metric", F.concat("metric", F.lit("_again"))).withColumn("label", F.concat(F.lit("of which "), "label"))
    return v, v.unionByName(again)


QUERIES = {
    "range_check": (lambda s, d: range_check(_values(s, d)), f"SELECT doc_id, metric, value, NOT (value < 0 AND NOT negative) AND coalesce(value BETWEEN low AND high, TRUE) AS passed FROM {_V} JOIN {_M.replace(' t(', ' m(')} USING (metric)"),
    "sanity_check": (lambda s, d: sanity(_values(s, d)), f"SELECT doc_id, metric, value, CASE WHEN unit = 'percent' AND NOT value BETWEEN -100 AND 1000 THEN 'percent out of bounds' WHEN value < 0 AND NOT negative THEN 'negative' WHEN unit = 'count' AND abs(value - round(value)) > 1e-6 THEN 'count with a fraction' WHEN NOT value BETWEEN low AND high AND value / 100 BETWEEN low AND high THEN 'decimal point missing' END AS problem FROM {_V} JOIN {_M.replace(' t(', ' m(')} USING (metric)"),
    "rule_check": (lambda s, d: rule_results(wide(_values(s, d))), _PIVOT + f"SELECT * FROM ({_RULE_SQL}) WHERE passed IS NOT NULL"),
    "rule_blame": (lambda s, d: blamed(rule_results(wide(_values(s, d)))), _PIVOT + f", r AS ({_RULE_SQL}), b AS (SELECT * FROM {values_sql('rule, metric', [(n, m) for n, a, _, b in RULES for m in [*a.split(' + '), b] if isinstance(m, str)])}) SELECT doc_id, metric, COUNT(*) AS broken FROM r JOIN b USING (rule) WHERE NOT passed GROUP BY doc_id, metric"),
    "formula_values": (lambda s, d: formula_values(wide(_values(s, d))), _PIVOT + "SELECT * FROM (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS metric, CAST({e} AS DOUBLE) AS computed FROM v" for k, e in _ID_SQL.items()) + ") WHERE computed IS NOT NULL"),
    "formula_check": (lambda s, d: formula_checks(wide(_values(s, d))), _PIVOT + f"SELECT * FROM ({_CHECK_SQL}) WHERE passed IS NOT NULL"),
    "formula_score": (lambda s, d: formula_score(formula_checks(wide(_values(s, d)))), _PIVOT + f", c AS (SELECT metric AS identity, doc_id, passed FROM ({_CHECK_SQL}) WHERE passed IS NOT NULL), m AS (SELECT * FROM {values_sql('identity, metric', [(k, m) for k, (_, i, _) in IDENTITIES.items() for m in (k, *i)])}) SELECT doc_id, metric, CAST(CASE WHEN bool_and(passed) THEN 1 WHEN bool_or(passed) THEN 0.625 ELSE 0.25 END AS DOUBLE) AS score FROM c JOIN m USING (identity) GROUP BY doc_id, metric"),
    "formula_derive": (lambda s, d: derived(_values(s, d).where(_GIVEN)), _BOTH + _DERIVE_SQL),
    "networth_chain": (lambda s, d: networth_chain(wide(_values(s, d)).select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("net_worth")).alias("net_worth"), F.col("pat").alias("capital"), F.col("other_income").alias("reserves"), "pat")), _PIVOT + "SELECT doc_id, nw AS net_worth, CAST(ROUND(pat / nullif(nw, 0) * 100, 2) AS DOUBLE) AS roe FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN net_worth ELSE pat + other_income END AS nw FROM v)"),
    "assets_rescue": (lambda s, d: assets_rescue(_values(s, d).where("num > 0"), wide(_values(s, d)).select("doc_id", F.col("total_deposits").alias("deposits"), F.col("gross_advances").alias("advances"))), _PIVOT + f"SELECT doc_id, total_assets, CASE WHEN total_assets IS NOT NULL THEN CAST(74 AS INTEGER) END AS score FROM (SELECT doc_id, COALESCE(MIN(CASE WHEN c.value BETWEEN 1.15 * total_deposits AND 1.9 * total_deposits THEN c.value END), MIN(CASE WHEN c.value BETWEEN 1.05 * gross_advances AND 4.0 * gross_advances THEN c.value END)) AS total_assets FROM v JOIN (SELECT doc_id, value FROM {_V} WHERE num > 0) AS c USING (doc_id) GROUP BY doc_id)"),
    "proportion_rules": (lambda s, d: proportions(wide(_values(s, d))), _PIVOT + "SELECT * FROM (" + " UNION ALL ".join(f"SELECT doc_id, '{a}/{b}' AS metric, {a} / nullif({b}, 0) BETWEEN {lo} AND {hi} AS passed FROM v" for a, b, lo, hi in PROPORTIONS) + ") WHERE passed IS NOT NULL"),
    "prior_year_trap": (lambda s, d: prior_trap(_values(s, d).withColumn("value", F.when(F.col("doc_id") % 4 == 1, F.col("prior")).otherwise(F.col("value"))), _values(s, d).withColumn("fy", F.col("fy") - 1).withColumn("value", F.col("prior"))), f"SELECT doc_id, metric, fy, CASE WHEN doc_id % 4 = 1 THEN TRUE ELSE greatest(abs(value), abs(prior)) = 0 OR abs(value - prior) <= 0.001 * greatest(abs(value), abs(prior)) END AS trapped FROM {_V}"),
    "magnitude_check": (lambda s, d: magnitude(_values(s, d), ["doc_id", "page"]), f"SELECT doc_id, metric, value, near, greatest(abs(value), abs(near)) > 5 * least(abs(value), abs(near)) AS suspect FROM (SELECT a.doc_id, a.metric, any_value(a.value) AS value, arg_min(b.value, (abs(b.value - a.value), b.value)) AS near FROM {reports.VALUES_SQL} AS a JOIN {reports.VALUES_SQL} AS b ON a.doc_id = b.doc_id AND a.page = b.page AND a.metric <> b.metric GROUP BY a.doc_id, a.metric)"),
    "trend_check": (lambda s, d: _values(s, d).select("doc_id", "metric", trend(F.try_divide(F.abs(F.col("value") - F.col("prior")), F.abs("prior"))).alias("score")), f"SELECT doc_id, metric, CAST(CASE WHEN prior = 0 OR abs(value - prior) / abs(prior) <= 0.3 THEN 1 WHEN abs(value - prior) / abs(prior) <= 2 THEN 0.9 WHEN abs(value - prior) / abs(prior) <= 5 THEN 0.8 ELSE 0.55 END AS DOUBLE) AS score FROM {_V}"),
    "history_check": (lambda s, d: history(yearly(s, d), yearly(s, d), ["category", "institution"]).select("institution", "fy", "previous", "change", "passed"), _Y + "SELECT institution, fy, previous, ROUND(change, 6) AS change, change <= 0.3 AS passed FROM (SELECT *, abs(value - previous) / previous AS change FROM (SELECT institution, fy, value, lag(value) OVER (PARTITION BY institution ORDER BY fy) AS previous FROM y)) WHERE previous IS NOT NULL"),
    "history_latest_other": (lambda s, d: history(yearly(s, d), yearly(s, d), ["category", "institution"], "latest_other").select("institution", "fy", "previous"), _Y + "SELECT a.institution, a.fy, arg_max(b.value, b.fy) AS previous FROM y a JOIN y b ON a.institution = b.institution AND a.fy <> b.fy GROUP BY ALL"),
    "peer_zscore": (lambda s, d: peers(yearly(s, d), ["category", "fy"]).select("institution", "fy", "z", "passed"), _Y + ", z AS (SELECT a.institution, a.fy, CASE WHEN COUNT(*) >= 3 AND stddev_pop(b.value) > 1e-9 THEN abs(any_value(a.value) - avg(b.value)) / stddev_pop(b.value) END AS z FROM y a JOIN y b ON a.category = b.category AND a.fy = b.fy AND a.institution <> b.institution GROUP BY ALL) SELECT y.institution, y.fy, ROUND(z, 6) AS z, COALESCE(z <= 3, TRUE) AS passed FROM y LEFT JOIN z ON y.institution = z.institution AND y.fy = z.fy"),
    "reverse_collision": (lambda s, d: reverse_hits(*_shadows(s, d)), f"WITH c AS (SELECT doc_id, page, metric AS other, label, CAST(ROUND(value, 4) AS DECIMAL(28,4)) AS sig FROM {_V} UNION ALL SELECT doc_id, page, metric || '_again', 'of which ' || label, CAST(ROUND(value, 4) AS DECIMAL(28,4)) FROM {_V} WHERE doc_id % 3 = 0) SELECT a.doc_id, a.metric, COUNT(DISTINCT (c.other, c.label)) AS hits, CAST(least(65, 18 + 8 * (COUNT(DISTINCT (c.other, c.label)) - 1)) AS INTEGER) AS penalty FROM {reports.VALUES_SQL} AS a JOIN c ON a.doc_id = c.doc_id AND a.page = c.page AND CAST(ROUND(a.value, 4) AS DECIMAL(28,4)) = c.sig AND c.other <> a.metric WHERE a.num > 0 GROUP BY a.doc_id, a.metric"),
}
