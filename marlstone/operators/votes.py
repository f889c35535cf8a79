"""Votes and gates: entity names by pattern weight, institution type by keyword counts, check scores, provisional values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.text import name_key, tidy_name
from marlstone.sources import reports


#: How an institution's own name is introduced and what that weighs; pages worth looking at; headings and others that are not it.
_SUFFIX = r"(?:Limited|Ltd\.?|Corporation|Corpn\.?|Bank|Company|PLC)"
_BODY = rf"[A-Z][A-Za-z0-9&.,'’\- ]{{0,60}}?{_SUFFIX}(?:\s+{_SUFFIX})?(?:\s+of\s+[A-Z][A-Za-z]+)?"
ENTITY_HINT = r"(?i)members\s+of|we\s+have\s+audited|\bCIN\b|balance\s+sheet\s+of"
ENTITY_PATTERNS = (
    (rf"(?i)to\s+the\s+members\s+of\s+({_BODY})", 100.0),
    (rf"(?i)audit\s+of\s+the\s+(?:standalone\s+|consolidated\s+)?financial\s+statements\s+of\s+({_BODY})", 90.0),
    (rf"(?i)(?:we\s+have\s+audited\s+the\s+[^.]{{0,60}}?\s+of\s+)({_BODY})", 80.0),
    (rf"(?i)(?:balance\s+sheet|profit\s+and\s+loss\s+account)\s+of\s+({_BODY})", 60.0),
    (rf"(?i)({_BODY})\s*\(\s*(?:the\s+)?[\"'‘“]?(?:Bank|Company|Corporation)\b", 50.0),
    (rf"(?i)({_BODY})[,\s]+CIN\s*[:\-]", 70.0),
)
NOT_A_NAME_START = (
    r"(?i)^(report|statement|notes?|schedule|annexure|independent|auditors?|directors?|management|annual|financial|consolidated|standalone|business|corporate|the\s+board|our|this|these|such|any|other|certain|all|form|part|section|note|"
    r"standards?|accounting|auditing|applicable|requirements?|provisions?|opinion|basis|responsibilit|information|matters?|act|rules?|regulations?|guidelines?|circular)\b"
)
NOT_THE_ENTITY = r"(?i)\b(reserve\s+bank|securities\s+and\s+exchange\s+board|national\s+housing\s+bank|insurance\s+regulatory|chartered\s+accountants?|llp\b|registrar|stock\s+exchange|national\s+stock|bombay\s+stock|ministry\s+of|government\s+of\s+india|institute\s+of|world\s+bank|asian\s+development)\b"


def entity_names(pages: DataFrame, by: list[str]) -> DataFrame:
    """(by, name, weight) of names that a document introduces as its own, on its first forty pages with a hint; regulators, auditors and headings are none."""
    hot = pages.where(F.col("body").rlike(ENTITY_HINT)).withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("page"))).where("n <= 40")

    def introduced(pattern: str, weight: float) -> Column:
        return F.transform(F.regexp_extract_all("body", F.lit(pattern), 1), lambda x: F.struct(x.alias("name"), F.lit(weight).alias("weight")))

    each = F.concat(*(introduced(p, w) for p, w in ENTITY_PATTERNS))
    found = hot.select(*by, F.explode(each).alias("x")).select(*by, tidy_name(F.col("x.name")).alias("name"), "x.weight")
    return found.where((F.length("name") >= 5) & ~F.col("name").rlike(NOT_THE_ENTITY) & ~F.col("name").rlike(NOT_A_NAME_START) & (F.length(name_key(F.col("name"))) >= 3))


def name_votes(found: DataFrame, by: list[str]) -> DataFrame:
    """Per document, of names found by weighted patterns: spellings with one key vote together; the longest spelling is shown, ties go to the smallest key, the share is the confidence."""
    keyed = found.withColumn("k", name_key(F.col("name")))
    votes = keyed.groupBy(*by, "k").agg(F.sum("weight").alias("votes"), F.max_by("name", F.struct(F.length("name"), "name")).alias("shown"))
    best = F.min_by(F.struct("shown", "votes"), F.struct((-F.col("votes")).alias("v"), "k"))
    return votes.groupBy(*by).agg(best.alias("b"), F.sum("votes").alias("total")).select(*by, F.col("b.shown").alias("name"), F.round(F.col("b.votes") / F.col("total"), 4).alias("confidence"))


def file_name_guess(path: Column) -> Column:
    """A name from a file's name, when the document has none: without folders, extension and fiscal year."""
    stem = F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.[^.]*$", "")
    return F.trim(F.regexp_replace(tidy_name(F.regexp_replace(stem, r"[_\-]+", " ")), r"(?i)\s*(?:FY)?\s*\d{2,4}\s*[-–]?\s*\d{0,4}\s*$", ""))


#: Type, words that speak for it, how often they must occur; tried in this order.
REGIMES = (("hfc", r"(?i)housing finance", 2), ("nbfc", r"(?i)\bnbfc\b|non-banking", 2), ("sfb", r"(?i)small finance bank", 2), ("aifi", r"(?i)all-india financial institution", 1))


def regime(text: Column) -> Column:
    """Institution type by the first family of words that occurs often enough, else bank."""
    return F.coalesce(*(F.when(F.regexp_count(text, F.lit(p)) >= n, F.lit(t)) for t, p, n in REGIMES), F.lit("bank"))


#: What a report says of the rules that its institution is under.
SIGNALS = {
    "aifi": r"(?i)all[-\s]india\s+financial\s+institution|established\s+under\s+the\s+(?:national\s+bank|small\s+industries|export-import)\b",
    "bank": r"(?i)banking\s+regulation\s+act|third\s+schedule\s+to\s+the\s+banking|form\s+a\s*[-–]?\s*balance\s+sheet",
}


def regime_single(pages: DataFrame, names: DataFrame, by: list[str]) -> DataFrame:
    """(by, kind), the single profile: by the document's name, and by the rules it cites, three times for a bank and twice for an institution of its own act."""
    n = pages.groupBy(*by).agg(*(F.sum(F.regexp_count("body", F.lit(p))).alias(k) for k, p in SIGNALS.items())).join(names, by, "left")
    name, is_bank = F.lower(F.coalesce("name", F.lit(""))), F.col("bank") >= 3
    kind = F.when(F.contains(name, F.lit("small finance bank")), "sfb").when(F.contains(name, F.lit("housing finance")), "hfc").when(F.contains(name, F.lit("bank")) & is_bank, "bank")
    return n.select(*by, kind.when((F.col("aifi") >= 2) | F.contains(name, F.lit("bank")), "aifi").when(is_bank, "bank").otherwise("nbfc").alias("kind"))


def check_score(failed: Column, insane: Column) -> Column:
    """1 minus .50 per range, .30 per rule, .15 per history and .10 per peer failure, .50 more for insane values; within 0 and 1."""
    loss = F.aggregate(failed, F.lit(0.0), lambda a, f: a + F.when(f == "range", 0.50).when(f == "rule", 0.30).when(f == "history", 0.15).when(f == "peer", 0.10).otherwise(0.0))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - loss - F.when(insane, 0.5).otherwise(0.0))), 4)


def provisional(confidence: Column, in_range: Column, year_penalty: Column, unit_penalty: Column, floor: float = 65) -> Column:
    """Whether a value may be used by the cross-checks: confident enough, or in range without year and unit penalties."""
    return (confidence >= floor) | (in_range & (year_penalty == 0) & (unit_penalty == 0))


_V = f"{reports.VALUES_SQL} AS v"
_PAGES = f"{reports.PAGES_SQL} AS p"
_FAILED = f"(SELECT doc_id, metric, list_concat(list_concat(CASE WHEN r % 3 = 0 THEN ['range'] ELSE [] END, CASE WHEN doc_id % 2 = 0 THEN ['rule', 'rule'] ELSE [] END), CASE WHEN page = 6 THEN ['history', 'peer'] ELSE [] END) AS failed, confidence < 60 AS insane FROM {_V})"


def _failed(s, d) -> DataFrame:
    some = lambda cond, *what: F.when(cond, F.array(*(F.lit(w) for w in what))).otherwise(F.array().cast("array<string>"))
    return reports.values(s, d).select("doc_id", "metric", F.concat(some(F.col("r") % 3 == 0, "range"), some(F.col("doc_id") % 2 == 0, "rule", "rule"), some(F.col("page") == 6, "history", "peer")).alias("failed"), (F.col("confidence") < 60).alias("insane"))


def _named(s, d) -> DataFrame:
    return name_votes(entity_names(reports.pages(s, d), ["doc_id"]), ["doc_id"])


def _sql(p: str) -> str:
    return p.replace("'", "''")


_KEY = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '[^a-z0-9& ]', ' ', 'g'), '\b(?:limited|ltd|pvt|private|corporation|corp|inc|the)\b', ' ', 'g'), '\s+', ' ', 'g'))"
_ENTITY = (
    f"WITH hot AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page) AS n FROM {_PAGES} WHERE regexp_matches(body, '{ENTITY_HINT}')) WHERE n <= 40), raw AS ("
    + " UNION ALL ".join(f"SELECT doc_id, unnest(regexp_extract_all(body, '{_sql(p)}', 1)) AS name, CAST({w} AS DOUBLE) AS weight FROM hot" for p, w in ENTITY_PATTERNS)
    + f"), ok AS (SELECT doc_id, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS name, weight FROM raw), keyed AS (SELECT *, {_KEY} AS k FROM ok WHERE length(name) >= 5 AND NOT regexp_matches(name, '{NOT_THE_ENTITY}') AND NOT regexp_matches(name, '{NOT_A_NAME_START}') AND length({_KEY}) >= 3), "
    "votes AS (SELECT doc_id, k, SUM(weight) AS votes, arg_max(name, (length(name), name)) AS shown FROM keyed GROUP BY ALL), named AS (SELECT doc_id, arg_min(shown, (-votes, k)) AS name, ROUND(MAX(votes) / SUM(votes), 4) AS confidence FROM votes GROUP BY doc_id) "
)

QUERIES = {
    "name_vote": (lambda s, d: _named(s, d), _ENTITY + "SELECT doc_id, name, confidence FROM named"),
    "regime_vote": (lambda s, d: reports.pages(s, d).select("doc_id", "page", regime(F.col("body")).alias("kind")), f"SELECT doc_id, page, CASE WHEN len(regexp_extract_all(lower(body), 'housing finance')) >= 2 THEN 'hfc' WHEN len(regexp_extract_all(lower(body), '\\bnbfc\\b|non-banking')) >= 2 THEN 'nbfc' WHEN len(regexp_extract_all(lower(body), 'small finance bank')) >= 2 THEN 'sfb' WHEN contains(lower(body), 'all-india financial institution') THEN 'aifi' ELSE 'bank' END AS kind FROM {_PAGES}"),
    "regime_vote_single": (lambda s, d: regime_single(reports.pages(s, d), _named(s, d).select("doc_id", "name"), ["doc_id"]), _ENTITY + f", hits AS (SELECT doc_id, SUM(len(regexp_extract_all(body, '{SIGNALS['aifi']}'))) AS aifi, SUM(len(regexp_extract_all(body, '{SIGNALS['bank']}'))) AS bank FROM {_PAGES} GROUP BY doc_id) SELECT doc_id, CASE WHEN contains(n, 'small finance bank') THEN 'sfb' WHEN contains(n, 'housing finance') THEN 'hfc' WHEN contains(n, 'bank') AND bank >= 3 THEN 'bank' WHEN aifi >= 2 OR contains(n, 'bank') THEN 'aifi' WHEN bank >= 3 THEN 'bank' ELSE 'nbfc' END AS kind FROM (SELECT doc_id, aifi, bank, lower(coalesce(name, '')) AS n FROM hits LEFT JOIN named USING (doc_id))"),
    "check_score": (lambda s, d: _failed(s, d).select("doc_id", "metric", check_score(F.col("failed"), F.col("insane")).alias("score")), f"SELECT doc_id, metric, ROUND(greatest(0, least(1, CAST(1 AS DOUBLE) - coalesce(list_sum(list_transform(failed, lambda f: CASE f WHEN 'range' THEN 0.50 WHEN 'rule' THEN 0.30 WHEN 'history' THEN 0.15 ELSE 0.10 END)), 0) - CASE WHEN insane THEN 0.5 ELSE 0 END)), 4) AS score FROM {_FAILED}"),
    "provisional_gate": (lambda s, d: reports.values(s, d).select("doc_id", "metric", provisional(F.col("confidence"), F.col("r") % 2 == 0, F.col("doc_id") % 3, F.col("page") % 2).alias("usable")), f"SELECT doc_id, metric, confidence >= 65 OR (r % 2 = 0 AND doc_id % 3 = 0 AND page % 2 = 0) AS usable FROM {_V}"),
    "file_name_guess": (lambda s, d: reports.docs(s, d).select("doc_id", file_name_guess(F.concat(F.lit("/in/"), F.regexp_replace("name", " ", "_"), F.lit("_FY"), (F.col("fy") - 1).cast("string"), F.lit("-"), F.lpad((F.col("fy") % 100).cast("string"), 2, "0"), F.lit(".pdf"))).alias("guess")), f"SELECT doc_id, CASE WHEN name = upper(name) AND regexp_matches(name, '[A-Z]{{4}}') THEN upper(left(name, 1)) || lower(substr(name, 2)) ELSE trim(regexp_replace(regexp_replace(name, '[_-]+', ' ', 'g'), '\\s+', ' ', 'g')) END AS guess FROM {reports.DOCS_SQL} AS x"),
}
