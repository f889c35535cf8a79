"""Look-ups and small exercises: skills still to learn, courses with fall-backs, date ranges, roadmaps, arrays, structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.sources.tables import inline, table, values_sql

#: Sign, first and last month and day.
ZODIAC = [("Capricorn", 12, 22, 1, 19), ("Aquarius", 1, 20, 2, 18), ("Pisces", 2, 19, 3, 20), ("Aries", 3, 21, 4, 19), ("Taurus", 4, 20, 5, 20), ("Gemini", 5, 21, 6, 20), ("Cancer", 6, 21, 7, 22), ("Leo", 7, 23, 8, 22), ("Virgo", 8, 23, 9, 22), ("Libra", 9, 23, 10, 22), ("Scorpio", 10, 23, 11, 21), ("Sagittarius", 11, 22, 12, 21)]
_Z = "sign, m1, d1, m2, d2"


def signs(dates: DataFrame, key: str, date: str) -> DataFrame:
    """Sign of a date: a range join on month and day with twelve rows; the range that wraps the year needs no special case."""
    z = inline(dates.sparkSession, _Z, ZODIAC)
    m, d = F.month(date), F.dayofmonth(date)
    return dates.join(F.broadcast(z), ((m == F.col("m1")) & (d >= F.col("d1"))) | ((m == F.col("m2")) & (d <= F.col("d2")))).select(key, "sign")


def to_learn(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Skills of a role that a person lacks, compared in lower case."""
    h = held.select("person", F.lower("skill").alias("s"))
    return wanted.join(h, (wanted["person"] == h["person"]) & (F.lower(wanted["skill"]) == h["s"]), "left_anti")


def advice(asked: DataFrame, specific: DataFrame, default: DataFrame, traits: DataFrame) -> DataFrame:
    """Advice by (sign, role), else by role, else by sign."""
    a = asked.join(specific.select("sign", "role", F.col("text").alias("a")), ["sign", "role"], "left").join(default.select("role", F.col("text").alias("b")), "role", "left").join(traits.select("sign", F.col("text").alias("c")), "sign", "left")
    return a.select("i", F.coalesce("a", "b", "c").alias("text"))


def roadmap(jobs: DataFrame) -> DataFrame:
    """One row per step of every job's roadmap."""
    return jobs.select("job", F.posexplode("roadmap").alias("step", "r")).select("job", "step", "r.level", "r.salary")


def array_facts(a: Column) -> list[Column]:
    """Sum, reversal, largest and smallest with their first places."""
    return [F.aggregate(a, F.lit(0), lambda s, x: s + x).alias("total"), F.array_join(F.transform(F.reverse(a), lambda x: x.cast("string")), ",").alias("reversed"), F.array_max(a).alias("largest"), (F.array_position(a, F.array_max(a)) - 1).alias("largest_at"), F.array_min(a).alias("smallest"), (F.array_position(a, F.array_min(a)) - 1).alias("smallest_at")]


#: Who wants and has which skill: a customer's orders ask for one of seven each, three of four customers have one.
_WANT = "(SELECT DISTINCT o_custkey AS person, 'Skill ' || CAST(o_orderkey % 7 AS VARCHAR) AS skill FROM orders)"
_HELD = "(SELECT c_custkey AS person, 'SKILL ' || CAST(c_custkey % 7 AS VARCHAR) AS skill FROM customer WHERE c_custkey % 4 <> 0)"
_LIST = "(SELECT l_orderkey AS i, list(CAST(l_quantity AS INTEGER) ORDER BY l_linenumber, l_partkey, l_quantity) AS a FROM lineitem GROUP BY l_orderkey)"


def _want(s, d) -> DataFrame:
    o = table(s, d, "orders")
    return o.select(F.col("o_custkey").alias("person"), F.concat(F.lit("Skill "), (F.col("o_orderkey") % 7).cast("string")).alias("skill")).distinct()


def _held(s, d) -> DataFrame:
    c = table(s, d, "customer").where("c_custkey % 4 <> 0")
    return c.select(F.col("c_custkey").alias("person"), F.concat(F.lit("SKILL "), (F.col("c_custkey") % 7).cast("string")).alias("skill"))


def _arr(s, d) -> DataFrame:
    """An order's quantities, line by line."""
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"))))
    return table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("i")).agg(F.transform(lines, lambda x: x["q"]).alias("a"))


def _student(s, d) -> DataFrame:
    return table(s, d, "customer").select(F.struct(F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("number")).alias("info"), F.struct(F.col("c_nationkey").alias("year"), F.col("c_mktsegment").alias("grade")).alias("course")).alias("student"))


def _advice(s, d) -> DataFrame:
    """Customers ask, by nation (sign) and segment (role); one pair in three has advice of its own, one segment none."""
    c, n = table(s, d, "customer"), table(s, d, "nation")
    asked = c.select(F.col("c_custkey").alias("i"), F.col("c_nationkey").alias("sign"), F.col("c_mktsegment").alias("role"))
    pairs = asked.select("sign", "role").distinct().where((F.col("sign") + F.length("role")) % 3 == 0)
    roles = asked.select("role").distinct().where("role <> 'MACHINERY'")
    return advice(asked, pairs.select("sign", "role", F.concat_ws(" ", F.lit("both"), F.col("sign").cast("string"), "role").alias("text")), roles.select("role", F.concat(F.lit("role "), "role").alias("text")), n.select(F.col("n_nationkey").alias("sign"), F.col("n_name").alias("text")))


def _jobs(s, d) -> DataFrame:
    steps = F.array_sort(F.collect_list(F.struct("p_partkey", "p_name", "p_size")))
    return table(s, d, "part").groupBy(F.col("p_brand").alias("job")).agg(F.transform(steps, lambda x: F.struct(x["p_name"].alias("level"), x["p_size"].alias("salary"))).alias("roadmap"))


QUERIES = {
    "zodiac_range": (lambda s, d: signs(table(s, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey", "o_orderdate"), f"SELECT o_orderkey, sign FROM orders JOIN {values_sql(_Z, ZODIAC)} ON (month(o_orderdate) = m1 AND day(o_orderdate) >= d1) OR (month(o_orderdate) = m2 AND day(o_orderdate) <= d2)"),
    "skills_anti": (lambda s, d: to_learn(_want(s, d), _held(s, d)), f"SELECT person, skill FROM {_WANT} AS w WHERE NOT EXISTS (SELECT 1 FROM {_HELD} AS h WHERE h.person = w.person AND lower(h.skill) = lower(w.skill))"),
    "skills_except": (lambda s, d: _want(s, d).select("person", F.lower("skill").alias("skill")).exceptAll(_held(s, d).select("person", F.lower("skill").alias("skill"))), f"SELECT person, lower(skill) AS skill FROM {_WANT} EXCEPT SELECT person, lower(skill) FROM {_HELD}"),
    "course_lookup": (lambda s, d: table(s, d, "part").select(F.col("p_brand").alias("role"), F.col("p_type").alias("course")).distinct().groupBy("role").agg(F.array_join(F.array_sort(F.collect_list("course")), "; ").alias("courses")), "SELECT p_brand AS role, string_agg(DISTINCT p_type, '; ' ORDER BY p_type) AS courses FROM part GROUP BY p_brand"),
    "advice_fallback": (_advice, "SELECT c_custkey AS i, CASE WHEN (c_nationkey + length(c_mktsegment)) % 3 = 0 THEN 'both ' || c_nationkey || ' ' || c_mktsegment WHEN c_mktsegment <> 'MACHINERY' THEN 'role ' || c_mktsegment ELSE n_name END AS text FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"),
    "roadmap_explode": (lambda s, d: roadmap(_jobs(s, d)), "SELECT p_brand AS job, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey, p_name, p_size) - 1 AS INTEGER) AS step, p_name AS level, p_size AS salary FROM part"),
    "array_ops": (lambda s, d: _arr(s, d).select("i", *array_facts(F.col("a"))), f"SELECT i, CAST(list_sum(a) AS INTEGER) AS total, array_to_string(list_reverse(a), ',') AS reversed, list_max(a) AS largest, CAST(list_position(a, list_max(a)) - 1 AS BIGINT) AS largest_at, list_min(a) AS smallest, CAST(list_position(a, list_min(a)) - 1 AS BIGINT) AS smallest_at FROM {_LIST}"),
    "linear_search": (lambda s, d: _arr(s, d).select("i", F.when(F.array_position("a", F.lit(3)) > 0, F.array_position("a", F.lit(3)) - 1).alias("at")), f"SELECT i, CASE WHEN list_contains(a, 3) THEN CAST(list_position(a, 3) - 1 AS BIGINT) END AS at FROM {_LIST}"),
    "factorial": (lambda s, d: s.range(0, 13).select("id", F.factorial("id").alias("f")), "SELECT CAST(range AS BIGINT) AS id, CAST(factorial(CAST(range AS INTEGER)) AS BIGINT) AS f FROM range(13)"),
    "struct_fields": (lambda s, d: _student(s, d).select(F.col("student.info.name").alias("name"), F.col("student.course.grade").alias("grade")), "SELECT c_name AS name, c_mktsegment AS grade FROM customer"),
    "top_records": (lambda s, d: table(s, d, "events").orderBy("event_id").limit(5).select("event_id", "event_type"), "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5"),
}
