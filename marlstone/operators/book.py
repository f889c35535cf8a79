"""Bond book: positions, present value, state as of an event, profit and loss over the trade tape.

accrued = coupon * months / 12 * 100; dirty = clean + accrued; present value = dirty * signed quantity. A trade of a bond
without terms goes to quarantine, not into the book. As of N means event id <= N, in id order. Every view filters before it
aggregates, the bond terms join on their key (Spark broadcasts them only below its own size threshold), and aggregates are
partial before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.sources.tables import bonds, trades

KEYS = ("bond_id", "desk", "trader")


def signed(side: Column, quantity: Column) -> Column:
    return F.when(side == "BUY", quantity).otherwise(-quantity)


def accrued(coupon: Column, months: Column) -> Column:
    return coupon * months / 12.0 * 100.0


def priced(tape: DataFrame, terms: DataFrame) -> DataFrame:
    """Trades with signed quantity, accrued interest, dirty price and present value; unknown bonds are left out."""
    t = tape.join(terms, "bond_id").withColumn("qty", signed(F.col("side"), F.col("quantity")).cast("long")).withColumn("accrued", accrued(F.col("coupon"), F.col("months")))
    t = t.withColumn("dirty", F.col("clean_price") + F.col("accrued"))
    return t.withColumn("pv", F.col("dirty") * F.col("qty"))


def quarantine(tape: DataFrame, terms: DataFrame) -> DataFrame:
    return tape.join(terms.select("bond_id"), "bond_id", "left_anti")


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced(trades(spark, sf_dir), bonds(spark, sf_dir))


def exact(c) -> Column:
    return F.round(c, 7)  # terms are multiples of 1/1200000, so no value lies on a rounding boundary


def positions(b: DataFrame) -> DataFrame:
    return b.groupBy(*KEYS).agg(F.sum("qty").alias("position"), exact(F.sum("pv")).alias("pv"))


def by_bond(b: DataFrame) -> DataFrame:
    """Net position and present value per bond; the row with a null bond is the total."""
    return b.rollup("bond_id").agg(F.sum("qty").alias("net_position"), exact(F.sum("pv")).alias("pv"))


def sliced(b: DataFrame, key: str, value, *levels: str) -> DataFrame:
    """One bond, desk or trader: rows by the other keys and the total (null keys)."""
    kept = b.where(F.upper(F.col(key).cast("string")) == str(value).upper())
    out = kept.groupingSets([[F.col(c) for c in levels], []], *(F.col(c) for c in levels))
    return out.agg(F.sum("qty").alias("position"), exact(F.max("accrued")).alias("accrued"), exact(F.sum("pv")).alias("pv"))


def running(b: DataFrame) -> DataFrame:
    """Position and cumulative present value of the key after every trade."""
    w = Window.partitionBy(*KEYS).orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return b.select("event_id", *KEYS, F.sum("qty").over(w).alias("position"), exact(F.sum("pv").over(w)).alias("cum_pv"))


def as_of(b: DataFrame, n: int) -> DataFrame:
    return b.where(F.col("event_id") <= n)


def show_bond(b: DataFrame, bond_id: int, n: int | None = None) -> DataFrame:
    """Mark to market of one bond: net position at the last clean price of any desk; no row when flat or never traded."""
    own = b.where(F.col("bond_id") == bond_id)
    own = own if n is None else as_of(own, n)
    one = own.groupBy("bond_id").agg(F.sum("qty").alias("net_position"), F.max_by("clean_price", "event_id").alias("last_price"), F.max("accrued").alias("accrued")).where("net_position <> 0")
    dirty = F.col("last_price") + F.col("accrued")
    return one.select("bond_id", "net_position", exact("last_price").alias("last_price"), exact(dirty).alias("dirty"), exact(dirty * F.col("net_position")).alias("market_value"))


def pnl_since(b: DataFrame, n: int) -> DataFrame:
    """Change of present value per key since before event n: what later trades added, 0 where none did."""
    return b.groupBy(*KEYS).agg(exact(F.sum(F.when(F.col("event_id") >= n, F.col("pv")).otherwise(0.0))).alias("pnl"))


def pnl_full_join(b: DataFrame, n: int) -> DataFrame:
    """The same by two states: now against as of n - 1, missing keys counting 0."""
    now, then = (x.groupBy(*KEYS).agg(F.sum("pv").alias(name)) for x, name in ((b, "pv_now"), (as_of(b, n - 1), "pv_then")))
    return now.join(then, list(KEYS), "full").select(*KEYS, exact(F.coalesce("pv_now", F.lit(0.0)) - F.coalesce("pv_then", F.lit(0.0))).alias("pnl"))


_B = """WITH b AS (
  SELECT e.event_id, upper(e.event_type) AS desk, 'T' || CAST(e.user_id % 5 AS VARCHAR) AS trader, e.user_id AS bond_id, e.value AS clean_price,
    CASE WHEN k % 2 = 0 THEN k ELSE -k END AS qty, c.c_acctbal / 100000 * (c.c_nationkey % 12) / 12.0 * 100.0 AS accrued,
    (e.value + c.c_acctbal / 100000 * (c.c_nationkey % 12) / 12.0 * 100.0) * CASE WHEN k % 2 = 0 THEN k ELSE -k END AS pv
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e JOIN customer c ON c.c_custkey = e.user_id)
"""
_SUMS = "CAST(SUM(qty) AS BIGINT) AS position, ROUND(MAX(accrued), 7) AS accrued, ROUND(SUM(pv), 7) AS pv"

N = 500  #: the event that the as-of queries look at
BOND, DESK, TRADER = 7, "click", "t3"

QUERIES = {
    "book_positions": (lambda s, d: positions(book(s, d)), _B + "SELECT bond_id, desk, trader, CAST(SUM(qty) AS BIGINT) AS position, ROUND(SUM(pv), 7) AS pv FROM b GROUP BY ALL"),
    "book_pv_by_bond": (lambda s, d: by_bond(book(s, d)), _B + "SELECT bond_id, CAST(SUM(qty) AS BIGINT) AS net_position, ROUND(SUM(pv), 7) AS pv FROM b GROUP BY ROLLUP (bond_id)"),
    "book_bond_slice": (lambda s, d: sliced(book(s, d), "bond_id", BOND, "desk", "trader"), _B + f"SELECT desk, trader, {_SUMS} FROM b WHERE bond_id = {BOND} GROUP BY GROUPING SETS ((desk, trader), ())"),
    "book_desk_slice": (lambda s, d: sliced(book(s, d), "desk", DESK, "bond_id", "trader"), _B + f"SELECT bond_id, trader, {_SUMS} FROM b WHERE desk = '{DESK.upper()}' GROUP BY GROUPING SETS ((bond_id, trader), ())"),
    "book_trader_slice": (lambda s, d: sliced(book(s, d), "trader", TRADER, "bond_id", "desk"), _B + f"SELECT bond_id, desk, {_SUMS} FROM b WHERE trader = '{TRADER.upper()}' GROUP BY GROUPING SETS ((bond_id, desk), ())"),
    "book_running": (lambda s, d: running(book(s, d)), _B + "SELECT event_id, bond_id, desk, trader, CAST(SUM(qty) OVER w AS BIGINT) AS position, ROUND(SUM(pv) OVER w, 7) AS cum_pv FROM b WINDOW w AS (PARTITION BY bond_id, desk, trader ORDER BY event_id ROWS UNBOUNDED PRECEDING)"),
    "book_event_lookup": (lambda s, d: running(book(s, d)).where(F.col("event_id") == N), _B + f"SELECT * FROM (SELECT event_id, bond_id, desk, trader, CAST(SUM(qty) OVER w AS BIGINT) AS position, ROUND(SUM(pv) OVER w, 7) AS cum_pv FROM b WINDOW w AS (PARTITION BY bond_id, desk, trader ORDER BY event_id ROWS UNBOUNDED PRECEDING)) WHERE event_id = {N}"),
    "book_event_range": (lambda s, d: trades(s, d).where(F.col("event_id").between(N, N + 25)).select("event_id", "desk", "trader", "bond_id", "side", "quantity"), _B + f"SELECT event_id, desk, trader, bond_id, CASE WHEN abs(qty) % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, CAST(abs(qty) AS INTEGER) AS quantity FROM b WHERE event_id BETWEEN {N} AND {N + 25}"),
    "book_state_after": (lambda s, d: by_bond(as_of(book(s, d), N)), _B + f"SELECT bond_id, CAST(SUM(qty) AS BIGINT) AS net_position, ROUND(SUM(pv), 7) AS pv FROM b WHERE event_id <= {N} GROUP BY ROLLUP (bond_id)"),
    "book_show_bond_asof": (lambda s, d: show_bond(book(s, d), BOND, N), _B + f"SELECT bond_id, CAST(SUM(qty) AS BIGINT) AS net_position, ROUND(arg_max(clean_price, event_id), 7) AS last_price, ROUND(arg_max(clean_price, event_id) + MAX(accrued), 7) AS dirty, ROUND((arg_max(clean_price, event_id) + MAX(accrued)) * SUM(qty), 7) AS market_value FROM b WHERE bond_id = {BOND} AND event_id <= {N} GROUP BY bond_id HAVING SUM(qty) <> 0"),
    "book_pnl_since": (lambda s, d: pnl_since(book(s, d), N), _B + f"SELECT bond_id, desk, trader, ROUND(SUM(CASE WHEN event_id >= {N} THEN pv ELSE 0 END), 7) AS pnl FROM b GROUP BY ALL"),
    "book_pnl_full_join": (lambda s, d: pnl_full_join(book(s, d), N), _B + f", x AS (SELECT bond_id, desk, trader, SUM(pv) AS p FROM b GROUP BY ALL), y AS (SELECT bond_id, desk, trader, SUM(pv) AS q FROM b WHERE event_id < {N} GROUP BY ALL) SELECT bond_id, desk, trader, ROUND(COALESCE(p, 0) - COALESCE(q, 0), 7) AS pnl FROM x FULL JOIN y USING (bond_id, desk, trader)"),
    "book_pnl_bond_since": (lambda s, d: pnl_since(book(s, d).where(F.col("bond_id") == BOND), N), _B + f"SELECT bond_id, desk, trader, ROUND(SUM(CASE WHEN event_id >= {N} THEN pv ELSE 0 END), 7) AS pnl FROM b WHERE bond_id = {BOND} GROUP BY ALL"),
    "book_quarantine": (lambda s, d: quarantine(trades(s, d), bonds(s, d).where(F.col("bond_id") % 10 != 0)).select("event_id", "bond_id"), "SELECT event_id, user_id AS bond_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)"),
}
