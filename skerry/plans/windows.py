"""Queries for ordered rows, ranks and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skerry.operators import ordering, ranking, statistics as stats, windows
from skerry.operators.joins import join_latest, join_outer_chain
from skerry.operators.sets import concat_frames
from skerry.plans.aggregates import ORDER_LINES_SQL, RATE_NAMES, order_lines
from skerry.plans.joins import OUTER_SQL, orders_by_customer
from skerry.plans.registry import INDICATORS, Tables, query, rounded
from skerry.plans.rows import harmonized


def month_text(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def row_number_latest(t: Tables) -> DataFrame:
    out = windows.row_number_latest(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return out.select("o_custkey", "o_orderkey", "o_totalprice")


RETURNS_SQL = "(SELECT month, " + ", ".join(f"{c}" for c in RATE_NAMES) + " FROM (SELECT month, " + ", ".join(
    f"LN({c} / LAG({c}) OVER (ORDER BY month)) AS {c}" for c in RATE_NAMES
) + " FROM @v_rates) WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in RATE_NAMES) + ")"


def monthly_returns(t: Tables) -> DataFrame:
    return windows.log_returns(t.v_rates, [], "month", RATE_NAMES)


@query(f"SELECT strftime(month, '%Y-%m-%d') AS month, {', '.join(f'ROUND({c}, 8) AS {c}' for c in RATE_NAMES)} FROM {RETURNS_SQL} r")
def log_returns(t: Tables) -> DataFrame:
    return month_text(rounded(monthly_returns(t), *RATE_NAMES, digits=8))


@query("""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, AVG(value) AS v FROM events GROUP BY 1, 2),
l AS (SELECT event_type, day, LN(v / LAG(v) OVER (PARTITION BY event_type ORDER BY day)) AS v FROM d)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, ROUND(v, 8) AS v FROM l WHERE v IS NOT NULL
""")
def log_returns_sliced(t: Tables) -> DataFrame:
    """The same per event type, cut into weekly slices so that a long key is not one task."""
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    out = windows.log_returns(daily, ["event_type"], "day", ["v"], slice_by=F.date_trunc("week", "day"))
    return rounded(out, "v", digits=8).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


PCT_SQL = """(SELECT country_key, year, value, (value / LAG(value) OVER (PARTITION BY country_key ORDER BY year) - 1) * 100 AS growth_pct
  FROM @v_ind WHERE indicator = 'revenue')"""


@query(f"SELECT country_key, year, ROUND(growth_pct, 6) AS growth_pct FROM {PCT_SQL} p")
def pct_change(t: Tables) -> DataFrame:
    out = windows.pct_change(t.indicator("revenue"), ["country_key"], "year", "revenue")
    return rounded(out, "growth_pct", digits=6).drop("revenue")


@query(f"SELECT country_key, ROUND(AVG(growth_pct), 6) AS mean_growth FROM {PCT_SQL} p GROUP BY country_key")
def mean_growth(t: Tables) -> DataFrame:
    out = windows.pct_change(t.indicator("revenue"), ["country_key"], "year", "revenue")
    return rounded(out.groupBy("country_key").agg(F.avg("growth_pct").alias("mean_growth")), "mean_growth", digits=6)


VOL_SQL = "SELECT strftime(month, '%Y-%m-%d') AS month, " + ", ".join(
    f"ROUND(CASE WHEN COUNT({c}) OVER w = 30 THEN STDDEV_SAMP({c}) OVER w * SQRT(252) END, 6) AS {c}_vol" for c in RATE_NAMES
) + f" FROM {RETURNS_SQL} r WINDOW w AS (ORDER BY month ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


@query(VOL_SQL)
def rolling_volatility(t: Tables) -> DataFrame:
    out = windows.rolling_volatility(monthly_returns(t), "month", RATE_NAMES).drop(*RATE_NAMES)
    return month_text(rounded(out, *[f"{c}_vol" for c in RATE_NAMES], digits=6))


@query("""
SELECT o_orderkey, ROUND(CASE WHEN COUNT(o_totalprice) OVER w = 30 THEN STDDEV_SAMP(o_totalprice) OVER w * SQRT(252) END, 2) AS o_totalprice_vol
FROM orders WINDOW w AS (ORDER BY o_orderkey ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
""")
def rolling_volatility_ranges(t: Tables) -> DataFrame:
    """One series of all orders, in ranges that each take the rows before them along."""
    prices = t.orders.select("o_orderkey", "o_totalprice")
    out = windows.rolling_volatility(prices, "o_orderkey", ["o_totalprice"], ranges=True)
    return rounded(out, "o_totalprice_vol", digits=2).select("o_orderkey", "o_totalprice_vol")


@query(f"SELECT * FROM ({VOL_SQL}) ORDER BY month DESC LIMIT 1")
def latest_volatility(t: Tables) -> DataFrame:
    out = windows.rolling_volatility(monthly_returns(t), "month", RATE_NAMES).drop(*RATE_NAMES)
    return month_text(rounded(windows.latest_row(out, "month"), *[f"{c}_vol" for c in RATE_NAMES], digits=6))


@query(f"""
SELECT country_key, year, {', '.join(f'LAST_VALUE({c} IGNORE NULLS) OVER w AS {c}' for c in INDICATORS)} FROM {OUTER_SQL} o
WINDOW w AS (PARTITION BY country_key ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def forward_fill(t: Tables) -> DataFrame:
    joined = join_outer_chain([t.indicator(n) for n in INDICATORS], ["country_key", "year"])
    return windows.forward_fill(joined, ["country_key"], "year", INDICATORS)


@query("""
SELECT record_id, LAST_VALUE(temperature_c IGNORE NULLS) OVER (PARTITION BY station ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS temperature_c FROM @v_obs
""")
def forward_fill_sliced(t: Tables) -> DataFrame:
    """Observations filled per station in stored ranges: no task holds a whole station, however many rows it has."""
    dealt = ordering.range_slices(t.v_obs.select("record_id", "station", "ts", "temperature_c"), ["station"], [F.col("ts")])
    filled = windows.forward_fill(dealt, ["station"], "ts", ["temperature_c"], slice_by=F.col(ordering.RANGE))
    return filled.select("record_id", "temperature_c")


@query("""
WITH n AS (SELECT c_nationkey, COUNT(*) AS customers, AVG(c_acctbal) AS balance FROM customer GROUP BY 1)
SELECT c_nationkey, customers, ROUND(balance, 4) AS balance, CAST(ROW_NUMBER() OVER (ORDER BY customers DESC, c_nationkey) AS INT) AS by_customers,
 CAST(ROW_NUMBER() OVER (ORDER BY balance, c_nationkey) AS INT) AS by_balance FROM n
""")
def rank_by(t: Tables) -> DataFrame:
    nations = t.customer.groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.avg("c_acctbal").alias("balance")
    )
    ranks = {
        "by_customers": [F.desc("customers"), F.col("c_nationkey")],
        "by_balance": [F.asc("balance"), F.col("c_nationkey")],
    }
    return rounded(windows.rank_by(nations, ranks), "balance")


def burst_sql(source: str, cell: str, ts: str, min_count: int) -> str:
    return f"""
WITH w AS (SELECT {cell}, {ts} AS ts, COUNT(*) OVER (PARTITION BY {cell} ORDER BY {ts} RANGE BETWEEN CURRENT ROW AND INTERVAL 24 HOUR FOLLOWING) AS n
  FROM {source}), f AS (SELECT {cell}, MIN(ts) AS ts FROM w WHERE n >= {min_count} GROUP BY {cell})
SELECT DISTINCT {', '.join('w.' + c.strip() for c in cell.split(','))}, strftime(w.ts, '%Y-%m-%d %H:%M') AS start, w.n AS count FROM w JOIN f ON
 {' AND '.join(f'w.{c.strip()} = f.{c.strip()}' for c in cell.split(','))} AND w.ts = f.ts"""


def minute_text(df: DataFrame) -> DataFrame:
    return df.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


@query(burst_sql("(SELECT user_id % 100 AS cell, event_type, ts FROM events)", "event_type, cell", "ts", 3))
def burst_clusters(t: Tables) -> DataFrame:
    cells = t.events.withColumn("cell", F.col("user_id") % 100)
    return minute_text(windows.burst_clusters(cells, ["event_type", "cell"], "ts"))


@query(burst_sql("(SELECT FLOOR(lat / 10) * 10 AS lat_bin, FLOOR(lon / 10) * 10 AS lon_bin, ts FROM @v_geo)", "lat_bin, lon_bin", "ts", 3))
def burst_clusters_grid(t: Tables) -> DataFrame:
    from skerry.operators.aggregates import with_grid

    return minute_text(windows.burst_clusters(with_grid(t.v_geo, "lat", "lon"), ["lat_bin", "lon_bin"], "ts"))


@query("""
SELECT event_id, value, ROUND(ABS(value - m) / s, 6) AS zscore FROM events, (SELECT AVG(value) AS m, STDDEV_SAMP(value) AS s FROM events)
WHERE ABS(value - m) / s > 3
""")
def zscore_outliers(t: Tables) -> DataFrame:
    out = windows.zscore_outliers(t.events, "value", 3.0)
    return rounded(out, "zscore", digits=6).select("event_id", "value", "zscore")


@query("""
WITH n AS (SELECT c_nationkey, AVG(c_acctbal) AS balance, 7.0 AS flat FROM customer GROUP BY 1)
SELECT c_nationkey, ROUND((balance - lo) / (hi - lo) * 100, 6) AS balance_norm, CAST(50 AS DOUBLE) AS flat_norm
FROM n, (SELECT MIN(balance) AS lo, MAX(balance) AS hi FROM n)
""")
def minmax_scale(t: Tables) -> DataFrame:
    nations = t.customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("balance")).withColumn("flat", F.lit(7.0))
    out = windows.minmax_scale(nations, ["balance", "flat"])
    return rounded(out, "balance_norm", digits=6).select("c_nationkey", "balance_norm", "flat_norm")


LEAD_SQL = """(SELECT CAST(FLOOR((epoch_us(ts) - f) / 86400000000) + 1 AS BIGINT) AS lead_day, AVG(value) AS mean, STDDEV_SAMP(value) AS std
  FROM events, (SELECT MIN(epoch_us(ts)) AS f FROM events) GROUP BY 1)"""


@query(f"SELECT lead_day, ROUND(mean, 4) AS mean, ROUND(std, 4) AS std FROM {LEAD_SQL} l")
def lead_time_stats(t: Tables) -> DataFrame:
    return rounded(windows.lead_time_stats(t.events, "ts", "value"), "mean", "std")


@query(f"""
SELECT COUNT(*) AS days, ROUND(ARG_MIN(std, lead_day), 4) AS first_day_std, ROUND(ARG_MAX(std, lead_day), 4) AS last_day_std FROM {LEAD_SQL} l
""")
def lead_time_span(t: Tables) -> DataFrame:
    out = windows.lead_time_span(windows.lead_time_stats(t.events, "ts", "value"))
    return rounded(out, "first_day_std", "last_day_std")


@query("""
WITH r AS (SELECT value, user_id, ROW_NUMBER() OVER (ORDER BY event_id) <= (SELECT COUNT(*) // 2 FROM events) AS head FROM events),
a AS (SELECT 'value' AS column_name, AVG(value) FILTER (WHERE head) AS f, AVG(value) FILTER (WHERE NOT head) AS s, STDDEV_SAMP(value) FILTER (WHERE head) AS d FROM r
 UNION ALL SELECT 'user_id', AVG(user_id) FILTER (WHERE head), AVG(user_id) FILTER (WHERE NOT head), STDDEV_SAMP(user_id) FILTER (WHERE head) FROM r)
SELECT column_name, ROUND(f, 4) AS first_mean, ROUND(s, 4) AS second_mean, ROUND(ABS(s - f), 4) AS mean_diff, ROUND(d * 1.5, 4) AS threshold,
 ABS(s - f) <= d * 1.5 AS stable FROM a
""")
def half_shift(t: Tables) -> DataFrame:
    out = windows.half_shift(t.events, "event_id", ["value", "user_id"])
    return rounded(out, "first_mean", "second_mean", "mean_diff", "threshold")


@query("""
WITH h AS (SELECT event_type AS station, strftime(ts, '%Y-%m-%d') AS date, value AS amount, 'events' AS source, 0 AS pos, event_id AS id FROM events
 UNION ALL SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), o_totalprice, 'orders', 1, o_orderkey FROM orders)
SELECT station, date, amount, source FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station, date ORDER BY pos, amount) AS rn FROM h) WHERE rn = 1
""")
def dedupe_first(t: Tables) -> DataFrame:
    merged = concat_frames([df.withColumn("pos", F.lit(i)) for i, df in enumerate(harmonized(t))])
    out = windows.dedupe_first(merged, ["station", "date"], [F.col("pos"), F.col("amount")])
    return out.drop("pos").orderBy("date", "station")


@query("SELECT CAST(ROW_NUMBER() OVER (ORDER BY n_name) AS BIGINT) AS nation_key, n_name FROM nation")
def sequence_keys(t: Tables) -> DataFrame:
    out = windows.sequence_keys(t.nation.select("n_name"), [F.col("n_name")], "nation_key")
    return out.withColumn("nation_key", F.col("nation_key").cast("bigint"))


@query("SELECT CAST(ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_no, o_orderkey FROM orders")
def sequence_keys_sliced(t: Tables) -> DataFrame:
    """Dense numbers for a large table: numbered inside stored ranges, shifted by the rows of earlier ones."""
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    dealt = ordering.range_slices(t.orders.select("o_orderkey", "o_orderdate"), [], order)
    out = windows.sequence_keys(dealt, order, "order_no", slice_by=F.col(ordering.RANGE))
    return out.select(F.col("order_no").cast("bigint").alias("order_no"), "o_orderkey")


SIGMA_SQL = f"""(SELECT l.series, strftime(l.month, '%Y-%m-%d') AS month, l.ret, ABS(l.ret) / s.sd AS std_devs
 FROM (SELECT * FROM {RETURNS_SQL} UNPIVOT (ret FOR series IN ({', '.join(RATE_NAMES)}))) l
 JOIN (SELECT series, AVG(ret) AS m, STDDEV_SAMP(ret) AS sd FROM (SELECT * FROM {RETURNS_SQL} UNPIVOT (ret FOR series IN ({', '.join(RATE_NAMES)})))
       GROUP BY series) s ON s.series = l.series WHERE ABS(l.ret) > s.m + 1.5 * s.sd)"""


def sigma(t: Tables) -> DataFrame:
    long = month_text(monthly_returns(t)).unpivot(["month"], RATE_NAMES, "series", "ret")
    return windows.sigma_events(long, "series", "ret", k=1.5)


@query(f"SELECT series, month, ROUND(ret, 8) AS ret, ROUND(std_devs, 6) AS std_devs FROM {SIGMA_SQL} e")
def sigma_events(t: Tables) -> DataFrame:
    return rounded(rounded(sigma(t), "ret", digits=8), "std_devs", digits=6)


@query(f"""
SELECT series, month, ROUND(ret, 8) AS ret, ROUND(std_devs, 6) AS std_devs, (SELECT COUNT(*) FROM {SIGMA_SQL} c) AS total_events
FROM {SIGMA_SQL} e ORDER BY ABS(e.ret) DESC, series, month LIMIT 20
""")
def largest_events(t: Tables) -> DataFrame:
    out = windows.largest_events(sigma(t), "ret", ["series", "month"], 20)
    return rounded(rounded(out, "ret", digits=8), "std_devs", digits=6)


@query(f"""
WITH d AS (SELECT * FROM {ORDER_LINES_SQL} o), m AS (SELECT REGR_SLOPE(lines, LN(o_totalprice)) AS s, REGR_INTERCEPT(lines, LN(o_totalprice)) AS i FROM d),
l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM d)
SELECT o_custkey, lines, ROUND(s * LN(o_totalprice) + i, 6) AS predicted, ROUND(lines - (s * LN(o_totalprice) + i), 6) AS residual,
 CASE WHEN lines - (s * LN(o_totalprice) + i) < 0 THEN 'better' ELSE 'worse' END AS direction FROM l, m WHERE rn = 1
""")
def residual_rank(t: Tables) -> DataFrame:
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    out = windows.residuals_in_one_pass(order_lines(t), ["o_custkey"], order, "o_totalprice", "lines").orderBy("residual", "o_custkey")
    return rounded(out, "predicted", "residual", digits=6).select(
        "o_custkey", "lines", "predicted", "residual", "direction"
    )


@query("""
SELECT c_custkey, o_totalprice FROM customer LEFT JOIN (SELECT o_custkey, o_totalprice, ROW_NUMBER() OVER (PARTITION BY o_custkey
 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o ON o_custkey = c_custkey AND rn = 1 ORDER BY 2 DESC NULLS LAST
""")
def sort_nulls_last(t: Tables) -> DataFrame:
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    latest = join_latest(t.customer.select("c_custkey"), orders_by_customer(t), ["c_custkey"], order)
    return ranking.sort_nulls_last(latest.select("c_custkey", "o_totalprice"), "o_totalprice", ["c_custkey"])


@query("""
SELECT 'largest' AS side, p_partkey, p_retailprice FROM (SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10)
UNION ALL SELECT 'smallest', p_partkey, p_retailprice FROM (SELECT * FROM part WHERE p_retailprice <> 0 ORDER BY p_retailprice, p_partkey LIMIT 10)
""")
def top_k(t: Tables) -> DataFrame:
    ends = [
        ranking.top_k(t.part, "p_retailprice", 10, ["p_partkey"], largest).select(
            F.lit(side).alias("side"), "p_partkey", "p_retailprice"
        )
        for largest, side in ((True, "largest"), (False, "smallest"))
    ]
    return concat_frames(ends)


@query("""
SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent filter' ELSE 'first result' END AS reason FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END, o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def first_match(t: Tables) -> DataFrame:
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    preferred = F.col("o_orderpriority") == "1-URGENT"
    out = ranking.first_match(t.orders, "o_custkey", preferred, order, ("urgent filter", "first result"))
    return out.select("o_custkey", "o_orderkey", "reason")


@query("""
WITH n AS (SELECT c_nationkey, CAST(COUNT(*) AS DOUBLE) AS customers, AVG(c_acctbal) AS balance FROM customer GROUP BY 1)
SELECT c_nationkey, 'customers' AS measure, CAST(ROW_NUMBER() OVER (ORDER BY customers DESC, c_nationkey) AS INT) AS rank FROM n
UNION ALL SELECT c_nationkey, 'balance', CAST(ROW_NUMBER() OVER (ORDER BY balance, c_nationkey) AS INT) FROM n
""")
def multi_rank(t: Tables) -> DataFrame:
    nations = t.customer.groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.avg("c_acctbal").alias("balance")
    )
    return ranking.multi_rank(nations, "c_nationkey", [("customers", False), ("balance", True)])
