"""Queries for aggregations and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skerry.operators import aggregates as agg, rows, statistics as stats
from skerry.operators.sets import concat_frames
from skerry.plans.registry import INDICATORS, PRIORITIES, Tables, query, round_half_up, rounded
from skerry.plans.rows import GATED_SQL, harmonized, sensor_text

VALUE_EDGES, VALUE_LABELS = (0, 10, 25, 50, 150), ("low", "mid", "high", "extreme")
# Severity order and advice of the test categories.
WORST_FIRST = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ADVICE = {"1-URGENT": "Ship today.", "2-HIGH": "Ship this week.", "3-MEDIUM": "Ship this month.", "5-LOW": "No hurry."}


@query("""
SELECT event_type, COUNT(value) AS record_count, ROUND(AVG(value), 4) AS value_mean, MIN(value) AS value_min, MAX(value) AS value_max,
  ROUND(AVG(user_id), 4) AS user_mean FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""")
def summarize_by(t: Tables) -> DataFrame:
    aggs = {
        "record_count": ("value", "count"), "value_mean": ("value", "mean"), "value_min": ("value", "min"),
        "value_max": ("value", "max"), "user_mean": ("user_id", "mean"),
    }
    return agg.summarize_by(t.events, ["event_type"], aggs, digits=4)


@query("""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(DISTINCT user_id) AS entities, ROUND(AVG(value), 4) AS value_mean,
  ROUND(STDDEV_SAMP(value), 4) AS value_std FROM events GROUP BY 1
""")
def daily_profile(t: Tables) -> DataFrame:
    out = agg.daily_profile(t.events, "ts", "user_id", ["value"], digits=4)
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("""
WITH b AS (SELECT event_type, CASE WHEN value > 0 AND value <= 10 THEN 'low' WHEN value > 10 AND value <= 25 THEN 'mid'
  WHEN value > 25 AND value <= 50 THEN 'high' WHEN value > 50 AND value <= 150 THEN 'extreme' END AS band FROM events)
SELECT CASE WHEN GROUPING(event_type) = 1 THEN 'All' ELSE event_type END AS event_type, COUNT(*) FILTER (WHERE band = 'low') AS low,
 COUNT(*) FILTER (WHERE band = 'mid') AS mid, COUNT(*) FILTER (WHERE band = 'high') AS high,
 COUNT(*) FILTER (WHERE band = 'extreme') AS extreme, COUNT(*) AS "All" FROM b WHERE band IS NOT NULL GROUP BY ROLLUP (event_type)
""")
def crosstab_margins(t: Tables) -> DataFrame:
    return agg.crosstab_margins(t.events, "event_type", "value", VALUE_EDGES, VALUE_LABELS)


@query("SELECT p_brand, COUNT(*) AS count FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY 2 DESC, 1 LIMIT 10")
def value_counts(t: Tables) -> DataFrame:
    return agg.value_counts(t.part, "p_brand", n=10)


@query("SELECT p_type, COUNT(*) AS count FROM part WHERE p_type IS NOT NULL GROUP BY p_type")
def value_counts_by_value(t: Tables) -> DataFrame:
    return agg.value_counts(t.part, "p_type", by_value=True)


@query("""
SELECT c AS column_name, COUNT(v) AS count, ROUND(SUM(v), 2) AS sum, ROUND(AVG(v), 4) AS mean, MIN(v) AS min, MAX(v) AS max,
  ROUND(MEDIAN(v), 4) AS median, ROUND(STDDEV_POP(v), 4) AS std
FROM (SELECT 'l_extendedprice' AS c, l_extendedprice AS v FROM lineitem UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem)
GROUP BY c
""")
def describe_columns(t: Tables) -> DataFrame:
    out = stats.describe_columns(t.lineitem, ["l_extendedprice", "l_quantity"])
    return rounded(out, "mean", "median", "std").withColumn("sum", round_half_up(F.col("sum"), 2))


@query("""
SELECT region, COUNT(*) AS members, CAST(SUM(population) AS BIGINT) AS total_population, SUM(area_km2) AS total_area_km2,
  ROUND(AVG(population), 4) AS avg_population, ROUND(SUM(population) / SUM(area_km2), 3) AS ratio FROM @v_country GROUP BY region
""")
def rollup_ratio(t: Tables) -> DataFrame:
    return rounded(agg.rollup_ratio(t.v_country, "region", "population", "area_km2", digits=3), "avg_population")


@query("""
SELECT FLOOR(lat / 10) * 10 AS lat_bin, FLOOR(lon / 10) * 10 AS lon_bin, CAST(ts AS DATE) = DATE '1997-05-28' AS on_day, COUNT(*) AS count
FROM @v_geo GROUP BY 1, 2, 3
""")
def group_size(t: Tables) -> DataFrame:
    cells = agg.with_grid(t.v_geo, "lat", "lon").withColumn("on_day", F.to_date("ts") == F.lit("1997-05-28").cast("date"))
    return agg.group_size(cells, ["lat_bin", "lon_bin", "on_day"])


RATE_NAMES = ["urgent", "high", "medium", "unspecified", "low"]


def rates_long(t: Tables) -> DataFrame:
    return t.v_rates.unpivot(["month"], RATE_NAMES, "series", "rate")


RATES_LONG_SQL = "(SELECT month, series, rate FROM (SELECT * FROM @v_rates) UNPIVOT (rate FOR series IN (urgent, high, medium, unspecified, low)))"


@query(f"""
SELECT strftime(month, '%Y-%m-%d') AS month, ROUND(MIN(rate), 4) AS min_value, ROUND(MAX(rate), 4) AS max_value,
  ROUND(AVG(rate), 4) AS mean_value FROM {RATES_LONG_SQL} r GROUP BY 1
""")
def spread_by_time(t: Tables) -> DataFrame:
    out = agg.spread_by_time(rates_long(t), "month", "rate").withColumn("month", F.date_format("month", "yyyy-MM-dd"))
    return rounded(out, "min_value", "max_value", "mean_value")


@query(f"""
SELECT ROUND(MIN(lo), 4) AS overall_min, ROUND(MAX(hi), 4) AS overall_max, ROUND(MAX(hi - lo), 4) AS widest_spread
FROM (SELECT MIN(rate) AS lo, MAX(rate) AS hi FROM {RATES_LONG_SQL} r GROUP BY month)
""")
def spread_overall(t: Tables) -> DataFrame:
    out = agg.spread_overall(agg.spread_by_time(rates_long(t), "month", "rate"))
    return rounded(out, "overall_min", "overall_max", "widest_spread")


@query("""
SELECT day, event_type, n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY day ORDER BY n DESC, event_type) AS rn FROM
  (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)) WHERE rn = 1
""")
def argmax_by(t: Tables) -> DataFrame:
    daily = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))
    return agg.argmax_by(daily, ["day"], "n", "event_type")


@query("""
WITH x AS (SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders)
SELECT c.k AS o_custkey, p.price, q.priority FROM (SELECT DISTINCT o_custkey AS k FROM x) c
LEFT JOIN (SELECT o_custkey, price, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM x WHERE price IS NOT NULL) p ON p.o_custkey = c.k AND p.rn = 1
LEFT JOIN (SELECT o_custkey, priority, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM x WHERE priority IS NOT NULL) q ON q.o_custkey = c.k AND q.rn = 1
""")
def latest_per_key(t: Tables) -> DataFrame:
    gappy = t.orders.select(
        "o_custkey", "o_orderdate", "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    return agg.latest_per_key(gappy, ["o_custkey"], order, ["price", "priority"])


@query("""
SELECT country_key, ARG_MIN(value, year) FILTER (WHERE indicator = 'revenue') AS revenue,
 ARG_MIN(value, year) FILTER (WHERE indicator = 'orders') AS orders, ARG_MIN(value, year) FILTER (WHERE indicator = 'urgent') AS urgent
FROM @v_ind GROUP BY country_key
""")
def pivot_first(t: Tables) -> DataFrame:
    return agg.pivot_first(t.v_ind, ["country_key"], "indicator", "value", INDICATORS, [F.col("year")])


@query("""
SELECT c_nationkey, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS "1-URGENT", COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS "2-HIGH",
 COUNT(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS "3-MEDIUM", COUNT(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
 COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS "5-LOW", COUNT(*) FILTER (WHERE o_orderpriority = '6-NONE') AS "6-NONE"
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey
""")
def category_distribution(t: Tables) -> DataFrame:
    counted = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    placed = counted.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return agg.category_distribution(placed, "c_nationkey", "o_orderpriority", [*PRIORITIES, "6-NONE"], weight="n")


@query("""
SELECT l_returnflag, COUNT(*) FILTER (WHERE l_quantity > 40) AS l_quantity_over, COUNT(*) FILTER (WHERE l_discount > 0.05) AS l_discount_over,
 COUNT(*) AS observations FROM lineitem GROUP BY l_returnflag
""")
def exceedance_counts(t: Tables) -> DataFrame:
    return agg.exceedance_counts(t.lineitem, "l_returnflag", {"l_quantity": 40.0, "l_discount": 0.05})


@query("""
SELECT p_type, COUNT(*) AS total, COUNT(*) FILTER (WHERE p_size > 25) AS big, COUNT(*) FILTER (WHERE p_retailprice < 950) AS cheap,
 COUNT(*) FILTER (WHERE p_name LIKE 'red%') AS red FROM part GROUP BY p_type
""")
def conditional_counts(t: Tables) -> DataFrame:
    conditions = {
        "big": F.col("p_size") > 25, "cheap": F.col("p_retailprice") < 950, "red": F.col("p_name").startswith("red"),
    }
    return agg.conditional_counts(t.part, conditions, ["p_type"])


@query("""
SELECT o_custkey, MIN(o_orderpriority) AS worst_category, CASE MIN(o_orderpriority) WHEN '1-URGENT' THEN 'Ship today.'
 WHEN '2-HIGH' THEN 'Ship this week.' WHEN '3-MEDIUM' THEN 'Ship this month.' WHEN '5-LOW' THEN 'No hurry.'
 ELSE 'No data available.' END AS advisory FROM orders GROUP BY o_custkey
""")
def worst_category(t: Tables) -> DataFrame:
    return agg.worst_category(t.orders, "o_custkey", "o_orderpriority", WORST_FIRST, ADVICE)


@query("""
SELECT l_returnflag, ROUND(AVG(ABS(e)), 4) AS mae, ROUND(SQRT(AVG(e * e)), 4) AS rmse, ROUND(AVG(e), 4) AS bias, COUNT(e) AS n FROM
 (SELECT l_returnflag, l_quantity * p_retailprice - l_extendedprice AS e FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY l_returnflag
""")
def error_metrics(t: Tables) -> DataFrame:
    priced = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "estimate", F.col("l_quantity") * F.col("p_retailprice")
    )
    return rounded(stats.error_metrics(priced, "estimate", "l_extendedprice", ["l_returnflag"]), "mae", "rmse", "bias")


@query("""
WITH c AS (SELECT l_returnflag, CORR(l_quantity, l_extendedprice) AS r, COUNT(*) AS n FROM lineitem GROUP BY 1),
u AS (SELECT *, r * SQRT((n - 2) / (1 - r * r)) AS t FROM c)
SELECT l_returnflag, ROUND(r, 6) AS r, ROUND(t, 4) AS t_stat, ROUND(2 * (1 - LEAST(0.9999, ABS(t) / SQRT(n))), 6) AS p_approx, n FROM u
""")
def pearson_safe(t: Tables) -> DataFrame:
    out = stats.pearson_safe(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return rounded(rounded(out, "r", "p_approx", digits=6), "t_stat")


@query("""
WITH m AS (SELECT * FROM @v_rates), n AS (SELECT UNNEST(['urgent','high','medium','unspecified','low']) AS x),
l AS (SELECT month, series, rate FROM m UNPIVOT (rate FOR series IN (urgent, high, medium, unspecified, low)))
SELECT a.series AS x, b.series AS y, ROUND(CORR(a.rate, b.rate), 6) AS r FROM l a JOIN l b ON a.month = b.month GROUP BY 1, 2
""")
def correlation_matrix(t: Tables) -> DataFrame:
    return rounded(stats.correlation_matrix(t.v_rates, RATE_NAMES), "r", digits=6)


# Remainders of prices, each missing for some orders: more columns than one aggregate takes.
REMAINDERS = {f"r{p}": p for p in (7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61, 67, 71, 73, 79, 83, 89, 97, 101, 103, 107, 109)}


@query(f"""
WITH v AS (SELECT {", ".join(f"CASE WHEN o_orderkey % {3 + i % 4} > 0 THEN FLOOR(o_totalprice) % {p} END AS {c}" for i, (c, p) in enumerate(REMAINDERS.items()))} FROM orders),
c AS (SELECT unnest([{", ".join(f"struct_pack(x := '{a}', y := '{b}', r := CORR({a}, {b}))" for a in REMAINDERS for b in REMAINDERS)}]) AS s FROM v)
SELECT s.x AS x, s.y AS y, ROUND(s.r, 6) AS r FROM c
""")
def correlation_blocks(t: Tables) -> DataFrame:
    price = F.floor("o_totalprice").cast("double")
    cells = {c: F.when(F.col("o_orderkey") % (3 + i % 4) > 0, price % p) for i, (c, p) in enumerate(REMAINDERS.items())}
    return rounded(stats.correlation_matrix(t.orders.select([v.alias(c) for c, v in cells.items()]), list(cells)), "r", digits=6)


@query("""
SELECT country_key, ROUND(REGR_SLOPE(value / 1e6, year), 7) AS slope, ROUND(REGR_INTERCEPT(value / 1e6, year), 4) AS intercept,
 ROUND(REGR_SLOPE(value / 1e6, year) * 10, 6) AS trend_per_decade FROM @v_ind WHERE indicator = 'revenue' GROUP BY country_key
""")
def linear_trend(t: Tables) -> DataFrame:
    millions = t.indicator("revenue").withColumn("revenue", F.col("revenue") / 1e6)
    out = stats.linear_trend(millions, "year", "revenue", ["country_key"])
    return out.select(
        "country_key", round_half_up(F.col("slope"), 7).alias("slope"), round_half_up(F.col("intercept"), 4).alias("intercept"),
        round_half_up(F.col("trend_per_decade"), 6).alias("trend_per_decade"),
    )


def order_lines(t: Tables) -> DataFrame:
    """Per order: line count and price."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    return t.orders.join(lines, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderdate", "lines", "o_totalprice")


ORDER_LINES_SQL = """(SELECT o_orderkey, o_custkey, o_orderdate, lines, o_totalprice FROM orders JOIN
  (SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


@query(f"""
SELECT ROUND(REGR_SLOPE(lines, LN(o_totalprice)), 6) AS slope, ROUND(REGR_INTERCEPT(lines, LN(o_totalprice)), 6) AS intercept,
 ROUND(REGR_R2(lines, LN(o_totalprice)), 8) AS r_squared, COUNT(*) AS n FROM {ORDER_LINES_SQL} o
""")
def log_regression(t: Tables) -> DataFrame:
    out = stats.log_regression(order_lines(t), "o_totalprice", "lines")
    return rounded(rounded(out, "slope", "intercept", digits=6), "r_squared", digits=8)


B_SQL = """
WITH g AS (SELECT magnitude FROM @v_geo), s AS (SELECT FLOOR(MIN(magnitude) * 2) / 2 AS lo, MAX(magnitude) AS hi FROM g),
e AS (SELECT lo + 0.5 * i AS b FROM s, generate_series(0, 200) x(i) WHERE lo + 0.5 * i < hi),
n AS (SELECT CAST(b AS DOUBLE) AS magnitude_bin, COUNT(*) AS at_least FROM e JOIN g ON g.magnitude >= e.b GROUP BY 1)
"""


@query(B_SQL + """SELECT ROUND(-REGR_SLOPE(LOG10(at_least), magnitude_bin), 6) AS b_value,
 ROUND(REGR_INTERCEPT(LOG10(at_least), magnitude_bin), 6) AS a_value, COUNT(*) AS bins FROM n""")
def b_value(t: Tables) -> DataFrame:
    return rounded(stats.b_value(t.v_geo, "magnitude"), "b_value", "a_value", digits=6)


@query(B_SQL + "SELECT magnitude_bin, at_least FROM n")
def magnitude_counts(t: Tables) -> DataFrame:
    return stats.magnitude_counts(t.v_geo, "magnitude")


@query("""
WITH b AS (SELECT CASE WHEN p_size >= 0 AND p_size < 10 THEN 0 WHEN p_size >= 10 AND p_size < 20 THEN 1 WHEN p_size >= 20 AND p_size < 40 THEN 2
  WHEN p_size >= 40 AND p_size < 1000 THEN 3 END AS l, CASE WHEN p_size > 0 AND p_size <= 10 THEN 0 WHEN p_size > 10 AND p_size <= 20 THEN 1
  WHEN p_size > 20 AND p_size <= 40 THEN 2 WHEN p_size > 40 AND p_size <= 1000 THEN 3 END AS r FROM part),
n AS (SELECT * FROM (VALUES (0, 'tiny'), (1, 'small'), (2, 'medium'), (3, 'large')) v(bin_no, bin))
SELECT 'left' AS closed, n.bin_no, n.bin, (SELECT COUNT(*) FROM b WHERE b.l = n.bin_no) AS count FROM n
UNION ALL SELECT 'right', n.bin_no, n.bin, (SELECT COUNT(*) FROM b WHERE b.r = n.bin_no) FROM n
""")
def histogram_bins(t: Tables) -> DataFrame:
    edges, labels = (0, 10, 20, 40, 1000), ("tiny", "small", "medium", "large")
    sides = [
        agg.histogram_bins(t.part, "p_size", edges, labels, right=right).withColumn("closed", F.lit(name))
        for right, name in ((False, "left"), (True, "right"))
    ]
    return concat_frames(sides)


@query("SELECT FLOOR(lat / 10) * 10 AS lat_bin, FLOOR(lon / 10) * 10 AS lon_bin, COUNT(*) AS count FROM @v_geo GROUP BY 1, 2")
def grid_bins(t: Tables) -> DataFrame:
    return agg.grid_bins(t.v_geo, "lat", "lon")


@query("SELECT FLOOR(lat / 10) * 10 AS lat_bin, ROUND(AVG(depth), 4) AS depth_mean, MAX(depth) AS depth_max FROM @v_geo GROUP BY 1")
def band_depths(t: Tables) -> DataFrame:
    return rounded(agg.band_depths(t.v_geo, "lat", "lon", "depth"), "depth_mean")


@query("""
WITH h AS (SELECT CAST(HOUR(ts) AS INT) AS h, AVG(value) AS m FROM events GROUP BY 1)
SELECT (SELECT h FROM h ORDER BY m, h LIMIT 1) AS lowest_hour, (SELECT h FROM h ORDER BY m DESC, h LIMIT 1) AS highest_hour,
 (SELECT ROUND(AVG(value), 4) FROM events WHERE ISODOW(ts) < 6) AS weekday_mean,
 (SELECT ROUND(AVG(value), 4) FROM events WHERE ISODOW(ts) >= 6) AS weekend_mean
""")
def hourly_cycle(t: Tables) -> DataFrame:
    return rounded(agg.hourly_cycle(t.events, "ts", "value"), "weekday_mean", "weekend_mean")


@query("""
WITH n AS (SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT day, event_type, n * 100.0 / SUM(n) OVER (PARTITION BY day) AS share FROM n)
SELECT event_type, ROUND(AVG(CAST(share AS DOUBLE)), 3) AS mean_share, ROUND(MAX(CAST(share AS DOUBLE)), 3) AS max_share FROM s GROUP BY 1
""")
def mix_summary(t: Tables) -> DataFrame:
    counts = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    totals = counts.groupBy("day").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "day").withColumn("share", F.col("n") * 100.0 / F.col("total"))
    return agg.mix_summary(shares, "event_type", "share", digits=3)


@query("""
SELECT CAST(YEAR(o_orderdate) AS INT) AS year, ROUND(AVG(o_totalprice), 4) AS o_totalprice_mean, CAST(SUM(o_custkey) AS BIGINT) AS o_custkey_sum
FROM orders GROUP BY 1
""")
def period_rollup(t: Tables) -> DataFrame:
    out = agg.period_rollup(t.orders, "o_orderdate", "year", {"o_totalprice": "mean", "o_custkey": "sum"})
    return rounded(out, "o_totalprice_mean").select(F.year("period").alias("year"), "o_totalprice_mean", "o_custkey_sum")


@query("""
WITH c AS (SELECT CAST(YEAR(o_orderdate) AS INT) AS year, MONTH(o_orderdate) AS month, SUM(o_totalprice) AS s, COUNT(*) AS n FROM orders GROUP BY 1, 2),
k AS (SELECT month, SUM(s) / SUM(n) AS clim FROM c GROUP BY 1),
y AS (SELECT year, AVG(s / n - clim) AS anomaly FROM c JOIN k ON c.month = k.month GROUP BY 1)
SELECT year, ROUND(anomaly, 4) AS anomaly, year = (SELECT year FROM y ORDER BY anomaly DESC LIMIT 1) AS is_warmest,
 year = (SELECT year FROM y ORDER BY anomaly LIMIT 1) AS is_coldest FROM y
""")
def seasonal_anomaly(t: Tables) -> DataFrame:
    return rounded(stats.seasonal_anomaly(t.orders, "o_orderdate", "o_totalprice"), "anomaly")


@query("""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1)
SELECT CAST(YEAR(day) AS INT) AS year, COUNT(*) FILTER (WHERE total >= 2000000) AS hot_days, COUNT(*) FILTER (WHERE total <= 500000) AS cold_days
FROM d GROUP BY ROLLUP (1)
""")
def extreme_days(t: Tables) -> DataFrame:
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
    )
    return agg.extreme_days(daily, "day", "total", "total", 2_000_000, 500_000)


@query("""
SELECT magnitude, MIN(lat) AS lat_min, MAX(lat) AS lat_max, MIN(lon) AS lon_min, MAX(lon) AS lon_max, COUNT(*) AS points FROM @v_geo GROUP BY 1
""")
def bounding_box(t: Tables) -> DataFrame:
    return agg.bounding_box(t.v_geo, "lat", "lon", ["magnitude"])


@query("""
SELECT l_suppkey, ROUND(AVG(s), 4) AS avg_risk, CAST(MAX(s) AS DOUBLE) AS max_risk FROM (SELECT l_suppkey, CASE WHEN l_quantity < 1 THEN 0
 WHEN l_quantity < 10 THEN 25 WHEN l_quantity < 25 THEN 50 WHEN l_quantity < 40 THEN 75 WHEN l_quantity >= 40 THEN 100 ELSE 0 END AS s FROM lineitem)
GROUP BY l_suppkey
""")
def score_summary(t: Tables) -> DataFrame:
    scored = rows.score_steps(t.lineitem, "l_quantity", (1, 10, 25, 40), (0, 25, 50, 75, 100), "score")
    return rounded(agg.score_summary(scored, "l_suppkey", "score"), "avg_risk")


@query("""
WITH m AS (SELECT c_nationkey, CAST(MONTH(o_orderdate) AS INT) AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT c_nationkey, ROUND(MAX(revenue) - MIN(revenue), 2) AS amplitude, MIN(revenue) AS min_value, ARG_MIN(month, revenue) AS min_label,
 MAX(revenue) AS max_value, ARG_MAX(month, revenue) AS max_label, ROUND(MAX(revenue) / MIN(revenue), 6) AS ratio FROM m GROUP BY 1
""")
def amplitude_extremes(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("o_custkey", F.month("o_orderdate").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue")
    )
    monthly = (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "month").agg(F.sum("revenue").cast("double").alias("revenue"))
    )
    out = agg.amplitude_extremes(monthly, "c_nationkey", "month", "revenue")
    return out.withColumns({"amplitude": round_half_up(F.col("amplitude"), 2), "ratio": round_half_up(F.col("ratio"), 6)})


@query("""
SELECT source, COUNT(*) AS rows, COUNT(DISTINCT station) AS entities FROM (SELECT 'events' AS source, event_type AS station FROM events
 UNION ALL SELECT 'orders', o_orderpriority FROM orders) GROUP BY source
""")
def source_summary(t: Tables) -> DataFrame:
    return agg.source_summary(concat_frames(harmonized(t)), "source", "station")


@query(f"""
SELECT l_returnflag, ROUND(AVG(value_numeric), 4) AS avg_value, MIN(value_numeric) AS min_value, MAX(value_numeric) AS max_value,
 COUNT(*) AS record_count FROM {GATED_SQL} g WHERE is_valid GROUP BY l_returnflag
""")
def summary_table(t: Tables) -> DataFrame:
    gated = rows.regex_gated_cast(sensor_text(t), "raw_value", "^-?[0-9.]+$", -50, 60)
    return rounded(agg.summary_table(gated, "l_returnflag", "value_numeric", "is_valid"), "avg_value")
