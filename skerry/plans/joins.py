"""Queries for joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skerry.operators import joins, rows, sets
from skerry.plans.registry import PRIORITIES, Tables, query, round_half_up
from skerry.plans.rows import RISK_BANDS, harmonized


@query("""
SELECT l_orderkey AS orderkey, l_linenumber, l_quantity, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def join_inner(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").cast("string").alias("orderkey"), "l_linenumber", "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    return joins.join_inner(lines, orders, ["orderkey"], integer_keys=["orderkey"])


@query("""
SELECT strftime(d.day, '%Y-%m-%d') AS day, COALESCE(n, 0) AS n, COALESCE(total, 0.0) AS total
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) d LEFT JOIN
 (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) e ON e.day = d.day
""")
def join_left_fill(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("day", F.to_date("o_orderdate"))
    urgent = (
        dated.filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("day")
        .agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    )
    filled = joins.join_left_fill(dated.select("day").distinct(), urgent, ["day"], {"n": 0, "total": 0.0})
    return filled.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


OUTER_SQL = """(SELECT country_key, year, MAX(CASE WHEN indicator='revenue' THEN value END) AS revenue,
  MAX(CASE WHEN indicator='orders' THEN value END) AS orders, MAX(CASE WHEN indicator='urgent' THEN value END) AS urgent
  FROM @v_ind GROUP BY country_key, year)"""


@query(f"SELECT * FROM {OUTER_SQL} o")
def join_outer_chain(t: Tables) -> DataFrame:
    return joins.join_outer_chain([t.indicator(n) for n in ("revenue", "orders", "urgent")], ["country_key", "year"])


@query("""
SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def join_left_dim(t: Tables) -> DataFrame:
    customer = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    return joins.join_left_dim(t.orders, customer, "o_custkey").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


def orders_by_customer(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate", "o_totalprice")


@query("""
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o
 ON o.o_custkey = c_custkey AND o.rn = 1
""")
def join_latest(t: Tables) -> DataFrame:
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    return joins.join_latest(t.customer, orders_by_customer(t), ["c_custkey"], order).select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice"
    )


@query(f"SELECT * FROM {OUTER_SQL} o WHERE revenue IS NOT NULL AND orders IS NOT NULL AND urgent IS NOT NULL")
def align_complete(t: Tables) -> DataFrame:
    return joins.align_complete([t.indicator(n) for n in ("revenue", "orders", "urgent")], ["country_key", "year"])


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, COALESCE(p_brand, 'EUR') AS p_brand, COALESCE(p_retailprice, 1.0) AS p_retailprice, s_name
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l_partkey = p_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey
""")
def enrich_lookup(t: Tables) -> DataFrame:
    parts = t.part.filter("p_size > 10").withColumnRenamed("p_partkey", "l_partkey")
    suppliers = t.supplier.filter("s_acctbal > 0").withColumnRenamed("s_suppkey", "l_suppkey")
    lookups = [
        (parts, "l_partkey", {"p_brand": "EUR", "p_retailprice": 1.0}),
        (suppliers, "l_suppkey", {"s_name": None}),
    ]
    return joins.enrich_lookup(t.lineitem, lookups).select(
        "l_orderkey", "l_linenumber", "l_quantity", "p_brand", "p_retailprice", "s_name"
    )


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
""")
def filter_known(t: Tables) -> DataFrame:
    known = t.customer.filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return joins.filter_known(t.orders, known, ["o_custkey"]).select("o_orderkey", "o_totalprice")


@query("""
SELECT o_custkey, COUNT(*) AS orphan_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey
""")
def find_orphans(t: Tables) -> DataFrame:
    master = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.find_orphans(t.orders, master, "o_custkey")


@query("""
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate < o_orderdate OR l_shipdate > o_orderdate + INTERVAL 90 DAY
""")
def outside_validity(t: Tables) -> DataFrame:
    windows = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").alias("active_from"),
        (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("active_to"),
    )
    late = joins.outside_validity(t.lineitem, windows, "l_orderkey", "l_shipdate", "active_from", "active_to")
    return late.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


@query("""
SELECT l_orderkey, l_linenumber, 'Quantity ' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' at size ' || CAST(p_size AS VARCHAR) AS detail
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 30 AND l_quantity > 35
""")
def rule_violations(t: Tables) -> DataFrame:
    rule = (F.col("p_size") > 30) & (F.col("l_quantity") > 35)
    text = F.format_string("Quantity %d at size %d", F.col("l_quantity").cast("int"), F.col("p_size"))
    parts = t.part.withColumnRenamed("p_partkey", "l_partkey")
    return joins.rule_violations(t.lineitem, parts, "l_partkey", rule, text).select(
        "l_orderkey", "l_linenumber", "detail"
    )


@query("""
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, ROUND(AVG(value), 4) AS mean_value, COUNT(*) AS n FROM events GROUP BY 1, 2),
a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY day) AS position FROM daily),
b AS (SELECT event_type, day, n AS later_n, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY day) AS position FROM daily
      WHERE day >= DATE '2024-01-08')
SELECT a.event_type, a.position, strftime(a.day, '%Y-%m-%d') AS day, a.mean_value, b.later_n FROM a JOIN b
ON a.event_type = b.event_type AND a.position = b.position
""")
def zip_series(t: Tables) -> DataFrame:
    """Each type's daily means against its daily counts a week later, paired by position."""
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        round_half_up(F.avg("value"), 4).alias("mean_value"), F.count("*").alias("n")
    )
    later = daily.filter("day >= DATE '2024-01-08'").select("event_type", "day", F.col("n").alias("later_n"))
    paired = joins.zip_series(daily.drop("n"), later, ["event_type"], [F.col("day")])
    return paired.withColumn("position", F.col("position").cast("bigint")).withColumn(
        "day", F.date_format("day", "yyyy-MM-dd")
    )


@query("""
WITH m AS (SELECT month, CAST(MONTH(month) AS INT) AS month_no, urgent FROM @v_rates)
SELECT strftime(m.month, '%Y-%m-%d') AS month, ROUND(b.climatology, 4) AS climatology, ROUND(m.urgent - b.climatology, 4) AS anomaly
FROM m JOIN (SELECT month_no, AVG(urgent) AS climatology FROM m GROUP BY 1) b ON b.month_no = m.month_no
""")
def attach_baseline(t: Tables) -> DataFrame:
    monthly = t.v_rates.select("month", F.month("month").alias("month_no"), "urgent")
    out = joins.attach_baseline(monthly, ["month_no"], "urgent", "climatology", "anomaly")
    return out.select(
        F.date_format("month", "yyyy-MM-dd").alias("month"),
        round_half_up(F.col("climatology"), 4).alias("climatology"),
        round_half_up(F.col("anomaly"), 4).alias("anomaly"),
    )


@query("""
SELECT 'part-' || CAST(p_partkey AS VARCHAR) || '.csv' AS filename FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)
""")
def new_only(t: Tables) -> DataFrame:
    name = lambda c: F.concat(F.lit("part-"), F.col(c).cast("string"), F.lit(".csv")).alias("filename")
    manifest = t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 45").select("l_partkey").distinct().select(name("l_partkey"))
    return joins.new_only(t.part.select(name("p_partkey")), manifest, "filename")


@query("""
WITH d AS (SELECT DISTINCT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders),
s AS (SELECT o_orderpriority, o_orderstatus, MIN(day) AS lo, MAX(day) AS hi, COUNT(*) AS n FROM d GROUP BY 1, 2),
c AS (SELECT o_orderpriority, o_orderstatus, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
g AS (SELECT c.*, ROW_NUMBER() OVER (PARTITION BY c.o_orderpriority, c.o_orderstatus ORDER BY c.day) AS rn FROM c ANTI JOIN d
      ON d.o_orderpriority = c.o_orderpriority AND d.o_orderstatus = c.o_orderstatus AND d.day = c.day),
f AS (SELECT o_orderpriority, o_orderstatus, string_agg(strftime(day, '%Y-%m-%d'), ',' ORDER BY day) AS first_missing FROM g
      WHERE rn <= 5 GROUP BY 1, 2)
SELECT s.o_orderpriority, s.o_orderstatus, CAST(hi - lo + 1 AS BIGINT) AS expected_days, CAST(hi - lo + 1 - n AS BIGINT) AS missing_days,
 COALESCE(first_missing, '') AS first_missing FROM s LEFT JOIN f ON f.o_orderpriority = s.o_orderpriority
 AND f.o_orderstatus = s.o_orderstatus
""")
def missing_dates(t: Tables) -> DataFrame:
    return joins.missing_dates(t.orders, "o_orderdate", ["o_orderpriority", "o_orderstatus"])


@query("""
SELECT country, population, CAST(m AS INT) AS month FROM @v_country, generate_series(1, 12) g(m)
""")
def cross_grid(t: Tables) -> DataFrame:
    return joins.cross_grid(t.v_country.select("country", "population"), "month", list(range(1, 13)))


SCORE_SQL = """
a AS (SELECT c_nationkey AS country_key, AVG(CASE WHEN c_acctbal < 1000 THEN 0 WHEN c_acctbal < 3000 THEN 25 WHEN c_acctbal < 5000 THEN 50
      WHEN c_acctbal < 8000 THEN 75 ELSE 100 END) AS sea_score FROM customer GROUP BY 1),
b AS (SELECT s_nationkey AS country_key, AVG(CASE WHEN s_acctbal < 1000 THEN 0 WHEN s_acctbal < 3000 THEN 25 WHEN s_acctbal < 5000 THEN 50
      WHEN s_acctbal < 8000 THEN 75 ELSE 100 END) AS river_score FROM supplier GROUP BY 1)
"""


@query(f"""
WITH {SCORE_SQL}, j AS (SELECT COALESCE(a.country_key, b.country_key) AS country_key,
  COALESCE(sea_score, 0) * 0.6 + COALESCE(river_score, 0) * 0.4 AS composite FROM a FULL JOIN b ON a.country_key = b.country_key)
SELECT country_key, ROUND(composite, 4) AS composite, CASE WHEN composite <= 25 THEN 'Low' WHEN composite <= 50 THEN 'Moderate'
  WHEN composite <= 75 THEN 'High' ELSE 'Extreme' END AS category FROM j
""")
def combine_scores(t: Tables) -> DataFrame:
    cuts, scores = (1000, 3000, 5000, 8000), (0, 25, 50, 75, 100)
    sea = rows.score_steps(t.customer, "c_acctbal", cuts, scores, "score").groupBy(
        F.col("c_nationkey").alias("country_key")
    ).agg(F.avg("score").alias("sea_score"))
    river = rows.score_steps(t.supplier, "s_acctbal", cuts, scores, "score").groupBy(
        F.col("s_nationkey").alias("country_key")
    ).agg(F.avg("score").alias("river_score"))
    out = joins.combine_scores(
        sea, river, "country_key", ("sea_score", "river_score"), (0.6, 0.4), RISK_BANDS, "Extreme"
    )
    return out.withColumn("composite", round_half_up(F.col("composite"), 4))


def neighbours(t: Tables) -> DataFrame:
    """Per customer nation, the supplier nations its lines were bought from."""
    # An order is joined once per supplier nation, not once per line.
    sold = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_nationkey").distinct()
    bought = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    pairs = sold.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).select("c_nationkey", "s_nationkey").distinct()
    # collect_set holds nation keys only, at most as many as there are nations.
    return pairs.groupBy(F.col("c_nationkey").alias("country_key")).agg(
        F.collect_set("s_nationkey").alias("borders")
    )


@query("""
SELECT DISTINCT LEAST(c_nationkey, s_nationkey) AS src, GREATEST(c_nationkey, s_nationkey) AS dst
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
""")
def edges_undirected(t: Tables) -> DataFrame:
    return joins.edges_undirected(neighbours(t), "country_key", "borders")


@query("""
SELECT DISTINCT k AS country_key FROM (SELECT c_nationkey AS k FROM customer JOIN orders ON o_custkey = c_custkey
   JOIN lineitem ON l_orderkey = o_orderkey
 UNION SELECT s_nationkey FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey)
""")
def graph_nodes(t: Tables) -> DataFrame:
    return joins.nodes_of(neighbours(t), "country_key", "borders")


@query("""
WITH a AS (SELECT user_id, CAST(ts AS DATE) AS slot, event_id FROM events WHERE event_type = 'purchase'),
b AS (SELECT user_id, CAST(ts AS DATE) AS slot, event_id FROM events WHERE event_type = 'signup'),
r AS (SELECT DISTINCT user_id, slot FROM a INTERSECT SELECT DISTINCT user_id, slot FROM b)
SELECT event_id, 'purchase' AS input FROM a SEMI JOIN r ON a.user_id = r.user_id AND a.slot = r.slot
UNION ALL SELECT event_id, 'signup' FROM b SEMI JOIN r ON b.user_id = r.user_id AND b.slot = r.slot
""")
def inputs_ready(t: Tables) -> DataFrame:
    """Purchases and signups of the user-days that have both."""
    slotted = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type")
    ready = joins.tagged_inputs_ready(slotted, ["user_id", "day"], "event_type", ("purchase", "signup"))
    return ready.select("event_id", F.col("event_type").alias("input"))


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def concat_frames(t: Tables) -> DataFrame:
    known = F.coalesce(F.col("o_orderpriority").isin(PRIORITIES), F.lit(False))
    parts = [t.orders.filter(known), t.orders.filter(~known)]
    return sets.concat_frames(parts).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("""
SELECT event_type AS station, strftime(ts, '%Y-%m-%d') AS date, value AS amount FROM events
UNION ALL SELECT NULL, strftime(o_orderdate, '%Y-%m-%d'), o_totalprice FROM orders
""")
def concat_common(t: Tables) -> DataFrame:
    events, orders = harmonized(t)
    return sets.concat_common([events, orders.drop("station")], ["station", "date", "amount", "colour"])


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def key_difference(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return sets.key_difference(t.customer, urgent, ["c_custkey"])


@query("""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')) AS matched,
 COUNT(*) FILTER (WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')) AS missing FROM customer
""")
def key_difference_summary(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return sets.key_difference_summary(t.customer, urgent, ["c_custkey"])


@query("""
SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'
INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N'
""")
def key_intersection(t: Tables) -> DataFrame:
    return sets.common_keys(t.lineitem, ["l_partkey"], "l_returnflag", ["R", "A", "N"])


@query("SELECT DISTINCT p_type FROM part")
def distinct_values(t: Tables) -> DataFrame:
    return sets.distinct_values(t.part, "p_type")
