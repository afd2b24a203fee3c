"""Queries for data quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skerry.operators import quality as q, ranking
from skerry.operators.sets import concat_frames
from skerry.plans.registry import SCHEMAS, Tables, query
from skerry.plans.rows import MIXED_SQL, mixed_text
from skerry.sources import files
from skerry.workspace import scratch

LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_quantity", "l_colour"]


@query("""
SELECT 'schema_columns' AS check_name, FALSE AS passed, 'missing [''l_colour''], extra [''l_discount'', ''l_extendedprice'', ''l_linenumber'', ''l_linestatus'', ''l_returnflag'', ''l_shipdate'', ''l_suppkey'', ''l_tax'']' AS details,
 'critical' AS severity, COUNT(*) AS rows FROM lineitem
""")
def check_schema(t: Tables) -> DataFrame:
    rows = t.lineitem.agg(F.count("*")).scalar()
    return q.check_schema(t.lineitem, LINE_COLUMNS).withColumn("rows", rows)


@query(f"""
WITH b AS (SELECT COUNT(*) FILTER (WHERE price_text IS NOT NULL AND TRY_CAST(price_text AS DOUBLE) IS NULL) AS p,
 COUNT(*) FILTER (WHERE date_text IS NOT NULL AND TRY_CAST(date_text AS DATE) IS NULL) AS d FROM {MIXED_SQL} m)
SELECT 'column_types' AS check_name, FALSE AS passed, 'colour: column missing; price_text: ' || p || ' not double; date_text: ' || d || ' not date' AS details,
 'critical' AS severity FROM b
""")
def check_types(t: Tables) -> DataFrame:
    return q.check_types(mixed_text(t), {"price_text": "double", "date_text": "date", "colour": "string"})


BOUNDS_SQL = """SELECT 'bounds_l_quantity' AS check_name, n = 0 AS passed, CASE WHEN n = 0 THEN 'all values within [1, 40]' ELSE n || ' values outside [1, 40]' END AS details,
 CASE WHEN n = 0 THEN 'info' ELSE 'warning' END AS severity FROM (SELECT COUNT(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40) AS n FROM lineitem)"""
DISCOUNT_SQL = BOUNDS_SQL.replace("l_quantity < 1 OR l_quantity > 40", "l_discount < 0 OR l_discount > 1").replace("l_quantity", "l_discount").replace("[1, 40]", "[0, 1]")
COUNT_SQL = """SELECT 'row_count' AS check_name, n BETWEEN 1 AND 1000 AS passed, CASE WHEN n < 1 THEN 'only ' || n || ' rows (minimum 1)' WHEN n > 1000
 THEN n || ' rows (maximum 1000)' ELSE n || ' rows within [1, 1000]' END AS details, CASE WHEN n < 1 THEN 'critical' WHEN n > 1000 THEN 'warning' ELSE 'info' END AS severity
 FROM (SELECT COUNT(*) AS n FROM {table})"""


@query(BOUNDS_SQL)
def check_bounds(t: Tables) -> DataFrame:
    return q.check_bounds(t.lineitem, "l_quantity", 1, 40)


@query("""
SELECT station, 'null_check' AS check_name, pct <= 1.9 AS passed, CASE WHEN pct <= 1.9 THEN 'all 2 columns within 1.9% null'
 ELSE 'temperature_c: ' || printf('%.1f', pct) || '% null (max 1.9%)' END AS details, CASE WHEN pct <= 1.9 THEN 'info' ELSE 'warning' END AS severity
FROM (SELECT station, COUNT(*) FILTER (WHERE temperature_c IS NULL) * 100.0 / COUNT(*) AS pct FROM @v_obs GROUP BY station)
""")
def check_nulls(t: Tables) -> DataFrame:
    return q.run_checks(t.v_obs, [q.nulls_check(t.v_obs, ["temperature_c", "humidity_pct"], 1.9)], by=["station"])


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, c.* FROM ({COUNT_SQL.format(table=n)}) c" for n in SCHEMAS))
def check_row_count(t: Tables) -> DataFrame:
    return concat_frames([
        q.check_row_count(getattr(t, n), 1, 1000).withColumn("table_name", F.lit(n)) for n in SCHEMAS
    ])


def zscore_sql(col: str) -> str:
    return f"""SELECT 'zscore_{col}' AS check_name, n = 0 AS passed, CASE WHEN n = 0 THEN 'no value beyond 3.0 deviations' ELSE n || ' values beyond 3.0 deviations' END AS details,
 CASE WHEN n = 0 THEN 'info' ELSE 'warning' END AS severity FROM (SELECT COUNT(*) FILTER (WHERE ABS({col} - m) / s > 3) AS n FROM events,
 (SELECT AVG({col}) AS m, STDDEV_SAMP({col}) AS s FROM events))"""


@query(f"{zscore_sql('value')} UNION ALL {zscore_sql('user_id')}")
def check_zscore(t: Tables) -> DataFrame:
    return q.check_zscore(t.events, ["value", "user_id"], 3.0)


@query("""
WITH r AS (SELECT value, ROW_NUMBER() OVER (ORDER BY event_id) <= (SELECT COUNT(*) // 2 FROM events) AS head FROM events),
a AS (SELECT AVG(value) FILTER (WHERE head) AS f, AVG(value) FILTER (WHERE NOT head) AS s, STDDEV_SAMP(value) FILTER (WHERE head) * 1.5 AS d FROM r)
SELECT 'distribution_shift_value' AS check_name, ABS(s - f) <= d AS passed, printf('means %.2f and %.2f, shift %.2f, threshold %.2f', f, s, ABS(s - f), d) AS details,
 CASE WHEN ABS(s - f) <= d THEN 'info' ELSE 'critical' END AS severity FROM a
""")
def check_distribution(t: Tables) -> DataFrame:
    return q.check_distribution(t.events, "event_id", ["value"])


@query("""
WITH d AS (SELECT DISTINCT event_type, user_id % 50 AS cohort, CAST(ts AS DATE) AS day FROM events),
s AS (SELECT event_type, cohort, MIN(day) AS lo, MAX(day) AS hi, COUNT(*) AS n FROM d GROUP BY 1, 2),
c AS (SELECT event_type, cohort, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
g AS (SELECT c.*, ROW_NUMBER() OVER (PARTITION BY c.event_type, c.cohort ORDER BY c.day) AS rn FROM c ANTI JOIN d
  ON d.event_type = c.event_type AND d.cohort = c.cohort AND d.day = c.day),
f AS (SELECT event_type, cohort, string_agg(strftime(day, '%Y-%m-%d'), ',' ORDER BY day) AS firsts FROM g WHERE rn <= 5 GROUP BY 1, 2)
SELECT s.event_type, s.cohort, 'date_coverage' AS check_name, hi - lo + 1 = n AS passed, CASE WHEN hi - lo + 1 = n THEN 'all ' || (hi - lo + 1) || ' days present'
 ELSE (hi - lo + 1 - n) || ' of ' || (hi - lo + 1) || ' days missing, first ' || firsts END AS details, CASE WHEN hi - lo + 1 = n THEN 'info' ELSE 'warning' END AS severity
FROM s LEFT JOIN f ON f.event_type = s.event_type AND f.cohort = s.cohort
""")
def check_date_coverage(t: Tables) -> DataFrame:
    cohorts = t.events.withColumn("cohort", F.col("user_id") % 50)
    return q.check_date_coverage(cohorts, "ts", ["event_type", "cohort"])


@query("""
SELECT 'referential_integrity' AS check_name, m = n AS passed, m || ' of ' || n || ' keys matched' AS details, CASE WHEN m = n THEN 'info' ELSE 'warning' END AS severity
FROM (SELECT COUNT(DISTINCT o_custkey) AS n, COUNT(DISTINCT o_custkey) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS m FROM orders)
""")
def check_reference(t: Tables) -> DataFrame:
    master = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return q.check_reference(t.orders, master, ["o_custkey"])


UNIQUE_SQL = """SELECT 'not_null_{k}' AS check_name, n = 0 AS passed, CASE WHEN n = 0 THEN '0 failing' ELSE n || ' rows without a key' END AS details,
 CASE WHEN n = 0 THEN 'info' ELSE 'critical' END AS severity FROM (SELECT COUNT(*) FILTER (WHERE {k} IS NULL) AS n FROM {t})
UNION ALL SELECT 'unique_{k}', n = 0, CASE WHEN n = 0 THEN '0 failing' ELSE n || ' repeated keys' END, CASE WHEN n = 0 THEN 'info' ELSE 'critical' END
 FROM (SELECT COUNT(*) AS n FROM (SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING COUNT(*) > 1))"""


@query(UNIQUE_SQL.format(k="c_custkey", t="customer") + " UNION ALL " + UNIQUE_SQL.format(k="o_custkey", t="orders"))
def check_not_null_unique(t: Tables) -> DataFrame:
    return concat_frames([q.check_not_null_unique(t.customer, "c_custkey"), q.check_not_null_unique(t.orders, "o_custkey")])


@query("""
SELECT COUNT(*) AS row_count, COUNT(*) >= 10 AS row_check_passed, ROUND((COUNT(*) - COUNT(temperature_c)) * 100.0 / (COUNT(*) * 3), 2) AS null_pct,
 (COUNT(*) - COUNT(temperature_c)) * 100.0 / (COUNT(*) * 3) <= 0.5 AS null_check_passed,
 COUNT(*) >= 10 AND (COUNT(*) - COUNT(temperature_c)) * 100.0 / (COUNT(*) * 3) <= 0.5 AS all_passed FROM @v_obs
""")
def check_records(t: Tables) -> DataFrame:
    return q.check_records(t.v_obs.select("record_id", "temperature_c", "humidity_pct"), max_null_pct=0.5, min_rows=10)


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) > 0 AS passed FROM {n}" for n in SCHEMAS))
def check_nonempty(t: Tables) -> DataFrame:
    return q.check_nonempty({n: getattr(t, n) for n in SCHEMAS})


def landed_folders(t: Tables) -> tuple[DataFrame, DataFrame, Column]:
    """Events landed in a folder per type: the listing, the expected folders and a fixed time half an hour later."""
    root = scratch(t.spark, "landed")
    t.events.write.partitionBy("event_type").parquet(root)
    listing = files.discover_files(t.spark, root, ["parquet"]).groupBy(F.col("folder").alias("path")).agg(
        F.sum("size").alias("size"), F.max("modified").alias("modified")
    )
    kinds = t.events.select("event_type").distinct()
    known = kinds.select(
        F.concat(F.lit("event_type="), "event_type").alias("path"),
        F.when(F.col("event_type") == "view", 60).otherwise(7200).alias("max_age_s"),
        F.when(F.col("event_type") == "error", 10**15).otherwise(1).alias("min_size"),
    )
    absent = kinds.select(F.concat(F.lit("absent="), "event_type").alias("path"), F.lit(7200).alias("max_age_s"), F.lit(1).alias("min_size"))
    now = listing.agg(F.max("modified") + F.expr("INTERVAL 30 MINUTES")).scalar()
    return listing, known.unionByName(absent), now


@query("""
SELECT 'event_type=' || k AS path, 'freshness' AS check_name, k <> 'view' AS passed, CASE WHEN k = 'view' THEN 'warning' ELSE 'info' END AS severity
FROM (SELECT DISTINCT event_type AS k FROM events) UNION ALL SELECT DISTINCT 'absent=' || event_type, 'freshness', FALSE, 'critical' FROM events
""")
def check_freshness(t: Tables) -> DataFrame:
    return q.check_freshness(*landed_folders(t)).drop("details")


FILES_SQL = """(SELECT 'event_type=' || k AS path, TRUE AS present, k <> 'view' AS fresh, k <> 'error' AS size_ok FROM (SELECT DISTINCT event_type AS k FROM events)
UNION ALL SELECT DISTINCT 'absent=' || event_type, FALSE, FALSE, FALSE FROM events)"""


@query(f"SELECT * FROM {FILES_SQL} f")
def check_files(t: Tables) -> DataFrame:
    return q.check_files(*landed_folders(t))


@query(f"""
SELECT n AS issues, c AS checks, CASE WHEN n = 0 THEN 'HEALTHY' WHEN n <= 2 THEN 'DEGRADED' ELSE 'CRITICAL' END AS status FROM
 (SELECT COUNT(*) FILTER (WHERE NOT present) + COUNT(*) FILTER (WHERE NOT fresh) + COUNT(*) FILTER (WHERE NOT size_ok) AS n, COUNT(*) * 3 AS c FROM {FILES_SQL} f)
""")
def health(t: Tables) -> DataFrame:
    return q.health(q.check_files(*landed_folders(t)))


GAPS_SQL = """(SELECT event_type, event_id, (epoch_us(ts) - epoch_us(date_trunc('hour', ts))) / 1000000.0 AS duration FROM events)"""


@query(f"""
SELECT event_type, event_id, limit_s, CASE WHEN duration <= limit_s THEN 'OK' ELSE 'BREACH' END AS status FROM
 (SELECT *, CAST(CASE event_type WHEN 'click' THEN 600 WHEN 'error' THEN 1800 ELSE 999 END AS DOUBLE) AS limit_s FROM {GAPS_SQL} g)
""")
def sla_breaches(t: Tables) -> DataFrame:
    return runs_with_limits(t).select("event_type", "event_id", "limit_s", "status")


@query(f"""
SELECT event_type, COUNT(*) AS runs, COUNT(*) FILTER (WHERE duration > CASE event_type WHEN 'click' THEN 600 WHEN 'error' THEN 1800 ELSE 999 END) AS breaches
FROM {GAPS_SQL} g GROUP BY event_type
""")
def sla_summary(t: Tables) -> DataFrame:
    return runs_with_limits(t).groupBy("event_type").agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "BREACH").alias("breaches")
    )


def runs_with_limits(t: Tables) -> DataFrame:
    """Time since the full hour as a run's duration, against limits known for some types."""
    at = F.col("ts").cast("timestamp")
    seconds = (F.unix_micros(at) - F.unix_micros(F.date_trunc("hour", at))) / 1_000_000
    runs = t.events.select("event_type", "event_id", seconds.alias("duration"))
    limits = t.events.select("event_type").distinct().select(
        "event_type", F.when(F.col("event_type") == "click", 600.0).when(F.col("event_type") == "error", 1800.0).alias("limit_s")
    ).dropna()
    return q.sla_breaches(runs, "event_type", "duration", limits)


LINE_CHECKS_SQL = f"""(SELECT 'bounds' AS category, * FROM ({BOUNDS_SQL}) UNION ALL SELECT 'bounds', * FROM ({DISCOUNT_SQL})
 UNION ALL SELECT 'volume', * FROM ({COUNT_SQL.format(table='lineitem')})
 UNION ALL SELECT 'nulls', 'null_check', TRUE, 'all 2 columns within 5% null', 'info')"""


def line_checks(t: Tables) -> DataFrame:
    """Bounds, volume and null checks of the line items in one pass."""
    df = t.lineitem
    checks = q.run_checks(df, [
        q.bounds_check(df, "l_quantity", 1, 40), q.bounds_check(df, "l_discount", 0, 1),
        q.row_count_check(1, 1000), q.nulls_check(df, ["l_quantity", "l_tax"], 5),
    ])
    name = F.col("check_name")
    return checks.withColumn(
        "category", F.when(name.startswith("bounds"), "bounds").when(name == "row_count", "volume").otherwise("nulls")
    )


@query(f"""
SELECT category, COUNT(*) AS total, COUNT(*) FILTER (WHERE passed) AS passed, COUNT(*) FILTER (WHERE NOT passed) AS failed,
 COUNT(*) FILTER (WHERE severity = 'warning') AS warnings, COUNT(*) FILTER (WHERE severity = 'critical' AND NOT passed) AS critical,
 ROUND(COUNT(*) FILTER (WHERE passed) * 100.0 / COUNT(*), 1) AS score_pct, CASE WHEN COUNT(*) FILTER (WHERE NOT passed) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall
FROM {LINE_CHECKS_SQL} c GROUP BY ROLLUP (category)
""")
def score_report(t: Tables) -> DataFrame:
    return q.score_report(line_checks(t), "category")


@query(f"""
WITH c AS (SELECT * FROM {LINE_CHECKS_SQL} x), n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE passed) AS ok, COUNT(*) FILTER (WHERE NOT passed) AS bad,
 COUNT(*) FILTER (WHERE severity = 'warning') AS w, COUNT(*) FILTER (WHERE severity = 'critical' AND NOT passed) AS k FROM c)
SELECT 0 AS section, '' AS name, 0 AS part, 'Total checks: ' || n AS line FROM n
UNION ALL SELECT 0, '', 1, 'Passed: ' || ok || '  |  Failed: ' || bad FROM n UNION ALL SELECT 0, '', 2, 'Warnings: ' || w || '  |  Critical: ' || k FROM n
UNION ALL SELECT 1, check_name, 0, '[' || CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || '] [' || UPPER(severity) || '] ' || check_name FROM c
UNION ALL SELECT 1, check_name, 1, '    ' || details FROM c UNION ALL SELECT 2, '', 0, 'Overall: ' || CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END FROM n
""")
def report_lines(t: Tables) -> DataFrame:
    return q.report_lines(line_checks(t))


@query(f"""
SELECT check_name, severity, CASE WHEN check_name LIKE '%bounds%' THEN 'review out-of-range values' ELSE 'check the delivery of the source' END AS suggestion
FROM {LINE_CHECKS_SQL} c WHERE NOT passed
""")
def recommend(t: Tables) -> DataFrame:
    return q.recommend(line_checks(t))


@query(f"SELECT check_name, severity FROM {LINE_CHECKS_SQL} c")
def order_by_severity(t: Tables) -> DataFrame:
    return ranking.order_by_severity(line_checks(t)).select("check_name", "severity")
