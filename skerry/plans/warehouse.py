"""Queries for dimensional modelling."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from skerry.operators import quality as q, warehouse as w
from skerry.operators.history import history_schema, load_delivery, snapshots as full_dates, versions
from skerry.plans.registry import INDICATORS, Tables, query
from skerry.sources.tables import KeyedTable
from skerry.workspace import scratch

DIM_SQL = """(SELECT CAST(ROW_NUMBER() OVER (ORDER BY country) AS BIGINT) AS dim_key, country_key, country, region, population, area_km2,
  CASE WHEN area_km2 > 0 THEN ROUND(population / area_km2, 3) ELSE 0.0 END AS density FROM @v_country)"""
TIME_SQL = """(SELECT CAST(y - lo + 1 AS INT) AS time_key, CAST(y AS INT) AS year, CAST(y // 10 * 10 AS INT) AS decade, y >= 2000 AS is_21st_century
  FROM (SELECT lo, UNNEST(generate_series(lo, hi)) AS y FROM (SELECT MIN(YEAR(o_orderdate)) AS lo, MAX(YEAR(o_orderdate)) AS hi FROM orders)))"""


@query("SELECT c_custkey AS customer_code, c_name AS customer_name, CAST(c_acctbal AS DOUBLE) AS balance FROM customer WHERE c_custkey IS NOT NULL")
def stage_customers(t: Tables) -> DataFrame:
    raw = t.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_name", F.col("c_acctbal").cast("string").alias("bal"))
    columns = {"customer_code": ("id", "bigint"), "customer_name": ("c_name", "string"), "balance": ("bal", "double")}
    return w.stage(raw, columns, ["customer_code"])


@query("SELECT country_key AS country_code, year, indicator, value FROM @v_ind WHERE value IS NOT NULL")
def stage_models(t: Tables) -> DataFrame:
    raw = t.v_ind.withColumns({c: F.col(c).cast("string") for c in ("year", "value")})
    columns = {
        "country_code": ("country_key", "int"), "year": ("year", "int"), "indicator": ("indicator", "string"),
        "value": ("value", "double"),
    }
    return w.stage(raw, columns, ["country_code", "value"])


def dimension(t: Tables) -> DataFrame:
    out = w.build_dimension(t.v_country, [F.col("country")], "dim_key", "population", "area_km2", digits=3)
    return out.withColumn("dim_key", F.col("dim_key").cast("bigint"))


@query(f"SELECT * FROM {DIM_SQL} d")
def build_dimension(t: Tables) -> DataFrame:
    return dimension(t)


@query(f"SELECT * FROM {TIME_SQL} d")
def build_time_dimension(t: Tables) -> DataFrame:
    return w.build_time_dimension(t.orders, "o_orderdate")


def indicator_dimension(t: Tables) -> DataFrame:
    """Keys for two of the three indicators; the third is unknown to it."""
    names = t.pinned_ind.select("indicator").distinct().filter(F.col("indicator") != "urgent")
    return w.build_dimension(names, [F.col("indicator")], "indicator_key")


@query(f"""
SELECT d.dim_key, t.time_key, CAST(CASE v.indicator WHEN 'orders' THEN 1 WHEN 'revenue' THEN 2 ELSE 0 END AS BIGINT) AS indicator_key, v.value
FROM (SELECT * FROM @v_ind) v JOIN {DIM_SQL} d ON d.country_key = v.country_key JOIN {TIME_SQL} t ON t.year = v.year
""")
def build_fact(t: Tables) -> DataFrame:
    return facts(t)


def facts(t: Tables) -> DataFrame:
    out = w.build_fact(
        t.pinned_ind,
        [(dimension(t), "country_key", "dim_key"), (w.build_time_dimension(t.orders, "o_orderdate"), "year", "time_key")],
        [(indicator_dimension(t), "indicator", "indicator_key", 0)],
        "value",
    )
    return out.withColumn("indicator_key", F.col("indicator_key").cast("bigint"))


@query(f"""
SELECT d.country, d.density, f.value, f.year FROM {DIM_SQL} d LEFT JOIN (SELECT country_key, value, year, ROW_NUMBER() OVER (PARTITION BY country_key
 ORDER BY year DESC) AS rn FROM @v_ind WHERE indicator = 'revenue') f ON f.country_key = d.country_key AND f.rn = 1 WHERE d.region = 'EUROPE'
ORDER BY f.value DESC NULLS LAST
""")
def mart_summary(t: Tables) -> DataFrame:
    revenue = t.v_ind.filter("indicator = 'revenue'").select("country_key", "value", "year")
    mart = w.mart_summary(dimension(t), revenue, "country_key", F.col("region") == "EUROPE", [F.col("year")], "value")
    return mart.select("country", "density", "value", "year")


COMPOSITE_SQL = """
WITH l AS (SELECT country_key, indicator, ARG_MAX(value, year) AS v FROM @v_ind GROUP BY 1, 2),
b AS (SELECT indicator, MIN(v) AS lo, MAX(v) AS hi FROM l GROUP BY 1),
s AS (SELECT country_key, CASE WHEN hi > lo THEN (v - lo) / (hi - lo) * 100 ELSE 50 END AS n FROM l JOIN b ON b.indicator = l.indicator)
SELECT country_key, ROUND(AVG(n), 4) AS composite_score FROM s GROUP BY country_key"""


@query(COMPOSITE_SQL)
def composite_index(t: Tables) -> DataFrame:
    return w.composite_index(t.pinned_ind, "country_key", "indicator", "value", [F.col("year")], INDICATORS, digits=4)


def snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers and a previous snapshot with changed, missing and vanished rows, and some unknown balances."""
    key = F.col("c_custkey")
    current = t.customer.select(
        key, "c_name", F.when(key % 5 != 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment"
    )
    kept = current.filter(key % 11 != 0).withColumn(
        "c_acctbal", F.when(key % 7 == 0, F.coalesce("c_acctbal", F.lit(0.0)) + 1).otherwise(F.col("c_acctbal"))
    )
    vanished = current.filter(key % 13 == 0).withColumn("c_custkey", key + 1_000_000_000_000)
    return current, kept.unionByName(vanished)


SCD_SQL = """(WITH cur AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer),
old AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN COALESCE(c_acctbal, 0.0) + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM cur WHERE c_custkey % 11 <> 0
  UNION ALL SELECT c_custkey + 1000000000000, c_name, c_acctbal, c_mktsegment FROM cur WHERE c_custkey % 13 = 0),
j AS (SELECT cur.c_custkey AS ck, old.c_custkey AS ok, cur.c_acctbal IS NOT DISTINCT FROM old.c_acctbal AND cur.c_mktsegment IS NOT DISTINCT FROM old.c_mktsegment AS same
  FROM cur FULL JOIN old ON cur.c_custkey = old.c_custkey)
SELECT cur.*, CASE WHEN ok IS NOT NULL AND same THEN '2024-01-01' ELSE '2025-01-01' END AS valid_from, '9999-12-31' AS valid_to, TRUE AS is_current
  FROM cur JOIN j ON j.ck = cur.c_custkey
UNION ALL SELECT old.*, '2024-01-01', '2025-01-01', FALSE FROM old JOIN j ON j.ok = old.c_custkey WHERE j.ck IS NULL OR NOT same)"""


def history(t: Tables) -> DataFrame:
    current, previous = snapshots(t)
    return w.scd2_merge(current, previous, "c_custkey", ["c_acctbal", "c_mktsegment"], "2024-01-01", "2025-01-01")


@query(f"SELECT * FROM {SCD_SQL} s")
def scd2_merge(t: Tables) -> DataFrame:
    return history(t).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("valid_from", "valid_to")})


DELIVERIES = {"2024-01-01": True, "2024-06-01": False, "2024-09-01": False, "2025-01-01": True}


def delivered(t: Tables, on: str) -> DataFrame:
    """Customers as stated on a date: two full snapshots without some keys, and changes in between."""
    key, balance = F.col("c_custkey"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal"))
    rows = t.customer.select(key, F.concat("c_name", F.lit(f" {on[:4]}")).alias("c_name"), balance.alias("c_acctbal"), "c_mktsegment")
    return {
        "2024-01-01": rows.where(key % 13 != 0),
        "2024-06-01": rows.where(key % 7 == 0).withColumn("c_acctbal", F.coalesce("c_acctbal", F.lit(0.0)) + 1),
        "2024-09-01": rows.where(key % 14 == 0).withColumn("c_mktsegment", F.lit("MOVED")),
        "2025-01-01": rows.where(key % 11 != 0),
    }[on]


@query("""
WITH r AS (SELECT c_custkey AS k, c_name AS n, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS b, c_mktsegment AS s FROM customer),
o AS (SELECT k, DATE '2024-01-01' AS d, n || ' 2024' AS n, b, s FROM r WHERE k % 13 <> 0
  UNION ALL SELECT k, DATE '2024-06-01', n || ' 2024', COALESCE(b, 0.0) + 1, s FROM r WHERE k % 7 = 0
  UNION ALL SELECT k, DATE '2024-09-01', n || ' 2024', b, 'MOVED' FROM r WHERE k % 14 = 0
  UNION ALL SELECT k, DATE '2025-01-01', n || ' 2025', b, s FROM r WHERE k % 11 <> 0),
p AS (SELECT *, lead(d) OVER w AS nx, CASE WHEN d < DATE '2025-01-01' THEN DATE '2025-01-01' END AS f FROM o WINDOW w AS (PARTITION BY k ORDER BY d)),
q AS (SELECT *, f IS NOT NULL AND (nx IS NULL OR f < nx) AS ends FROM p),
x AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR b IS DISTINCT FROM lag(b) OVER w OR s IS DISTINCT FROM lag(s) OVER w OR lag(ends) OVER w THEN 1 ELSE 0 END AS starts
  FROM q WINDOW w AS (PARTITION BY k ORDER BY d)),
y AS (SELECT *, SUM(starts) OVER (PARTITION BY k ORDER BY d) AS v FROM x)
SELECT k AS c_custkey, arg_max(n, d) AS c_name, MAX(b) AS c_acctbal, MAX(s) AS c_mktsegment, strftime(MIN(d), '%Y-%m-%d') AS valid_from,
  strftime(arg_max(CASE WHEN ends THEN f ELSE COALESCE(nx, DATE '9999-12-31') END, d), '%Y-%m-%d') AS valid_to,
  arg_max(CASE WHEN ends THEN f ELSE COALESCE(nx, DATE '9999-12-31') END, d) = DATE '9999-12-31' AS is_current
FROM y GROUP BY k, v
""")
def scd2_deliveries(t: Tables) -> DataFrame:
    """Four deliveries, the latest first and one of them twice, each committed onto the history so far."""
    attributes = "c_name string, c_acctbal double, c_mktsegment string"
    schema = history_schema("c_custkey bigint", attributes)
    table = KeyedTable(t.spark, scratch(t.spark, "history"), schema, ("c_custkey",), part_rows=20_000)
    for on in ("2025-01-01", "2024-06-01", "2024-01-01", "2024-06-01", "2024-09-01"):
        load_delivery(table, delivered(t, on), date.fromisoformat(on), DELIVERIES[on])
    found = versions(table.read(), "c_custkey", ["c_acctbal", "c_mktsegment"], full_dates(table))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("valid_from", "valid_to")})


@query(f"""
WITH s AS (SELECT * FROM {SCD_SQL} x), o AS (SELECT COUNT(DISTINCT o_custkey + CASE WHEN o_orderkey % 100 = 0 THEN 5000000000 ELSE 0 END) AS n FROM orders
  WHERE o_custkey + CASE WHEN o_orderkey % 100 = 0 THEN 5000000000 ELSE 0 END NOT IN (SELECT c_custkey FROM s))
SELECT 'scd_has_current' AS check_name, TRUE AS passed, COUNT(*) FILTER (WHERE is_current) || ' current rows' AS details, 'info' AS severity FROM s
UNION ALL SELECT 'no_orphan_keys', n = 0, CASE WHEN n = 0 THEN 'all fact keys present' ELSE n || ' fact keys unknown' END, CASE WHEN n = 0 THEN 'info' ELSE 'critical' END FROM o
UNION ALL SELECT 'date_range_validity', TRUE, 'all ranges valid', 'info' UNION ALL SELECT 'one_current_per_key', TRUE, 'at most one each', 'info'
""")
def validate_scd(t: Tables) -> DataFrame:
    shift = F.when(F.col("o_orderkey") % 100 == 0, 5_000_000_000).otherwise(0)
    fact = t.orders.select((F.col("o_custkey") + shift).alias("c_custkey"))
    return w.validate_scd(history(t), fact, "c_custkey")


@query(f"""
SELECT (SELECT COUNT(*) FROM customer) AS staging_rows, (SELECT COUNT(*) FROM {SCD_SQL} s) AS scd_rows, (SELECT COUNT(*) FROM @v_ind) AS fact_rows,
 (SELECT COUNT(*) FROM {SCD_SQL} s WHERE NOT is_current) AS scd_changes, '1.0' AS schema_version
""")
def audit_trail(t: Tables) -> DataFrame:
    """Counts observed while the stages are written; nothing is counted again."""
    return observed_stages(t).trail().drop("recorded_at")


def observed_stages(t: Tables) -> w.ObservedStages:
    """Staging, history and facts written one after the other, watched and timed."""
    root, audit = scratch(t.spark, "audit"), w.ObservedStages(t.spark, "1.0")
    stages = {"staging": (t.customer, {}), "scd": (history(t), {"scd_changes": F.count_if(~F.col("is_current"))}), "fact": (t.v_ind, {})}
    for name, (df, extra) in stages.items():
        with audit.stage(name):
            audit.watch(name, df, **extra).write.parquet(f"{root}/{name}")
    return audit


@query(f"""
SELECT task, rows, 'OK' AS status FROM (SELECT 'staging' AS task, COUNT(*) AS rows FROM customer UNION ALL SELECT 'scd', COUNT(*) FROM {SCD_SQL} s
 UNION ALL SELECT 'fact', COUNT(*) FROM @v_ind) r
""")
def stage_runs(t: Tables) -> DataFrame:
    """The stages' own runs against a generous limit."""
    limits = t.spark.createDataFrame([(name, 86_400.0) for name in ("staging", "scd", "fact")], "task string, limit_s double")
    return q.sla_breaches(observed_stages(t).runs(), "task", "duration", limits).select("task", "rows", "status")


@query("""
SELECT c_mktsegment AS segment, COUNT(*) AS members, ROUND(CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_balance, MIN('c-' || c_nationkey) AS first_home
FROM customer WHERE c_custkey % 17 <> 0 GROUP BY 1
""")
def medallion(t: Tables) -> DataFrame:
    """Customer documents, some without a code, through three layers."""
    key = F.col("c_custkey")
    homes = F.when(key % 4 != 0, F.array(F.concat(F.lit("c-"), "c_nationkey"), F.lit("c-0"))).otherwise(
        F.array(F.concat(F.lit("c-"), "c_nationkey"))
    )
    doc = F.struct(
        F.when(key % 17 != 0, key).alias("code"), F.struct(F.col("c_name").alias("common")).alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), homes.alias("homes"),
    )
    schema = "code bigint, name struct<common: string>, segment string, balance double, homes array<string>"
    silver = {
        "code": F.col("code"), "customer": F.col("name.common"), "segment": F.col("segment"),
        "balance": F.col("balance"), "home": F.get("homes", F.lit(0)),
    }
    gold = [
        F.count("code").alias("members"), F.sum(F.col("balance").cast("decimal(18,2)")).cast("double").alias("total_balance"),
        F.min("home").alias("first_home"),
    ]
    raw = t.customer.select(F.to_json(doc).alias("doc"))
    return w.medallion(raw, "doc", scratch(t.spark, "medallion"), schema, silver, ["code"], "segment", gold)


@query("""
SELECT n_nationkey, n_name, r_name, COALESCE(c.balance, 0.0) AS balance, COALESCE(s.suppliers, 0) AS suppliers FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT c_nationkey AS k, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer GROUP BY 1) c ON c.k = n_nationkey
LEFT JOIN (SELECT s_nationkey AS k, COUNT(*) AS suppliers FROM supplier GROUP BY 1) s ON s.k = n_nationkey
""")
def layered_integration(t: Tables) -> DataFrame:
    balances = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance")
    )
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    sources = [
        ("regions", t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", {"r_name": None}),
        ("balances", balances, "n_nationkey", {"balance": 0.0}),
        ("suppliers", suppliers, "n_nationkey", {"suppliers": 0}),
    ]
    out = w.layered_integration(("nations", t.nation), sources, scratch(t.spark, "layers"))
    return out.select("n_nationkey", "n_name", "r_name", "balance", "suppliers")
