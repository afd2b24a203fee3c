"""Queries for row-wise operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F, types as T

from skerry.functions.measures import safe_ratio as ratio
from skerry.operators import rows
from skerry.operators.sets import concat_frames
from skerry.plans.registry import Tables, query, round_half_up

# Bands of the public European air quality index, wind and temperature classes.
AIR_BANDS = [(20, "Good"), (40, "Fair"), (60, "Moderate"), (80, "Poor"), (100, "Very Poor")]
RISK_BANDS = [(25, "Low"), (50, "Moderate"), (75, "High")]
WIND_BANDS = [(1, "calm"), (5, "light"), (10, "moderate"), (20, "strong")]
EVENT_LIMITS = {"click": 15.0, "error": 45.0, "view": 25.0}


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def select_present(t: Tables) -> DataFrame:
    return rows.select_present(t.customer, ["c_custkey", "c_name", "c_phone", "c_acctbal"])


@query("""
SELECT event_type AS station, strftime(ts, '%Y-%m-%d') AS date, value AS amount, 'events' AS source FROM events
UNION ALL
SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), o_totalprice, 'orders' FROM orders
""")
def harmonize_columns(t: Tables) -> DataFrame:
    return concat_frames(harmonized(t))


def harmonized(t: Tables) -> list[DataFrame]:
    """Events and orders under shared column names."""
    renames = {"event_type": "station", "o_orderpriority": "station", "value": "amount", "o_totalprice": "amount"}
    keep = ["station", "date", "amount", "source"]
    return [
        rows.select_present(rows.harmonize_columns(df, renames, {"source": name}, date_from=when), keep)
        for df, name, when in ((t.events, "events", "ts"), (t.orders, "orders", "o_orderdate"))
    ]


@query("""
SELECT event_id, ROUND((value - 32) * 5 / 9, 2) AS temperature_c, 'C' AS unit FROM events
""")
def convert_units(t: Tables) -> DataFrame:
    out = rows.convert_units(t.events, "value", "F", "C", "temperature_c", digits=2)
    return out.select("event_id", "temperature_c", "unit")


@query("""
SELECT p_partkey, ROUND(p_retailprice + 0.05 * p_size, 3) AS heat_index, ROUND(p_retailprice - p_size, 3) AS spread,
       CAST(ROUND(20 - ABS(p_size - 60) * 0.5, 3) AS DOUBLE) AS latitude_estimate FROM part
""")
def derive_measure(t: Tables) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    formulas = {
        "heat_index": price + 0.05 * size,
        "spread": price - size,
        "latitude_estimate": 20 - F.abs(size - 60) * 0.5,
    }
    return rows.derive_measure(t.part, formulas, digits=3).select("p_partkey", *formulas)


@query("SELECT record_id, COALESCE(temperature_c, 0.0) AS temperature_c, humidity_pct FROM @v_obs")
def fill_defaults(t: Tables) -> DataFrame:
    filled = rows.fill_defaults(t.v_obs, {"temperature_c": 0.0, "humidity_pct": 50.0})
    return filled.select("record_id", "temperature_c", "humidity_pct")


@query("SELECT record_id, temperature_c FROM @v_obs WHERE temperature_c IS NOT NULL AND humidity_pct IS NOT NULL")
def drop_incomplete(t: Tables) -> DataFrame:
    kept = rows.drop_incomplete(t.v_obs, ["temperature_c", "humidity_pct"])
    return kept.select("record_id", "temperature_c")


@query("""
SELECT o_orderkey,
  CASE WHEN o_totalprice/4000 <= 20 THEN 'Good' WHEN o_totalprice/4000 <= 40 THEN 'Fair'
       WHEN o_totalprice/4000 <= 60 THEN 'Moderate' WHEN o_totalprice/4000 <= 80 THEN 'Poor'
       WHEN o_totalprice/4000 <= 100 THEN 'Very Poor' ELSE 'Extremely Poor' END AS air_band,
  CASE WHEN o_totalprice/20000 < 1 THEN 'calm' WHEN o_totalprice/20000 < 5 THEN 'light'
       WHEN o_totalprice/20000 < 10 THEN 'moderate' WHEN o_totalprice/20000 < 20 THEN 'strong'
       ELSE 'storm' END AS wind_band
FROM orders
""")
def classify_ladder(t: Tables) -> DataFrame:
    df = t.orders.select(
        "o_orderkey", (F.col("o_totalprice") / 4000).alias("aqi"), (F.col("o_totalprice") / 20000).alias("wind")
    )
    df = rows.classify_ladder(df, "aqi", AIR_BANDS, "Extremely Poor", "air_band", closed="upper")
    df = rows.classify_ladder(df, "wind", WIND_BANDS, "storm", "wind_band", closed="lower")
    return df.select("o_orderkey", "air_band", "wind_band")


@query("""
SELECT event_id, COALESCE(value > CASE event_type WHEN 'click' THEN 15.0 WHEN 'error' THEN 45.0 WHEN 'view' THEN 25.0 END,
       FALSE) AS exceeds FROM events
""")
def exceeds_threshold(t: Tables) -> DataFrame:
    out = rows.exceeds_threshold(t.events, "event_type", "value", EVENT_LIMITS)
    return out.select("event_id", "exceeds")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, CAST(CASE WHEN l_quantity < 1 THEN 0 WHEN l_quantity < 10 THEN 25
   WHEN l_quantity < 25 THEN 50 WHEN l_quantity < 40 THEN 75 WHEN l_quantity >= 40 THEN 100 ELSE 0 END AS DOUBLE) AS score
FROM lineitem
""")
def score_steps(t: Tables) -> DataFrame:
    out = rows.score_steps(t.lineitem, "l_quantity", (1, 10, 25, 40), (0, 25, 50, 75, 100), "score")
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "score")


@query("""
SELECT o.o_orderkey, CAST(CASE WHEN o.o_totalprice / m.mean_price >= 3.0 THEN 100 WHEN o.o_totalprice / m.mean_price >= 1.5
   THEN 50 ELSE 0 END AS DOUBLE) AS score
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN (SELECT c_nationkey AS nk, AVG(o_totalprice) AS mean_price FROM orders JOIN customer ON o_custkey = c_custkey
      GROUP BY c_nationkey) m ON m.nk = c.c_nationkey
""")
def score_ratio(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"), F.count("o_totalprice").alias("n"))
    homes = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    means = per_customer.join(homes, "o_custkey").groupBy("c_nationkey").agg(
        (F.sum("s") / F.sum("n")).alias("mean_price")
    )
    known = homes.join(means, "c_nationkey").select("o_custkey", "mean_price")
    return rows.score_ratio(t.orders.join(known, "o_custkey"), "o_totalprice", "mean_price", "score").select(
        "o_orderkey", "score"
    )


def sensor_text(t: Tables) -> DataFrame:
    """Line quantities as text, with an error marker on every tenth order and a malformed number."""
    return t.lineitem.select(
        "l_orderkey",
        "l_returnflag",
        F.when(F.col("l_orderkey") % 10 == 3, "ERR")
        .when(F.col("l_orderkey") % 10 == 4, "1.2.3")
        .otherwise((F.col("l_quantity") * 2 - 20).cast("string"))
        .alias("raw_value"),
    )


SENSOR_SQL = """(SELECT l_orderkey, l_returnflag, CASE WHEN l_orderkey % 10 = 3 THEN 'ERR' WHEN l_orderkey % 10 = 4 THEN '1.2.3'
  ELSE CAST(l_quantity * 2 - 20 AS VARCHAR) END AS raw_value FROM lineitem)"""
GATED_SQL = f"""(SELECT l_orderkey, l_returnflag, raw_value,
  CASE WHEN regexp_matches(raw_value, '^-?[0-9.]+$') THEN TRY_CAST(raw_value AS DOUBLE) END AS value_numeric,
  COALESCE(CASE WHEN regexp_matches(raw_value, '^-?[0-9.]+$') THEN TRY_CAST(raw_value AS DOUBLE) END BETWEEN -50 AND 60,
           FALSE) AS is_valid FROM {SENSOR_SQL} s)"""


@query(f"SELECT * FROM {GATED_SQL} g")
def regex_gated_cast(t: Tables) -> DataFrame:
    return rows.regex_gated_cast(sensor_text(t), "raw_value", "^-?[0-9.]+$", -50, 60)


MIXED_SQL = """(SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'not_a_number' WHEN o_orderkey % 13 = 0 THEN NULL
   ELSE CAST(o_totalprice AS VARCHAR) END AS price_text,
   CASE WHEN o_orderkey % 17 = 0 THEN 'bad-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text FROM orders)"""


def mixed_text(t: Tables) -> DataFrame:
    """Orders as text with unparseable and missing cells."""
    key = F.col("o_orderkey")
    return t.orders.select(
        key,
        F.when(key % 11 == 0, "not_a_number")
        .when(key % 13 == 0, None)
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("price_text"),
        F.when(key % 17 == 0, "bad-date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_text"),
    )


@query(f"""
SELECT o_orderkey, TRY_CAST(price_text AS DOUBLE) AS price_text,
       strftime(TRY_CAST(date_text AS DATE), '%Y-%m-%d') AS date_text FROM {MIXED_SQL} m
""")
def coerce_types(t: Tables) -> DataFrame:
    typed = rows.coerce_types(mixed_text(t), {"price_text": "double", "date_text": "date"})
    return typed.withColumn("date_text", F.date_format("date_text", "yyyy-MM-dd"))


@query(f"""
SELECT 'price_text' AS column_name, COUNT(*) FILTER (WHERE price_text IS NOT NULL AND TRY_CAST(price_text AS DOUBLE) IS NULL)
  AS violations FROM {MIXED_SQL} m
UNION ALL
SELECT 'date_text', COUNT(*) FILTER (WHERE date_text IS NOT NULL AND TRY_CAST(date_text AS DATE) IS NULL) FROM {MIXED_SQL} m
""")
def coercion_report(t: Tables) -> DataFrame:
    return rows.coercion_report(mixed_text(t), {"price_text": "double", "date_text": "date"})


VALID_SQL = "temperature_c IS NOT NULL AND humidity_pct IS NOT NULL AND temperature_c BETWEEN -50 AND 60"


@query(f"SELECT record_id, temperature_c, humidity_pct FROM @v_obs WHERE {VALID_SQL}")
def split_valid(t: Tables) -> DataFrame:
    valid, _ = rows.split_valid(t.v_obs, ["temperature_c", "humidity_pct"], {"temperature_c": (-50, 60)})
    return valid.select("record_id", "temperature_c", "humidity_pct")


@query(f"SELECT record_id, temperature_c, humidity_pct FROM @v_obs WHERE ({VALID_SQL}) IS NOT TRUE")
def split_invalid(t: Tables) -> DataFrame:
    _, invalid = rows.split_valid(t.v_obs, ["temperature_c", "humidity_pct"], {"temperature_c": (-50, 60)})
    return invalid.select("record_id", "temperature_c", "humidity_pct")


FAULTY_SQL = """(SELECT record_id, station, CASE WHEN record_id % 17 = 0 THEN 'not_a_number'
   ELSE CAST(temperature_c AS VARCHAR) END AS temperature_f,
   CAST(humidity_pct AS VARCHAR) AS humidity_pct FROM @v_obs)"""


def faulty_text(t: Tables) -> DataFrame:
    """Observations as text: some temperatures are words, some humidities exceed 100."""
    return t.v_obs.select(
        "record_id",
        "station",
        F.when(F.col("record_id") % 17 == 0, "not_a_number")
        .otherwise(F.col("temperature_c").cast("string"))
        .alias("temperature_f"),
        F.col("humidity_pct").cast("string").alias("humidity_pct"),
    )


def fault_rules() -> dict:
    return {
        "temperature_f is not numeric": rows.numeric_fault("temperature_f"),
        "humidity_pct outside 0..100": rows.range_fault("humidity_pct", 0, 100),
    }


@query(f"""
SELECT record_id AS record_id, 'bad' AS route, CASE WHEN record_id % 17 = 0 AND CAST(humidity_pct AS DOUBLE) > 100
    THEN 'temperature_f is not numeric; humidity_pct outside 0..100'
    WHEN record_id % 17 = 0 THEN 'temperature_f is not numeric' ELSE 'humidity_pct outside 0..100' END AS reason
FROM {FAULTY_SQL} f WHERE record_id % 17 = 0 OR CAST(humidity_pct AS DOUBLE) > 100
UNION ALL
SELECT record_id, 'good', NULL FROM {FAULTY_SQL} f WHERE NOT (record_id % 17 = 0 OR CAST(humidity_pct AS DOUBLE) > 100)
""")
def quarantine_rows(t: Tables) -> DataFrame:
    good, bad = rows.quarantine_rows(faulty_text(t), fault_rules(), F.col("station"))
    rejected = bad.select(
        F.get_json_object("row_data", "$.record_id").cast("bigint").alias("record_id"),
        F.lit("bad").alias("route"),
        "reason",
    )
    kept = good.select("record_id", F.lit("good").alias("route"), F.lit(None).cast("string").alias("reason"))
    return rejected.unionByName(kept)


@query("SELECT id, lat, lon FROM @v_geo WHERE COALESCE(lat, 0) BETWEEN 30 AND 60 AND COALESCE(lon, 0) BETWEEN -20 AND 40")
def bbox_filter(t: Tables) -> DataFrame:
    return rows.bbox_filter(t.v_geo, "lat", "lon", (30, 60, -20, 40)).select("id", "lat", "lon")


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-05-28'
  AND o_orderdate < TIMESTAMP '1997-05-29'
""")
def filter_slot(t: Tables) -> DataFrame:
    slot = rows.filter_slot(t.orders, "o_orderdate", date(1997, 5, 28))
    return slot.select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
SELECT record_id, temperature_c IS NOT NULL AS has_temperature, temperature_c, humidity_pct FROM @v_obs
""")
def drop_null_fields(t: Tables) -> DataFrame:
    records = rows.drop_null_fields(t.v_obs.select("record_id", "temperature_c", "humidity_pct"))
    parsed = T.StructType.fromDDL("record_id bigint, temperature_c double, humidity_pct double")
    return records.select(
        F.from_json("record", parsed).alias("r"),
        F.array_contains(F.json_object_keys("record"), "temperature_c").alias("has_temperature"),
    ).select("r.*", "has_temperature")


@query("""
SELECT country_key, population, area_km2, CASE WHEN area_km2 > 0 THEN ROUND(population / area_km2, 3) ELSE 0.0 END AS density
FROM @v_country
""")
def safe_ratio(t: Tables) -> DataFrame:
    density = ratio(F.col("population"), F.col("area_km2"), 3).alias("density")
    return t.v_country.select("country_key", "population", "area_km2", density)


@query("""
SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'machinery' THEN 'industry' WHEN 'automobile' THEN 'transport'
  WHEN 'building' THEN 'construction' ELSE 'industry' END AS resolved FROM customer
""")
def resolve_name(t: Tables) -> DataFrame:
    mixed = t.customer.withColumn(
        "segment", F.when(F.col("c_custkey") % 2 == 0, F.initcap("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    )
    lookup = [("Machinery", "industry"), ("Automobile", "transport"), ("Building", "construction")]
    return rows.resolve_name(mixed, "segment", lookup).select("c_custkey", "resolved")


@query("""
SELECT e.event_id, e.event_type, CASE WHEN g.bad = 0 THEN 'publish' ELSE 'quarantine' END AS route FROM events e
JOIN (SELECT event_type, user_id % 7 AS batch, COUNT(*) FILTER (WHERE value IS NULL OR value < 0 OR value > 300) AS bad
      FROM events GROUP BY 1, 2) g ON g.event_type = e.event_type AND g.batch = e.user_id % 7
""")
def quality_gate(t: Tables) -> DataFrame:
    batches = t.events.withColumn("batch", F.col("user_id") % 7)
    return rows.gate_routes(batches, ["event_type", "batch"], "value", 0, 300).select("event_id", "event_type", "route")


@query("""
SELECT event_type, COUNT(*) AS kept, ROUND(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 2) AS total, ROUND(AVG(value), 4) AS mean
FROM events WHERE value > 100.0 GROUP BY event_type
""")
def filter_threshold(t: Tables) -> DataFrame:
    kept = rows.filter_threshold(t.events, "value", 100.0)
    return kept.groupBy("event_type").agg(
        F.count("*").alias("kept"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        round_half_up(F.avg("value"), 4).alias("mean"),
    )


@query("""
SELECT s_suppkey, CASE WHEN s_name LIKE '%1' THEN s_acctbal + 0.5 ELSE s_acctbal END AS s_acctbal FROM supplier
""")
def update_where(t: Tables) -> DataFrame:
    out = rows.update_where(t.supplier, F.col("s_name").like("%1"), {"s_acctbal": F.col("s_acctbal") + 0.5})
    return out.select("s_suppkey", "s_acctbal")
