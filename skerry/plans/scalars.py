"""Queries for text, date, array, map and JSON functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skerry import functions as fn
from skerry.operators.joins import join_outer_chain
from skerry.plans.joins import OUTER_SQL
from skerry.plans.registry import INDICATORS, Tables, query, round_half_up
from skerry.sources import payloads

# Unit and range per type code.
SENSORS = {
    "click": {"unit": "celsius", "range": "-50 to 60"},
    "view": {"unit": "percent", "range": "0 to 100"},
    "purchase": {"unit": "hPa", "range": "870 to 1084"},
}


@query("""
SELECT doc_id, CAST(COALESCE(LENGTH(text), 0) AS INT) AS name_length, source IS NOT NULL AS has_code FROM documents
""")
def text_length_flags(t: Tables) -> DataFrame:
    flags = fn.text_length_flags(F.col("text"), F.col("source"))
    return t.documents.withColumns(flags).select("doc_id", "name_length", "has_code")


@query("SELECT doc_id, CAST(LEN(REGEXP_EXTRACT_ALL(text, '[A-Z][a-z]+')) AS INT) AS capitals FROM documents")
def count_pattern(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", fn.count_pattern(F.col("text"), "[A-Z][a-z]+").alias("capitals"))


def expressions(t: Tables) -> DataFrame:
    """Indicator-like expressions built from part columns; every seventh part has no denominator."""
    num = F.concat(F.lit("#{"), "p_name", F.lit("}+#{"), "p_type", F.lit("}*"), F.col("p_size").cast("string"))
    den = F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit("#{"), "p_brand", F.lit("}-1")))
    return t.part.select("p_partkey", num.alias("numerator"), den.alias("denominator"))


@query("SELECT p_partkey, CAST(4 + CASE WHEN p_partkey % 7 <> 0 THEN 2 ELSE 0 END AS INT) AS complexity FROM part")
def expression_complexity(t: Tables) -> DataFrame:
    score = fn.expression_complexity([F.col("numerator"), F.col("denominator")])
    return expressions(t).select("p_partkey", score.alias("complexity"))


@query("SELECT page_id, CAST(LENGTH(url) - LENGTH(REPLACE(url, '/', '')) - 1 AS INT) AS depth FROM pages")
def path_depth(t: Tables) -> DataFrame:
    return t.pages.select("page_id", fn.path_depth(F.col("url")).alias("depth"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_nationkey AS nation, c_acctbal AS balance FROM customer")
def split_records(t: Tables) -> DataFrame:
    """Customers packed fifty to a text, then split again."""
    record = F.concat_ws(":", "c_custkey", "c_nationkey", "c_acctbal")
    packed = t.customer.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(
        F.array_join(F.collect_list(record), "|").alias("text")
    )
    names = {"id": "string", "nation": "int", "balance": "double"}
    return payloads.split_records(packed, "text", "|", ":", names).drop("page")


@query("""
SELECT c_custkey, UPPER(c_mktsegment) AS upper_text, LOWER(c_mktsegment) AS lower_text, c_mktsegment AS trimmed_text,
 CAST(LENGTH(c_mktsegment) + 4 AS INT) AS text_length, UPPER(c_mktsegment) AS shout FROM customer
""")
def normalize_text(t: Tables) -> DataFrame:
    padded = t.customer.withColumn("padded", F.concat(F.lit("  "), "c_mktsegment", F.lit("  ")))
    parts = fn.normalize_text(F.col("padded"))
    out = padded.withColumns(parts)
    return out.select(
        "c_custkey", F.trim("upper_text").alias("upper_text"), F.trim("lower_text").alias("lower_text"), "trimmed_text",
        "text_length", F.trim("upper_text").alias("shout"),
    )


@query("""
SELECT page_id, NULLIF(REGEXP_EXTRACT(url, '^https?://([^/]+)/', 1), '') AS host, NULLIF(REGEXP_EXTRACT(url, '/([a-z]{2})/', 1), '') AS lang,
 NULLIF(REGEXP_EXTRACT(url, '/[a-z]{2}/([0-9]+)', 1), '') AS number FROM pages
""")
def extract_parts(t: Tables) -> DataFrame:
    patterns = {"host": "^https?://([^/]+)/", "lang": "/([a-z]{2})/", "number": "/[a-z]{2}/([0-9]+)"}
    return t.pages.select("page_id", *[fn.extract_part(F.col("url"), p).alias(n) for n, p in patterns.items()])


HASH_SQL = "CAST(('0x' || SUBSTR(MD5(c_name), 1, 8)) AS BIGINT) % 100000"


@query(f"SELECT c_custkey, {HASH_SQL} AS hash_key FROM customer")
def hash_key(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", fn.hash_key(F.col("c_name")).alias("hash_key"))


@query(f"SELECT COUNT(DISTINCT c_name) AS codes, COUNT(DISTINCT c_name) - COUNT(DISTINCT {HASH_SQL}) AS collisions FROM customer")
def hash_collisions(t: Tables) -> DataFrame:
    """How many codes lost their own key: the bucket range is finite."""
    keys = t.customer.select("c_name").distinct().groupBy(fn.hash_key(F.col("c_name")).alias("k")).agg(
        F.count("*").alias("n")
    )
    return keys.agg(F.sum("n").alias("codes"), (F.sum("n") - F.count("*")).alias("collisions"))


@query("""
SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') AS time_text, strftime(ts, '%Y-%m-%d') AS date_text FROM events
""")
def epoch_parts(t: Tables) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return t.events.withColumns(fn.epoch_parts(millis)).select("event_id", "time_text", "date_text")


@query("""
SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INT) AS year, CAST(MONTH(o_orderdate) AS INT) AS month, CAST(HOUR(o_orderdate) AS INT) AS hour,
 ISODOW(o_orderdate) < 6 AS is_weekday, CAST(YEAR(o_orderdate) // 10 * 10 AS INT) AS decade, YEAR(o_orderdate) >= 2000 AS is_21st_century,
 strftime(o_orderdate, '%Y-%m-%d') AS iso_date FROM orders
""")
def calendar_parts(t: Tables) -> DataFrame:
    parts = fn.calendar_parts(F.col("o_orderdate"))
    return t.orders.withColumns(parts).select("o_orderkey", *parts)


@query("""
WITH h AS (SELECT event_id, (epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) - epoch_us(ts)) / 3600000000.0 AS h FROM events)
SELECT event_id, ROUND(h, 6) AS hours_behind, CASE WHEN h <= 2 THEN 'CURRENT' ELSE 'CATCHING UP' END AS status FROM h
""")
def duration_units(t: Tables) -> DataFrame:
    day_end = F.date_trunc("day", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 DAY")
    hours = fn.hours_between(F.col("ts"), day_end)
    status = F.when(F.col("hours_behind") <= 2, "CURRENT").otherwise("CATCHING UP")
    return (
        t.events.select("event_id", hours.alias("hours_behind")).withColumn("status", status)
        .withColumn("hours_behind", round_half_up(F.col("hours_behind"), 6))
    )


@query("""
SELECT o_orderkey, ROUND(COALESCE(CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END / 3600, 0), 6) AS hours FROM orders
""")
def seconds_to_hours(t: Tables) -> DataFrame:
    seconds = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice"))
    return t.orders.select("o_orderkey", F.round(fn.seconds_to_hours(seconds), 6).alias("hours"))


@query("""
SELECT conv_id AS station_id, 'conv' || conv_id AS station_name, turn AS station_location_lat, turn * 2 AS station_location_lon,
 role AS observations_role, CAST(LENGTH(text) AS INT) AS observations_size FROM conversations
""")
def flatten_json(t: Tables) -> DataFrame:
    location = F.struct(F.col("turn").alias("lat"), (F.col("turn") * 2).alias("lon"))
    station = F.struct(
        F.col("conv_id").alias("id"), F.concat(F.lit("conv"), "conv_id").alias("name"), location.alias("location")
    )
    nested = t.conversations.select(
        station.alias("station"), F.struct("role", F.char_length("text").alias("size")).alias("observations")
    )
    return nested.select(fn.flatten_columns(nested.schema))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, COALESCE(json_extract_string(props, '$.absent'), 'none') AS absent FROM events")
def nested_field(t: Tables) -> DataFrame:
    doc = F.col("props")
    return t.events.select(
        "event_id", fn.nested_field(doc, "$.k", "bigint").alias("k"),
        fn.nested_field(doc, "$.absent", "string", "none").alias("absent"),
    )


@query("""
SELECT strftime(l_shipdate, '%Y-%m-%dT%H:%M') AS "from", strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M') AS "to",
 CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS forecast, CASE WHEN l_linenumber <> 2 THEN l_quantity END AS actual,
 CASE WHEN l_linenumber <> 2 THEN l_returnflag END AS index FROM lineitem
""")
def flatten_intensity(t: Tables) -> DataFrame:
    return payloads.flatten_intensity(intensity_documents(t), "doc")


def intensity_documents(t: Tables) -> DataFrame:
    """Line items as slot documents; second lines carry no intensity object."""
    body = F.struct(
        F.col("l_extendedprice").alias("forecast"), F.col("l_quantity").alias("actual"), F.col("l_returnflag").alias("index")
    )
    stamp = "yyyy-MM-dd'T'HH:mm"
    slot = F.struct(
        F.date_format("l_shipdate", stamp).alias("from"),
        F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 1 DAY"), stamp).alias("to"),
        F.when(F.col("l_linenumber") != 2, body).alias("intensity"),
    )
    return t.lineitem.select(F.to_json(slot).alias("doc"))


@query("SELECT conv_id, turn, role, CAST(LENGTH(text) AS INT) AS size FROM conversations")
def explode_mix(t: Tables) -> DataFrame:
    """Turns packed twenty to an array per conversation, then one row per turn again."""
    turn = F.struct("turn", "role", F.char_length("text").alias("size"))
    packed = t.conversations.groupBy("conv_id", F.floor(F.col("turn") / 20).alias("page")).agg(
        F.collect_list(turn).alias("mix")
    )
    return payloads.explode_mix(packed, ["conv_id"], "mix")


@query("SELECT vec_id, CAST(LEN(embedding) AS INT) AS dims FROM embeddings")
def array_length(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", fn.array_length(F.col("embedding")).alias("dims"))


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS head, CAST(-1 AS DOUBLE) AS beyond FROM embeddings")
def array_item(t: Tables) -> DataFrame:
    values = F.col("embedding").cast("array<double>")
    return t.embeddings.select(
        "vec_id", fn.array_item(values, 0).alias("head"), fn.array_item(values, 100_000, -1.0).alias("beyond")
    )


@query("""
SELECT c_nationkey, c_mktsegment AS code, 'segment ' || LOWER(c_mktsegment) AS name, COUNT(*) AS members FROM customer GROUP BY 1, 2
""")
def bridge_tables(t: Tables) -> DataFrame:
    """A map per nation from segment to a struct, unfolded into link rows."""
    counts = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("members"))
    entry = F.struct(
        F.col("c_mktsegment"),
        F.struct(F.concat(F.lit("segment "), F.lower("c_mktsegment")).alias("name"), F.col("members")),
    )
    maps = counts.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(entry)).alias("segments"))
    return payloads.bridge_table(maps, "c_nationkey", "segments")


@query(f"""
SELECT country_key, year, ROUND((COALESCE(revenue, 0) + COALESCE(orders, 0) + COALESCE(urgent, 0)) /
 ((revenue IS NOT NULL)::INT + (orders IS NOT NULL)::INT + (urgent IS NOT NULL)::INT), 4) AS mean_value FROM {OUTER_SQL} o
""")
def row_mean(t: Tables) -> DataFrame:
    joined = join_outer_chain([t.indicator(n) for n in INDICATORS], ["country_key", "year"])
    return joined.select("country_key", "year", fn.row_mean([F.col(c) for c in INDICATORS], 4).alias("mean_value"))


@query("""
WITH b AS (SELECT event_type, user_id % 7 AS batch, COUNT(*) FILTER (WHERE value > 250) = 0 AS ok FROM events GROUP BY 1, 2),
c AS (SELECT event_type, COUNT(*) FILTER (WHERE ok) AS passed, COUNT(*) AS total FROM b GROUP BY 1)
SELECT event_type, passed, total, CASE WHEN passed = total THEN 'GREEN' WHEN passed >= total // 2 THEN 'YELLOW' ELSE 'RED' END AS light FROM c
""")
def traffic_light(t: Tables) -> DataFrame:
    batches = t.events.groupBy("event_type", (F.col("user_id") % 7).alias("batch")).agg(
        (F.count_if(F.col("value") > 250) == 0).alias("ok")
    )
    counts = batches.groupBy("event_type").agg(F.count_if("ok").alias("passed"), F.count("*").alias("total"))
    return counts.withColumn("light", fn.traffic_light(F.col("passed"), F.col("total")))


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'celsius' WHEN 'view' THEN 'percent' WHEN 'purchase' THEN 'hPa' ELSE 'unknown' END AS unit,
 CASE event_type WHEN 'click' THEN '-50 to 60' WHEN 'view' THEN '0 to 100' WHEN 'purchase' THEN '870 to 1084' ELSE 'N/A' END AS range FROM events
""")
def sensor_metadata(t: Tables) -> DataFrame:
    attributes = fn.code_lookup(F.col("event_type"), SENSORS, {"unit": "unknown", "range": "N/A"})
    return t.events.withColumns(attributes).select("event_id", "unit", "range")


@query("""
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 30, '%Y-%m-%d') AS minus_30_days, strftime(CAST(o_orderdate AS DATE) - 7, '%Y-%m-%d') AS minus_7_days,
 strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS minus_1_days, strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%d') AS plus_1_days,
 CASE WHEN DAY(o_orderdate) <= 10 THEN 'early' WHEN DAY(o_orderdate) <= 20 THEN 'mid' ELSE 'late' END AS third FROM orders
""")
def date_offsets(t: Tables) -> DataFrame:
    offsets: dict[str, Column] = fn.date_offsets(F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey", *[c.alias(n) for n, c in offsets.items()], fn.month_third(F.col("o_orderdate")).alias("third")
    )
