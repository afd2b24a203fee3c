"""Queries for scans, landed payloads and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skerry.operators.sets import concat_frames
from skerry.plans.registry import SCHEMAS, Tables, query, round_half_up
from skerry.sources import files, payloads
from skerry.sources.json_arrays import scan_json_arrays
from skerry.workspace import scratch, write_bytes

LINE_STAMP = "yyyy-MM-dd'T'HH:mm"


@query("SELECT r_regionkey, r_name, n_name, n_nationkey, FALSE AS corrupt FROM region JOIN nation ON n_regionkey = r_regionkey")
def scan_csv_regions(t: Tables) -> DataFrame:
    path = scratch(t.spark, "csv")
    t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).select(
        "r_regionkey", "r_name", "n_name", "n_nationkey"
    ).write.option("header", True).csv(path)
    out = files.scan_csv(t.spark, path, "r_regionkey int, r_name string, n_name string, n_nationkey int")
    return out.withColumn("corrupt", F.col("_corrupt").isNotNull()).drop("_corrupt")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderkey % 10 = 3 AS corrupt FROM orders
""")
def scan_csv(t: Tables) -> DataFrame:
    """Orders as CSV with a word in every tenth price, read with a declared schema."""
    path = scratch(t.spark, "csv")
    price = F.when(F.col("o_orderkey") % 10 == 3, "not_a_number").otherwise(F.col("o_totalprice").cast("string"))
    t.orders.select("o_orderkey", price.alias("o_totalprice")).write.option("header", True).csv(path)
    out = files.scan_csv(t.spark, path, "o_orderkey bigint, o_totalprice double")
    return out.withColumn("corrupt", F.col("_corrupt").isNotNull()).drop("_corrupt")


@query("SELECT conv_id, turn, role, CAST(LENGTH(text) AS INT) AS size FROM conversations")
def scan_json_array(t: Tables) -> DataFrame:
    """Conversations as files that hold one JSON array each, two hundred conversations to an array."""
    path = scratch(t.spark, "json")
    turn = F.struct("conv_id", "turn", F.struct("role", "text").alias("body"))
    arrays = t.conversations.groupBy(F.floor(F.col("conv_id") / 200).alias("block"), F.floor(F.col("turn") / 100).alias("page")).agg(
        F.to_json(F.collect_list(turn)).alias("value")
    )
    # One line per array: each line is a file's content, split on write by rows per file.
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    out = scan_json_arrays(t.spark, path, "conv_id bigint, turn bigint, body struct<role: string, text: string>")
    return out.select("conv_id", "turn", "body.role", F.char_length("body.text").alias("size"))


@query("""
SELECT 'l_quantity' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT(l_quantity) AS nulls FROM lineitem
UNION ALL SELECT 'l_shipdate', COUNT(*), COUNT(*) - COUNT(l_shipdate) FROM lineitem
""")
def scan_parquet(t: Tables) -> DataFrame:
    path = f"{t.sf_dir}/lineitem.parquet"
    return files.profile(files.scan_parquet(t.spark, path, ["l_quantity", "l_shipdate"], SCHEMAS["lineitem"]))


RECORD = "c_custkey bigint, c_name string, c_acctbal double"


def landed_pages(t: Tables, last_empty: bool) -> DataFrame:
    """Customers as pages `[metadata, records]` of a hundred, one file per page."""
    path = scratch(t.spark, "pages")
    record = F.struct("c_custkey", "c_name", "c_acctbal")
    pages = t.customer.groupBy((F.floor(F.col("c_custkey") / 100) + 1).cast("int").alias("page")).agg(
        F.collect_list(record).alias("records")
    )
    total = t.customer.agg((F.floor(F.max("c_custkey") / 100) + 1).cast("int")).scalar()
    body = F.to_json("records")
    if last_empty:
        body = F.when(F.col("page") == total, "null").otherwise(body)
    meta = F.to_json(F.struct("page", total.alias("pages"), F.lit(100).alias("per_page")))
    pages.select(F.concat(F.lit("["), meta, F.lit(","), body, F.lit("]")).alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).text(path)
    return files.scan_envelope_pages(t.spark, path, RECORD)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey // 100 < (SELECT MAX(c_custkey) // 100 FROM customer)")
def scan_envelope_pages(t: Tables) -> DataFrame:
    """The last page has no records, which ends the set before it."""
    return payloads.page_records(landed_pages(t, last_empty=True))


@query("SELECT MAX(c_custkey) // 100 + 1 AS landed, CAST(MAX(c_custkey) // 100 + 1 AS INT) AS announced, TRUE AS complete FROM customer")
def page_completeness(t: Tables) -> DataFrame:
    return payloads.page_completeness(landed_pages(t, last_empty=False))


@query("SELECT p_brand, p_partkey, p_name, p_size FROM part WHERE p_brand <> 'Brand#1'")
def explode_records(t: Tables) -> DataFrame:
    """Parts in envelopes of at most fifty per brand; the documents of one brand use another key."""
    record = F.struct("p_partkey", "p_name", "p_size")
    packed = t.part.groupBy("p_brand", F.floor(F.col("p_partkey") / 50).alias("page")).agg(
        F.collect_list(record).alias("value")
    )
    other = F.to_json(F.struct(F.col("value").alias("data")))
    doc = F.when(F.col("p_brand") == "Brand#1", other).otherwise(F.to_json(F.struct("value")))
    docs = packed.select("p_brand", doc.alias("doc"))
    return payloads.explode_records(docs, "doc", "value", "p_partkey: bigint, p_name: string, p_size: int", ["p_brand"])


@query("SELECT CAST(c_custkey AS VARCHAR) AS dx, c_mktsegment AS ou, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS value FROM customer")
def rows_with_headers(t: Tables) -> DataFrame:
    """Customers as header and row matrices; the column order differs between documents."""
    key = F.col("c_custkey")
    dx, ou = key.cast("string"), F.col("c_mktsegment")
    value = F.when(key % 9 != 0, F.col("c_acctbal").cast("string")).otherwise("n/a")
    page = F.floor(key / 100)
    straight = page % 2 == 0
    row = F.when(straight, F.array(dx, ou, value)).otherwise(F.array(value, dx, ou))
    names = F.when(straight, F.array(F.lit("dx"), F.lit("ou"), F.lit("value"))).otherwise(
        F.array(F.lit("value"), F.lit("dx"), F.lit("ou"))
    )
    docs = t.customer.groupBy(page.alias("page"), names.alias("names")).agg(F.collect_list(row).alias("rows"))
    headers = F.transform("names", lambda n: F.struct(n.alias("name")))
    packed = docs.select(F.to_json(F.struct(headers.alias("headers"), "rows")).alias("doc"))
    return payloads.rows_with_headers(packed, "doc", ["dx", "ou", "value"], {"value": "double"})


@query("""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, ROUND(AVG(value), 4) AS mean, COUNT(*) AS n FROM events GROUP BY 1, 2),
x AS (SELECT event_type, MIN(day) AS first FROM d GROUP BY 1)
SELECT d.event_type, strftime(day, '%Y-%m-%d') AS time, mean, CASE WHEN d.event_type <> 'view' THEN n END AS n FROM d
""")
def parallel_arrays_to_rows(t: Tables) -> DataFrame:
    """Daily series per event type packed as parallel arrays, one of them missing for one type."""
    daily = t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("time")).agg(
        round_half_up(F.avg("value"), 4).alias("mean"), F.count("*").alias("n")
    )
    # One element per calendar day and type, however many events there are.
    packed = daily.groupBy("event_type").agg(F.sort_array(F.collect_list(F.struct("time", "mean", "n"))).alias("s"))
    counts = F.when(F.col("event_type") != "view", F.col("s.n")).alias("n")
    arrays = [F.col("s.time").alias("time"), F.col("s.mean").alias("mean"), counts]
    hourly = packed.select("event_type", F.struct(*arrays).alias("daily"))
    return payloads.parallel_arrays_to_rows(
        hourly, "daily", {"time": "string", "mean": "double", "n": "bigint"}, ["event_type"]
    )


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, 'parquet' AS format, TRUE AS sized, COUNT(*) AS rows FROM {name}" for name in SCHEMAS
))
def discover_files(t: Tables) -> DataFrame:
    """The tables found by listing the folder, each with the rows behind its files."""
    listed = files.discover_files(t.spark, t.sf_dir, ["parquet"])
    table = F.regexp_extract("path", r"/([a-z]+)\.parquet(/[^/]*)?$", 1).alias("table_name")
    found = listed.groupBy(table, "format").agg((F.min("size") > 0).alias("sized"))
    counts = concat_frames([getattr(t, name).agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name)) for name in SCHEMAS])
    return found.join(counts, "table_name").select("table_name", "format", "sized", "rows")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 0")
def load_table(t: Tables) -> DataFrame:
    """Replaced, refilled, then appended to."""
    path = scratch(t.spark, "table")
    name = "skerry_supplier_" + path.rsplit("-", 1)[1][:12]
    files.load_table(t.supplier.filter("s_acctbal < 0"), name, "replace", path)
    files.load_table(t.supplier, name, "refill")
    files.load_table(t.supplier.filter("s_acctbal > 0"), name, "append", path)
    return t.spark.table(name).drop("loaded_at")


@query(" UNION ALL ".join(f"SELECT '{f}' AS format, COUNT(*) AS rows, 5 AS columns, MAX(c_name) AS last_name FROM customer" for f in ("csv", "json", "parquet", "xml")))
def write_dataset(t: Tables) -> DataFrame:
    """The same table through each format; an unknown format is written as CSV."""
    out = []
    for fmt in ("csv", "json", "parquet", "xml"):
        path = scratch(t.spark, f"dataset-{fmt}")
        written = files.write_dataset(t.customer, path, fmt)
        reader = t.spark.read.schema(SCHEMAS["customer"]).option("header", True)
        back = reader.format(fmt if fmt in ("json", "parquet") else "csv").load(path)
        out.append(back.agg(F.count("*").alias("rows"), F.max("c_name").alias("last_name")).select(
            F.lit(fmt).alias("format"), "rows", F.lit(written["columns"]).alias("columns"), "last_name"
        ))
    return concat_frames(out)


@query("SELECT o_orderkey, o_totalprice, CAST(YEAR(o_orderdate) AS INT) AS year FROM orders")
def append_dataset(t: Tables) -> DataFrame:
    """Orders appended half by half to one cumulative dataset."""
    path = scratch(t.spark, "append")
    dated = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    for part in (dated.filter("year < 1998"), dated.filter("year >= 1998")):
        files.append_dataset(part, path)
    return files.file_tagged(t.spark.read.schema(dated.schema).parquet(path)).drop("source_file")


UPSERT_SQL = """(SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 2 ELSE c_acctbal END AS c_acctbal FROM customer
 UNION ALL SELECT c_custkey + 1000000000000, c_name, c_acctbal + 2 FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 2 = 0)"""


def customer_updates(t: Tables) -> DataFrame:
    """Two updates of every seventh customer, the second one counts; half of them also as new customers."""
    seventh = t.customer.filter("c_custkey % 7 = 0").select("c_custkey", "c_name", "c_acctbal")
    twice = seventh.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "c_acctbal", F.col("c_acctbal") + F.col("version")
    )
    fresh = twice.filter("c_custkey % 2 = 0").withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000_000)
    return twice.unionByName(fresh)


@query(f"SELECT * FROM {UPSERT_SQL} u")
def merge_upsert(t: Tables) -> DataFrame:
    target = t.customer.select("c_custkey", "c_name", "c_acctbal", F.lit(0).alias("version"))
    once = files.merge_upsert(target, customer_updates(t), ["c_custkey"], [F.col("version")])
    again = files.merge_upsert(once, customer_updates(t), ["c_custkey"], [F.col("version")])
    return again.drop("version")


@query(f"SELECT * FROM {UPSERT_SQL} u")
def upsert_partitions(t: Tables) -> DataFrame:
    """The same into a partitioned dataset, where only touched partitions are rewritten."""
    path = scratch(t.spark, "upsert")
    bucket = F.pmod(F.xxhash64("c_custkey"), F.lit(8)).cast("int")
    target = t.customer.select("c_custkey", "c_name", "c_acctbal", F.lit(0).alias("version"), bucket.alias("bucket"))
    for rows in (target, customer_updates(t).withColumn("bucket", bucket)):
        files.upsert_partitions(rows, path, ["c_custkey"], "bucket", [F.col("version")])
    return t.spark.read.schema(target.schema).parquet(path).drop("version", "bucket")


@query("SELECT id, CASE WHEN id % 4 = 1 THEN 0.0 ELSE lon END AS lon, CASE WHEN id % 4 = 1 THEN 0.0 ELSE lat END AS lat, CASE WHEN id % 4 = 1 THEN 0.0 WHEN id % 4 = 2 THEN 0.0 ELSE depth END AS depth, magnitude FROM @v_geo WHERE id % 9 <> 0")
def write_features(t: Tables) -> DataFrame:
    """Point events as features; some have no depth, some documents no geometry, some rows no coordinates."""
    root = scratch(t.spark, "features")
    placed = t.v_geo.withColumn("lat", F.when(F.col("id") % 9 != 0, F.col("lat")))
    shallow, deep = F.col("id") % 4 == 2, F.col("id") % 4 != 2
    files.write_features(placed.filter(shallow), f"{root}/flat", "lon", "lat", ["id", "magnitude"])
    files.write_features(placed.filter(deep), f"{root}/deep", "lon", "lat", ["id", "magnitude"], "depth")
    docs = t.spark.read.text([f"{root}/flat", f"{root}/deep"])
    bare = F.get_json_object("value", "$.properties.id").cast("bigint") % 4 == 1
    stripped = F.regexp_replace("value", r'"geometry":\{[^}]*\},', "")
    docs = docs.withColumn("value", F.when(bare, stripped).otherwise(F.col("value")))
    return payloads.flatten_features(docs, "value", "id: bigint, magnitude: double")


@query("""
SELECT CASE WHEN id % 4 = 0 THEN 'Polygon' WHEN id % 4 = 1 THEN 'LineString' WHEN id % 4 = 2 THEN 'Point' ELSE 'GeometryCollection' END AS geometry_type, COUNT(*) AS count
FROM @v_geo WHERE id % 9 <> 0 AND id % 10 <> 0 GROUP BY 1
""")
def geometry_counts(t: Tables) -> DataFrame:
    """Features of several geometries, written as text and read back; some rows have none, some one that is no JSON."""
    path = scratch(t.spark, "geometries")
    point = F.array("lon", "lat")
    square = F.array(*[F.array(F.col("lon") + x, F.col("lat") + y) for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))])
    shape = lambda kind, body, name="coordinates": F.to_json(F.struct(F.lit(kind).alias("type"), body.alias(name)))
    member = F.array(F.struct(F.lit("Point").alias("type"), point.alias("coordinates")))
    kind = F.col("id") % 4
    geometry = (
        F.when(F.col("id") % 10 == 0, "no geometry {").when(F.col("id") % 9 == 0, F.lit(None)).when(kind == 0, shape("Polygon", F.array(square)))
        .when(kind == 1, shape("LineString", F.array(point, point))).when(kind == 2, shape("Point", point))
        .otherwise(shape("GeometryCollection", member, "geometries"))
    )
    files.geometry_features(t.v_geo.withColumn("geometry", geometry), "geometry", ["id", "magnitude"]).write.text(path)
    return files.geometry_counts(t.spark.read.text(path), "value")


@query("""
SELECT lon, lat, depth, magnitude, place, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text FROM
 (SELECT g.lon, g.lat, g.depth, g.magnitude, 'cell ' || CAST(g.lat AS INT) AS place, ts FROM @v_geo g) WHERE magnitude IS NOT NULL
""".replace("FROM @v_geo g", "FROM (SELECT * FROM @v_geo) g"))
def flatten_features(t: Tables) -> DataFrame:
    from skerry.functions import epoch_parts

    placed = t.v_geo.select(
        "lon", "lat", "depth", F.col("magnitude").alias("mag"),
        F.concat(F.lit("cell "), F.col("lat").cast("int").cast("string")).alias("place"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
    )
    docs = files.features(placed, "lon", "lat", ["mag", "place", "time"], "depth")
    flat = payloads.flatten_features(docs, "value", "mag: double, place: string, time: bigint")
    return flat.select(
        "lon", "lat", "depth", F.col("mag").alias("magnitude"), "place",
        epoch_parts(F.col("time"))["time_text"].alias("time_text"),
    )


@query("""
SELECT COUNT(*) AS rows_written, COUNT(*) AS rows_read, 6 AS columns_written, 6 AS columns_read, TRUE AS listed, TRUE AS verified FROM part
""")
def object_store_roundtrip(t: Tables) -> DataFrame:
    return files.object_store_roundtrip(t.part, scratch(t.spark, "object") + "/parts")


@query("""
SELECT s_suppkey, 's_name' AS field, s_name AS value FROM supplier UNION ALL SELECT s_suppkey, 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier
""")
def fields_to_rows(t: Tables) -> DataFrame:
    return files.fields_to_rows(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), ["s_suppkey"])


def mixed_folder(t: Tables) -> str:
    """Suppliers as CSV, parts as JSON and customers as Parquet, next to a Parquet file that is none."""
    root = scratch(t.spark, "lenient")
    shape = lambda df, key, name: df.select(F.col(key).alias("id"), F.col(name).alias("name"))
    shape(t.supplier, "s_suppkey", "s_name").write.option("header", True).csv(f"{root}/suppliers")
    shape(t.part, "p_partkey", "p_name").write.json(f"{root}/parts")
    shape(t.customer, "c_custkey", "c_name").write.parquet(f"{root}/customers")
    write_bytes(t.spark, f"{root}/broken/bad.parquet", b"this is not a parquet file")
    write_bytes(t.spark, f"{root}/broken/late.csv", b"id,name\n" + b"1,x\n" * 50_000 + b"2,\x00\n")
    write_bytes(t.spark, f"{root}/broken/none.json", b"")
    return root


@query("""
SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT p_partkey, p_name FROM part UNION ALL SELECT c_custkey, c_name FROM customer
""")
def scan_lenient(t: Tables) -> DataFrame:
    return files.scan_lenient(t.spark, mixed_folder(t), "id bigint, name string").filter("corrupt IS NULL").drop("source_path", "corrupt")


@query("""
SELECT f.*, (SELECT COUNT(*) FROM supplier) + (SELECT COUNT(*) FROM part) + (SELECT COUNT(*) FROM customer) AS rows_elsewhere FROM (VALUES
 ('bad.parquet', 'broken', 'unreadable footer'), ('late.csv', 'broken', 'not a text file'), ('none.json', 'broken', 'empty file')) f(name, folder, reason)
""")
def skipped_files(t: Tables) -> DataFrame:
    """The unreadable files with their reasons, and the rows of all the others."""
    root = mixed_folder(t)
    rows = files.scan_lenient(t.spark, root, "id bigint, name string").filter("corrupt IS NULL").agg(F.count("id")).scalar()
    found = files.skipped_files(t.spark, root)
    return found.select("name", "folder", F.substring_index("reason", ":", 1).alias("reason"), rows.alias("rows_elsewhere"))


@query("SELECT o_orderkey, o_totalprice, CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS INT) AS slot, YEAR(o_orderdate) = 1997 AND MONTH(o_orderdate) = 5 AS corrected FROM orders")
def backfill_slots(t: Tables) -> DataFrame:
    """Orders by month, then one month run again."""
    path = scratch(t.spark, "slots")
    slot = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("slot")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.lit(False).alias("corrected"), slot)
    files.backfill_slots(rows, path, "slot")
    files.backfill_slots(rows.filter("slot = 199705").withColumn("corrected", F.lit(True)), path, "slot")
    return t.spark.read.schema(rows.schema).parquet(path)
