"""Missing order values, keys, verdicts and dates lose nothing; queries leave the session alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from skerry.operators import aggregates, joins, quality as q, warehouse, windows
from skerry.plans import load_all
from skerry.plans.registry import Tables
from skerry.sources import files
from tests.oracle import TESTDATA


def frame(spark, rows, schema="k int, o int, v int"):
    return spark.createDataFrame(rows, schema)


def test_rows_without_an_order_stay(spark):
    df = frame(spark, [(1, None, 5), (2, None, 6), (2, 3, 7), (None, 1, 8)])
    assert sorted(map(tuple, windows.row_number_latest(df, ["k"], [F.col("o")]).collect()), key=str) == [(1, None, 5), (2, 3, 7), (None, 1, 8)]
    assert sorted(map(tuple, windows.dedupe_first(df, ["k"], [F.col("o")]).collect()), key=str) == [(1, None, 5), (2, 3, 7), (None, 1, 8)]
    assert sorted(map(tuple, aggregates.latest_per_key(df, ["k"], [F.col("o")], ["v"]).collect()), key=str) == [(1, 5), (2, 7), (None, 8)]
    dim = spark.createDataFrame([(1,), (2,), (9,)], "k int")
    assert {r["k"]: r["v"] for r in joins.join_latest(dim, df, ["k"], [F.col("o")]).collect()} == {1: 5, 2: 7, 9: None}


def test_missing_keys_do_not_double(spark, tmp_path):
    target, update = frame(spark, [(1, 0, 1), (None, 0, 2)]), frame(spark, [(None, 1, 3), (2, 1, 4)])
    once = files.merge_upsert(target, update, ["k"], [F.col("o")])
    twice = files.merge_upsert(once, update, ["k"], [F.col("o")])
    assert sorted(map(tuple, twice.collect()), key=str) == [(1, 0, 1), (2, 1, 4), (None, 1, 3)]
    path = str(tmp_path / "upsert")
    for rows in (target, update, update):
        files.upsert_partitions(rows.withColumn("part", F.col("k") % 2), path, ["k"], "part", [F.col("o")])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3, 4]


def test_empty_dimension_fails_its_checks(spark):
    dim = spark.createDataFrame([], "k int, valid_from date, valid_to date, is_current boolean")
    checks = warehouse.validate_scd(dim, spark.createDataFrame([(1,)], "k int"), "k")
    got = {r["check_name"]: r["passed"] for r in checks.collect()}
    assert got["scd_has_current"] is False and got["no_orphan_keys"] is False and None not in got.values()


def test_a_check_without_verdict_fails(spark):
    checks = spark.createDataFrame([("a", None, "d", "critical")], "check_name string, passed boolean, details string, severity string")
    report = q.score_report(checks.withColumn("category", F.lit("c")), "category").filter("category IS NULL").first()
    assert (report["failed"], report["critical"], report["overall"]) == (1, 1, "FAIL")


def test_no_dates_is_a_finding(spark):
    rows = q.check_date_coverage(spark.createDataFrame([], "day date"), "day").collect()
    assert [(r["passed"], r["severity"]) for r in rows] == [(False, "critical")]


def test_queries_leave_the_session_alone(spark):
    before = {r[0]: r[1] for r in spark.sql("SET").collect()}
    for name in ("summarize_by", "stream_dedupe", "stream_window_counts"):
        load_all()[name].build(Tables(spark, f"{TESTDATA}/sf0.001")).count()
    assert {r[0]: r[1] for r in spark.sql("SET").collect()} == before


def test_malformed_lines_and_files_are_reported(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "a b.csv").write_text("id,name\n1,x\nnot a number,y\n")
    (tmp_path / "head.csv").write_text("id,name\n")
    (tmp_path / "junk.json").write_bytes(b"\x00\x01\x02")
    (tmp_path / "c.json").write_text('{"id": 2, "name": "z"}\n{"id": \n')
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    pq.write_table(pa.table({"id": pa.array([], pa.int64()), "name": pa.array([], pa.string())}), tmp_path / "none.parquet")
    rows = files.scan_lenient(spark, str(tmp_path), "id bigint, name string").collect()
    good = sorted((r["id"], r["name"]) for r in rows if r["corrupt"] is None)
    assert good == [(1, "x"), (2, "z")]
    assert any("not a number" in (r["corrupt"] or "") for r in rows) and any('{"id": ' in (r["corrupt"] or "") for r in rows)
    faults = {r["name"]: r["reason"].split(":")[0] for r in files.skipped_files(spark, str(tmp_path)).collect()}
    assert faults == {"junk.json": "not a text file", "bad.parquet": "unreadable footer"}


def test_ranks_over_many_ranges(spark):
    from skerry.operators.ordering import values_at_ranks

    df = spark.range(5000).selectExpr("cast(pmod(hash(id), 700) as double) AS a", "cast(if(id % 3 = 0, null, 7) as double) AS b")
    a = sorted(r["a"] for r in df.collect())
    assert values_at_ranks(df, {"a": [1, 2500, 2501, 5000], "b": [1, 3333]}) == {"a": (a[0], a[2499], a[2500], a[-1]), "b": (7.0, 7.0)}


def test_one_key_with_all_rows_spreads(spark):
    from skerry.operators import ordering

    df = spark.range(4000).selectExpr("1 AS k", "id AS o", "if(id % 97 = 0, id, null) AS v").repartition(5)
    dealt = ordering.range_slices(df, ["k"], [F.col("o")], ranges=7)
    assert dealt.select(ordering.RANGE).distinct().count() > 4
    filled = windows.forward_fill(dealt, ["k"], "o", ["v"], slice_by=F.col(ordering.RANGE)).collect()
    assert all(r["v"] == r["o"] // 97 * 97 for r in filled) and len(filled) == 4000
    keyed = warehouse.build_dimension(dealt, [F.col("o")], "n", slice_by=F.col(ordering.RANGE)).collect()
    assert all(r["n"] == r["o"] + 1 for r in keyed)


def test_any_geometry_passes_through(spark):
    import json

    shapes = ['{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}', '{"type":"Point","coordinates":[1.5,2]}', None, "broken {"]
    df = spark.createDataFrame(list(enumerate(shapes)), "id int, geo string")
    found = [json.loads(r["value"]) for r in files.geometry_features(df, "geo", ["id"]).collect()]
    assert [(f["properties"]["id"], f["geometry"]) for f in found] == [(i, json.loads(shapes[i])) for i in (0, 1)]
    assert {r["geometry_type"]: r["count"] for r in files.geometry_counts(files.geometry_features(df, "geo", ["id"]), "value").collect()} == {"Polygon": 1, "Point": 1}


def test_pages_end_with_the_announced_number(spark):
    from skerry.sources import payloads

    pages = spark.createDataFrame([(1, 2, [("a",)]), (2, 2, [("b",)]), (3, 2, [("c",)])], "page int, pages int, records array<struct<v: string>>")
    assert sorted(r["v"] for r in payloads.page_records(pages).collect()) == ["a", "b"]


def test_both_ways_to_intersect_keys(spark):
    from skerry.operators import sets

    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (None, "a"), (None, "b"), (3, "c")], "k int, t string")
    one_pass = sets.common_keys(df, ["k"], "t", ["a", "b"]).collect()
    slices = sets.key_intersection([df.filter(F.col("t") == v) for v in ("a", "b")], ["k"]).collect()
    assert {r["k"] for r in one_pass} == {r["k"] for r in slices} == {1, None}


def test_a_missing_dataset_name_is_a_dataset(spark):
    from skerry.operators import rows

    df = spark.createDataFrame([("a", 1.0), ("a", 500.0), (None, 2.0)], "d string, v double")
    got = {(r["d"], r["v"]): r["route"] for r in rows.gate_routes(df, ["d"], "v", 0, 300).collect()}
    assert got == {("a", 1.0): "quarantine", ("a", 500.0): "quarantine", (None, 2.0): "publish"}


def test_a_later_line_like_the_header_is_a_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\nid,name\n2,y\n")
    (tmp_path / "b.csv").write_text("name,id\nz,3\n")
    (tmp_path / "c.csv").write_text("id\n4\n")
    lines = spark.read.text(str(tmp_path)).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block_start")
    )
    rows, skipped = files.csv_by_header(lines, ["id", "name"], ["name"])
    assert sorted((r["id"], r["name"]) for r in rows.collect()) == [("1", "x"), ("2", "y"), ("3", "z"), ("id", "name")]
    assert skipped.count() == 1
