"""Literal cases and brute force comparisons for the operators."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from skerry.operators import (
    aggregates as agg,
    joins,
    ordering,
    quality as q,
    ranking,
    rows,
    sets,
    statistics as stats,
    warehouse as w,
    windows,
)
from skerry.sources import files, payloads

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def magnitudes(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "m double")


def b_brute(values, start=None):
    """Slope of the closed least squares formula over counts at and above each half step below the maximum."""
    if len(values) < 2:
        return 0.0
    top, step = max(values), (math.floor(min(values) * 2) / 2 if start is None else start)
    pairs = []
    while step < top:
        if above := [v for v in values if v >= step]:
            pairs.append((step, math.log10(len(above))))
        step += 0.5
    n, sx, sy = len(pairs), sum(x for x, _ in pairs), sum(y for _, y in pairs)
    spread = sum(x * x for x, _ in pairs) * n - sx * sx
    return -(sum(x * y for x, y in pairs) * n - sx * sy) / spread if n > 1 else 0.0


def test_b_value_cases(spark):
    sample = [4.0] * 100 + [4.5] * 30 + [5.0] * 10 + [5.5] * 3 + [6.0]
    got = stats.b_value(magnitudes(spark, sample), "m").first()
    assert 0.5 < got.b_value < 2.0
    assert got.b_value == pytest.approx(b_brute(sample))
    assert stats.b_value(magnitudes(spark, []), "m").first().b_value == 0.0
    assert stats.b_value(magnitudes(spark, [5.0]), "m").first().b_value == 0.0


@FEW
@given(st.lists(st.integers(30, 75).map(lambda i: i / 10), min_size=2, max_size=40))
def test_b_value_is_the_definition(spark, values):
    assert stats.b_value(magnitudes(spark, values), "m").first().b_value == pytest.approx(b_brute(values), abs=1e-9)
    fixed = [v for v in values if v >= 4.0]
    if len(fixed) >= 2:
        assert stats.b_value(magnitudes(spark, values), "m", start=4.0).first().b_value == pytest.approx(
            b_brute(fixed, 4.0), abs=1e-9
        )


def pearson(spark, x, y):
    return stats.pearson_safe(spark.createDataFrame(list(zip(x, y)), "x double, y double"), "x", "y").first()


def test_pearson_cases(spark):
    perfect = pearson(spark, [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0, 8.0])
    assert perfect.r == pytest.approx(1.0) and perfect.n == 4
    assert pearson(spark, [1.0, 2.0], [1.0, 2.0]).r is None
    assert pearson(spark, [1.0, 1.0, 1.0, 1.0], [1.0, 2.0, 3.0, 4.0]).r is None
    gap = pearson(spark, [1.0, 2.0, math.nan, 4.0], [1.0, 2.0, 3.0, 5.0])
    assert gap.n == 3 and gap.r is not None
    assert pearson(spark, [math.inf, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 5.0]).n == 3


def test_pearson_values(spark):
    rng = random.Random(3)
    x = [rng.random() for _ in range(50)]
    y = [v + rng.random() for v in x]
    got, r = pearson(spark, x, y), float(np.corrcoef(x, y)[0, 1])
    t = r * math.sqrt(48 / (1 - r * r))
    assert got.r == pytest.approx(r)
    assert got.t_stat == pytest.approx(t)
    assert got.p_approx == pytest.approx(2 * (1 - min(0.9999, abs(t) / math.sqrt(50))))


def trend(spark, points):
    return stats.linear_trend(spark.createDataFrame(points, "x double, y double"), "x", "y").first()


def test_trend_cases(spark):
    rising = [(2000.0 + 5 * i, 5.0 + 0.5 * i) for i in range(5)]
    assert trend(spark, rising).trend_per_decade == pytest.approx(1.0)
    assert trend(spark, [(2000.0, 5.0), (2001.0, 5.0), (2002.0, 5.0)]).slope == pytest.approx(0.0)
    assert tuple(trend(spark, [(2000.0, 5.0)])) == (0.0, 0.0, 0.0)
    assert tuple(trend(spark, [])) == (0.0, 0.0, 0.0)


def test_error_metrics_without_pairs(spark):
    got = stats.error_metrics(spark.createDataFrame([(1.0, None)], "p double, a double"), "p", "a").first()
    assert tuple(got) == (0.0, 0.0, 0.0, 0)


def test_correlation_with_constant_column(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 4.0)], "a double, b double")
    got = {(r.x, r.y): r.r for r in stats.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] == pytest.approx(1.0)


@FEW
@given(st.lists(st.integers(-5, 30), min_size=1, max_size=60))
def test_ranks_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    ranks = sorted({1, (len(values) + 1) // 2, len(values)})
    assert ordering.values_at_ranks(df, {"v": ranks})["v"] == tuple(sorted(values)[rank - 1] for rank in ranks)


def test_median_of_skewed_values(spark):
    values = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 10).alias("v"))
    want = float(np.median([7.0 if i % 3 == 0 else i / 10 for i in range(30_000)]))
    got = stats.describe_columns(values, ["v"]).first()
    assert got.median == want and got["count"] == 30_000


def burst_brute(events, span, least):
    out = {}
    for cell in {c for c, _ in events}:
        times = sorted(t for c, t in events if c == cell)
        for t in times:
            n = sum(t <= u <= t + span for u in times)
            if n >= least:
                out[cell] = (t, n)
                break
    return out


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 400)), min_size=1, max_size=60), st.integers(2, 4))
def test_bursts_are_the_definition(spark, events, least):
    df = spark.createDataFrame(events, "cell string, s int").withColumn("ts", F.timestamp_seconds("s"))
    found = windows.burst_clusters(df, ["cell"], "ts", span_seconds=24, min_count=least)
    got = {r.cell: (r.s, r["count"]) for r in found.select("cell", F.unix_seconds("start").alias("s"), "count").collect()}
    assert got == burst_brute(events, 24, least)


def series(spark, n=400):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.7 else "cold", i, None if rng.random() < 0.3 else rng.random()) for i in range(n)]
    return spark.createDataFrame(data, "k string, i int, v double")


def test_slices_do_not_change_windows(spark):
    df, cut = series(spark), F.floor(F.col("i") / 23)
    for plain, sliced in (
        (ordering.previous_value(df, ["k"], "i", "v", "p"), ordering.previous_value(df, ["k"], "i", "v", "p", cut)),
        (ordering.carry_forward(df, ["k"], "i", ["v"]), ordering.carry_forward(df, ["k"], "i", ["v"], cut)),
        (ordering.positions(df, ["k"], [F.col("i")], "n"), ordering.positions(df, ["k"], [F.col("i")], "n", cut)),
    ):
        order = ["k", "i"]
        assert plain.orderBy(*order).collect() == sliced.select(plain.columns).orderBy(*order).collect()


def test_latest_per_key_is_per_column(spark):
    df = spark.createDataFrame([("a", 1, 5.0, "x"), ("a", 2, None, "y"), ("a", 3, None, None)], "k string, i int, v double, s string")
    assert tuple(agg.latest_per_key(df, ["k"], [F.col("i")], ["v", "s"]).first()) == ("a", 5.0, "y")


def test_argmax_takes_first_label_on_ties(spark):
    df = spark.createDataFrame([("g", "b", 2.0), ("g", "a", 2.0), ("g", "c", math.nan)], "g string, l string, v double")
    assert agg.argmax_by(df, ["g"], "v", "l").first().l == "a"


def test_worst_category_defaults_to_the_mildest(spark):
    df = spark.createDataFrame([("x", "Poor"), ("x", "Good"), ("y", None), ("z", "odd")], "e string, c string")
    got = {r.e: (r.worst_category, r.advisory) for r in agg.worst_category(df, "e", "c", ["Poor", "Good"], {"Poor": "stay in"}).collect()}
    assert got == {"x": ("Poor", "stay in"), "y": ("Good", "No data available."), "z": ("Good", "No data available.")}


def test_crosstab_drops_values_outside(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 15.0), ("b", 5.0), ("b", 99.0)], "r string, v double")
    got = {r.r: (r.lo, r.hi, r.All) for r in agg.crosstab_margins(df, "r", "v", (0, 10, 20), ("lo", "hi")).collect()}
    assert got == {"a": (1, 1, 2), "b": (1, 0, 1), "All": (2, 1, 3)}


def test_hourly_cycle_without_data(spark):
    df = spark.createDataFrame([], "ts timestamp, v double")
    assert tuple(agg.hourly_cycle(df, "ts", "v").first()) == (0, 0, 0.0, 0.0)


def test_minmax_of_constant_is_fifty(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0), (None, 4.0)], "a double, b double")
    got = sorted(tuple(r) for r in windows.minmax_scale(df, ["a", "b"]).select("a_norm", "b_norm").collect())
    assert got == [(50.0, 0.0), (50.0, 50.0), (50.0, 100.0)]


def test_rolling_waits_for_a_full_frame(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(4)], "i int, v double")
    got = [r.v_vol for r in windows.rolling_volatility(df, "i", ["v"], n=3, periods=1).orderBy("i").collect()]
    assert got[:2] == [None, None] and got[3] == pytest.approx(np.std([1, 4, 9], ddof=1))


def test_zscore_of_constant_has_no_outliers(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "v double")
    assert windows.zscore_outliers(df, "v").count() == 0


def test_split_valid(spark):
    data = [("ok", 20.0), (None, 20.0), ("hot", 100.0), ("gap", None)]
    df = spark.createDataFrame(data, "station string, temperature_c double")
    good, bad = rows.split_valid(df, ["station", "temperature_c"], {"temperature_c": (-50, 60)})
    assert [r.station for r in good.collect()] == ["ok"] and bad.count() == 3
    good, _ = rows.split_valid(df, ["station"], {"temperature_c": (0, 30)})
    assert good.count() == 1
    good, bad = rows.split_valid(df, ["absent"], {})
    assert good.count() == 0 and bad.count() == 4


def test_regex_gate_keeps_rows(spark):
    df = spark.createDataFrame([("22.5",), ("ERR",), ("-5.0",), ("99",), ("1.2.3",)], "raw string")
    got = [(r.value_numeric, r.is_valid) for r in rows.regex_gated_cast(df, "raw", "^-?[0-9.]+$", -50, 60).collect()]
    assert got == [(22.5, True), (None, False), (-5.0, True), (99.0, False), (None, False)]


def test_bbox_counts_missing_as_zero(spark):
    df = spark.createDataFrame([(None, None), (50.0, 5.0), (-1.0, 0.0)], "lat double, lon double")
    assert rows.bbox_filter(df, "lat", "lon", (0, 60, 0, 10)).count() == 2


def test_limits_from_a_table(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 5.0)], "k string, v double")
    limits = spark.createDataFrame([("a", 4.0), ("b", 5.0)], "k string, limit double")
    got = {r.k: r.exceeds for r in rows.exceeds_threshold(df, "k", "v", limits).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_missing_dates_of_everything(spark):
    df = spark.sql("SELECT explode(array(DATE '2024-01-01', DATE '2024-01-02', DATE '2024-01-09')) AS day")
    got = joins.missing_dates(df, "day").first()
    assert (got.expected_days, got.missing_days) == (9, 6)
    assert got.first_missing == "2024-01-03,2024-01-04,2024-01-05,2024-01-06,2024-01-07"


def test_outer_chain_coalesces_keys(spark):
    frames = [spark.createDataFrame([(k, 1)], f"k string, v{i} int") for i, k in enumerate("ab")]
    got = sorted(tuple(r) for r in joins.join_outer_chain(frames, ["k"]).collect())
    assert got == [("a", 1, None), ("b", None, 1)]


def test_combine_scores_counts_absent_as_zero(spark):
    sea = spark.createDataFrame([("x", 100.0), ("y", 50.0)], "k string, a double")
    river = spark.createDataFrame([("x", 50.0), ("z", 100.0)], "k string, b double")
    got = {r.k: (r.composite, r.category) for r in joins.combine_scores(sea, river, "k", ("a", "b"), (0.6, 0.4), [(25, "Low"), (50, "Moderate")], "High").collect()}
    assert got == {"x": (80.0, "High"), "y": (30.0, "Moderate"), "z": (40.0, "Moderate")}


def test_edges_are_undirected(spark):
    df = spark.createDataFrame([("N", ["S", "F"]), ("S", ["N"]), ("I", [])], "code string, borders array<string>")
    edges = joins.edges_undirected(df, "code", "borders")
    assert sorted(tuple(r) for r in edges.collect()) == [("F", "N"), ("N", "S")]
    assert sorted(r[0] for r in joins.graph_nodes(df, "code", edges).collect()) == ["F", "I", "N", "S"]


def test_first_match_prefers(spark):
    df = spark.createDataFrame([("q", "SE", 1), ("q", "NO", 2), ("r", "SE", 5), ("r", "DK", 9)], "term string, cc string, pos int")
    got = {r.term: (r.cc, r.reason) for r in ranking.first_match(df, "term", F.col("cc") == "NO", [F.col("pos")], ("filter", "first")).collect()}
    assert got == {"q": ("NO", "filter"), "r": ("SE", "first")}


def test_concat_common_takes_what_is_there(spark):
    a = spark.createDataFrame([(1, "x")], "k int, only_a string")
    b = spark.createDataFrame([(2, 9)], "k int, v int")
    out = sets.concat_common([a, b], ["k", "v", "nothing"])
    assert out.columns == ["k", "v"] and sorted(tuple(r) for r in out.collect()) == [(1, None), (2, 9)]


def scd(spark, current, previous):
    frames = [spark.createDataFrame(x, "code string, population long") for x in (current, previous)]
    out = w.scd2_merge(frames[0], frames[1], "code", ["population"], "2024-01-01", "2025-01-01")
    return sorted((r.code, r.population, str(r.valid_from), str(r.valid_to), r.is_current) for r in out.collect())


def test_scd_cases(spark):
    open_end = "9999-12-31"
    assert scd(spark, [("NOR", 5)], [("NOR", 5)]) == [("NOR", 5, "2024-01-01", open_end, True)]
    assert scd(spark, [("NOR", 6)], [("NOR", 5)]) == [
        ("NOR", 5, "2024-01-01", "2025-01-01", False), ("NOR", 6, "2025-01-01", open_end, True),
    ]
    assert len(scd(spark, [("NOR", 5), ("SWE", 9)], [("SWE", 8), ("NOR", 5)])) == 3
    assert scd(spark, [("NEW", 1)], [("OLD", 2)]) == [
        ("NEW", 1, "2025-01-01", open_end, True), ("OLD", 2, "2024-01-01", "2025-01-01", False),
    ]
    assert scd(spark, [], []) == []


def test_scd_missing_values_are_equal(spark):
    out = scd(spark, [("X", None)], [("X", None)])
    assert len(out) == 1 and out[0][4]


def test_validate_scd_finds_faults(spark):
    dim = spark.sql("""
        SELECT 'a' AS k, DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current
        UNION ALL SELECT 'a', DATE '2025-01-01', DATE '2024-01-01', TRUE""")
    fact = spark.createDataFrame([("a",), ("ghost",)], "k string")
    got = {r.check_name: r.passed for r in w.validate_scd(dim, fact, "k").collect()}
    assert got == {"scd_has_current": True, "no_orphan_keys": False, "date_range_validity": False, "one_current_per_key": False}


def only(df):
    rows_ = df.collect()
    assert len(rows_) == 1
    return rows_[0].passed, rows_[0].severity


def test_check_verdicts(spark):
    df = spark.createDataFrame([(1, 5.0), (2, math.nan), (3, 50.0), (4, None)], "k int, v double")
    assert only(q.check_schema(df, ["k", "v"])) == (True, "info")
    assert only(q.check_schema(df, ["k"])) == (True, "warning")
    assert only(q.check_schema(df, ["k", "x"])) == (False, "critical")
    assert only(q.check_bounds(df, "v", 0, 100)) == (True, "info")
    assert only(q.check_bounds(df, "v", 0, 10)) == (False, "warning")
    assert only(q.check_bounds(df, "x", 0, 10)) == (False, "critical")
    assert only(q.check_nulls(df, ["v"], 50.0)) == (True, "info")
    assert only(q.check_nulls(df, ["v"], 49.0)) == (False, "warning")
    assert only(q.check_nulls(df, ["x"], 100.0)) == (False, "warning")
    assert only(q.check_nulls(df.limit(0), ["v"], 0.0)) == (True, "info")
    assert only(q.check_row_count(df, 1, 10)) == (True, "info")
    assert only(q.check_row_count(df, 5, 10)) == (False, "critical")
    assert only(q.check_row_count(df, 1, 3)) == (False, "warning")
    assert only(q.check_date_coverage(df, "day")) == (False, "critical")


def test_report_counts(spark):
    checks = spark.createDataFrame(
        [("a", True, "d", "info"), ("b", False, "d", "warning"), ("c", False, "d", "critical")],
        "check_name string, passed boolean, details string, severity string",
    ).withColumn("category", F.lit("all"))
    total = q.score_report(checks, "category").filter("category IS NULL").first()
    assert (total.total, total.passed, total.failed, total.warnings, total.critical, total.overall) == (3, 1, 2, 1, 1, "FAIL")
    lines = [r.line for r in q.report_lines(checks).collect()]
    assert lines[0] == "Total checks: 3" and lines[-1] == "Overall: FAIL"
    assert any("[PASS] [INFO] a" in line for line in lines) and any("[FAIL] [CRITICAL] c" in line for line in lines)


def test_file_checks(spark):
    listing = spark.sql("SELECT 'new' AS path, 100L AS size, TIMESTAMP '2024-01-01 11:59:00' AS modified UNION ALL SELECT 'old', 5L, TIMESTAMP '2024-01-01 10:00:00'")
    expected = spark.createDataFrame([("new", 3600, 10), ("old", 3600, 10), ("gone", 3600, 10)], "path string, max_age_s long, min_size long")
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    fresh = {r.path: (r.passed, r.severity) for r in q.check_freshness(listing, expected, now).collect()}
    assert fresh == {"new": (True, "info"), "old": (False, "warning"), "gone": (False, "critical")}
    flags = q.check_files(listing, expected, now)
    got = {r.path: (r.present, r.fresh, r.size_ok) for r in flags.collect()}
    assert got == {"new": (True, True, True), "old": (True, False, False), "gone": (False, False, False)}
    assert tuple(q.health(flags).first()) == (5, 9, "CRITICAL")
    assert q.health(flags.filter("path = 'new'")).first().status == "HEALTHY"
    assert q.health(flags.filter("path = 'old'")).first().status == "DEGRADED"


def test_require_nonempty(spark):
    q.require_nonempty({"a": spark.range(1)})
    with pytest.raises(ValueError, match="b"):
        q.require_nonempty({"a": spark.range(1), "b": spark.range(0)})


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "doc string")


def test_envelope_pages(spark):
    record = "id: string, value: double"
    pages = payloads.envelope_pages(docs(
        spark, '[{"page":1,"pages":3},[{"id":"a","value":1.5}]]', '[{"page":2,"pages":3},[{"id":"b","value":null}]]',
        '[{"page":3,"pages":3},null]',
    ), "doc", record)
    assert sorted(tuple(r) for r in payloads.page_records(pages).collect()) == [("a", 1.5), ("b", None)]
    assert payloads.page_completeness(pages).first().complete
    assert payloads.page_records(pages.filter("page = 3")).count() == 0
    assert not payloads.page_completeness(pages.filter("page < 3")).first().complete


def test_features_with_short_coordinates(spark):
    flat = payloads.flatten_features(docs(
        spark,
        '{"geometry":{"type":"Point","coordinates":[1.0,2.0,10.0]},"properties":{"mag":5.0}}',
        '{"geometry":{"type":"Point","coordinates":[1.0,2.0]},"properties":{"mag":4.0}}',
        '{"properties":{"mag":3.0}}',
    ), "doc", "mag: double")
    assert [tuple(r) for r in flat.collect()] == [(1.0, 2.0, 10.0, 5.0), (1.0, 2.0, 0.0, 4.0), (0.0, 0.0, 0.0, 3.0)]


def test_intensity_without_object(spark):
    got = payloads.flatten_intensity(docs(spark, '{"from":"a","to":"b","intensity":{"forecast":1,"actual":2,"index":"low"}}', '{"from":"c","to":"d"}'), "doc")
    assert [tuple(r) for r in got.collect()] == [("a", "b", 1.0, 2.0, "low"), ("c", "d", None, None, None)]


def test_empty_mix_gives_no_rows(spark):
    df = spark.sql("SELECT 'a' AS k, array(named_struct('fuel', 'gas', 'perc', 10.0D), named_struct('fuel', 'wind', 'perc', 90.0D)) AS mix UNION ALL SELECT 'b', array()")
    assert payloads.explode_mix(df, ["k"], "mix").count() == 2


def test_envelope_without_key_gives_no_rows(spark):
    out = payloads.explode_records(docs(spark, '{"value":[{"a":1}]}', '{"other":[{"a":2}]}'), "doc", "value", "a: int")
    assert [tuple(r) for r in out.collect()] == [(1,)]


def test_split_records(spark):
    df = spark.createDataFrame([("oslo:12.5:68|bergen:x",)], "t string")
    got = payloads.split_records(df, "t", "|", ":", {"city": "string", "temp": "double", "hum": "int"})
    assert [tuple(r) for r in got.collect()] == [("oslo", 12.5, 68), ("bergen", None, None)]


def test_csv_by_header_takes_any_order(spark):
    lines = spark.createDataFrame([
        ("f1", 0, "a,b"), ("f1", 0, '1,"x, y"'), ("f1", 0, "2,"), ("f2", 0, "b,c,a"), ("f2", 0, "z,9,3"), ("f3", 0, "b"), ("f3", 0, "q"),
    ], "source_file string, block_start long, value string").coalesce(1)
    table, skipped = files.csv_by_header(lines, ["a", "b"], ["a"])
    got = sorted((r.source_file, r.a, r.b) for r in table.collect())
    assert got == [("f1", "1", "x, y"), ("f1", "2", None), ("f2", "3", "z")]
    assert [tuple(r) for r in skipped.collect()] == [("f3", "missing columns: a")]


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 0, 1), (2, "b", 1, 1)], "k int, v string, part int, n int")
    change = spark.createDataFrame([(2, "old", 1, 2), (2, "c", 1, 3), (3, "d", 1, 1)], first.schema)
    for updates in (first, change, change):
        files.upsert_partitions(updates, path, ["k"], "part", [F.col("n")])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_unknown_format_is_csv(spark, tmp_path):
    assert files.write_dataset(spark.range(3), str(tmp_path / "x"), "xml") == {"rows": 3, "columns": 1}
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).count() == 3
