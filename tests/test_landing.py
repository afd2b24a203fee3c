"""Landed files: quoted records over lines and blocks, unusable files, moved originals."""

from __future__ import annotations

import csv
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from skerry.operators.rows import numeric_fault
from skerry.sources import delimited, files
from skerry.streaming import landing as ld
from tests.test_streaming import replay_last_batch


def lines_of(spark, path, block=None):
    """Text lines as the streams read them, in blocks of about `block` bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        if block:
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
        read = spark.read.option("lineSep", "\n").text(str(path)).select(
            "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block_start")
        )
        return read.persist(), read.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def table(rng, rows):
    words = ["plain", "a, b", 'say "yes"', "two\nlines", '"', '""', "end\n", "\nstart", "three\n\n\nlines", "", " ", 'x"y', "é,\n\"漢\"", "1,2\n3,4"]
    return [[str(i), rng.choice(words) + rng.choice(["", "", "!"]), rng.choice(words)] for i in range(rows)]


def bare(cell):
    return cell.strip(" ") or None


@pytest.mark.parametrize(("seed", "block", "end"), [(1, 150, "\n"), (2, 400, "\r\n"), (4, None, "\n")])
def test_cells_keep_line_breaks_over_blocks(spark, tmp_path, seed, block, end):
    rng, want = random.Random(seed), []
    for name in "abc":
        order = rng.sample([0, 1, 2], 3)
        rows = table(rng, 40)
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end)
        writer.writerow([["id", "left", "right"][i] for i in order])
        for row in rows:
            writer.writerow([row[i] for i in order])
        (tmp_path / f"{name}.csv").write_bytes(out.getvalue().encode())
        # A record's own last carriage return cannot be told from the line's.
        want += [(name, *map(bare, r)) for r in rows]
    lines, parts = lines_of(spark, tmp_path, block)
    assert block is None or parts > 5
    got, skipped = delimited.csv_by_header(lines, ["id", "left", "right"], ["id"], strict=True)
    name = F.regexp_extract("source_file", "([a-c]).csv$", 1)
    found = [tuple(r) for r in got.select(name.alias("f"), "id", "left", "right").collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and skipped.count() == 0


def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,5" pipe\n2,"ok"\n3,say "hi" there\n4,"a"b\n5,"",\n6,""\n7,""""\n8,  "in"  \n9,"x""y"\n')
    lines, _ = lines_of(spark, tmp_path)
    got, _ = delimited.csv_by_header(lines, ["id", "note"], ["id"])
    assert dict(map(tuple, got.drop("source_file").collect())) == {
        "1": '5" pipe', "2": "ok", "3": 'say "hi" there', "4": "ab", "5": None, "6": None, "7": '"', "8": "in", "9": 'x"y',
    }


def test_many_quotes_in_one_line(spark, tmp_path):
    long = '"' + '""x' * 200_000 + '"'
    (tmp_path / "a.csv").write_text(f"id,note\n1,{long}\n2,b\n" + ",".join('"c"' for _ in range(20_000)) + "\n")
    lines, _ = lines_of(spark, tmp_path)
    got, _ = delimited.csv_by_header(lines, ["id", "note"], ["id"])
    rows = {r["id"]: r["note"] for r in got.collect()}
    assert rows["1"] == '"x' * 200_000 and rows["2"] == "b" and rows["c"] == "c"


def test_unclosed_cell_swallows_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"two\nlines"\n2,"never\n' + "".join(f"{i},x\n" for i in range(500)))
    (tmp_path / "b.csv").write_text("id,note\n7,y\n")
    lines, _ = lines_of(spark, tmp_path, 256)
    whole = delimited.whole_records(lines.withColumn("line", F.monotonically_increasing_id()))
    found = whole.where("source_file LIKE '%a.csv'").collect()
    assert len(found) == 503 and [r["value"] for r in found if r["unclosed"]] == ['2,"never']
    got, skipped = delimited.csv_by_header(lines, ["id"], ["id"])
    assert [r["id"] for r in got.collect()] == ["7"] and [r["reason"] for r in skipped.collect()] == ["a quoted cell is never closed"]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_both_ways_to_join_the_blocks(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(delimited, "BROADCAST_BLOCKS", limit)
    (tmp_path / "a.csv").write_text("id,note\n" + "".join(f'{i},"a\n{i}"\n' for i in range(300)))
    lines, _ = lines_of(spark, tmp_path, 100)
    got, _ = delimited.csv_by_header(lines, ["id", "note"], ["id"])
    assert {r["id"]: r["note"] for r in got.collect()} == {str(i): f"a\n{i}" for i in range(300)}


def bad_files(folder):
    folder.mkdir(exist_ok=True)
    (folder / "good.csv").write_text('k,v\n1,5\n2,word\n3,"7"\n"4\n4",8\n')
    (folder / "empty.csv").write_bytes(b"")
    (folder / "binary.csv").write_bytes(b"k,v\n1,2\n" + b"x" * 200_000 + b"\n\x00\xff\xfe\n3,4\n")
    (folder / "latin.csv").write_bytes("k,v\n1,caf\xe9\n2,3\n".encode("latin-1"))
    (folder / "cut.csv").write_text("k,v\n1,2\n2,3\n3")
    (folder / "open.csv").write_text('k,v\n1,2\n2,"3\n3,4\n')
    (folder / "lacks.csv").write_text("k,w\n1,2\n")
    (folder / "head only.csv").write_text("k,v\n")


REASONS = {
    "empty.csv": "empty file", "binary.csv": "not a text file", "latin.csv": "not UTF-8 text", "cut.csv": "the last record is cut off",
    "open.csv": "a quoted cell is never closed", "lacks.csv": "missing columns: v",
}


def test_unusable_files_are_dead_letters(spark, tmp_path):
    landing, out, state, aside = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state", tmp_path / "aside"
    bad_files(landing)

    def run():
        rules = {"not numeric": numeric_fault("v")}
        ld.stream_quarantine(spark, str(landing), out, str(state), ["k", "v"], ["k", "v"], rules, str(aside))
        clean, rejected, dead = (spark.read.parquet(f"{out}/{n}").collect() for n in ("clean", "rejected", "dead_letters"))
        return sorted(r["k"] for r in clean), len(rejected), sorted((r["source_file"].split("/")[-1], r["reason"]) for r in dead)

    want = ["1", "3", "4\n4"], 1, sorted(REASONS.items())
    assert run() == want
    moved = {p.name for p in aside.iterdir() if not p.name.startswith(".")}
    assert {re.sub(r"^\d{8}T\d{6}_", "", n) for n in moved} == {x for n in REASONS for x in (n, f"{n}.reason")}
    assert all(re.match(r"^\d{8}T\d{6}_", n) for n in moved)
    assert {p.name for p in landing.iterdir() if p.suffix == ".csv"} == {"good.csv", "head only.csv"}
    told = next(p for p in aside.iterdir() if p.name.endswith("_cut.csv.reason")).read_text()
    assert "file: cut.csv" in told and "reason: the last record is cut off" in told
    assert run() == want  # nothing new
    (landing / "empty2.csv").write_bytes(b"")
    (landing / "more.csv").write_text("v,k\n9,5\n")
    clean, rejected, dead = run()
    assert clean == ["1", "3", "4\n4", "5"] and rejected == 1 and dead == sorted([*REASONS.items(), ("empty2.csv", "empty file")])


def test_replay_before_the_files_have_moved(spark, tmp_path, monkeypatch):
    landing, out, state, aside = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state", tmp_path / "aside"
    bad_files(landing)

    def run():
        ld.stream_quarantine(spark, str(landing), out, str(state), ["k", "v"], ["k", "v"], {"not numeric": numeric_fault("v")}, str(aside))

    with monkeypatch.context() as patch:
        patch.setattr(ld, "move_listed", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            run()
    replay_last_batch(state)
    run()
    assert spark.read.parquet(f"{out}/clean").count() == 3 and spark.read.parquet(f"{out}/dead_letters").count() == len(REASONS)
    assert sum(p.name.endswith(".reason") for p in aside.iterdir() if not p.name.startswith(".")) == len(REASONS)


def test_landing_zone_writes_by_file_and_archives_the_last_batch(spark, tmp_path):
    landing, out, state, archive = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state", tmp_path / "archive"
    landing.mkdir()

    def run():
        ld.stream_landing_zone(spark, str(landing), out, str(state), ["k", "v"], ["k"], lambda df: df, str(archive))
        return sorted(re.sub(r"^\d{8}T\d{6}_", "", p.name) for p in archive.iterdir() if not p.name.startswith("."))

    (landing / "a.csv").write_text('k,v\n1,"x\ny"\n2,z\n')
    (landing / "b.csv").write_text("v,k\nq,3\n")
    (landing / "none.csv").write_text("w\n1\n")
    assert run() == ["a.csv", "b.csv"]
    assert {p.name for p in landing.iterdir() if p.suffix == ".csv"} == {"none.csv"}
    by_file = spark.read.parquet(f"{out}/rows").groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in by_file} == {"a.csv": 2, "b.csv": 1}
    (landing / "c.csv").write_text("k,v\n4,again\n")
    assert run() == ["a.csv", "b.csv", "c.csv"]
    assert sorted(r["k"] for r in spark.read.parquet(f"{out}/rows").collect()) == ["1", "2", "3", "4"]


def test_faults_behind_the_first_bytes_are_found(spark, tmp_path):
    """A file is judged by all it holds, and gives no rows if it cannot be read to its end."""
    big = tmp_path / "big.parquet"
    spark.range(200_000).withColumn("name", F.uuid()).withColumnRenamed("id", "id").coalesce(1).write.parquet(str(tmp_path / "w"))
    source = next((tmp_path / "w").glob("*.parquet"))
    raw = bytearray(source.read_bytes())
    middle = len(raw) // 2
    raw[middle : middle + 60_000] = b"\x13" * 60_000
    for p in (tmp_path / "w").iterdir():
        p.unlink()
    big.write_bytes(bytes(raw))
    (tmp_path / "late.csv").write_bytes(b"id,name\n" + b"1,x\n" * 50_000 + b"2,\x00\n")
    (tmp_path / "zero.json").write_bytes(b"")
    (tmp_path / "ok.csv").write_text("id,name\n5,y\n")
    faults = {r["name"]: r["reason"].split(":")[0] for r in files.skipped_files(spark, str(tmp_path)).collect()}
    assert faults == {"big.parquet": "unreadable data", "late.csv": "not a text file", "zero.json": "empty file"}
    assert [(r["id"], r["name"]) for r in files.scan_lenient(spark, str(tmp_path), "id bigint, name string").collect()] == [(5, "y")]
