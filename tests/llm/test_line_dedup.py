"""Line dedup against brute force."""

from __future__ import annotations

import random
from collections import defaultdict
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from skerry.llm.line_dedup import BLANKS, drop_repeated_lines

SCHEMA = "doc_id long, text string, kept string, doc string"


def key_of(line):
    return line.strip(BLANKS).translate(str.maketrans(ascii_uppercase, ascii_lowercase))


def brute(rows, min_chars=10, min_docs=2):
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(h := holders.get(key_of(x), ())) >= min_docs and i != min(h, key=order) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def run(spark, rows, partitions=4, **options):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in drop_repeated_lines(df, **options).collect()), key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["alpha", "Beta", "ÄRGER", "çelik"]) for _ in range(rng.randint(1, 4))) for _ in range(30)]
    for i in range(n):
        lines = [rng.choice(["", "\t", " "]) + rng.choice([str.upper, str.lower, str])(rng.choice(pool)) + rng.choice(["", "\r", "\x0b "])
                 for _ in range(rng.randint(0, 12))]
        yield i, "\n".join(lines)


def test_equals_brute_force(spark):
    rows = list(texts(1, 200))
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, min_docs=5, min_chars=4) == brute(rows, 4, 5)


def test_odd_rows(spark):
    shared = "one shared line"
    rows = [
        (5, f"{shared}\nown\n{shared}"), (5, f"{shared}\nown\n{shared}"), (5, "another text of five"), (2, f"x\n  {shared.upper()}\t"),
        (None, f"{shared}\nanother text of five"), (None, None), (7, None), (8, ""), (9, "\n\n"), (10, f"{shared}\n" * 3), (11, shared),
        (12, "ÄRGER mit Zeilen"), (13, "ärger mit zeilen"), (14, " inner blank"), (15, "inner blank"), (16, "123456789"), (17, "123456789"),
    ]
    assert run(spark, rows) == brute(rows)


def test_line_in_every_document_and_long_text(spark):
    rows = [(i, f"header of every page\nbody {i} of page") for i in range(400)]
    rows.append((1000, "\n".join(f"line number {k % 150_000}" for k in range(200_000)) + "\nheader of every page"))
    rows.append((1001, "x" * 3_000_000 + "\nline number 7"))
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_no_python_in_the_plan(spark):
    df = drop_repeated_lines(spark.createDataFrame([(1, "a", "b", "c")], SCHEMA))
    plan = df._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and df.select(F.sha2("kept", 256)).count() == 1
