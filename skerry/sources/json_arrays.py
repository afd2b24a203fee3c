"""Files that hold one JSON array of objects, read by several tasks each.

Text is cut at closing braces, so a file of any size splits into blocks. Whether a
brace closes an object or is a character of a string depends on all pieces
before it, by one bit; how deep it lies, by a sum. Both are found for each piece
alone, joined over the pieces of a block and then over the blocks of a file, and
the pieces of one element are put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skerry.sources.delimited import join_steps, open_after, open_before


def _depth(text: Column) -> Column:
    """Opening less closing brackets of a text without strings."""
    return F.length(F.regexp_replace(text, r"[^\[{]", "")) - F.length(F.regexp_replace(text, r"[^\]}]", ""))


def _steps(text: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """After a piece: whether a string is open, and the change of depth; each if none was open before it, and if one was."""
    bare = F.regexp_replace(text, r"\\.", "")  # escaped characters end no string
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    odd = quotes % 2 == 1
    # Without strings: pieces of the text between quotes, every second one is outside.
    outside = F.regexp_replace(F.regexp_replace(bare, '"[^"]*"', ""), '"[^"]*$', "")
    behind = F.when(quotes > 0, F.regexp_replace(bare, '^[^"]*"', "")).otherwise(F.lit(""))
    inside = F.regexp_replace(F.regexp_replace(behind, '"[^"]*"', ""), '"[^"]*$', "")
    return {"closed": odd, "opened": ~odd}, {"from_closed": _depth(outside), "from_opened": _depth(inside)}


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, place, value): the text of each object of the arrays, in file order by `place`.

    Values between objects that are none themselves are left out. Text behind the
    last whole object, as of a file that was cut off, gives no row.
    """
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"), F.concat("value", F.lit("}")).alias("value"),
    )
    bits, depths = _steps(F.col("value"))
    pieces = read.withColumns(bits | depths)
    start = F.lit(False)
    # Blocks first: what each does to the bit, and how deep it ends either way.
    stepped = join_steps(pieces.drop("value"), ["file", "at"], "line")
    moves = {name: open_before(F.lit(was)) for name, was in (("closed", False), ("opened", True))}
    move = lambda inside: F.when(inside, F.col("from_opened")).otherwise(F.col("from_closed"))
    blocks = stepped.groupBy("file", "at").agg(
        *[F.max_by(open_after(before), "line").alias(name) for name, before in moves.items()],
        *[F.sum(move(before)).alias(f"from_{name}") for name, before in moves.items()],
    )
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    known = (
        join_steps(blocks, ["file"], "at").withColumn("inside", open_before(start))
        .withColumn("depth", F.coalesce(F.sum(move(F.col("inside"))).over(earlier), F.lit(0)))
        .select("file", "at", F.col("inside").alias("start"), F.col("depth").alias("base"))
    )
    upto = Window.partitionBy("file", "at").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        join_steps(pieces.join(known, ["file", "at"]), ["file", "at"], "line").withColumn("inside", open_before(F.col("start")))
        .withColumn("depth", F.col("base") + F.sum(move(F.col("inside"))).over(upto))
        .withColumn("ends", (~open_after(F.col("inside")) & (F.col("depth") == 1)).cast("int"))
        .withColumn("own", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .select("file", "at", "line", "value", "ends", "own")
    )
    # Elements that ended in earlier blocks of the file.
    ended = placed.groupBy("file", "at").agg(F.sum("ends").alias("n")).select(
        "file", "at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("former")
    )
    piece = F.struct("at", "line", "value")
    joined = placed.join(ended, ["file", "at"]).groupBy("file", (F.col("former") + F.col("own")).alias("place")).agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"), F.max("ends").alias("whole")
    ).where("whole = 1")
    text = F.array_join(F.transform("pieces", lambda p: p["value"]), "")
    return joined.select(F.col("file").alias("source_file"), "place", F.regexp_replace(text, r"^[^{]*", "").alias("value"))


def scan_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that each hold one JSON array of objects, however large a file is."""
    return json_elements(spark, path).select(F.from_json("value", schema).alias("r")).select("r.*")
