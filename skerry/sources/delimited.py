"""Delimited text of many files, whose quoted cells may hold commas and line breaks.

Text files come to tasks in blocks, cut at line feeds, so a record with a line
break in a cell arrives as several lines, perhaps in several blocks. Whether a
cell is open where a line begins depends on all lines before it, but each line
only turns one bit into another. That step is found for both values of the bit
(`open_ends`), steps are joined over the lines of a block and then over the blocks
of a file, and blocks that hold no open cell pass as they are: only the text of
the others is sorted by block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.workspace import pin

# Stands for two quotes in a row while cells are cut; no text holds it.
NUL = "\0"
# One cell and the comma before it: in quotes, with whatever stands behind them, or plain. Nothing in it backtracks.
CELL = r',((?>\s*+\x00*+"[^"]*+"?+[^,]*+)|[^,]*+)'
# Blocks with open cells up to this number are a broadcast side of a few megabytes; more are joined by sorting.
BROADCAST_BLOCKS = 20_000


def open_ends(text: Column) -> Column:
    """struct(closed, opened): whether a cell is open after the line, if none was before it, and if one was.

    Two quotes in a row change nothing. A single one closes an open cell; it opens
    one at the start of a cell only, elsewhere it is a character like others.
    """
    pieces = F.split(F.replace(text, F.lit('""'), F.lit("")), '"')
    before = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def step(at: Column, piece: Column) -> Column:
        starts = (at["first"] & (F.trim(piece) == "")) | piece.rlike(r",\s*$")
        return F.struct(
            (~at["closed"] & starts).alias("closed"), (~at["opened"] & starts).alias("opened"), F.lit(False).alias("first")
        )

    start = F.struct(F.lit(False).alias("closed"), F.lit(True).alias("opened"), F.lit(True).alias("first"))
    return F.when(F.contains(text, F.lit('"')), F.aggregate(before, start, step)).otherwise(start)


def join_steps(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """What `open_before` needs: the last row before this one whose step forgets its start, and the flips since and in all."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum((F.col("closed") & ~F.col("opened")).cast("int")).over(before), F.lit(0))
    fixed = F.when(F.col("closed") == F.col("opened"), F.struct(F.col("closed").alias("to"), F.col("__flips").alias("flips")))
    return df.withColumn("__flips", flips).withColumn("__fixed", F.last(fixed, ignorenulls=True).over(before))


def open_before(start: Column) -> Column:
    """Whether a cell is open before the row, given whether one was before the first row of its group."""
    since = (F.col("__flips") - F.col("__fixed.flips")) % 2 == 1
    return F.when(F.col("__fixed").isNotNull(), F.col("__fixed.to") != since).otherwise(start != (F.col("__flips") % 2 == 1))


def open_after(before: Column) -> Column:
    return F.when(before, F.col("opened")).otherwise(F.col("closed"))


def _broken_blocks(lines: DataFrame, file: str, at: str) -> DataFrame:
    """Blocks in which a cell is open at some line's end: (file, at, start, before, lost).

    `start`: a cell is open at the block's start; `before`: cells opened over a
    line's end in earlier blocks of the file; `lost`: the number of the one that
    is never closed.
    """
    steps = lines.where(F.contains("value", F.lit('"'))).select(file, at, "line", open_ends(F.col("value")).alias("s")).select(
        file, at, "line", "s.closed", "s.opened"
    )
    joined = join_steps(steps.where(F.col("closed") | ~F.col("opened")), [file, at], "line")
    either = {"closed": open_before(F.lit(False)), "opened": open_before(F.lit(True))}
    summed = joined.groupBy(file, at).agg(
        *[F.max_by(open_after(b), "line").alias(f"__{name}") for name, b in either.items()],
        *[F.count_if(~b & F.col("closed")).alias(f"__from_{name}") for name, b in either.items()],
    )
    blocks = lines.select(file, at).distinct().join(summed, [file, at], "left").select(
        file, at,
        F.coalesce("__closed", F.lit(False)).alias("closed"), F.coalesce("__opened", F.lit(True)).alias("opened"),
        *[F.coalesce(f"__from_{n}", F.lit(0)).alias(f"from_{n}") for n in either],
    )
    whole = Window.partitionBy(file)
    earlier = whole.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    start = open_before(F.lit(False))
    known = join_steps(blocks, [file], at).withColumns(
        {"start": start, "opens": F.when(start, F.col("from_opened")).otherwise(F.col("from_closed")), "end": open_after(start)}
    ).withColumns({
        "before": F.coalesce(F.sum("opens").over(earlier), F.lit(0)),
        "total": F.sum("opens").over(whole),
        "end": F.max_by("end", at).over(whole),
    })
    return known.where(F.col("start") | (F.col("opens") > 0)).select(
        file, at, "start", "before", F.when(F.col("end"), F.col("total")).alias("lost")
    )


def whole_records(lines: DataFrame, file: str = "source_file", at: str = "block_start") -> DataFrame:
    """(file, at, line, value, unclosed): one row per record of text lines (file, at, line, value).

    `line` orders the lines of a block. A record of several lines stands at its
    first one. A cell that is never closed would swallow its file, so the lines
    from its first one on stay alone, and that one is marked `unclosed`.
    """
    lines = lines.select(file, at, "line", "value")
    pin(lines.sparkSession)
    broken = _broken_blocks(lines, file, at).checkpoint()
    count = broken.count()
    if not count:
        return lines.withColumn("unclosed", F.lit(False))
    side = F.broadcast(broken) if count <= BROADCAST_BLOCKS else broken
    stepped = lines.join(side, [file, at]).withColumn("__s", open_ends(F.col("value"))).select(
        file, at, "line", "value", "start", "before", "lost", "__s.closed", "__s.opened"
    )
    inside = open_before(F.col("start"))
    opens = ~F.col("inside") & F.col("closed")
    so_far = Window.partitionBy(file, at).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        join_steps(stepped, [file, at], "line").withColumn("inside", inside)
        .withColumn("number", F.col("before") + F.sum(opens.cast("int")).over(so_far))
        .withColumn("gone", F.coalesce(F.col("number") >= F.col("lost"), F.lit(False)))
        .withColumn("part", (F.col("inside") | opens) & ~F.col("gone"))
    )
    alone = placed.where(~F.col("part")).select(file, at, "line", "value", (opens & F.col("gone")).alias("unclosed"))
    piece = F.struct(F.col(at).alias("at"), "line", "value")
    joined = placed.where("part").groupBy(file, "number").agg(F.sort_array(F.collect_list(piece)).alias("all")).select(
        file, F.col("all")[0]["at"].alias(at), F.col("all")[0]["line"].alias("line"),
        F.array_join(F.transform("all", lambda x: x["value"]), "\n").alias("value"), F.lit(False).alias("unclosed"),
    )
    untouched = lines.join(side.select(file, at), [file, at], "left_anti").withColumn("unclosed", F.lit(False))
    return untouched.unionByName(alone).unionByName(joined)


def cells(text: Column) -> Column:
    """The cells of a record, quotes and all; `cell_value` reads one."""
    masked = F.replace(F.replace(text, F.lit(NUL), F.lit("")), F.lit('""'), F.lit(NUL))
    return F.regexp_extract_all(F.concat(F.lit(","), masked), F.lit(CELL), 1)


def cell_value(raw: Column) -> Column:
    """A cell without its quotes and outer blanks; an empty one is NULL."""
    quote = lambda c: F.replace(c, F.lit(NUL), F.lit('"'))
    quoted = quote(F.regexp_replace(raw, r'(?s)^\s*(\x00*)"([^"]*)"?(.*)$', "$1$2$3"))
    # Quotes in pairs only: the first and the last one are those around the cell.
    pairs = quote(F.substr(F.trim(raw), F.lit(2)))
    bare = (
        F.when(raw.rlike(r'^\s*\x00*"'), quoted)
        .when(raw.rlike(r"^\s*\x00+\s*$"), pairs)
        .otherwise(F.replace(raw, F.lit(NUL), F.lit('""')))
    )
    return F.nullif(F.trim(bare), F.lit(""))


def text_faults(lines: DataFrame, file: str = "source_file") -> DataFrame:
    """(file, reason): files whose lines are not text, judged by all their bytes."""
    found = lines.groupBy(file).agg(
        F.max(F.contains("value", F.lit(NUL))).alias("binary"), F.max(~F.is_valid_utf8("value")).alias("encoding")
    )
    reason = F.when(F.col("binary"), "not a text file").when(F.col("encoding"), "not UTF-8 text")
    return found.select(file, reason.alias("reason")).where("reason IS NOT NULL")


def csv_by_header(
    lines: DataFrame, columns: Sequence[str], required: Sequence[str], text: str = "value", file: str = "source_file",
    at: str = "block_start", strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """CSV text lines of many files to named text columns, and (file, reason) of the files that cannot be used.

    Column positions come from each file's own header, so files may order their
    columns differently or carry extra ones. A cell that is empty or absent is
    NULL. Quoted cells may hold commas, quotes in pairs and line breaks. A file
    is unusable if it lacks a required column or never closes a cell; `strict`
    adds files that are not UTF-8 text and files whose last record has fewer
    cells than the header. Unusable files give no rows.
    """
    numbered = lines.select(
        file, at, F.monotonically_increasing_id().alias("line"), F.rtrim(F.col(text), F.lit("\r")).alias("value")
    )
    faults = None
    if strict:
        # Rubbish must not reach the cell rules, so these files go first.
        faults = text_faults(numbered, file)
        numbered = numbered.join(faults.select(file), file, "left_anti")
    place = F.struct(at, "line").alias("__place")
    records = whole_records(numbered, file, at).where(F.length(F.trim("value")) > 0).select(file, "value", "unclosed", place)
    headers = records.groupBy(file).agg(
        F.min_by("value", "__place").alias("header"), F.min("__place").alias("__first"),
        F.max_by("value", "__place").alias("last"), F.max("unclosed").alias("unclosed"),
    ).withColumn(
        "__names", F.transform(cells(F.ltrim(F.col("header"), F.lit("\ufeff"))), lambda c: F.coalesce(cell_value(c), F.lit("")))
    )
    absent = F.array_except(F.array(*[F.lit(c) for c in required]), "__names")
    reason = (
        F.when(F.size(absent) > 0, F.concat(F.lit("missing columns: "), F.array_join(absent, ", ")))
        .when(F.col("unclosed"), "a quoted cell is never closed")
    )
    if strict:
        reason = reason.when(F.size(cells(F.col("last"))) < F.size("__names"), "the last record is cut off")
    judged = headers.withColumn("reason", reason).select(file, "__names", "__first", "reason")
    body = (
        # Only the first record is the header; a later one that looks like it is a row.
        records.drop("unclosed").join(judged.where("reason IS NULL").drop("reason"), file)
        .filter(F.col("__place") != F.col("__first"))
        .withColumn("__cells", cells(F.col("value")))
    )

    def cell(name: str) -> Column:
        return cell_value(F.get("__cells", F.array_position("__names", name).cast("int") - 1)).alias(name)

    skipped = judged.where("reason IS NOT NULL").select(file, "reason")
    return body.select(file, *[cell(c) for c in columns]), skipped.unionByName(faults) if faults is not None else skipped
