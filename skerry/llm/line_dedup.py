"""Repeated lines removed across documents, in DataFrame functions only.

Lines are exploded, normalised and hashed; documents are counted per hash, lines
of hashes over the threshold go everywhere but in the smallest document, and each
text is put together again by the positions that stay.

What moves: 128-bit hashes, ids and positions of the lines long enough to count,
and each text once, for the reassembly. A hash that a third of all documents share
is counted in `salts` parts by document, and its lines meet the verdict in the
same parts, so no task holds them all.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.llm.shared import stored

BLANKS = "\t\n\x0b\x0c\r "


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case; other letters stay as they are."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), ascii_uppercase, ascii_lowercase)


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, salts: int) -> DataFrame:
    """(doc, row, at, h1, h2, salt) of each line whose key has at least `min_chars` characters."""
    line = F.col("line")
    cut = _rows(docs, id_col, text_col).select("doc", "row", F.posexplode("lines").alias("at", "line"))
    return cut.where(F.char_length(F.btrim(line, F.lit(BLANKS))) >= min_chars).select(
        "doc", "row", "at", line_key(line).alias("key"), F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int").alias("salt")
    ).select("doc", "row", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "salt")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text cut at line feeds, and what identifies a row: its document and a hash of its text.

    A missing id is one document, greater than all others.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`"),
        F.struct(F.col(f"`{id_col}`").isNull().alias("missing"), F.col(f"`{id_col}`").alias("id")).alias("doc"),
        F.xxhash64(text).alias("row"),
        F.split(text, "\n", -1).alias("lines"),
    )


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, salt, first): hashes held by at least `min_docs` documents, and the smallest of these, per part.

    Documents fall into parts by id, so their numbers per part add up. The window
    sees at most one row per part of a hash.
    """
    parts = lines.groupBy("h1", "h2", "salt").agg(F.count_distinct("doc").alias("docs"), F.min("doc").alias("least"))
    whole = Window.partitionBy("h1", "h2")
    counted = parts.withColumns({"total": F.sum("docs").over(whole), "first": F.min("least").over(whole)})
    return counted.where(F.col("total") >= min_docs).select("h1", "h2", "salt", "first")


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2, salts: int = 64
) -> DataFrame:
    """One row per row of `docs`: its id, n_lines, n_dropped and `kept`, the text without repeated lines.

    A line is repeated if its key (`line_key`) has `min_chars` characters and
    occurs in `min_docs` documents; it stays in the smallest of them, as often as
    it occurs there. NULL and empty texts are one empty line. Rows of one id are
    one document, each with its own text; rows without id are one document after
    all others. Other columns of `docs` are not read.
    """
    lines = stored(hashed_lines(docs, id_col, text_col, min_chars, salts), "lines")
    verdicts = repeated_lines(lines, min_docs)
    gone = (
        lines.join(verdicts, ["h1", "h2", "salt"]).where(~F.col("doc").eqNullSafe(F.col("first")))
        .groupBy("doc", "row").agg(F.collect_set("at").alias("gone"))
    )
    # Cut below the join, so that `lines` is a stored array there and a position costs no second cut.
    whole = _rows(docs, id_col, text_col).join(gone, ["doc", "row"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return whole.select(
        F.col(f"`{id_col}`"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.transform(stay, lambda at: F.get("lines", at)), "\n").alias("kept"),
    )
