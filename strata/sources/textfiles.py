"""Text and sheet files read from a path, every line with its number in its file.

A line's number comes from the file and the place in it, not from arrival: Spark reads a file in
splits, each from a known byte; lines of a split come in order, so the lines of the earlier splits plus the
place inside the split is the number. It is the same in every run and with any split size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

BROADCAST_SPLITS = 200_000
FILE_BYTES = 128 << 20           # a written file's share of the rows' bytes, and a bucket's when lines are placed


def write_lines(df: DataFrame, order: Sequence[str], line: str | Column, path: str, least: int = 1,
                line_sep: str = "\n") -> None:
    """S6, the way out: ``line`` of every row into text files under ``path``; file names and the lines of a file
    follow ``order``.

    One task writes one file, so the files grow in number with the rows (``FILE_BYTES`` each), not in size;
    there are ``least`` at least.
    """
    from ..operators.ordering import range_sort

    rows = range_sort(df, order, least=least, bucket_bytes=FILE_BYTES)
    rows.select(line).write.option("lineSep", line_sep).text(path)


def place_lines(lines: DataFrame, out: str = "pos") -> DataFrame:
    """``out``: the 1-based place of each line of ``read_lines`` over all files, in file and line order."""
    from ..operators.scan import global_position

    return global_position(lines, ["file", "line_no"], out=out, bucket_bytes=FILE_BYTES)


def read_lines(spark: SparkSession, path: str, line_col: str = "line", line_sep: str = "\n") -> DataFrame:
    """(file, line_no, line) of all files under ``path``; ``line_no`` is 1-based in its file.

    Only ``line_sep`` ends a line. The lines are written once, so that numbers and lines come from one reading.
    """
    read = spark.read.option("lineSep", line_sep).text(path)
    lines = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_from"),
                        F.monotonically_increasing_id().alias("_id"), F.col("value").alias(line_col))
    lines = materialize(lines, "lines")
    splits = lines.groupBy("file", "_from").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per split of a file
    earlier = Window.partitionBy("file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(splits.select("file", "_from", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0))
                                       .alias("_before")), "line-splits")
    small = F.broadcast(splits) if splits.count() <= BROADCAST_SPLITS else splits
    numbered = lines.join(small, ["file", "_from"])
    return numbered.select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), line_col)


def read_sheet(spark: SparkSession, path: str, schema: str, row: str = "row_idx", first_row: int = 2,
               header_lines: int = 0) -> DataFrame:
    """The rows of CSV files without line breaks inside cells, in file and line order.

    ``row`` numbers the rows of all files together from ``first_row``; the first ``header_lines`` of each file are no rows.
    """
    placed = place_lines(read_lines(spark, path).where(F.col("line_no") > header_lines), "_place")
    cells = placed.select((F.col("_place") + (first_row - 1)).cast("int").alias(row),
                          # a bare empty cell is null, "" is the empty text
                          F.from_csv("line", schema, {"nullValue": "\\N"}).alias("_c"))
    return cells.select(row, "_c.*")
