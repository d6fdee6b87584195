"""Text sources and sinks.

All positional work uses ``operators.positional.number_lines`` (physical line
numbers from the file scan, no sort, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positional import chunk_of, number_lines, positional_zip
from ..schema import MISSING_CATEGORY
from ..session import materialize

WS = r"[ \t]+"


def lines(spark: SparkSession, path: str, file: str | None = None) -> DataFrame:
    """Numbered lines ``(value, row_no)`` of a text file or folder, in path order; ``file`` names a column for the path."""
    return number_lines(spark.read.text(path), file=file)


def read_rating_text(spark: SparkSession, path: str) -> DataFrame:
    """A1 (A9): ``user movie date rating`` lines → ratings without category.

    Each file is read up to its first empty line; later files are not affected, and
    ``row_no`` stays the line's place in the input.
    """
    ln = lines(spark, path, file="_path")
    stops = ln.where(F.length("value") < 1).groupBy("_path").agg(F.min("row_no").alias("_stop"))
    stops = materialize(stops, "stops")  # a row per file with an empty line; its known size decides the join's form
    kept = ln.join(stops, "_path", "left").where(F.col("_stop").isNull() | (F.col("row_no") < F.col("_stop")))
    f = F.split(F.regexp_replace(F.col("value"), r"^[ \t]+|[ \t\r]+$", ""), WS)
    # try_cast: a malformed field is NULL instead of failing a whole scan (ANSI casts raise)
    return kept.select(
        "row_no",
        f.getItem(0).try_cast("long").alias("user_id"),
        f.getItem(1).try_cast("int").alias("movie_id"),
        f.getItem(2).try_cast("int").alias("date"),
        f.getItem(3).try_cast("int").alias("rating"),
    )


def read_index_text(spark: SparkSession, path: str) -> DataFrame:
    """A2: one category per line ``(row_no, category)``."""
    return lines(spark, path).select("row_no", F.trim(F.col("value")).try_cast("int").alias("category"))


def read_split_input(spark: SparkSession, data_path: str, index_path: str) -> DataFrame:
    """A1 + A2 + J1 + P6: rating lines with the category of the same index line (6 past its end)."""
    return positional_zip(read_rating_text(spark, data_path), read_index_text(spark, index_path), MISSING_CATEGORY)


def read_numeric_lines(spark: SparkSession, path: str) -> DataFrame:
    """A10: one number per line; non-numeric lines are NULL."""
    return lines(spark, path).select("row_no", F.col("value").try_cast("double").alias("value"))


def write_rating_text(ratings: DataFrame, data_path: str, index_path: str | None = None,
                      order: str = "row_no") -> None:
    """Ratings as ``user movie date rating`` lines (and an index file), in ``order``."""
    s = ratings.orderBy(order)
    s.select(F.concat_ws(" ", "user_id", "movie_id", "date", "rating").alias("value")).write.mode(
        "overwrite").text(data_path)
    if index_path:
        s.select(F.col("category").cast("string").alias("value")).write.mode("overwrite").text(index_path)


def write_chunks(spark: SparkSession, path: str, out: str, chunk: int = 5_000_000) -> None:
    """K3: split a text file every ``chunk`` lines into ``out/chunk=k/`` (appended)."""
    ln = lines(spark, path)
    (
        ln.select(chunk_of("row_no", chunk).alias("chunk"), "row_no", "value")
        .repartition("chunk")
        .sortWithinPartitions("row_no")
        .drop("row_no")
        .write.mode("append")
        .partitionBy("chunk")
        .text(out)
    )


def prediction_lines(scored_rows: DataFrame, value: str = "prediction", digits: int = 5) -> DataFrame:
    """K7 / K10 body: ``(row_no, line)`` with ``%.5f`` text."""
    return scored_rows.select("row_no", F.format_string(f"%.{digits}f", F.col(value)).alias("line"))


def write_in_order(numbered: DataFrame, path: str, order: str = "row_no", line: str = "line", parts: int | None = None) -> None:
    """One text line per row: part files follow each other in ``order`` and are sorted inside, so that the files in path order are it.

    A range-partitioned sort, in ``parts`` files if given, else as many as Spark plans.
    """
    by_range = numbered.orderBy(order) if parts is None else numbered.repartitionByRange(parts, order).sortWithinPartitions(order)
    by_range.select(F.col(line).alias("value")).write.mode("overwrite").text(path)


def write_predictions(scored_rows: DataFrame, path: str, value: str = "prediction", digits: int = 5, parts: int | None = None) -> None:
    """One line per row, in input order (a range-partitioned sort at the sink only)."""
    write_in_order(prediction_lines(scored_rows, value, digits), path, parts=parts)


def dump_lines(dump: DataFrame, path: str) -> None:
    """K9: the labelled record dump as text, ``split: line``."""
    dump.select(F.concat_ws(": ", "split", "line").alias("value")).write.mode("overwrite").text(path)
