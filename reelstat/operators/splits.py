"""Holdout routing and split accounting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MISSING_CATEGORY, PROBE_CATEGORY, RATING_COLUMNS, TEST_CATEGORY

# Fixed values of the split report: label and category, in report order.
REPORT_LABELS = (("train_1", 1), ("train_2", 2), ("train_3", 3), ("train_6", 6), ("probe", 4), ("test", 5))


def split_of(category: str | Column = "category") -> Column:
    """1, 2, 3, 6 (and 0, by ``< 4``) → train; 4 → probe; 5 → test; above 6 → null (routed nowhere)."""
    c = F.col(category) if isinstance(category, str) else category
    return (
        F.when((c < PROBE_CATEGORY) | (c == MISSING_CATEGORY), F.lit("train"))
        .when(c == PROBE_CATEGORY, F.lit("probe"))
        .when(c == TEST_CATEGORY, F.lit("test"))
    )


def route(ratings: DataFrame) -> DataFrame:
    """Rows with their split; rows whose category routes nowhere are dropped (as in the reference)."""
    return ratings.withColumn("split", split_of("category")).where(F.col("split").isNotNull())


def category_filter(ratings: DataFrame, category: int, columns=("user_id", "movie_id", "rating")) -> DataFrame:
    """P4 + P7: one category, only the columns a trainer needs (pruned at the scan)."""
    return ratings.where(F.col("category") == category).select(*columns)


def nonzero(ratings: DataFrame) -> DataFrame:
    """P5: drop unknown (zero) ratings."""
    return ratings.where(F.col("rating") != 0)


def split_report(sources: Mapping[str, DataFrame] | DataFrame) -> DataFrame:
    """G3 + U2: one report row per source: entries and counts per category label.

    One partially aggregated pass per source; sources are unioned first so the
    whole report is a single aggregate. Categories outside 1..6 are counted as
    ``invalid`` (the reference indexes out of bounds there).
    """
    if isinstance(sources, DataFrame):
        sources = {"ratings": sources}
    parts = [df.select(F.lit(name).alias("source"), "category") for name, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    c = F.col("category")
    return u.groupBy("source").agg(
        F.count(F.lit(1)).alias("entries"),
        *[F.count_if(c == k).alias(label) for label, k in REPORT_LABELS],
        F.count_if((c < 1) | (c > 6)).alias("invalid"),
    )


def split_dump(splits: Mapping[str, DataFrame]) -> DataFrame:
    """U1 + K9: the splits concatenated, each row labelled, as ``"%u %hu %hu %hhu %hhu"`` lines."""
    parts = [
        df.select(F.lit(name).alias("split"), *RATING_COLUMNS) for name, df in splits.items()
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.select("split", F.concat_ws(" ", *[F.col(c).cast("string") for c in RATING_COLUMNS]).alias("line"))


def write_splits(ratings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: one pass, three outputs — parquet partitioned by split (pruned on read)."""
    route(ratings).write.mode(mode).partitionBy("split").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """K2: the report appended to a table (one row per source)."""
    report.write.mode("append").parquet(path)


def append_report(report: DataFrame, path: str, run: str) -> None:
    """K2, repeatable: the rows of ``run`` appended to the table at ``path``, one per source.

    The table is partitioned by (run, source) and only the partitions written are replaced: a job that is
    repeated after a failure leaves one row per source, and other runs' rows stay.
    """
    report.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run", "source").parquet(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """All appended report rows; partition values stay text, whatever they look like."""
    counts = ", ".join(f"{label} bigint" for label in ("entries", *(label for label, _ in REPORT_LABELS), "invalid"))
    return spark.read.schema(f"{counts}, run string, source string").parquet(path)
