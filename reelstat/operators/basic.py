"""Projections and whole-table aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .scan import BLOCK, prefix


def global_mean(ratings: DataFrame, rating: str = "rating") -> Column:
    """G1 as a scalar subquery column (stays in the plan; no driver round trip)."""
    return ratings.select(F.avg(F.col(rating))).scalar()


def zero_based(ratings: DataFrame) -> DataFrame:
    """Ids rebased to zero."""
    return ratings.withColumn("user_id", F.col("user_id") - 1).withColumn("movie_id", F.col("movie_id") - 1)


def centered(ratings: DataFrame, mu: float | Column | None = None) -> DataFrame:
    """``r = rating − μ``; μ defaults to the table's own mean (G1)."""
    mu = global_mean(ratings) if mu is None else (mu if isinstance(mu, Column) else F.lit(float(mu)))
    return ratings.withColumn("r", F.col("rating") - mu)


def merge_duplicates(ratings: DataFrame) -> DataFrame:
    """Repeated (user, movie) cells summed into one, as a sparse-matrix build does."""
    return ratings.groupBy("user_id", "movie_id").agg(
        F.sum("rating").cast("long").alias("rating"), F.count(F.lit(1)).alias("copies"))


def seen_entities(ratings: DataFrame, key: str) -> DataFrame:
    """Ids that occur in the ratings (distinct, partially aggregated)."""
    return ratings.select(key).distinct()


def sparse_difference(left: DataFrame, right: DataFrame, value: str = "rating") -> DataFrame:
    """``left - right`` of two sparse (user, movie) matrices, a row per cell that either side has; the other counts 0.

    Repeated cells are summed first on each side (G8), so the full join meets every cell at most once per side.
    """
    sums = [m.groupBy("user_id", "movie_id").agg(F.sum(value).alias(name)) for m, name in ((left, "_left"), (right, "_right"))]
    zero = F.lit(0)
    return sums[0].join(sums[1], ["user_id", "movie_id"], "full_outer").select(
        "user_id", "movie_id", (F.coalesce("_left", zero) - F.coalesce("_right", zero)).alias("difference"))


def run_groups(numbered: DataFrame, key: str = "movie_id", row_no: str = "row_no", block: int = BLOCK) -> DataFrame:
    """Contiguous runs of equal ``key`` in file order, one row per run.

    Lines are looked at in blocks of ``block`` positions: a run starts where ``lag`` inside the block
    has another key, and at a block's first line if the last line before the block has. Ends follow
    from the next start in the block, or from the first start of a later block. What lies before and after a block comes from
    prefix scans in levels (``scan.prefix``) over one row per block, so no window without a partition sees more than
    ``block`` rows. No row is grouped by key, so a hot key costs nothing extra.
    """
    rows = numbered.select(F.col(key).alias("_k"), F.col(row_no).alias("_r"), F.expr(f"`{row_no}` div {block}").alias("_b"))
    in_block = Window.partitionBy("_b").orderBy("_r")
    edges = materialize(
        rows.groupBy("_b").agg(F.min("_r").alias("_first"), F.max("_r").alias("_last"), F.max_by("_k", "_r").alias("_last_key")),
        "run-blocks")
    before = prefix(edges, "_b", F.struct("_b", "_last_key"), "max", "_p", block=block).select(
        "_b", "_first", F.col("_p").isNull().alias("_none"), F.col("_p._last_key").alias("_before"))
    seen = rows.withColumn("_prev", F.lag("_k").over(in_block))
    inner = seen.where(F.col("_prev") != F.col("_k")).select("_k", "_r", "_b")
    heads = rows.join(before, "_b").where(
        (F.col("_r") == F.col("_first")) & (F.col("_none") | (F.col("_before") != F.col("_k")))).select("_k", "_r", "_b")
    starts = materialize(inner.unionByName(heads), "run-starts")
    firsts = materialize(starts.groupBy("_b").agg(F.min("_r").alias("_start")), "run-first-starts")
    after = prefix(firsts, "_b", "_start", "min", "_after", reverse=True, block=block).select("_b", "_after")
    last = edges.select(F.max("_last")).scalar()
    return starts.withColumn("_next", F.lead("_r").over(in_block)).join(after, "_b").select(
        F.col("_k").alias(key),
        F.col("_r").alias("run_start"),
        (F.coalesce("_next", "_after", last + 1) - 1).alias("run_end"),
    ).withColumn("rows", F.col("run_end") - F.col("run_start") + 1)
