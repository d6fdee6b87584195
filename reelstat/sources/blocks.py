"""A user-major layout of the ratings for many epochs.

Ratings are stored in blocks, bucketed by ``block`` and sorted by user. A user's ratings lie in one block; a user
with more than ``per_part`` of them is split in parts, and the parts in several blocks, so that no block gets
all of a hot user. Two small tables say which users and which movies occur in a block, bucketed alike:

    ratings  (block, user_id, movie_id, rating)      bucketed by block
    users    (block, user_id)                        one row per user and block it is in
    movies   (block, movie_id)                       one row per movie and block it is in

An epoch sends factor rows to the blocks that need them (joins of the model with ``users`` and ``movies``) and joins them to the
ratings inside each block. The ratings themselves are never shuffled: what moves is a factor row per (block, user)
and (block, movie), and the partial sums of the gradients, of which a block gives one per entity. A movie is in many blocks,
so movie rows are moved once per block; there are never more of them than ratings.

The tables are external tables of the session's catalog, as bucketing needs; their files lie under the shared checkpoint
folder. Every block is one task of an epoch.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model as M
from ..session import materialize, scratch_path, settings

ROWS_PER_BLOCK = 4_000_000
PARTS_PER_BLOCK = 8  # a part is at most this fraction of a block, so that blocks even out

# joins on (block, id) may use that both sides are dealt out by block alone
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@dataclass(frozen=True)
class RatingBlocks:
    """Names of the three tables of one layout and its number of blocks."""

    ratings: str
    users: str
    movies: str
    blocks: int


def _bucketed(df: DataFrame, name: str, path: str, blocks: int, *order: str) -> str:
    by_block = df.repartition(blocks, "block").sortWithinPartitions("block", *order)
    by_block.write.mode("overwrite").bucketBy(blocks, "block").sortBy("block", *order).option("path", path).saveAsTable(name)
    return name


def write_blocks(ratings: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, parts_per_block: int = PARTS_PER_BLOCK) -> RatingBlocks:
    """The layout of ``ratings`` (user_id, movie_id, rating); repeated ratings stay.

    The number of blocks follows from the number of rows. Part p of a user goes to the block that the hash of (user, p)
    names; a row's part is a hash of its movie, so the choice is the same whenever a task is repeated.
    """
    spark = ratings.sparkSession
    rows = materialize(ratings.select("user_id", "movie_id", "rating"), "layout-rows")
    counts = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    blocks = max(1, math.ceil(total / rows_per_block))
    per_part = max(1, rows_per_block // parts_per_block)
    # only split users need to be looked up: at most total / per_part of them
    split = materialize(counts.where(F.col("n") > per_part).select("user_id", F.ceil(F.col("n") / per_part).alias("parts")), "layout-split")
    part = F.pmod(F.xxhash64("movie_id", F.lit("part")), F.coalesce("parts", F.lit(1)))
    placed = rows.join(split, "user_id", "left").withColumn("part", part)
    placed = placed.select(F.pmod(F.xxhash64("user_id", "part"), F.lit(blocks)).cast("int").alias("block"), "user_id", "movie_id", "rating")
    name = f"rating_blocks_{uuid.uuid4().hex}"
    base = scratch_path(spark, "reelstat-tables", name)
    _bucketed(placed, name, f"{base}/ratings", blocks, "user_id")
    stored = spark.table(name)
    users = _bucketed(stored.select("block", "user_id").distinct(), f"{name}_users", f"{base}/users", blocks, "user_id")
    movies = _bucketed(stored.select("block", "movie_id").distinct(), f"{name}_movies", f"{base}/movies", blocks, "movie_id")
    return RatingBlocks(name, users, movies, blocks)


def drop_blocks(spark: SparkSession, layout: RatingBlocks) -> None:
    """Forget a layout's tables; their files stay until ``session.clear_scratch``."""
    for name in (layout.ratings, layout.users, layout.movies):
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def scored_blocks(spark: SparkSession, layout: RatingBlocks, model: DataFrame, mu: float = 0.0, use_bias: bool = True, k: int | None = None) -> DataFrame:
    """``M.scored`` of the stored ratings, block by block; plan and run it under the settings ``CO_LOCATED``."""
    users = spark.table(layout.users).join(M.user_factors(model), "user_id")
    movies = spark.table(layout.movies).join(M.movie_factors(model), "movie_id")
    return M.scored_rows(spark.table(layout.ratings).join(users, ["block", "user_id"]).join(movies, ["block", "movie_id"]), mu, use_bias, k)


def epoch_blocks(spark: SparkSession, layout: RatingBlocks, model: DataFrame, mu: float, rule: M.StepRule, k: int) -> DataFrame:
    """M4 / M5 on the layout: the model after one batch step, written (its settings hold for this job only)."""
    with settings(spark, CO_LOCATED):
        s = scored_blocks(spark, layout, model, mu, rule.use_bias, k)
        return materialize(M.apply_gradients(model, M.gradients(s, k), rule), "layout-epoch")


def fit_blocks(spark: SparkSession, ratings: DataFrame, model: DataFrame, mu: float, rule: M.StepRule, k: int, epochs: int,
               layout: RatingBlocks | None = None) -> DataFrame:
    """``epochs`` steps over one layout: the ratings are dealt out once, however many epochs follow."""
    layout = layout or write_blocks(ratings)
    for _ in range(epochs):
        model = epoch_blocks(spark, layout, model, mu, rule, k)
    return model
