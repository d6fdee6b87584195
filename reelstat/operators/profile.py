"""Per-movie profile (G4 W1 W2 W3 S1 P11): the movie summary table.

Rule per movie, on its rows sorted by (date, user_id, rating) — rank r = 0..n-1:

* ratings = n, rating_mean = Σr/n, rating_var = Σr²/n − mean², first/last date;
* viewdate[i-1] (i = 1..10) = date at rank (n·i > 10 ? n·i div 10 − 1 : 0) − first;
* ratingdate[i] (i = 0..9) = Σ rating over ranks [n·i div 10, n·(i+1) div 10) / n · 10.

Skew-safe plan. A naive window ``partitionBy(movie)`` puts a whole movie in one
task; a movie holding a third of all rows would then be one task. Here no raw
row is ever sorted. Ranks are resolved by refining histograms:

1. ``(movie, date)`` histogram of all rows (map-side partial aggregation). A
   window over a movie's dates (≤ 65,536: date is a u16 day number) gives each
   date block its first rank. Count, sums, first/last and all ten viewdates
   come from this level alone, as do the rating-decile prefix sums at every
   boundary that falls on a block edge.
2. At most 9 boundaries per movie fall inside a date block. Only rows of those
   blocks are read again (join with the cut blocks) into a ``(movie, date, user, rating)``
   histogram, which is rolled up to user buckets (user_id div 65,536) to find
   the bucket holding each boundary, then resolved inside that one bucket.

Every window partition is bounded by a constant (dates per movie, buckets per
block, keys per bucket), every raw pass is a partially aggregated scan, and the
result is exact integer arithmetic — equal bit for bit to a sequential sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import fixed
from ..session import materialize

# Fixed values of the decile rule: ten slices.
DECILES = 10
# Users per bucket at the middle refinement level.
USER_BUCKET_BITS = 16

SUMMARY_COLUMNS = (
    ["movie_id", "ratings", "rating_mean", "rating_var", "first_rating", "last_rating"]
    + [f"viewdate{i}" for i in range(DECILES)]
    + [f"ratingdate{i}" for i in range(DECILES)]
)


# The rank arithmetic is written as SQL expression text: one JVM call per
# expression instead of one per operator node when the plan is built.

def _bound(n: str, i: int) -> str:
    """Rank boundary n·i div 10."""
    return f"(({n}) * {i}) div {DECILES}"


def _view_rank(n: str, i: int) -> str:
    """Rank whose date is viewdate[i-1]: n·i > 10 ? n·i div 10 − 1 : 0."""
    return f"(CASE WHEN ({n}) * {i} > {DECILES} THEN {_bound(n, i)} - 1 ELSE 0 END)"


def _inside(lo: str, width: str, k: str) -> str:
    """Rank k falls in the block [lo, lo + width)."""
    return f"(({lo}) <= ({k}) AND ({k}) < ({lo}) + ({width}))"


def movie_summary(ratings: DataFrame, checkpoint: bool = True) -> DataFrame:
    """Summary rows for every movie of ``ratings`` (columns movie_id, date, user_id, rating).

    The per-movie row (with the ≤ 9 cut blocks collected into it) is written
    once to the session's checkpoint folder: it is read twice (final row, cut
    blocks), and without the cut each read would re-run the histogram.
    """
    r = ratings.select("movie_id", "date", "user_id", "rating")
    bounds = list(range(1, DECILES))
    ms = [f"m{i}" for i in bounds]
    E = F.expr

    # ---- level 1: date blocks (one ordered window spec, one sort) ---------------
    w_all = "(PARTITION BY movie_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    w_before = "(PARTITION BY movie_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    h1 = r.groupBy("movie_id", "date").agg(
        F.count(F.lit(1)).alias("c"),
        F.sum(F.col("rating").cast("long")).alias("s"),
        F.sum((F.col("rating") * F.col("rating")).cast("long")).alias("s2"),
    ).selectExpr(
        "*",
        f"sum(c) OVER {w_all} AS n",
        f"min(date) OVER {w_all} AS first",
        f"coalesce(sum(c) OVER {w_before}, 0) AS c0",
        f"coalesce(sum(s) OVER {w_before}, 0) AS s0",
    )
    # offset of boundary i inside this block (null when the block does not hold it)
    h1 = h1.selectExpr(
        "*", *[f"CASE WHEN {_inside('c0', 'c', _bound('n', i))} THEN {_bound('n', i)} - c0 END AS m{i}" for i in bounds])
    cut_struct = "named_struct('date', date, " + ", ".join(
        f"'m{i}', CASE WHEN m{i} > 0 THEN m{i} END" for i in bounds) + ")"
    per_movie = h1.groupBy("movie_id").agg(
        E("first(n) AS ratings"),
        E("sum(s) AS rsum"),
        E("sum(s2) AS r2sum"),
        E("min(date) AS first_rating"),
        E("max(date) AS last_rating"),
        *[E(f"max(CASE WHEN {_inside('c0', 'c', _view_rank('n', i))} THEN date - first END) AS viewdate{i - 1}")
          for i in range(1, DECILES + 1)],
        # prefix sum of whole blocks before boundary i
        *[E(f"max(CASE WHEN m{i} IS NOT NULL THEN s0 END) AS full{i}") for i in bounds],
        # the blocks a boundary cuts: at most 9 per movie (nulls are not collected)
        E(f"collect_list(CASE WHEN greatest({', '.join(ms)}) > 0 THEN {cut_struct} END) AS cuts"),
    )
    if checkpoint:
        # one row per movie, read twice below: written once instead of re-running the histogram
        per_movie = materialize(per_movie, "movie-profile")

    # ---- levels 2-3: only blocks cut by a boundary ------------------------------
    cut = per_movie.select("movie_id", F.inline("cuts"))
    # raw rows of cut blocks only (cut has at most 9 rows per movie: AQE broadcasts it when small)
    h3 = r.join(cut, ["movie_id", "date"]).groupBy(
        "movie_id", "date", "user_id", "rating", F.shiftright(F.col("user_id"), USER_BUCKET_BITS).alias("ub")
    ).agg(F.count(F.lit(1)).alias("c"), *[F.max(x).alias(x) for x in ms])
    w_bucket = "(PARTITION BY movie_id, date ORDER BY ub ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    h2 = h3.groupBy("movie_id", "date", "ub").agg(
        F.sum("c").alias("c"), F.sum(F.col("c") * F.col("rating")).alias("s"), *[F.max(x).alias(x) for x in ms]
    ).selectExpr("*", f"coalesce(sum(c) OVER {w_bucket}, 0) AS c0", f"coalesce(sum(s) OVER {w_bucket}, 0) AS s0")
    hit = {i: _inside("c0", "c", f"m{i}") for i in bounds}
    buckets = h2.where(" OR ".join(f"coalesce({h}, false)" for h in hit.values())).selectExpr(
        "movie_id", "date", "ub",
        *[f"CASE WHEN {h} THEN m{i} - c0 END AS k{i}" for i, h in hit.items()],
        *[f"CASE WHEN {h} THEN s0 END AS t{i}" for i, h in hit.items()],
    )
    w_key = "(PARTITION BY movie_id, date, ub ORDER BY user_id, rating ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    h3 = h3.drop(*ms).join(buckets, ["movie_id", "date", "ub"]).selectExpr(
        "*", f"coalesce(sum(c) OVER {w_key}, 0) AS c0", f"coalesce(sum(c * rating) OVER {w_key}, 0) AS s0")
    partial = h3.groupBy("movie_id").agg(*[
        E(f"max(CASE WHEN {_inside('c0', 'c', f'k{i}')} THEN t{i} + s0 + (k{i} - c0) * rating END) AS part{i}")
        for i in bounds
    ])

    # ---- assemble ---------------------------------------------------------------
    prefix = ["CAST(0 AS BIGINT)"] + [f"(full{i} + coalesce(part{i}, CAST(0 AS BIGINT)))" for i in bounds] + ["rsum"]
    return per_movie.join(partial, "movie_id", "left").selectExpr(
        "movie_id",
        "ratings",
        "rsum / ratings AS rating_mean",
        "r2sum / ratings - (rsum / ratings) * (rsum / ratings) AS rating_var",
        "first_rating",
        "last_rating",
        *[f"CAST(viewdate{i} AS INT) AS viewdate{i}" for i in range(DECILES)],
        *[f"({prefix[i + 1]} - {prefix[i]}) / ratings * {DECILES} AS ratingdate{i}" for i in range(DECILES)],
    )


def summary_lines(summary: DataFrame) -> DataFrame:
    """K8 body: the 26 columns, ``movie_id`` as ``movie``, fractions as ``%.3f`` text."""
    return summary.select(
        *[
            fixed(c, 3).alias(c) if c in ("rating_mean", "rating_var") or c.startswith("ratingdate") else F.col(c)
            for c in SUMMARY_COLUMNS
        ]
    ).withColumnRenamed("movie_id", "movie")


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """K8: header + one row per movie, ordered by movie at the sink only."""
    summary_lines(summary).orderBy("movie").write.mode("overwrite").option("header", True).csv(path)


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """A summary CSV under an explicit schema; a malformed file fails instead of giving nulls."""
    whole = {"movie", "ratings", "first_rating", "last_rating", *(f"viewdate{i}" for i in range(DECILES))}
    names = ["movie" if c == "movie_id" else c for c in SUMMARY_COLUMNS]
    schema = ", ".join(f"{c} {('bigint' if c == 'ratings' else 'int') if c in whole else 'decimal(12,3)'}" for c in names)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
