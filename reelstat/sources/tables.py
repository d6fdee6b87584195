"""Table sources: the rating view over the driver's tables, and model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MISSING_CATEGORY

# Fixed values of the rating view: the hash bucket edges that assign a
# holdout category to each line (h in 0..99).
CATEGORY_EDGES = ((88, 1), (91, 2), (94, 3), (96, 4), (99, 5))
DAY_ZERO = "1995-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def category_expr(h: F.Column) -> F.Column:
    expr = F.when(h < CATEGORY_EDGES[0][0], F.lit(CATEGORY_EDGES[0][1]))
    for edge, cat in CATEGORY_EDGES[1:]:
        expr = expr.when(h < edge, F.lit(cat))
    return expr.otherwise(F.lit(MISSING_CATEGORY)).cast("int")


def day_number(ts: str, schema) -> F.Column:
    """Whole days since 1995-01-01, independent of the session time zone.

    A wall-clock (``TIMESTAMP_NTZ``) or ``DATE`` column is diffed directly; an
    instant (``TIMESTAMP``) column is taken in UTC via its epoch seconds.
    """
    from pyspark.sql import types as T

    dtype = schema[ts].dataType
    if isinstance(dtype, T.TimestampType):
        epoch_days = F.floor(F.unix_timestamp(F.col(ts)) / 86400)
        return epoch_days - F.datediff(F.lit(DAY_ZERO).cast("date"), F.lit("1970-01-01").cast("date"))
    return F.datediff(F.col(ts), F.lit(DAY_ZERO).cast("date"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings(user_id, movie_id, date, rating, category)`` over lineitem ⋈ orders.

    Only the five lineitem and two orders columns used are read (pruned at
    the parquet scan); the join is a plain equi-join Catalyst plans.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    h = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey") * 7) % 100
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .select(
            F.col("o_custkey").cast("long").alias("user_id"),
            F.col("l_partkey").cast("int").alias("movie_id"),
            day_number("l_shipdate", li.schema).cast("int").alias("date"),
            (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("int").alias("rating"),
            category_expr(h).alias("category"),
        )
    )


def write_ordered(ratings: DataFrame, path: str, order=("movie_id", "user_id", "date"), fmt: str = "parquet",
                  partitions: int | None = None, wide: bool = False) -> None:
    """Store the table in one physical order (movie-major ``mu`` or user-major ``um``).

    A range-partitioned sort: part files follow each other in key order, each
    sorted inside, so a later scan meets rows movie by movie (or user by user)
    without a global sort on one task. ``fmt`` is ``parquet`` or ``ratings_bin`` (``wide`` as in
    ``write_ratings_bin``).
    """
    cols = list(order)
    n = partitions or int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = ratings.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    if fmt == "ratings_bin":
        from .binary import write_ratings_bin

        write_ratings_bin(s, path, wide=wide)
    else:
        s.write.mode("overwrite").parquet(path)
