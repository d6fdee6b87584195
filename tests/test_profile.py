import random

from pyspark.sql import types as T

from brute import movie_summary as brute_summary
from reelstat.operators.profile import SUMMARY_COLUMNS, movie_summary

SCHEMA = T.StructType([
    T.StructField("movie_id", T.IntegerType()), T.StructField("date", T.IntegerType()),
    T.StructField("user_id", T.LongType()), T.StructField("rating", T.IntegerType())])


def _check(spark, rows):
    got = {r["movie_id"]: r.asDict() for r in movie_summary(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute_summary(rows)
    assert set(got) == set(want)
    for m, w in want.items():
        for c in SUMMARY_COLUMNS[1:]:
            assert got[m][c] == w[c], (m, c, got[m][c], w[c])


def test_single_event(spark):
    got = movie_summary(spark.createDataFrame([(1, 7, 10, 3)], SCHEMA)).collect()[0]
    assert got.rating_mean == 3 and got.rating_var == 0
    assert [got[f"viewdate{i}"] for i in range(10)] == [0] * 10
    assert [got[f"ratingdate{i}"] for i in range(10)] == [0] * 9 + [30]


def test_ten_and_eleven(spark):
    ten = [(1, d, 100 + d, [1, 2, 3, 4, 5][d % 5]) for d in range(10)]
    r = movie_summary(spark.createDataFrame(ten, SCHEMA)).collect()[0]
    assert [r[f"viewdate{i}"] for i in range(10)] == list(range(10))
    assert [r[f"ratingdate{i}"] for i in range(10)] == [float(x) for x in [1, 2, 3, 4, 5, 1, 2, 3, 4, 5]]
    eleven = [(2, d, 5, 1) for d in range(11)]
    r = movie_summary(spark.createDataFrame(eleven, SCHEMA)).collect()[0]
    assert [r[f"viewdate{i}"] for i in range(10)] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 10]


def test_every_size_with_date_ties(spark):
    rng = random.Random(7)
    rows = []
    for n in range(1, 61):
        for _ in range(n):
            rows.append((n, rng.randint(0, 6), rng.randint(1, 40), rng.randint(1, 5)))
    _check(spark, rows)


def test_hot_movie_cut_inside_blocks_and_buckets(spark):
    """One movie, few dates, users spread over many 65,536-id buckets, duplicate rows."""
    rng = random.Random(11)
    rows = [(9, rng.choice([3, 4, 8]), rng.randint(0, 1 << 21), rng.randint(1, 5)) for _ in range(3000)]
    rows += rows[:50]  # exact duplicates
    rows += [(10, 1, 5, 4)] * 37  # one key only
    _check(spark, rows)


def test_fixture_matches_window_plan(spark):
    """On the sf0.001 view: the skew-safe plan equals the sequential rule."""
    from conftest import SF_SMALL
    from reelstat.sources.tables import ratings

    r = ratings(spark, SF_SMALL).where("category in (1,2,3,6)")
    rows = [(x.movie_id, x.date, x.user_id, x.rating) for x in r.collect()]
    _check(spark, rows)
