"""Prefix scans in levels, and what is built on them."""

import random

import pytest
from pyspark.sql import functions as F

from reelstat.operators import basic, positional, scan
from reelstat.session import materialize


def _tops(df, out=None):
    """The windows without a partition in a plan (logical)."""
    found = []

    def walk(node):
        if node.nodeName() == "Window" and node.partitionSpec().isEmpty():
            found.append(node)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().analyzed())
    return found


@pytest.mark.parametrize("op", ["sum", "min", "max"])
@pytest.mark.parametrize("reverse", [False, True])
def test_prefix_over_three_levels(spark, op, reverse):
    pick = random.Random(3)
    places = sorted(pick.sample(range(100), 61))        # block 4: levels of 100, 25, 7 and 2 positions
    rows = [(p, pick.randint(-50, 50)) for p in places]
    df = materialize(spark.createDataFrame(rows, "pos long, v long"), "scan-test")
    out = scan.prefix(df, "pos", "v", op, "x", reverse, block=4)
    got = {r.pos: r.x for r in out.collect()}
    fold = {"sum": sum, "min": min, "max": max}[op]
    for p, _ in rows:
        before = [v for q, v in rows if (q > p if reverse else q < p)]
        assert got[p] == (fold(before) if before else None)
    assert out.columns == ["pos", "v", "x"] and len(got) == len(rows)


def test_no_window_without_partition_above_the_top_level(spark, monkeypatch):
    """Every window without a partition reads a table of at most ``block`` positions."""
    seen = []
    real = scan.Window.orderBy

    def counted(*order):
        seen.append(order)
        return real(*order)

    monkeypatch.setattr(scan.Window, "orderBy", staticmethod(counted))
    df = materialize(spark.range(1000).selectExpr("id AS pos", "id AS v"), "scan-test")
    out = scan.prefix(df, "pos", "v", "sum", "x", block=8)
    assert len(seen) == 1   # 1000 → 125 → 16 → 2 positions: the top alone
    assert {r.pos: r.x for r in out.collect()}[999] == sum(range(999))
    top = _tops(out)
    assert all(w.child().stats().sizeInBytes() is not None for w in top)


def test_empty_and_single_row(spark):
    none = materialize(spark.range(0).selectExpr("id AS pos", "id AS v"), "scan-test")
    assert scan.prefix(none, "pos", "v", "sum", "x", block=2).collect() == []
    one = materialize(spark.range(9, 10).selectExpr("id AS pos", "id AS v"), "scan-test")
    assert [tuple(r) for r in scan.prefix(one, "pos", "v", "max", "x", block=2).collect()] == [(9, 9, None)]


@pytest.mark.parametrize("block", [2, 5, 65_536])
def test_runs_with_small_blocks(spark, block):
    pick = random.Random(8)
    keys = [pick.choice([1, 1, 1, 2, 3]) for _ in range(90)] + [4] * 30 + [5]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "movie_id int, row_no long")
    got = sorted((r.run_start, r.run_end, r.movie_id, r["rows"]) for r in basic.run_groups(rows, block=block).collect())
    want, start = [], 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            want.append((start, i - 1, keys[start], i - start))
            start = i
    assert got == want


def test_line_numbers_over_many_files(spark, tmpdir_fresh):
    """File offsets come from a range sort of the paths, numbers in paths taken as numbers."""
    for k in (1, 2, 9, 10, 11, 100):
        spark.createDataFrame([(f"{k}-{j}",) for j in range(k % 7 + 1)], "value string").coalesce(1).write.text(f"{tmpdir_fresh}/d={k}")
    files = [f"{tmpdir_fresh}/d={k}" for k in (100, 2, 1, 11, 10, 9)]
    got = [r.value for r in positional.number_lines(spark.read.text(files)).orderBy("row_no").collect()]
    assert got == [f"{k}-{j}" for k in (1, 2, 9, 10, 11, 100) for j in range(k % 7 + 1)]
    numbers = [r.row_no for r in positional.number_lines(spark.read.text(files)).orderBy("row_no").collect()]
    assert numbers == list(range(len(got)))


def test_difference_of_matrices(spark):
    left = spark.createDataFrame([(1, 1, 5), (1, 1, 2), (2, 1, 3)], "user_id long, movie_id int, rating int")
    right = spark.createDataFrame([(1, 1, 4), (3, 9, 1), (3, 9, 1)], "user_id long, movie_id int, rating int")
    got = {(r.user_id, r.movie_id): r.difference for r in basic.sparse_difference(left, right).collect()}
    assert got == {(1, 1): 3, (2, 1): 3, (3, 9): -2}
    empty = left.where(F.lit(False))
    assert basic.sparse_difference(empty, empty).collect() == []
    assert {r.difference for r in basic.sparse_difference(empty, right).collect()} == {-4, -2}
