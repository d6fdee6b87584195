"""The user-major block layout: results, co-location, hot users."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelstat.operators import model as M
from reelstat.session import settings
from reelstat.sources import blocks as BL
from reelstat.sources.tables import ratings

RULE = M.rule_bias_model(0.002)


def _rows(spark):
    r = ratings(spark, SF_SMALL)
    return r, r.where("category in (1, 2, 3, 6)").select("user_id", "movie_id", "rating")


def _values(model):
    return {(r.side, r.id): (*r.f, r.b) for r in model.collect()}


def _close(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=1e-9)


def test_epochs_on_blocks_equal_plain_epochs(spark):
    r, train = _rows(spark)
    layout = BL.write_blocks(train, rows_per_block=900)
    assert layout.blocks > 3
    m0 = M.init_model(r, 3)
    plain = m0
    for _ in range(2):
        plain = M.epoch(train, plain, 3.0, RULE, 3)
    _close(_values(BL.fit_blocks(spark, train, m0, 3.0, RULE, 3, 2, layout)), _values(plain))
    assert spark.table(layout.ratings).count() == train.count()
    BL.drop_blocks(spark, layout)


def _above_scan(node, table, path=()):
    """The node names from the root down to the scan of ``table``."""
    name = node.nodeName()
    path = (*path, name)
    if name.startswith("Scan") and f"{table}" in name and not name.endswith(("_users", "_movies")):
        return path
    children = node.children()
    for i in range(children.size()):
        found = _above_scan(children.apply(i), table, path)
        if found:
            return found
    return None


@pytest.mark.parametrize("k", [3, 40])
def test_ratings_are_not_shuffled(spark, k):
    """With broadcasting off, no exchange stands between the rating scan and the partial sums of the gradients."""
    r, train = _rows(spark)
    layout = BL.write_blocks(train, rows_per_block=900)
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", **BL.CO_LOCATED}
    with settings(spark, off):
        g = M.gradients(BL.scored_blocks(spark, layout, M.init_model(r, k), 3.0, True, k), k)
        path = _above_scan(g._jdf.queryExecution().executedPlan(), layout.ratings)
        plain = M.gradients(M.scored(train, M.init_model(r, k), 3.0, True, k), k)._jdf.queryExecution().executedPlan().toString()
    assert path, g._jdf.queryExecution().executedPlan().toString()
    below = path[max(i for i, n in enumerate(path) if "Aggregate" in n):]
    assert sum("Join" in n for n in below) == 2 and not any("Exchange" in n for n in below), path
    assert plain.count("Exchange hashpartitioning(user_id") + plain.count("Exchange hashpartitioning(movie_id") >= 2
    BL.drop_blocks(spark, layout)


def test_a_hot_user_lies_in_several_blocks(spark):
    n = 30_000
    rows = spark.range(n).selectExpr("if(id % 3 = 0, 7, id) AS user_id", "cast(id % 500 AS int) AS movie_id", "cast(1 + id % 5 AS int) AS rating")
    layout = BL.write_blocks(rows, rows_per_block=3_000)
    sizes = {r.block: r.n for r in spark.table(layout.ratings).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(sizes.values()) == n and max(sizes.values()) < 2 * n / layout.blocks
    hot = spark.table(layout.users).where("user_id = 7").count()
    assert hot >= layout.blocks // 2   # its row is repeated for every block it lies in
    m0 = M.init_model(rows, 2)
    _close(_values(BL.epoch_blocks(spark, layout, m0, 3.0, RULE, 2)), _values(M.epoch(rows, m0, 3.0, RULE, 2)))
    BL.drop_blocks(spark, layout)


def test_one_block_and_repeated_ratings(spark):
    rows = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (2, 1, 3)], "user_id long, movie_id int, rating int")
    layout = BL.write_blocks(rows)
    assert layout.blocks == 1 and spark.table(layout.ratings).count() == 3
    m0 = M.init_model(rows, 2)
    _close(_values(BL.epoch_blocks(spark, layout, m0, 3.0, RULE, 2)), _values(M.epoch(rows, m0, 3.0, RULE, 2)))
    BL.drop_blocks(spark, layout)


def test_settings_are_put_back(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), settings(spark, BL.CO_LOCATED):
        assert spark.conf.get(key) == "false"
        raise ValueError
    assert spark.conf.get(key) == before
