"""The grid of user and movie strips: the sums of plain epochs, nulls, hot users, and one pass per model of a fit."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelstat.operators import grid as G
from reelstat.operators import model as M
from reelstat.plans import fit
from reelstat.sources.tables import ratings

SCHEMA = "user_id long, movie_id int, rating int"


@pytest.fixture()
def small_cells(monkeypatch):
    monkeypatch.setattr(G, "CELL_BYTES", 20_000)


def _sums(df):
    return {(r.side, r.id): (r.n, r.se, r.g, r.ss, r.ne) for r in df.select("side", "id", "n", "se", "g", "ss", "ne").collect()}


def _same(a, b):
    assert a.keys() == b.keys()
    for key, (n, se, g, ss, ne) in a.items():
        m, sf, h, tt, me = b[key]
        assert (n, ne) == (m, me) and se == pytest.approx(sf, abs=1e-9) and ss == pytest.approx(tt, abs=1e-9)
        assert [x is None for x in g] == [x is None for x in h] and [x or 0.0 for x in g] == pytest.approx([x or 0.0 for x in h], abs=1e-9)


def test_sums_and_rmses_equal_plain_ones(spark, small_cells):
    r = ratings(spark, SF_SMALL)
    train, valid = r.where("category in (1, 2, 3, 6)"), r.where("category = 2")
    grid = G.deal(r, 3, {"train": F.col("category").isin(1, 2, 3, 6), "valid": F.col("category") == 2})
    assert grid.side > 2 and grid.of("valid").count() == valid.count() and grid.of("train").count() == train.count()
    rule = M.rule_bias_model(0.002)
    model = M.epoch(train, M.init_model(r, 3), 3.0, rule, 3).localCheckpoint()
    _same(_sums(M.gradients(M.scored(grid, model, 3.0, k=3), 3, squares=True)), _sums(M.gradients(M.scored(train, model, 3.0, k=3), 3, squares=True)))
    s = M.scored(grid, model, 3.0, k=3)
    found = s.rmses(s.sums())
    assert found["train"] == pytest.approx(M.rmse_value(M.scored(train, model, 3.0, k=3)), abs=1e-12)
    assert found["valid"] == pytest.approx(fit.holdout_rmse(valid, model, 3.0, True, 3), abs=1e-12)


def test_a_pass_moves_entities_not_ratings(spark, small_cells):
    """What is sent to the cells is a row per entity and strip of the other side, however many ratings there are."""
    r = ratings(spark, SF_SMALL).select("user_id", "movie_id", "rating")
    many = r.unionByName(r).unionByName(r).unionByName(r)
    model = M.init_model(r, 3)
    grid = G.deal(many, 3, {"train": F.lit(True)})
    sent = M.scored(grid, model, 3.0, k=3)._sent()
    assert sent.count() == model.count() * grid.side < 2 * many.count()
    assert len(grid.labels) == grid.side**2 == len(set(grid.labels))
    parts = spark.createDataFrame([(x,) for x in grid.labels], "cell int").repartition(len(grid.labels), "cell")
    assert parts.select(F.spark_partition_id().alias("p")).distinct().count() == len(grid.labels)


def test_nulls_and_repeated_rows(spark, small_cells):
    rows = [(u, m, (u * m) % 5 + 1) for u in range(1, 40) for m in range(1, 30)] + [(1, 1, 2), (1, 1, 2)]
    rows += [(None, 3, 4), (4, None, 5), (None, None, 1), (5, 5, None), (77, 78, None)]
    train = spark.createDataFrame(rows, SCHEMA)
    model = M.init_model(train, 2)
    grid = G.deal(train, 2, {"train": F.lit(True)})
    assert grid.of("train").count() == len(rows)
    _same(_sums(M.gradients(M.scored(grid, model, 3.0, k=2), 2, squares=True)), _sums(M.gradients(M.scored(train, model, 3.0, k=2), 2, squares=True)))


def test_a_hot_user_lies_in_all_strips(spark, small_cells):
    train = spark.range(6000).selectExpr("if(id % 3 = 0, 7, id) AS user_id", "cast(id % 50 AS int) AS movie_id", "cast(1 + id % 5 AS int) AS rating")
    grid = G.deal(train, 2, {"train": F.lit(True)})
    assert 7 in grid.hot_users
    sizes = [r.n for r in grid.rows.where("user_id = 7").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 2000 / 2
    model = M.init_model(train, 2)
    _same(_sums(M.gradients(M.scored(grid, model, 3.0, k=2), 2, squares=True)), _sums(M.gradients(M.scored(train, model, 3.0, k=2), 2, squares=True)))


@pytest.mark.parametrize("lr", [0.001, 5.0])
def test_a_guarded_fit_makes_one_pass_per_model(spark, monkeypatch, lr):
    """Also where steps are rolled back: the gradients of the model that stays are those it had."""
    calls, real = [], M.scored
    monkeypatch.setattr(M, "scored", lambda *a, **k: (calls.append(1), real(*a, **k))[1])
    monkeypatch.setattr(M, "scored_all", None)
    log = fit.fit_adaptive(spark, ratings(spark, SF_SMALL), fit.FitConfig(run="passes", k=3, iterations=3, lr=lr)).log_rows
    assert [row[5] for row in log] == [lr < 1] * 3
    assert len(calls) == 4
