"""Queries that read the rating view several times join it once; a fit scores its rows once per step."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelstat.operators import model as M
from reelstat.plans import catalog, fit
from reelstat.sources.tables import ratings


@pytest.mark.parametrize("name", ["report_append", "bias_minibatch_step", "score_clamped", "rmse_bias", "predict_bias"])
def test_the_view_is_computed_once(spark, monkeypatch, name):
    met = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    def view(spark, sf_dir):
        r = ratings(spark, sf_dir)
        return r.mapInArrow(counted, r.schema)

    monkeypatch.setattr(catalog, "ratings", view)
    rows = catalog.QUERIES[name](spark, SF_SMALL).collect()
    assert rows and met.value == ratings(spark, SF_SMALL).count()


def test_threshold_fit_scores_once_per_step(spark, monkeypatch):
    r = ratings(spark, SF_SMALL).where("category in (1, 2, 3, 6)")
    calls, real = [], M.scored
    monkeypatch.setattr(M, "scored", lambda *a, **k: (calls.append(1), real(*a, **k))[1])
    log, path = fit.fit_threshold(spark, r, k=2, max_loops=4, stop=0.0)
    assert len(calls) == 4                     # three steps and the RMSE after the last; seven before
    rows = sorted(log.collect(), key=lambda x: x.iteration)
    assert [x.iteration for x in rows] == [1, 2, 3]
    cells = r.groupBy("user_id", "movie_id").agg(F.sum("rating").alias("rating"))
    mu = cells.agg(F.avg("rating")).first()[0]
    model, rule = M.init_model(cells, 2, constant=0.1), M.rule_per_rating(0.0005, 0.001)
    want = [M.rmse_value(M.scored(cells, model, mu, k=2))]
    for _ in range(3):
        model = M.epoch(cells, model, mu, rule, 2).localCheckpoint()
        want.append(M.rmse_value(M.scored(cells, model, mu, k=2)))
    assert [x.rmse_before for x in rows] == pytest.approx(want[:-1]) and [x.rmse_after for x in rows] == pytest.approx(want[1:])
    last = {(x.side, x.id): x.b for x in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).columns == ["side", "id", "f", "b"]
    assert last == pytest.approx({(x.side, x.id): x.b for x in model.collect()})
    # a stop after the second step leaves the model of that step
    stopped, path = fit.fit_threshold(spark, r, k=2, max_loops=9, stop=abs(want[1] - want[2]) * 1.0001 if abs(want[1] - want[2]) < abs(want[0] - want[1]) else 1e9)
    assert stopped.count() in (1, 2) and spark.read.parquet(path).count() == len(last)
