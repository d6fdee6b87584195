import math

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelstat.operators import model as M
from reelstat.plans import fit
from reelstat.sources.tables import ratings


def _np_step(rows, model, mu, rule, k):
    """Batch step in NumPy: sums over all ratings from the old model, simultaneous update."""
    f = {(s, i): np.array(v, dtype=float) for s, i, v, _ in model}
    b = {(s, i): bb for s, i, _, bb in model}
    g = {key: np.zeros(k) for key in f}
    se = {key: 0.0 for key in f}
    n = {key: 0 for key in f}
    for u, m, r in rows:
        pu, qm = f[("user", u)], f[("movie", m)]
        pred = float(pu @ qm) + ((b[("user", u)] + b[("movie", m)]) if rule.use_bias else 0.0)
        e = (r - mu) - pred
        g[("user", u)] += e * qm
        g[("movie", m)] += e * pu
        for key in (("user", u), ("movie", m)):
            se[key] += e
            n[key] += 1
    out = {}
    for key in f:
        lam = rule.reg_user if key[0] == "user" else rule.reg_movie
        w = n[key] if rule.per_rating else 1.0
        fn = f[key] + rule.lr * g[key] - rule.lr * lam * w * f[key] if n[key] else f[key]
        bn = b[key] + (rule.bias_ratio * rule.lr * se[key] if rule.use_bias else 0.0)
        if rule.use_bias and rule.reg_bias:
            bn -= rule.lr * lam * w * b[key]
        out[key] = (fn, bn)
    return out


def test_epoch_matches_numpy(spark):
    r = ratings(spark, SF_SMALL)
    train = r.where("category in (1,2,3,6)").select("user_id", "movie_id", "rating")
    k = 3
    m0 = M.init_model(r, k)
    mu = 3.0
    rows = [(x.user_id, x.movie_id, x.rating) for x in train.collect()]
    model = [(x.side, x.id, x.f, x.b) for x in m0.collect()]
    for rule in (M.rule_bias_model(0.003), M.rule_factor_only(0.003), M.rule_full_batch(0.001), M.rule_per_rating(0.001)):
        got = {(x.side, x.id): (np.array(x.f), x.b) for x in M.epoch(train, m0, mu, rule, k).collect()}
        want = _np_step(rows, model, mu, rule, k)
        assert set(got) == set(want)
        for key, (fw, bw) in want.items():
            assert np.allclose(got[key][0], fw, rtol=0, atol=1e-12), key
            assert abs(got[key][1] - bw) < 1e-12


def test_rmse_and_unseen_entities(spark):
    r = ratings(spark, SF_SMALL)
    m0 = M.init_model(r.where("category = 1"), 2)
    probe = r.where("category = 4")
    s = M.scored_all(probe, m0.where("id % 3 <> 0"), 3.0)
    # unseen ids score with their initial factors and no bias: here as if the model had them
    assert s.count() == probe.count()
    full = M.scored_all(probe, M.init_model(r, 2), 3.0)
    assert abs(M.rmse_value(s) - M.rmse_value(full)) < 1e-12
    v = M.rmse_value(s)
    es = [x.e for x in s.select("e").collect()]
    assert abs(v - math.sqrt(sum(e * e for e in es) / len(es))) < 1e-12


def test_rollback_on_divergence(spark):
    """A huge learning rate makes valid RMSE rise (or NaN): step rolled back, rate × 0.8."""
    r = ratings(spark, SF_SMALL)
    cfg = fit.FitConfig(run="diverge", k=3, iterations=2, lr=5.0)
    res = fit.fit_adaptive(spark, r, cfg)
    log = res.log_rows
    assert log[0][5] is False and log[1][5] is False
    assert abs(log[1][2] - 5.0 * 0.8) < 1e-12
    # rolled back: the kept model is still the initial one
    m_final = spark.read.parquet(res.final_model)
    m_init = spark.read.parquet(res.final_model.replace("/final", "/epoch=0"))
    assert m_final.exceptAll(m_init).count() == 0


def test_small_rate_decreases_rmse(spark):
    r = ratings(spark, SF_SMALL)
    res = fit.fit_adaptive(spark, r, fit.FitConfig(run="mono", k=3, iterations=3, lr=0.001))
    vals = [row[3] for row in res.log_rows]
    assert all(row[5] for row in res.log_rows)
    assert vals == sorted(vals, reverse=True)
    best = fit.best_iteration(res.run_log).collect()[0]
    assert best.best_probe_rmse == min(row[4] for row in res.log_rows)


def test_gram_and_norm(spark):
    m = spark.createDataFrame([("user", 1, [1.0, 2.0], 0.0), ("user", 2, [3.0, 4.0], 0.0)], "side string, id long, f array<double>, b double")
    assert M.factor_norm(m).collect()[0].norm == 30.0
    # Gram = [[10, 14], [14, 20]] → 100 + 196 + 196 + 400
    assert M.gram_norm(m, 2).collect()[0].gram_norm == 892.0


def test_run_log_csv_format(spark, tmpdir_fresh):
    log = spark.createDataFrame([("r", 2, 0.1, 0.95, 0.97, True), ("r", 1, 0.1, 0.96, 0.98, True)], fit.S.RUN_LOG)
    import glob

    other = log.limit(1).withColumn("run", F.lit("a b/c"))
    for rows in (log, other, log):   # a repeated job replaces its own run's lines only
        fit.write_run_log_csv(rows, f"{tmpdir_fresh}/log")
    lines = []
    for f in sorted(glob.glob(f"{tmpdir_fresh}/log/run=r/part-*")):
        lines += open(f).read().splitlines()
    assert lines == ["1, 0.9600000, 0.9800000", "2, 0.9500000, 0.9700000"]
    back = fit.read_run_log_csv(spark, f"{tmpdir_fresh}/log").orderBy("row_no").collect()
    assert [(r.run, r.iteration, r.valid_rmse) for r in back if r.run == "r"] == [("r", 1, 0.96), ("r", 2, 0.95)]
    assert [r.run for r in back if r.run != "r"] == ["a b/c"]


def test_als_crosscheck(spark):
    from reelstat.plans.als import als_fit, als_rmse

    r = ratings(spark, SF_SMALL)
    model, mu = als_fit(r.where("category in (1,2,3,6)"), k=4, iterations=5)
    got = als_rmse(model, r.where("category = 4"), mu).collect()[0]
    assert got.n > 0 and 0 < got.rmse < 3


def test_write_ordered_movie_major(spark, tmpdir_fresh):
    from reelstat.sources.tables import write_ordered
    from reelstat.sources import binary

    r = ratings(spark, SF_SMALL)
    write_ordered(r, f"{tmpdir_fresh}/mu", fmt="ratings_bin", partitions=4)
    back = sorted(binary.read_ratings_bin(spark, f"{tmpdir_fresh}/mu").collect(), key=lambda x: x.row_no)
    keys = [(x.movie_id, x.user_id, x.date) for x in back]
    assert keys == sorted(keys) and len(keys) == 6000


def test_rate_probe_inside_fit_loop(spark):
    """tune_freq = 1: after every logged step the rate is probed (×1.5, ÷1.5, ×1) and the best kept."""
    r = ratings(spark, SF_SMALL)
    cfg = fit.FitConfig(run="tune", k=3, iterations=2, lr=0.001, tune_freq=1)
    res = fit.fit_adaptive(spark, r, cfg)
    rates = [row[2] for row in res.log_rows]
    assert len(rates) == 2
    # the second step's rate is the first ×1.005 (accepted) and then ×1.5, ÷1.5 or unchanged
    base = rates[0] * 1.005
    assert any(abs(rates[1] - x) < 1e-12 for x in (base * 1.5, base / 1.5, base))
    kv = {x.key: x.value for x in res.run_params.collect()}
    assert kv["mu_bips"] == str(int(res.mu * 10000)) and len(kv["stamp"]) == 9


def test_a_step_that_ends_in_nan_is_rolled_back(spark):
    """F8: a rate so high that the factors overflow; the residuals are NaN and the model before stays."""
    r = ratings(spark, SF_SMALL)
    cfg = fit.FitConfig(run="nan", k=2, iterations=1, lr=1e300, tune_freq=100)
    train = r.where("category in (1, 2, 3, 6)")
    model = M.epoch(train, M.init_model(r, 2), 3.0, cfg.step_rule(1e300), 2)
    assert math.isnan(fit.holdout_rmse(r.where("category = 2"), model, 3.0, True, 2))
    log = fit.fit_adaptive(spark, r, cfg).log_rows
    assert [row[5] for row in log] == [False] and not math.isnan(log[0][3])
