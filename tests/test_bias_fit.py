from conftest import SF_SMALL
from reelstat.functions.expressions import DRAW_MOD, DRAW_MULTS
from reelstat.operators import bias_fit as BF
from reelstat.sources.tables import ratings


def _key(*parts):
    x = sum(p * m for p, m in zip(parts, DRAW_MULTS)) % DRAW_MOD
    return (x * x + x) % DRAW_MOD // 256


def test_one_step_equals_sequential_model(spark):
    r = ratings(spark, SF_SMALL).where("category in (1,2,3,6)").select("user_id", "movie_id", "date", "rating")
    rows = [(x.user_id, x.movie_id, x.date, x.rating) for x in r.collect()]
    mu = sum(x[3] for x in rows) / len(rows)
    lr, reg, batch = 0.1, 0.5, 3
    bu = {u: 0.1 for u, _, _, _ in rows}
    bm = {m: 0.1 for _, m, _, _ in rows}
    by_user, by_movie = {}, {}
    for u, m, d, rt in rows:
        by_user.setdefault(u, []).append((m, d, rt))
        by_movie.setdefault(m, []).append((u, d, rt))
    new_bu = {}
    for u, rs in by_user.items():
        s = 0.0
        for dd in range(1, batch + 1):
            m, d, rt = min(rs, key=lambda x: (_key(u, x[0], x[1], x[2], 1, dd), x[0], x[2]))
            s += rt - mu - bu[u] - bm[m]
        new_bu[u] = bu[u] - lr * (reg * 2 * bu[u] - 2 * s)
    new_bm = {}
    for m, rs in by_movie.items():
        s = 0.0
        for dd in range(1, batch + 1):
            u, d, rt = min(rs, key=lambda x: (_key(m, x[0], x[1], x[2], 1, dd), x[0], x[2]))
            s += rt - mu - new_bu[u] - bm[m]
        new_bm[m] = bm[m] - lr * (reg * 2 * bm[m] - 2 * s)
    bu0, bm0 = BF.init_biases(r)
    bu1, bm1 = BF.step(BF.draws(r, [1], batch), bu0, bm0, mu, batch, lr, reg)
    got_u = {x.user_id: x.bu for x in bu1.collect()}
    got_m = {x.movie_id: x.bm for x in bm1.collect()}
    assert max(abs(got_u[u] - v) for u, v in new_bu.items()) < 1e-9
    assert max(abs(got_m[m] - v) for m, v in new_bm.items()) < 1e-9
    # objective: per-cell λ·bm² and per-user λ·bu²
    obj = BF.objective(r, bu1, bm1, mu, reg).collect()[0].objective
    want = sum((rt - mu - new_bu[u] - new_bm[m]) ** 2 + reg * new_bm[m] ** 2 for u, m, _, rt in rows)
    want += reg * sum(v * v for v in new_bu.values())
    assert abs(obj - want) < 1e-6 * abs(want)


def test_draws_are_hash_aggregates_from_one_scan(spark):
    r = ratings(spark, SF_SMALL).select("user_id", "movie_id", "date", "rating")
    drawn = BF.draws(r, [1, 2], 3)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.count("FileScan parquet") == 2  # lineitem and orders once each
    assert drawn.where("step = 1").count() == drawn.where("step = 2").count()


def test_more_draws_than_sixteen_stay_apart(spark):
    r = spark.createDataFrame([(1, m, 1, 1 + m % 5) for m in range(1, 400)], "user_id long, movie_id int, date int, rating int")
    got = [x.partner for x in BF.draws(r, [1, 2], 18).where("side = 'user'").orderBy("step").collect()]
    assert len(got) == 36 and len(set(got)) > 25


def test_a_block_of_steps_takes_one_pass_of_objectives(spark, monkeypatch):
    from reelstat.plans import fit as FIT

    rows = [(1 + i % 37, 1 + i * i % 23, i % 50, 1 + i % 5) for i in range(900)]
    r = spark.createDataFrame([*rows, (None, 3, 1, 2)], "user_id long, movie_id int, date int, rating int")
    mu, batch, lr, reg, steps = r.selectExpr("avg(rating)").first()[0], 2, 0.01, 0.5, 5
    monkeypatch.setattr(FIT, "DRAW_BLOCK", 3)
    drawn, state, want = BF.draws(r, list(range(1, steps + 1)), batch).cache(), BF.init_biases(r), []
    want = [BF.objective(r, *state, mu, reg).first()[0]]
    for i in range(1, steps + 1):
        t = BF.to_table(*BF.step(drawn.where(f"step = {i}"), *state, mu, batch, lr, reg)).localCheckpoint()
        state = BF.from_table(t)
        want.append(BF.objective(r, *state, mu, reg).first()[0])
    calls, objectives = [], BF.objectives
    monkeypatch.setattr(BF, "objectives", lambda rows, tables, *a: calls.append(len(tables)) or objectives(rows, tables, *a))
    log, path = FIT.fit_bias_sgd(spark, r, -1.0, steps, batch, lr, reg)
    got = log.orderBy("step").collect()
    assert calls == [FIT.DRAW_BLOCK + 1, steps - FIT.DRAW_BLOCK] and path.endswith(f"step={steps}")
    assert [x.step for x in got] == list(range(1, steps + 1))
    assert all(abs(x.objective_before - a) < 1e-6 * a and abs(x.objective_after - b) < 1e-6 * b for x, a, b in zip(got, want, want[1:]))
    # the stopping step is logged, and its biases are the last ones, though its block goes on
    moves = [abs(b - a) for a, b in zip(want, want[1:])]
    stop = moves[1] * 1.001 if moves[0] > moves[1] * 1.001 else moves[0] * 1.001
    last = next(i for i, m in enumerate(moves, 1) if m < stop)
    log, path = FIT.fit_bias_sgd(spark, r, stop, steps, batch, lr, reg)
    assert log.count() == last and path.endswith(f"step={last}")


def test_stored_sides_hold_an_entity_in_one_place(spark, tmpdir_fresh):
    rows = [(1 + i % 211, 1 + i * 7 % 113, i % 50, 1 + i % 5) for i in range(6000)]
    r = spark.createDataFrame(rows, "user_id long, movie_id int, date int, rating int").repartition(6)
    BF.by_entity(r).write.parquet(f"{tmpdir_fresh}/sides")
    stored = spark.read.parquet(f"{tmpdir_fresh}/sides")
    files = stored.selectExpr("side", "id", "_metadata.file_path f").distinct()
    entities = files.select("side", "id").distinct().count()
    assert entities == 211 + 113 and files.count() <= entities + 8
    assert sorted(map(tuple, BF.draws_of(stored, [1, 2], 3).collect())) == sorted(map(tuple, BF.draws(r, [1, 2], 3).collect()))
