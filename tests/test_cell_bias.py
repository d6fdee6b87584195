"""The model with a bias per cell and the total error, against plain loops."""


import pytest

from reelstat.functions.expressions import fixed
from reelstat.operators import cell_bias as CB, model as M
from reelstat.plans import fit

CELLS = [(1, 1, 5), (1, 2, 3), (2, 1, 4), (3, 2, 1), (3, 3, 2), (1, 1, 1)]


def _plain(k, lr, reg, epochs):
    cells = {}
    for u, m, r in CELLS:
        cells[u, m] = cells.get((u, m), 0) + r
    vec = lambda i: [0.05 * ((i * 31 + j * 17) % 1000) / 1000 for j in range(k)]
    p, q = {u: vec(u) for u, _ in cells}, {m: vec(m) for _, m in cells}
    b = dict.fromkeys(cells, 3.0)
    for _ in range(epochs):
        e = {c: r - (b[c] + sum(x * y for x, y in zip(p[c[0]], q[c[1]]))) for c, r in cells.items()}
        step = lambda f, v, mine: [f[j] + lr * (sum(e[c] * v(c)[j] for c in mine) - reg * len(mine) * f[j]) for j in range(k)]
        p, q = (
            {u: step(p[u], lambda c: q[c[1]], [c for c in cells if c[0] == u]) for u in p},
            {m: step(q[m], lambda c: p[c[0]], [c for c in cells if c[1] == m]) for m in q},
        )
        b = {c: b[c] + lr * (e[c] - reg * b[c]) for c in cells}
    e = {c: r - (b[c] + sum(x * y for x, y in zip(p[c[0]], q[c[1]]))) for c, r in cells.items()}
    gram = sum(sum(f[i] * f[j] for f in side.values()) ** 2 for side in (p, q) for i in range(k) for j in range(k))
    return p, q, b, sum(x * x for x in e.values()) + sum(x * x for x in b.values()) + gram


@pytest.mark.parametrize("k", [1, 4])
def test_epochs_and_total_error(spark, k):
    r = spark.createDataFrame(CELLS, "user_id long, movie_id int, rating int")
    paths = fit.fit_cell_bias(spark, r, k, 0.1, 0.2, 3, init=None)
    cells, model = (spark.read.parquet(x) for x in paths)
    p, q, b, error = _plain(k, 0.1, 0.2, 3)
    got = {(x.side, x.id): x.f for x in model.collect()}
    for side, vectors in (("user", p), ("movie", q)):
        for i, f in vectors.items():
            assert got[side, i] == pytest.approx(f)
    assert {(x.user_id, x.movie_id): x.b_ui for x in cells.collect()} == pytest.approx(b)
    assert M.total_error(CB.scored_cells(cells, model, k), model, k).first()[0] == pytest.approx(error)


def test_fixed_rounds_as_printf(spark):
    values = [k / n for n in (1, 3, 8, 16, 32, 80, 400, 2000) for k in range(1, 4 * n, max(1, n // 40))]
    values += [2.0005, 1.0005, 0.0625, 0.1875, 1e-9, 12345.0625, 0.0005, 0.9995, -0.0625, -2.0005]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (3, 5):
        assert [r[0] for r in df.select(fixed("x", digits)).collect()] == [f"{v:.{digits}f}" for v in values]
