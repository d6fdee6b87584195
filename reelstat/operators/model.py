"""Latent-factor model as DataFrames.

The model is one table ``factors(side, id, f, b)``: ``side`` is ``'user'`` or
``'movie'``, ``f`` the factor vector (p or q), ``b`` the bias (bu or bm). The
views ``user_factors`` / ``movie_factors`` give the canonical column names.

One training epoch is one plan:

    ratings ⋈ user rows (on user_id) ⋈ movie rows (on movie_id)   -- residual e
      → inline: (user, user_id, e, q) and (movie, movie_id, e, p)  -- 2 rows each
      → groupBy(side, id): n, Σe, Σ e·v[k]                         -- partial agg map-side
      → factors ⟕ gradients on (side, id) → update                 -- K + 2 numbers per key

so the ratings are scanned and joined once, a hot user or movie collapses to
one partial row per task before the shuffle, and the only data that grows with
the ratings is never broadcast. Join strategy is left to Catalyst/AQE, which
broadcasts a factor side only when its measured size is under the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import INIT_RANGE
from ..functions.expressions import clamp, const_vector, dot, init_vector, sum_squares
from .grid import GridScores, RatingGrid

USER, MOVIE = "user", "movie"


# ---------------------------------------------------------------------------
# model tables
# ---------------------------------------------------------------------------

def user_factors(model: DataFrame) -> DataFrame:
    return model.where(F.col("side") == USER).select(
        F.col("id").alias("user_id"), F.col("f").alias("p"), F.col("b").alias("bu"))


def movie_factors(model: DataFrame) -> DataFrame:
    return model.where(F.col("side") == MOVIE).select(
        F.col("id").cast("int").alias("movie_id"), F.col("f").alias("q"), F.col("b").alias("bm"))


def from_factors(user_f: DataFrame, movie_f: DataFrame) -> DataFrame:
    """Canonical user/movie factor tables → one model table."""
    return user_f.select(F.lit(USER).alias("side"), F.col("user_id").cast("long").alias("id"),
                         F.col("p").alias("f"), F.col("bu").alias("b")).unionByName(
        movie_f.select(F.lit(MOVIE).alias("side"), F.col("movie_id").cast("long").alias("id"),
                       F.col("q").alias("f"), F.col("bm").alias("b")))


def init_model(ratings: DataFrame, k: int, init_range: float = 0.05, constant: float | None = None,
               bias: float = 0.0) -> DataFrame:
    """One row per user and movie seen in ``ratings``.

    Factors are ``init_range · ((id·31 + j·17) mod 1000) / 1000`` (repeatable
    in any engine), or ``constant`` for every element (M1b); biases ``bias``.
    Pass the union of all splits so holdout users are in the model (J4).
    """
    ids = ratings.select(F.inline(F.array(
        F.struct(F.lit(USER).alias("side"), F.col("user_id").cast("long").alias("id")),
        F.struct(F.lit(MOVIE).alias("side"), F.col("movie_id").cast("long").alias("id")),
    ))).distinct()
    f = const_vector(constant, k) if constant is not None else init_vector("id", k, init_range)
    return ids.select("side", "id", f.alias("f"), F.lit(float(bias)).alias("b"))


def model_long(model: DataFrame, digits: int = 6) -> DataFrame:
    """Model as flat rows (side, id, k, value) plus the bias as k = -1 (for reports and checks)."""
    vals = model.select("side", "id", F.posexplode("f").alias("k", "value")).select(
        "side", "id", F.col("k").cast("int").alias("k"), "value")
    bias = model.select("side", "id", F.lit(-1).alias("k"), F.col("b").alias("value"))
    return vals.unionByName(bias).withColumn("value", F.round("value", digits))


# ---------------------------------------------------------------------------
# prediction and residuals
# ---------------------------------------------------------------------------

def scored(ratings: DataFrame | RatingGrid, model: DataFrame, mu: float | Column = 0.0, use_bias: bool = True,
           k: int | None = None) -> DataFrame | GridScores:
    """Ratings with p, q, biases, prediction ``pred`` (centred) and residual ``e``.

    ``pred = p·q (+ bu + bm)``; ``e = (rating − μ) − pred``. Inner joins: build
    the model over the ids of all splits (``init_model`` on the whole table,
    J4) so every rated id has a row, as the reference preallocates all ids.
    Pass ``k`` to unroll the dot product into codegen'd arithmetic.
    Ratings stored as a ``RatingGrid`` (``k`` is needed then) give the sums that ``gradients`` and ``rmse_value`` ask for.
    """
    if isinstance(ratings, RatingGrid):
        return ratings.scored(model, mu, use_bias, k)
    return scored_rows(ratings.join(user_factors(model), "user_id").join(movie_factors(model), "movie_id"), mu, use_bias, k)


def scored_rows(s: DataFrame, mu: float | Column = 0.0, use_bias: bool = True, k: int | None = None) -> DataFrame:
    """``pred`` and ``e`` of ratings that already have p, q, bu and bm."""
    mu = mu if isinstance(mu, Column) else F.lit(float(mu))
    pred = dot("p", "q", k)
    if use_bias:
        pred = pred + F.col("bu") + F.col("bm")
    return s.withColumn("pred", pred).withColumn("e", (F.col("rating") - mu) - F.col("pred"))


def width(model: DataFrame) -> int:
    """K, read from the model itself."""
    row = model.select(F.size("f").alias("k")).first()
    if row is None:
        raise ValueError("the model has no rows")
    return row["k"]


def scored_all(ratings: DataFrame, model: DataFrame, mu: float | Column = 0.0, use_bias: bool = True, k: int | None = None,
               init_range: float = INIT_RANGE) -> DataFrame:
    """``scored`` for evaluation and scoring: every row of ``ratings`` stays.

    An id that the model never saw has its initial factors (the rule that fits start from) and
    zero bias. ``k`` is read from the model if it is not given.
    """
    mu = mu if isinstance(mu, Column) else F.lit(float(mu))
    k = width(model) if k is None else k
    s = ratings.join(user_factors(model), "user_id", "left").join(movie_factors(model), "movie_id", "left")
    s = s.withColumns({
        "p": F.coalesce("p", init_vector("user_id", k, init_range)),
        "q": F.coalesce("q", init_vector("movie_id", k, init_range)),
        "bu": F.coalesce("bu", F.lit(0.0)),
        "bm": F.coalesce("bm", F.lit(0.0)),
    })
    pred = dot("p", "q", k)
    if use_bias:
        pred = pred + F.col("bu") + F.col("bm")
    return s.withColumn("pred", pred).withColumn("e", (F.col("rating") - mu) - F.col("pred"))


def first_biases(model: DataFrame, n: int = 10) -> DataFrame:
    """S3: the biases of the first ``n`` ids per side (a top-n report: the limit is the feature)."""
    from pyspark.sql import Window

    w = Window.partitionBy("side").orderBy("id")
    # per side a top-n: Spark plans a per-partition limit before the shuffle
    return model.select("side", "id", "b").withColumn("_r", F.row_number().over(w)).where(
        F.col("_r") <= n).drop("_r")


def predicted_rating(s: DataFrame, mu: float | Column, clamp_range: tuple[float, float] | None = None) -> Column:
    """P10 (+ P8): μ + prediction, optionally clamped to [1, 5]."""
    mu = mu if isinstance(mu, Column) else F.lit(float(mu))
    x = mu + F.col("pred")
    return clamp(x, *clamp_range) if clamp_range else x


def rmse(s: DataFrame, e: str = "e") -> DataFrame:
    """One row ``rmse = sqrt(Σe² / n)``, ``n`` (unclamped, as the reference)."""
    return s.agg(F.sqrt(F.avg(F.col(e) * F.col(e))).alias("rmse"), F.count(F.lit(1)).alias("n"))


def rmse_value(s: DataFrame | GridScores, e: str = "e") -> float:
    """G5 as a number (one tiny action)."""
    if isinstance(s, GridScores):
        return s.rmses(s.sums(gradients=False))[s.grid.names[0]]
    v = rmse(s, e).first()["rmse"]
    return float("nan") if v is None else float(v)


def residual_sums(s: DataFrame, key: str) -> DataFrame:
    """G6 (+ P12 when filtered on ``se != 0``): Σe per user or movie."""
    return s.groupBy(key).agg(F.sum("e").alias("se"), F.count(F.lit(1)).alias("n"))


def gradients(s: DataFrame | GridScores, k: int, squares: bool = False) -> DataFrame:
    """G7 for both sides in one pass: (side, id, n, se, g) with g[j] = Σ e·v[j]; ``squares`` adds ss = Σe² and its count ne.

    Users sum e·q, movies e·p. Each scored row becomes two rows (``inline``),
    then a single partially aggregated ``groupBy(side, id)``.
    """
    if isinstance(s, GridScores):
        own = s.sums().where(F.col("side") != "set")
        return own if squares else own.drop("ss", "ne")
    two = s.select(F.inline(F.array(
        F.struct(F.lit(USER).alias("side"), F.col("user_id").cast("long").alias("id"),
                 F.col("e").alias("e"), F.col("q").alias("v")),
        F.struct(F.lit(MOVIE).alias("side"), F.col("movie_id").cast("long").alias("id"),
                 F.col("e").alias("e"), F.col("p").alias("v")),
    )))
    return two.groupBy("side", "id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("e").alias("se"),
        F.array(*[F.sum(F.col("e") * F.col("v")[j]) for j in range(k)]).alias("g"),
        *([F.sum(F.col("e") * F.col("e")).alias("ss"), F.count("e").alias("ne")] if squares else []),
    )


def factor_norm(model: DataFrame) -> DataFrame:
    """ΣΣ f² per side."""
    return model.groupBy("side").agg(F.sum(sum_squares("f")).alias("norm"))


def _gram_sums(k: int) -> list[str]:
    """The upper triangle of a side's Gram matrix, row by row, as ``sum`` expressions."""
    return [f"sum(f[{i}] * f[{j}])" for i in range(k) for j in range(i, k)]


def _squared(k: int, g: str = "g") -> str:
    """Σ of the squared Gram entries from the triangle ``g``: an entry off the diagonal stands for two."""
    diagonal, at = [], 0
    for i in range(k):
        diagonal.append(at)
        at += k - i
    add = "(s, x) -> s + x * x"
    on = f"aggregate(array({', '.join(f'{g}[{i}]' for i in diagonal)}), 0D, {add})"
    return f"(2 * aggregate({g}, 0D, {add}) - {on})"


def gram_norm(model: DataFrame, k: int) -> DataFrame:
    """Σ_{i,j} (Σ_entities f_i·f_j)² per side.

    The Gram matrix is symmetric: its K(K+1)/2 entries are plain sum columns of one partially aggregated
    pass, so a task gives one row per side.
    """
    sums = model.groupBy("side").agg(F.expr(f"array({', '.join(_gram_sums(k))})").alias("g"))
    return sums.select("side", F.expr(_squared(k)).alias("gram_norm"))


def total_error(cells: DataFrame, model: DataFrame, k: int, e: str = "e", b: str = "b_ui") -> DataFrame:
    """G11 as one row ``total_error``: Σ(e² + b²) over the rating cells + ‖QQᵀ‖² + ‖PPᵀ‖².

    Two partially aggregated passes, one over the cells and one over the entities, that each end in one or two rows.
    """
    own = cells.agg(F.sum(F.col(e) * F.col(e) + F.col(b) * F.col(b)).alias("x")).select("x")
    norms = gram_norm(model, k).agg(F.sum("gram_norm").alias("x"))
    return own.unionByName(norms).agg(F.sum("x").alias("total_error"))


# ---------------------------------------------------------------------------
# training steps
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class StepRule:
    """One batch step: f += γ·(g − λ·w·f), b += ρ·γ·Σe − [reg_bias] γ·λ·w·b.

    w = n (the entity's rating count) when ``per_rating`` — the per-rating
    regularisation of a sequential pass, summed — else 1 (once per epoch).
    """

    lr: float
    reg_user: float = 0.002
    reg_movie: float = 0.002
    bias_ratio: float = 0.02
    use_bias: bool = True
    per_rating: bool = True
    reg_bias: bool = False


# Named rules (M4, M4b, M4c, M5, M6 re-aimed).
def rule_bias_model(lr, reg_user=0.002, reg_movie=0.002, bias_ratio=0.02):
    return StepRule(lr, reg_user, reg_movie, bias_ratio, True, True, False)


def rule_factor_only(lr, reg_user=0.002, reg_movie=0.002):
    return StepRule(lr, reg_user, reg_movie, 0.0, False, True, False)


def rule_unregularised(lr):
    return StepRule(lr, 0.0, 0.0, 0.0, False, True, False)


def rule_full_batch(lr, reg=0.001):
    return StepRule(lr, reg, reg, 1.0, True, False, True)


def rule_per_rating(lr, reg=0.001):
    return StepRule(lr, reg, reg, 1.0, True, True, True)


def apply_gradients(model: DataFrame, grads: DataFrame, rule: StepRule, squares: bool = False) -> DataFrame:
    """New model from the old one and one pass of gradients (entities without ratings keep their values).

    ``squares`` keeps each entity's ss and ne: the old model's RMSE is then ``rmse_of_sums`` of the new table.
    """
    lam = F.when(F.col("side") == USER, F.lit(rule.reg_user)).otherwise(F.lit(rule.reg_movie))
    j = model.join(grads, ["side", "id"], "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    se = F.coalesce(F.col("se"), F.lit(0.0))
    w = n if rule.per_rating else F.lit(1.0)
    gamma = F.lit(rule.lr)
    f_new = F.when(
        F.col("g").isNull(), F.col("f")
    ).otherwise(F.zip_with("f", "g", lambda f, g: f + gamma * g - gamma * lam * w * f))
    if rule.use_bias:
        b_new = F.col("b") + F.lit(rule.bias_ratio) * gamma * se
        if rule.reg_bias:
            b_new = b_new - gamma * lam * w * F.col("b")
    else:
        b_new = F.col("b")
    return j.select("side", "id", f_new.alias("f"), b_new.alias("b"), *(["ss", "ne"] if squares else []))


def epoch(train: DataFrame | RatingGrid, model: DataFrame, mu: float | Column, rule: StepRule, k: int, squares: bool = False) -> DataFrame:
    """One batch step over ``train`` (simultaneous p/q update)."""
    s = scored(train, model, mu, rule.use_bias, k)
    return apply_gradients(model, gradients(s, k, squares), rule, squares)


def rmse_of_sums(stepped: DataFrame) -> float:
    """G5 on ``train`` of the model that ``epoch(..., squares=True)`` started from: every rating is in one user's sums."""
    v = stepped.where(F.col("side") == USER).agg(F.sqrt(F.sum("ss") / F.sum("ne")).alias("rmse")).first()["rmse"]
    return float("nan") if v is None else float(v)


def cell_bias_update(s: DataFrame, lr: float, reg: float, bias: str = "b_ui") -> DataFrame:
    """M7: per-(user, movie) bias b += γ·(e − λ·b), row-wise."""
    return s.withColumn(bias, F.col(bias) + F.lit(lr) * (F.col("e") - F.lit(reg) * F.col(bias)))
