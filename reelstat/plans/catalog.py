"""Query catalogue: one Spark plan and (where SQL can say it) one oracle per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile
from ..schema import PROBE_CATEGORY, TRAIN_CATEGORIES
from ..session import materialize
from ..sources.tables import ratings
from . import oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _train(spark, sf_dir):
    return ratings(spark, sf_dir).where(F.col("category").isin(*TRAIN_CATEGORIES))


@register("movie_summary", oracle.movie_summary_sql("category IN (1, 2, 3, 6)"))
def q_movie_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.movie_summary(_train(spark, sf_dir))


@register("movie_summary_sparse", oracle.movie_summary_sql(f"category = {PROBE_CATEGORY}"))
def q_movie_summary_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.movie_summary(ratings(spark, sf_dir).where(F.col("category") == PROBE_CATEGORY))


# ---------------------------------------------------------------------------
# parameters of the registered queries (fixed, data-independent)
# ---------------------------------------------------------------------------

K = 4                 # factors in oracle-checked model queries
LR = 0.002            # batch learning rate (a batch step sums over an entity's ratings)
REG = 0.002           # λ user = λ movie (reference constants)
RATIO = 0.02          # bias learning ratio (reference constant)
PY_LR, PY_REG = 0.0005, 0.001   # Python-trainer style rules (M5 / M6 re-aimed)
CHUNK = 5000          # lines per chunk for the chunk writer on the fixture
FIRST_N = 5000        # rows of the row-limited scan (the reference's n_entries)
ORDER = ["user_id", "movie_id", "date", "rating", "category"]
ORDER_SQL = ", ".join(ORDER)

from ..operators import basic, model as M, positional, splits  # noqa: E402
from ..schema import VALID_CATEGORY  # noqa: E402
from .oracle import (  # noqa: E402
    TRAIN_WHERE, dot_sql, model_ctes, model_long_sql, scored_cte, step_ctes, with_ratings,
)

R = "ratings"


def _numbered(spark, sf_dir):
    return positional.number_by(ratings(spark, sf_dir), ORDER)


NUMBERED_SQL = f"d AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS row_no FROM ratings)"


# ---- splits -----------------------------------------------------------------

@register("split_route", with_ratings() + """SELECT *, CASE WHEN category < 4 OR category = 6 THEN 'train'
  WHEN category = 4 THEN 'probe' WHEN category = 5 THEN 'test' END AS split FROM ratings
  WHERE category < 7""")
def q_split_route(spark, sf_dir):
    return splits.route(ratings(spark, sf_dir))


def _short_index(spark, sf_dir):
    """Data numbered by the total order; an index holding only the first 90 % of the categories."""
    d = _numbered(spark, sf_dir)
    n = d.count()
    index = d.where(F.col("row_no") < n * 9 // 10).select("row_no", "category")
    return positional.positional_zip(d.drop("category"), index, rows=n)


SHORT_INDEX_SQL = [
    NUMBERED_SQL,
    "idx AS (SELECT row_no, category FROM d WHERE row_no < (SELECT count(*) FROM ratings) * 9 // 10)",
    "z AS (SELECT d.row_no, user_id, movie_id, date, rating, coalesce(idx.category, 6) AS category "
    "FROM d LEFT JOIN idx USING (row_no))",
]


@register("positional_zip", with_ratings(*SHORT_INDEX_SQL) + "SELECT * FROM z")
def q_positional_zip(spark, sf_dir):
    return _short_index(spark, sf_dir)


REPORT_SQL = ", ".join(
    [f"count(*) FILTER (WHERE category = {c}) AS {label}" for label, c in splits.REPORT_LABELS]
    + ["count(*) FILTER (WHERE category < 1 OR category > 6) AS invalid"])


@register("split_report", with_ratings(*SHORT_INDEX_SQL) + f"""SELECT source, count(*) AS entries, {REPORT_SQL}
FROM (SELECT 'ratings' AS source, category FROM ratings UNION ALL SELECT 'short_index', category FROM z)
GROUP BY source""")
def q_split_report(spark, sf_dir):
    return splits.split_report({"ratings": ratings(spark, sf_dir), "short_index": _short_index(spark, sf_dir)})


@register("split_dump", with_ratings() + """SELECT split, concat_ws(' ', user_id, movie_id, date, rating, category) AS line
FROM (SELECT 'train' AS split, * FROM ratings WHERE category < 4 OR category = 6
      UNION ALL SELECT 'probe', * FROM ratings WHERE category = 4
      UNION ALL SELECT 'test', * FROM ratings WHERE category = 5)""")
def q_split_dump(spark, sf_dir):
    routed = splits.route(ratings(spark, sf_dir))
    return splits.split_dump({s: routed.where(F.col("split") == s) for s in ("train", "probe", "test")})


@register("category_filter", with_ratings() + f"SELECT user_id, movie_id, rating FROM ratings WHERE category = {VALID_CATEGORY}")
def q_category_filter(spark, sf_dir):
    return splits.category_filter(ratings(spark, sf_dir), VALID_CATEGORY)


ZERO_SQL = "rz AS (SELECT user_id, movie_id, date, CASE WHEN category = 5 THEN 0 ELSE rating END AS rating, category FROM ratings)"


def _ratings_zero(spark, sf_dir):
    r = ratings(spark, sf_dir)
    return r.withColumn("rating", F.when(F.col("category") == 5, F.lit(0)).otherwise(F.col("rating")))


@register("nonzero_filter", with_ratings(ZERO_SQL) + "SELECT * FROM rz WHERE rating <> 0")
def q_nonzero_filter(spark, sf_dir):
    return splits.nonzero(_ratings_zero(spark, sf_dir))


# ---- projections / whole-table aggregates ----------------------------------------

@register("global_mean", with_ratings() + "SELECT round(avg(rating), 9) AS mean_rating FROM ratings")
def q_global_mean(spark, sf_dir):
    return ratings(spark, sf_dir).agg(F.round(F.avg("rating"), 9).alias("mean_rating"))


@register("row_count", with_ratings() + "SELECT count(*) AS entries FROM ratings")
def q_row_count(spark, sf_dir):
    return ratings(spark, sf_dir).agg(F.count(F.lit(1)).alias("entries"))


@register("center_ratings", with_ratings() + """SELECT user_id - 1 AS user_id, movie_id - 1 AS movie_id, date, category,
  round(rating - (SELECT avg(rating) FROM ratings), 6) AS r FROM ratings""")
def q_center_ratings(spark, sf_dir):
    r = ratings(spark, sf_dir)
    c = basic.centered(basic.zero_based(r))
    return c.select("user_id", "movie_id", "date", "category", F.round("r", 6).alias("r"))


@register("merge_duplicates", with_ratings() + """SELECT user_id, movie_id, CAST(sum(rating) AS BIGINT) AS rating,
  count(*) AS copies FROM ratings GROUP BY user_id, movie_id""")
def q_merge_duplicates(spark, sf_dir):
    return basic.merge_duplicates(ratings(spark, sf_dir))


@register("seen_entities", with_ratings() + """SELECT DISTINCT 'user' AS side, user_id AS id FROM ratings
UNION SELECT DISTINCT 'movie' AS side, CAST(movie_id AS BIGINT) AS id FROM ratings""")
def q_seen_entities(spark, sf_dir):
    r = ratings(spark, sf_dir)
    u = basic.seen_entities(r, "user_id").select(F.lit("user").alias("side"), F.col("user_id").alias("id"))
    m = basic.seen_entities(r, "movie_id").select(F.lit("movie").alias("side"), F.col("movie_id").cast("long").alias("id"))
    return u.unionByName(m)


# ---- positional ------------------------------------------------------------

@register("chunk_assign", with_ratings(NUMBERED_SQL) + f"SELECT *, row_no // {CHUNK} AS chunk FROM d")
def q_chunk_assign(spark, sf_dir):
    d = _numbered(spark, sf_dir)
    return d.withColumn("chunk", positional.chunk_of("row_no", CHUNK))


@register("first_n", with_ratings(NUMBERED_SQL) + f"SELECT * FROM d WHERE row_no < {FIRST_N}")
def q_first_n(spark, sf_dir):
    return positional.first_n(_numbered(spark, sf_dir), FIRST_N)


@register("run_groups", with_ratings(
    NUMBERED_SQL,
    "st AS (SELECT movie_id, row_no AS run_start FROM (SELECT movie_id, row_no, lag(movie_id) OVER (ORDER BY row_no) AS prev FROM d) "
    "WHERE prev IS NULL OR prev <> movie_id)",
    "ru AS (SELECT movie_id, run_start, coalesce(lead(run_start) OVER (ORDER BY run_start) - 1, (SELECT max(row_no) FROM d)) AS run_end FROM st)",
) + "SELECT movie_id, run_start, run_end, run_end - run_start + 1 AS rows FROM ru")
def q_run_groups(spark, sf_dir):
    return basic.run_groups(_numbered(spark, sf_dir), "movie_id")


# ---- model read path -------------------------------------------------------

def _train_rows(spark, sf_dir):
    return _train_of(ratings(spark, sf_dir))


def _train_of(r):
    return r.where(F.col("category").isin(*TRAIN_CATEGORIES)).select("user_id", "movie_id", "rating")


def _stored(spark, sf_dir):
    """The rating view joined once and written, for queries that read it several times: each would join it anew."""
    return materialize(ratings(spark, sf_dir), "ratings")


def _mu(train):
    return basic.global_mean(train)


def _init(spark, sf_dir):
    return M.init_model(ratings(spark, sf_dir), K)


def _one_epoch(r):
    """A model after one step over the ratings ``r``, written once: its readers join a small table, not the plan that made it."""
    tr = _train_of(r)
    return materialize(M.epoch(tr, M.init_model(r, K), _mu(tr), M.rule_bias_model(LR, REG, REG, RATIO), K), "epoch")


M4_SQL = step_ctes("m0", "m1", K, LR, REG, REG, RATIO, True, True, False)


@register("init_factors", with_ratings(*model_ctes(K)) + model_long_sql("m0", K))
def q_init_factors(spark, sf_dir):
    return M.model_long(_init(spark, sf_dir))


@register("predict_dot", with_ratings(*model_ctes(K), scored_cte("s", "train", "m0", K, False))
          + "SELECT user_id, movie_id, rating, round(pred, 10) AS pred FROM s")
def q_predict_dot(spark, sf_dir):
    tr = _train_rows(spark, sf_dir)
    s = M.scored(tr, _init(spark, sf_dir), _mu(tr), use_bias=False, k=K)
    # products of init values are multiples of 2.5e-9: 10 digits has no rounding ties
    return s.select("user_id", "movie_id", "rating", F.round("pred", 10).alias("pred"))


@register("predict_bias", with_ratings(*model_ctes(K), *M4_SQL, scored_cte("s", "train", "m1", K, True))
          + "SELECT user_id, movie_id, rating, round((SELECT mu FROM mu) + pred, 6) AS prediction FROM s")
def q_predict_bias(spark, sf_dir):
    r = _stored(spark, sf_dir)
    tr = _train_of(r)
    mu = _mu(tr)
    s = M.scored(tr, _one_epoch(r), mu, use_bias=True, k=K)
    return s.select("user_id", "movie_id", "rating", F.round(M.predicted_rating(s, mu), 6).alias("prediction"))


@register("residuals", with_ratings(*model_ctes(K), *M4_SQL, scored_cte("s", "train", "m1", K, True))
          + "SELECT user_id, movie_id, rating, round(e, 6) AS e FROM s")
def q_residuals(spark, sf_dir):
    r = _stored(spark, sf_dir)
    tr = _train_of(r)
    s = M.scored(tr, _one_epoch(r), _mu(tr), use_bias=True, k=K)
    return s.select("user_id", "movie_id", "rating", F.round("e", 6).alias("e"))


def _holdout(r, where):
    return r.where(where).select("user_id", "movie_id", "rating")


RMSE_CASES = {
    "rmse_factors": (False, "category IN (1, 2, 3, 6)", lambda: F.col("category").isin(1, 2, 3, 6), "m0"),
    "rmse_bias": (True, "category = 2", lambda: F.col("category") == 2, "m1"),
    "rmse_probe": (True, "category = 4", lambda: F.col("category") == 4, "m1"),
}


def _rmse_query(use_bias, cond, model_name):
    def q(spark, sf_dir):
        r = _stored(spark, sf_dir)
        model = M.init_model(r, K) if model_name == "m0" else _one_epoch(r)
        s = M.scored(_holdout(r, cond()), model, _mu(_train_of(r)), use_bias, K)
        return M.rmse(s).select(F.round("rmse", 6).alias("rmse"), "n")
    return q


for _name, (_ub, _where, _cond, _m) in RMSE_CASES.items():
    _chain = [*model_ctes(K)] + (M4_SQL if _m == "m1" else []) + [
        f"h AS (SELECT user_id, movie_id, rating FROM ratings WHERE {_where})",
        scored_cte("s", "h", _m, K, _ub)]
    register(_name, with_ratings(*_chain) + "SELECT round(sqrt(avg(e*e)), 6) AS rmse, count(*) AS n FROM s")(
        _rmse_query(_ub, _cond, _m))


@register("residual_by_user", with_ratings(*model_ctes(K), scored_cte("s", "train", "m0", K, True))
          + "SELECT user_id, round(sum(e), 6) AS se, count(*) AS n FROM s GROUP BY user_id HAVING sum(e) <> 0")
def q_residual_by_user(spark, sf_dir):
    tr = _train_rows(spark, sf_dir)
    s = M.scored(tr, _init(spark, sf_dir), _mu(tr), k=K)
    return M.residual_sums(s, "user_id").where(F.col("se") != 0).select(
        "user_id", F.round("se", 6).alias("se"), "n")


@register("residual_by_movie", with_ratings(*model_ctes(K), scored_cte("s", "train", "m0", K, True))
          + "SELECT movie_id, round(sum(e), 6) AS se, count(*) AS n FROM s GROUP BY movie_id HAVING sum(e) <> 0")
def q_residual_by_movie(spark, sf_dir):
    tr = _train_rows(spark, sf_dir)
    s = M.scored(tr, _init(spark, sf_dir), _mu(tr), k=K)
    return M.residual_sums(s, "movie_id").where(F.col("se") != 0).select(
        "movie_id", F.round("se", 6).alias("se"), "n")


def _gradient_query(side):
    def q(spark, sf_dir):
        tr = _train_rows(spark, sf_dir)
        s = M.scored(tr, _init(spark, sf_dir), _mu(tr), k=K)
        g = M.gradients(s, K).where(F.col("side") == side)
        return g.select("id", F.posexplode("g").alias("k", "value")).select(
            "id", F.col("k").cast("int").alias("k"), F.round("value", 6).alias("value"))
    return q


for _side, _key, _vec in (("user", "user_id", "q"), ("movie", "movie_id", "p")):
    _cols = "\nUNION ALL ".join(
        f"SELECT CAST({_key} AS BIGINT) AS id, {j} AS k, round(sum(e*{_vec}[{j + 1}]), 6) AS value FROM s GROUP BY {_key}"
        for j in range(K))
    register(f"gradient_{_side}", with_ratings(*model_ctes(K), scored_cte("s", "train", "m0", K, True)) + _cols)(
        _gradient_query(_side))


@register("factor_norm", with_ratings(*model_ctes(K), *M4_SQL) + "SELECT side, round(sum("
          + " + ".join(f"f[{j + 1}]*f[{j + 1}]" for j in range(K)) + "), 6) AS norm FROM m1 GROUP BY side")
def q_factor_norm(spark, sf_dir):
    return M.factor_norm(_one_epoch(_stored(spark, sf_dir))).select("side", F.round("norm", 6).alias("norm"))


_GRAM = ", ".join(f"sum(f[{i + 1}]*f[{j + 1}]) AS g_{i}_{j}" for i in range(K) for j in range(K))
_GRAM_SUM = " + ".join(f"g_{i}_{j}*g_{i}_{j}" for i in range(K) for j in range(K))


@register("gram_norm", with_ratings(*model_ctes(K), *M4_SQL, f"gr AS (SELECT side, {_GRAM} FROM m1 GROUP BY side)")
          + f"SELECT side, round({_GRAM_SUM}, 4) AS gram_norm FROM gr")
def q_gram_norm(spark, sf_dir):
    return M.gram_norm(_one_epoch(_stored(spark, sf_dir)), K).select("side", F.round("gram_norm", 4).alias("gram_norm"))


# ---- one training step per rule ----------------------------------------------

EPOCH_RULES = {
    "epoch_bias_model": (M.rule_bias_model(LR, REG, REG, RATIO), (LR, REG, REG, RATIO, True, True, False)),
    "epoch_factor_only": (M.rule_factor_only(LR, REG, REG), (LR, REG, REG, 0.0, False, True, False)),
    "epoch_unregularised": (M.rule_unregularised(LR), (LR, 0.0, 0.0, 0.0, False, True, False)),
    "epoch_full_batch": (M.rule_full_batch(PY_LR, PY_REG), (PY_LR, PY_REG, PY_REG, 1.0, True, False, True)),
    "epoch_per_rating": (M.rule_per_rating(PY_LR, PY_REG), (PY_LR, PY_REG, PY_REG, 1.0, True, True, True)),
}


def _epoch_query(rule):
    def q(spark, sf_dir):
        r = _stored(spark, sf_dir)
        tr = _train_of(r)
        return M.model_long(M.epoch(tr, M.init_model(r, K), _mu(tr), rule, K))
    return q


for _name, (_rule, _args) in EPOCH_RULES.items():
    register(_name, with_ratings(*model_ctes(K), *step_ctes("m0", "m1", K, *_args)) + model_long_sql("m1", K))(
        _epoch_query(_rule))


@register("cell_bias_update", with_ratings(
    "c AS (SELECT user_id, movie_id, CAST(sum(rating) AS BIGINT) AS rating FROM ratings WHERE " + TRAIN_WHERE
    + " GROUP BY user_id, movie_id)",
    "mu AS (SELECT 0.0::DOUBLE AS mu)",
    "m0 AS (SELECT 'user' AS side, user_id AS id, [" + ", ".join(["0.1::DOUBLE"] * K) + "] AS f, 0.0::DOUBLE AS b "
    "FROM (SELECT DISTINCT user_id FROM ratings) UNION ALL SELECT 'movie', CAST(movie_id AS BIGINT), ["
    + ", ".join(["0.1::DOUBLE"] * K) + "], 0.0::DOUBLE FROM (SELECT DISTINCT movie_id FROM ratings))",
    "s AS (SELECT c.*, " + dot_sql("p", "q", K) + " AS pq FROM c "
    "JOIN (SELECT id AS user_id, f AS p FROM m0 WHERE side = 'user') USING (user_id) "
    "JOIN (SELECT CAST(id AS INTEGER) AS movie_id, f AS q FROM m0 WHERE side = 'movie') USING (movie_id))",
) + f"SELECT user_id, movie_id, round(3.0 + {PY_LR!r}*((rating - (3.0 + pq)) - {PY_REG!r}*3.0), 6) AS b_ui FROM s")
def q_cell_bias_update(spark, sf_dir):
    """M7 with M1c init: cells of the merged train matrix, b_ui = 3, factors 0.1."""
    cells = basic.merge_duplicates(_train_rows(spark, sf_dir)).select("user_id", "movie_id", "rating")
    model = M.init_model(ratings(spark, sf_dir), K, constant=0.1)
    s = M.scored(cells, model, 0.0, use_bias=False, k=K).withColumn("b_ui", F.lit(3.0))
    s = s.withColumn("e", F.col("rating") - (F.col("b_ui") + F.col("pred")))
    return M.cell_bias_update(s, PY_LR, PY_REG).select("user_id", "movie_id", F.round("b_ui", 6).alias("b_ui"))


# ---- sources and sinks: round trips through files Spark writes from the tables ----

import uuid as _uuid  # noqa: E402

from ..session import scratch_path  # noqa: E402
from ..sources import binary as B, text as TX  # noqa: E402


def _scratch(spark, what):
    return scratch_path(spark, "reelstat-scratch", f"{what}-{_uuid.uuid4().hex}")


@register("binary_roundtrip", with_ratings() + """SELECT split, count(*) AS entries, CAST(sum(user_id) AS BIGINT) AS user_sum,
  CAST(sum(movie_id) AS BIGINT) AS movie_sum, CAST(sum(rating) AS BIGINT) AS rating_sum,
  min(date) AS first_date, max(date) AS last_date
FROM (SELECT *, CASE WHEN category < 4 OR category = 6 THEN 'train' WHEN category = 4 THEN 'probe'
                     WHEN category = 5 THEN 'test' END AS split FROM ratings) GROUP BY split""")
def q_binary_roundtrip(spark, sf_dir):
    """K1 (bytes) + A3 + A6 + U1: write each split as records (10 bytes where the ids fit), read the three back."""
    base = _scratch(spark, "bin")
    routed = splits.route(ratings(spark, sf_dir))
    for s in ("train", "probe", "test"):
        B.write_ratings_bin(routed.where(F.col("split") == s), f"{base}/{s}", wide=True)
    back = None
    for s in ("train", "probe", "test"):
        part = B.read_ratings_bin(spark, f"{base}/{s}").withColumn("split", F.lit(s))
        back = part if back is None else back.unionByName(part)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("user_id").alias("user_sum"),
        F.sum("movie_id").cast("long").alias("movie_sum"), F.sum("rating").cast("long").alias("rating_sum"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@register("text_roundtrip", with_ratings(*SHORT_INDEX_SQL) + "SELECT * FROM z")
def q_text_roundtrip(spark, sf_dir):
    """A1 + A2 + J1 + P6: write the numbered view as rating lines and a 90 % index, scan them back."""
    base = _scratch(spark, "txt")
    d = _numbered(spark, sf_dir)
    n = d.select(F.count(F.lit(1))).scalar()
    TX.write_rating_text(d, f"{base}/data")
    idx = d.where(F.col("row_no") < (n * 9 - F.pmod(n * 9, F.lit(10))) / 10)
    idx.orderBy("row_no").select(F.col("category").cast("string").alias("value")).write.text(f"{base}/index")
    z = TX.read_split_input(spark, f"{base}/data", f"{base}/index")
    return z.select("row_no", "user_id", "movie_id", "date", "rating", "category")


@register("score_clamped", with_ratings(NUMBERED_SQL, *model_ctes(K), *M4_SQL,
                                        scored_cte("s", "(SELECT * FROM d WHERE category = 5)", "m1", K, True))
          + "SELECT row_no, printf('%.5f', least(5.0, greatest(1.0, (SELECT mu FROM mu) + pred))) AS line FROM s")
def q_score_clamped(spark, sf_dir):
    """M13 + K4 + A8 + P10 + P8 + K7: save the model, load it, score test rows in input order."""
    base = _scratch(spark, "model")
    r = _stored(spark, sf_dir)
    mu = _mu(_train_of(r))
    _one_epoch(r).write.parquet(f"{base}/factors")
    model = spark.read.parquet(f"{base}/factors")
    test = positional.number_by(r, ORDER).where(F.col("category") == 5)
    from .scoring import prediction_text
    return prediction_text(test, model, mu, K)


# ---- bias fitter (sparse re-aim) --------------------------------------------------

from ..functions.expressions import DRAW_MOD, DRAW_MULTS  # noqa: E402
from ..operators import bias_fit as BF  # noqa: E402

BIAS_LR, BIAS_REG, BIAS_BATCH = 0.1, 0.5, 3   # reference call: (0.01, 100, 3, 0.1, 0.5)


def _draw_sql(key: str, partner: str, step_no: int, d: int) -> str:
    """The packed key of draw ``d``: hash, partner and rating in one number."""
    parts = zip((key, partner, "date", "rating", str(step_no), str(d)), DRAW_MULTS)
    x = "(" + " + ".join(f"CAST({p} AS BIGINT)*{m}" for p, m in parts) + f") % {DRAW_MOD}"
    h = f"((({x}) * ({x}) + ({x})) % {DRAW_MOD})"
    return f"({h} // 256) * {BF.PARTNERS * BF.RATINGS} + CAST({partner} AS BIGINT) * {BF.RATINGS} + rating"


def _bias_step_sql(step_no: int = 1) -> list[str]:
    def picked(key: str, partner: str) -> str:
        keys = " UNION ALL ".join(
            f"SELECT {key}, min({_draw_sql(key, partner, step_no, d)}) AS k FROM bt GROUP BY {key}" for d in range(1, BIAS_BATCH + 1))
        return f"SELECT {key}, (k // {BF.RATINGS}) % {BF.PARTNERS} AS {partner}, k % {BF.RATINGS} AS rating FROM ({keys})"

    ud, md = picked("user_id", "movie_id"), picked("movie_id", "user_id")
    return [
        f"bt AS (SELECT user_id, movie_id, date, rating FROM ratings WHERE {TRAIN_WHERE})",
        "bmu AS (SELECT avg(rating) AS mu FROM bt)",
        "bu0 AS (SELECT DISTINCT user_id, 0.1::DOUBLE AS bu FROM bt)",
        "bm0 AS (SELECT DISTINCT movie_id, 0.1::DOUBLE AS bm FROM bt)",
        f"ud AS ({ud})",
        "us AS (SELECT user_id, sum(rating - (SELECT mu FROM bmu) - bu - bm) AS s FROM ud JOIN bm0 USING (movie_id) "
        "JOIN bu0 USING (user_id) GROUP BY user_id)",
        f"bu1 AS (SELECT user_id, CASE WHEN s IS NULL THEN bu ELSE bu - {BIAS_LR!r}*({BIAS_REG!r}*2*bu - 2*s) END AS bu "
        "FROM bu0 LEFT JOIN us USING (user_id))",
        f"md AS ({md})",
        "ms AS (SELECT movie_id, sum(rating - (SELECT mu FROM bmu) - bu - bm) AS s FROM md JOIN bu1 USING (user_id) "
        "JOIN bm0 USING (movie_id) GROUP BY movie_id)",
        f"bm1 AS (SELECT movie_id, CASE WHEN s IS NULL THEN bm ELSE bm - {BIAS_LR!r}*({BIAS_REG!r}*2*bm - 2*s) END AS bm "
        "FROM bm0 LEFT JOIN ms USING (movie_id))",
    ]


def _bias_rows(spark, sf_dir):
    return _train(spark, sf_dir).select("user_id", "movie_id", "date", "rating")


def _bias_step(rows, bu, bm):
    return BF.step(materialize(BF.draws(rows, [1], BIAS_BATCH), "draws"), bu, bm, basic.global_mean(rows), BIAS_BATCH, BIAS_LR, BIAS_REG)


@register("bias_objective", with_ratings(*_bias_step_sql()) + f"""SELECT round(sum((rating - (SELECT mu FROM bmu) - bu - bm)
  * (rating - (SELECT mu FROM bmu) - bu - bm)) + {BIAS_REG!r} * sum(bm*bm)
  + (SELECT {BIAS_REG!r} * sum(bu*bu) FROM bu1), 4) AS objective
FROM bt JOIN bu1 USING (user_id) JOIN bm1 USING (movie_id)""")
def q_bias_objective(spark, sf_dir):
    rows = materialize(_bias_rows(spark, sf_dir), "bias-rows")
    bu, bm = _bias_step(rows, *BF.init_biases(rows))  # after one step: biases that differ
    return BF.objective(rows, bu, bm, basic.global_mean(rows), BIAS_REG).select(
        F.round("objective", 4).alias("objective"))


@register("bias_minibatch_step", with_ratings(*_bias_step_sql())
          + """SELECT 'user' AS side, user_id AS id, round(bu, 6) AS bias FROM bu1
UNION ALL SELECT 'movie' AS side, CAST(movie_id AS BIGINT) AS id, round(bm, 6) AS bias FROM bm1""")
def q_bias_minibatch_step(spark, sf_dir):
    rows = materialize(_bias_rows(spark, sf_dir), "bias-rows")
    bu, bm = BF.init_biases(rows)
    bu1, bm1 = _bias_step(rows, bu, bm)
    return bu1.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), F.round("bu", 6).alias("bias")).unionByName(
        bm1.select(F.lit("movie").alias("side"), F.col("movie_id").cast("long").alias("id"), F.round("bm", 6).alias("bias")))


# ---- learning-rate probe (M10 G12) -------------------------------------------------

_CANDS = (("up", LR * 1.5), ("down", LR / 1.5), ("same", LR))


def _rate_probe_sql():
    ctes = [*model_ctes(K), f"v AS (SELECT user_id, movie_id, rating FROM ratings WHERE category = {VALID_CATEGORY})"]
    sel = []
    for label, rate in _CANDS:
        ctes += step_ctes("m0", f"m_{label}", K, rate, REG, REG, RATIO, True, True, False)
        ctes.append(scored_cte(f"sv_{label}", "v", f"m_{label}", K, True))
        sel.append(f"SELECT '{label}' AS candidate, {rate!r}::DOUBLE AS learning_rate, sqrt(avg(e*e)) AS rmse FROM sv_{label}")
    ctes.append("c AS (" + " UNION ALL ".join(sel) + ")")
    return with_ratings(*ctes) + """SELECT candidate, learning_rate, round(rmse, 6) AS valid_rmse,
  CASE WHEN candidate = 'same' THEN NOT (
        ((SELECT rmse FROM c WHERE candidate = 'up') < (SELECT rmse FROM c WHERE candidate = 'down')
          AND (SELECT rmse FROM c WHERE candidate = 'up') < (SELECT rmse FROM c WHERE candidate = 'same'))
     OR ((SELECT rmse FROM c WHERE candidate = 'down') < (SELECT rmse FROM c WHERE candidate = 'up')
          AND (SELECT rmse FROM c WHERE candidate = 'down') < (SELECT rmse FROM c WHERE candidate = 'same')))
  ELSE rmse < (SELECT min(rmse) FROM c x WHERE x.candidate <> c.candidate) END AS chosen
FROM c"""


@register("rate_probe", _rate_probe_sql())
def q_rate_probe(spark, sf_dir):
    """Three steps from one snapshot; the candidate strictly better than both others wins, else 'same'."""
    r = _stored(spark, sf_dir)
    tr = _train_of(r)
    mu = _mu(tr)
    m0 = M.init_model(r, K)
    valid = _holdout(r, F.col("category") == VALID_CATEGORY)
    c = None
    for label, rate in _CANDS:
        m = M.epoch(tr, m0, mu, M.rule_bias_model(rate, REG, REG, RATIO), K)
        row = M.rmse(M.scored(valid, m, mu, k=K)).select(
            F.lit(label).alias("candidate"), F.lit(rate).alias("learning_rate"), "rmse")
        c = row if c is None else c.unionByName(row)
    # three rows: a bounded frame, so an unpartitioned window is fine here
    from pyspark.sql import Window
    w = Window.partitionBy()
    up = F.max(F.when(F.col("candidate") == "up", F.col("rmse"))).over(w)
    down = F.max(F.when(F.col("candidate") == "down", F.col("rmse"))).over(w)
    same = F.max(F.when(F.col("candidate") == "same", F.col("rmse"))).over(w)
    win_up = (up < down) & (up < same)
    win_down = (down < up) & (down < same)
    chosen = (F.when(F.col("candidate") == "up", win_up).when(F.col("candidate") == "down", win_down)
              .otherwise(~(win_up | win_down)))
    return c.select("candidate", "learning_rate", F.round("rmse", 6).alias("valid_rmse"), chosen.alias("chosen"))


# ---- iterative fits: the loops' logs against chains of the step SQL ---------------------

from . import fit as FIT  # noqa: E402


FIT_K, FIT_ITERATIONS, FIT_LOOPS, FIT_STOP = 10, 10, 30, 1e-4


class _Sql(str):
    """SQL text that formats as itself where a number is expected."""

    __repr__ = str.__str__


def _kept(ctes: list[str]) -> list[str]:
    """Each step's tables are computed once, however many later steps read them."""
    return [c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes]


def _rmse_sql(name: str) -> str:
    return f"(SELECT sqrt(avg(e*e)) FROM {name})"


def _fit_adaptive_sql(run: str, lr: float, digits: int = 6) -> str:
    cfg = FIT.FitConfig(run=run)
    ctes = [*model_ctes(FIT_K), f"v AS (SELECT user_id, movie_id, rating FROM ratings WHERE category = {VALID_CATEGORY})",
            f"pr AS (SELECT user_id, movie_id, rating FROM ratings WHERE category = {PROBE_CATEGORY})",
            scored_cte("v0", "v", "m0", FIT_K), scored_cte("p0", "pr", "m0", FIT_K),
            f"st0 AS (SELECT {lr!r}::DOUBLE AS lr, {_rmse_sql('v0')} AS valid, {_rmse_sql('p0')} AS probe, false AS stopped, "
            "true AS accepted, 0.0::DOUBLE AS used)"]
    for i in range(1, FIT_ITERATIONS + 1):
        rate = _Sql(f"(SELECT lr FROM st{i - 1})")
        ctes += step_ctes(f"m{i - 1}", f"c{i}", FIT_K, rate, REG, REG, RATIO, True, True, False)
        ctes += [
            scored_cte(f"v{i}", "v", f"c{i}", FIT_K), scored_cte(f"p{i}", "pr", f"c{i}", FIT_K),
            f"t{i} AS (SELECT {_rmse_sql(f'v{i}')} AS nv, {_rmse_sql(f'p{i}')} AS np)",
            f"st{i} AS (SELECT CASE WHEN ok THEN lr * {cfg.inc!r}::DOUBLE ELSE lr * {cfg.dec!r}::DOUBLE END AS lr, "
            "CASE WHEN ok THEN nv ELSE valid END AS valid, CASE WHEN ok THEN np ELSE probe END AS probe, "
            f"stopped OR (ok AND valid - nv < {cfg.threshold!r}) AS stopped, ok AS accepted, lr AS used "
            f"FROM (SELECT *, NOT (nv > valid OR isnan(nv)) AS ok FROM st{i - 1}, t{i}))",
            f"m{i} AS (SELECT * FROM c{i} WHERE (SELECT accepted FROM st{i}) UNION ALL "
            f"SELECT * FROM m{i - 1} WHERE NOT (SELECT accepted FROM st{i}))",
        ]
    log = " UNION ALL ".join(f"SELECT {i} AS iteration, * FROM st{i} WHERE NOT stopped" for i in range(1, FIT_ITERATIONS + 1))
    return with_ratings(*_kept(ctes)) + f"""SELECT '{run}' AS run, iteration, round(used, 9) AS learning_rate,
  round(valid, {digits}) AS valid_rmse, round(probe, {digits}) AS probe_rmse, accepted,
  round(valid - lag(valid) OVER (ORDER BY iteration), 6) AS delta_valid,
  probe = min(probe) OVER () AND iteration = min(CASE WHEN probe <= least_probe THEN iteration END) OVER () AS best
FROM (SELECT *, min(probe) OVER () AS least_probe FROM ({log}))"""


def _fit_adaptive(run: str, lr: float):
    def q(spark, sf_dir):
        cfg = FIT.FitConfig(run=run, k=FIT_K, iterations=FIT_ITERATIONS, lr=lr)
        log = FIT.rmse_changes(FIT.fit_adaptive(spark, ratings(spark, sf_dir), cfg).run_log)
        best = FIT.best_iteration(log).select("run", "best_iteration")
        return log.join(best, "run").select(
            "run", "iteration", F.round("learning_rate", 9).alias("learning_rate"), F.round("valid_rmse", 6).alias("valid_rmse"),
            F.round("probe_rmse", 6).alias("probe_rmse"), "accepted", F.round("delta_valid", 6).alias("delta_valid"),
            (F.col("iteration") == F.col("best_iteration")).alias("best"))
    return q


# M8 + M11 + M12 + G13 + W6: guarded epochs, best model, RMSE changes; and a rate so high that steps are rolled back
for _name, _lr in (("fit_adaptive", LR), ("fit_adaptive_rollback", 0.08)):
    register(_name, _fit_adaptive_sql(_name, _lr))(_fit_adaptive(_name, _lr))


def _fit_threshold_sql() -> str:
    f0 = "[" + ", ".join(["0.1::DOUBLE"] * FIT_K) + "]"
    ctes = [
        f"cells AS (SELECT user_id, movie_id, CAST(sum(rating) AS BIGINT) AS rating FROM ratings WHERE {TRAIN_WHERE} AND rating <> 0 "
        "GROUP BY user_id, movie_id)",
        "mu AS (SELECT avg(rating) AS mu FROM cells)",
        f"m0 AS (SELECT 'user' AS side, user_id AS id, {f0} AS f, 0.0::DOUBLE AS b FROM (SELECT DISTINCT user_id FROM cells) "
        f"UNION ALL SELECT 'movie', CAST(movie_id AS BIGINT), {f0}, 0.0::DOUBLE FROM (SELECT DISTINCT movie_id FROM cells))",
    ]
    for i in range(1, FIT_LOOPS + 1):
        ctes += step_ctes(f"m{i - 1}", f"m{i}", FIT_K, PY_LR, PY_REG, PY_REG, 1.0, True, True, True, rows="cells")
    # the residuals of step i are those of the model before it
    rows = " UNION ALL ".join(
        f"SELECT {i} AS iteration, {_rmse_sql(f's_m{i}')} AS b, {_rmse_sql(f's_m{i + 1}')} AS a" for i in range(1, FIT_LOOPS))
    return with_ratings(*_kept(ctes), f"l AS MATERIALIZED ({rows})") + f"""SELECT 'python' AS run, iteration,
  round(b, 6) AS rmse_before, round(a, 6) AS rmse_after FROM l
WHERE NOT EXISTS (SELECT 1 FROM l x WHERE x.iteration < l.iteration AND abs(x.b - x.a) < {FIT_STOP!r})"""


@register("fit_threshold", _fit_threshold_sql())
def q_fit_threshold(spark, sf_dir):
    """M12 Python variant: merged cells, per-rating rule, stop at |ΔRMSE| < 1e-4 (≤ 29 steps)."""
    log, _ = FIT.fit_threshold(spark, _train(spark, sf_dir), k=FIT_K, lr=PY_LR, reg=PY_REG, max_loops=FIT_LOOPS, stop=FIT_STOP)
    return log.select("run", "iteration", F.round("rmse_before", 6).alias("rmse_before"), F.round("rmse_after", 6).alias("rmse_after"))


def _bias_fit_sql(run: str, steps: int, stop: float) -> str:
    """The whole loop as one recursion: half a step updates one side (odd: users, even: movies) and carries the other on."""
    def picked(name: str, key: str, partner: str, h: str) -> str:
        return (f"SELECT {h} AS h, '{name}' AS side, CAST({key} AS BIGINT) AS id, min({_draw_sql(key, partner, 's', 'd')}) AS k "
                f"FROM bt, range(1, {steps + 1}) x(s), range(1, {BIAS_BATCH + 1}) y(d) GROUP BY s, d, {key}")

    draws = picked("user", "user_id", "movie_id", "2*s - 1") + " UNION ALL " + picked("movie", "movie_id", "user_id", "2*s")
    e = "(rating - (SELECT mu FROM bmu) - u.b - m.b)"
    ctes = [
        f"bt AS MATERIALIZED (SELECT user_id, movie_id, date, rating FROM ratings WHERE {TRAIN_WHERE})",
        "bmu AS MATERIALIZED (SELECT avg(rating) AS mu FROM bt)",
        f"dr AS MATERIALIZED (SELECT h, side, id, (k // {BF.RATINGS}) % {BF.PARTNERS} AS partner, k % {BF.RATINGS} AS rating FROM ({draws}))",
        f"""st AS (SELECT 0::BIGINT AS h, side, id, 0.1::DOUBLE AS b
  FROM (SELECT DISTINCT 'user' AS side, user_id AS id FROM bt UNION ALL SELECT DISTINCT 'movie', CAST(movie_id AS BIGINT) FROM bt)
  UNION ALL SELECT st.h + 1, side, id, CASE WHEN t IS NULL THEN b
    ELSE b - {BIAS_LR!r}*({BIAS_REG!r}*2*b - 2*(t - {float(BIAS_BATCH)!r}*b)) END
  FROM st LEFT JOIN (SELECT dr.side, dr.id, sum(dr.rating - (SELECT mu FROM bmu) - p.b) AS t
    FROM dr JOIN st p ON p.side <> dr.side AND p.id = dr.partner AND dr.h = p.h + 1 GROUP BY dr.side, dr.id) x USING (side, id)
  WHERE st.h < {2 * steps})""",
        f"""ob AS MATERIALIZED (SELECT u.h // 2 AS step, sum({e}*{e}) + {BIAS_REG!r}*sum(m.b*m.b) + {BIAS_REG!r}*any_value(z.s) AS o
  FROM bt JOIN st u ON u.side = 'user' AND u.id = bt.user_id JOIN st m ON m.side = 'movie' AND m.id = bt.movie_id AND m.h = u.h
  JOIN (SELECT h, sum(b*b) AS s FROM st WHERE side = 'user' GROUP BY h) z ON z.h = u.h WHERE u.h % 2 = 0 GROUP BY u.h)""",
        "l AS MATERIALIZED (SELECT step, lag(o) OVER (ORDER BY step) AS b, o AS a FROM ob)",
    ]
    sql = with_ratings(*ctes).replace("WITH ratings", "WITH RECURSIVE ratings", 1)
    return sql + f"""SELECT '{run}' AS run, CAST(step AS INTEGER) AS step, round(b, 2) AS objective_before, round(a, 2) AS objective_after
FROM l WHERE step > 0 AND NOT EXISTS (SELECT 1 FROM l x WHERE x.step > 0 AND x.step < l.step AND abs(x.a - x.b) < {stop!r})"""


BIAS_STEPS = 100


def _bias_fit(run: str, stop: float):
    def q(spark, sf_dir):
        log, _ = FIT.fit_bias_sgd(spark, _bias_rows(spark, sf_dir), stop, BIAS_STEPS, BIAS_BATCH, BIAS_LR, BIAS_REG, run)
        return log.select("run", "step", F.round("objective_before", 2).alias("objective_before"),
                          F.round("objective_after", 2).alias("objective_after"))
    return q


# M9 loop with the reference call's parameters (threshold 0.01, ≤ 100 steps, B = 3, η = 0.1, λ = 0.5), and one that the threshold stops
for _name, _stop in (("bias_fit", 0.01), ("bias_fit_stop", 500.0)):
    register(_name, _bias_fit_sql(_name, BIAS_STEPS, _stop))(_bias_fit(_name, _stop))


_PARAMS = FIT.FitConfig(run="run10")
_PARAM_SQL = "\nUNION ALL ".join(
    f"SELECT '{_PARAMS.run}' AS run, '{k}' AS key, '{v}' AS value" for k, v in FIT.param_values(_PARAMS).items())


@register("run_params", with_ratings() + _PARAM_SQL + f"""
UNION ALL SELECT '{_PARAMS.run}', 'mu_bips', CAST(CAST(floor(avg(rating) * 10000) AS BIGINT) AS VARCHAR) FROM ratings WHERE {TRAIN_WHERE}
UNION ALL SELECT '{_PARAMS.run}', 'entries_' || category, CAST(count(*) AS VARCHAR) FROM ratings GROUP BY category""")
def q_run_params(spark, sf_dir):
    """K5 + F5: the parameters of a run with what it read from the ratings, written and read back."""
    from ..functions.expressions import basis_points
    r = ratings(spark, sf_dir)
    run = F.lit(_PARAMS.run).alias("run")
    mean = r.where(F.col("category").isin(*TRAIN_CATEGORIES)).agg(basis_points(F.avg("rating")).cast("string").alias("value"))
    counts = r.groupBy("category").agg(F.count(F.lit(1)).cast("string").alias("value"))
    rows = FIT.params_frame(spark, _PARAMS).unionByName(mean.select(run, F.lit("mu_bips").alias("key"), "value")).unionByName(
        counts.select(run, F.concat(F.lit("entries_"), F.col("category").cast("string")).alias("key"), "value"))
    return materialize(rows, "run-params")


# ---- ids that the model has not seen (J4) -----------------------------------------

def _init_list(key: str) -> str:
    return "[" + ", ".join(f"0.05::DOUBLE * (({key}*31 + {j}*17) % 1000)::DOUBLE / 1000.0::DOUBLE" for j in range(K)) + "]"


def _unseen_sql(rows: str) -> list[str]:
    return [
        NUMBERED_SQL, *model_ctes(K), *M4_SQL, "m_part AS (SELECT * FROM m1 WHERE id % 7 <> 0)",
        f"x AS (SELECT x.*, coalesce(p, {_init_list('CAST(user_id AS BIGINT)')}) AS p2, coalesce(q, {_init_list('CAST(movie_id AS BIGINT)')}) AS q2, "
        f"coalesce(bu, 0.0) AS bu2, coalesce(bm, 0.0) AS bm2 FROM {rows} x "
        "LEFT JOIN (SELECT id AS user_id, f AS p, b AS bu FROM m_part WHERE side = 'user') USING (user_id) "
        "LEFT JOIN (SELECT CAST(id AS INTEGER) AS movie_id, f AS q, b AS bm FROM m_part WHERE side = 'movie') USING (movie_id))",
        f"s AS (SELECT *, {dot_sql('p2', 'q2', K)} + bu2 + bm2 AS pred FROM x)",
    ]


def _part_model(r):
    return _one_epoch(r).where(F.col("id") % 7 != 0)


@register("score_unseen", with_ratings(*_unseen_sql("(SELECT * FROM d WHERE category = 5)"))
          + "SELECT row_no, printf('%.5f', least(5.0, greatest(1.0, (SELECT mu FROM mu) + pred))) AS line FROM s")
def q_score_unseen(spark, sf_dir):
    """J4 + M13: every test row is scored, ids that the model lacks by their initial factors."""
    from .scoring import prediction_text
    r = _stored(spark, sf_dir)
    test = positional.number_by(r, ORDER).where(F.col("category") == 5)
    return prediction_text(test, _part_model(r), _mu(_train_of(r)))


@register("rmse_unseen", with_ratings(*_unseen_sql("(SELECT * FROM d WHERE category = 4)"))
          + "SELECT round(sqrt(avg((rating - (SELECT mu FROM mu) - pred) * (rating - (SELECT mu FROM mu) - pred))), 6) AS rmse, count(*) AS n FROM s")
def q_rmse_unseen(spark, sf_dir):
    """J4 + M14: the RMSE counts all probe rows."""
    r = _stored(spark, sf_dir)
    s = M.scored_all(_holdout(r, F.col("category") == PROBE_CATEGORY), _part_model(r), _mu(_train_of(r)))
    return M.rmse(s).select(F.round("rmse", 6).alias("rmse"), "n")


# ---- the step at the shipped width ---------------------------------------------------

K40, LR40 = 40, 0.0002


@register("epoch_bias_model_k40", with_ratings(*model_ctes(K40), *step_ctes("m0", "m1", K40, LR40, REG, REG, RATIO, True, True, False))
          + model_long_sql("m1", K40))
def q_epoch_bias_model_k40(spark, sf_dir):
    r = _stored(spark, sf_dir)
    tr = _train_of(r)
    m0 = M.init_model(r, K40)
    return M.model_long(M.epoch(tr, m0, _mu(tr), M.rule_bias_model(LR40, REG, REG, RATIO), K40))


# ---- sinks written and read back -----------------------------------------------------

@register("chunk_files", with_ratings(NUMBERED_SQL) + f"SELECT CAST(row_no // {CHUNK} AS INTEGER) AS chunk, concat_ws(' ', user_id, movie_id, date, rating) AS line FROM d")
def q_chunk_files(spark, sf_dir):
    """K3: rating lines split into chunk folders, read back with their chunk."""
    base = _scratch(spark, "chunks")
    TX.write_rating_text(_numbered(spark, sf_dir), f"{base}/data")
    TX.write_chunks(spark, f"{base}/data", f"{base}/chunks", CHUNK)
    return spark.read.text(f"{base}/chunks").select("chunk", F.col("value").alias("line"))


@register("numeric_lines", with_ratings(NUMBERED_SQL) + "SELECT row_no, CAST(rating AS DOUBLE) AS value FROM d")
def q_numeric_lines(spark, sf_dir):
    """K10 + A10: the true ratings as %.5f lines in input order, scanned back as numbers."""
    from .scoring import true_rating_file
    base = _scratch(spark, "true")
    true_rating_file(_numbered(spark, sf_dir), base)
    return TX.read_numeric_lines(spark, base)


# ---- S3 and A7 ---------------------------------------------------------------

@register("first_biases", with_ratings(*model_ctes(K), *M4_SQL) + """SELECT side, id, round(b, 6) AS b FROM (
  SELECT side, id, b, row_number() OVER (PARTITION BY side ORDER BY id) AS rn FROM m1) WHERE rn <= 10""")
def q_first_biases(spark, sf_dir):
    """S3: first ten user and movie biases after one bias-model step."""
    return M.first_biases(_one_epoch(_stored(spark, sf_dir)), 10).select("side", "id", F.round("b", 6).alias("b"))


@register("binary_movie_summary", oracle.movie_summary_sql("category IN (1, 2, 3, 6)"))
def q_binary_movie_summary(spark, sf_dir):
    """A11 + K1 + A7: the train split stored movie-major as records (10 bytes where the ids fit), scanned back into the summary."""
    from ..sources.tables import write_ordered

    base = _scratch(spark, "mu")
    write_ordered(_train(spark, sf_dir), f"{base}/all.train", fmt="ratings_bin", wide=True)
    return profile.movie_summary(B.read_ratings_bin(spark, f"{base}/all.train"))


# ---- the user-major block layout (A11 J2) --------------------------------------------

from ..sources import blocks as BL  # noqa: E402


@register("user_major_epoch", with_ratings(*model_ctes(K), *M4_SQL) + model_long_sql("m1", K))
def q_user_major_epoch(spark, sf_dir):
    """One step on ratings stored in user-major blocks: the model of ``epoch_bias_model``, the ratings not shuffled."""
    r = _stored(spark, sf_dir)
    tr = _train_of(r)
    mu = float(tr.agg(F.avg("rating")).first()[0])
    layout = BL.write_blocks(tr, rows_per_block=LAYOUT_ROWS)
    m1 = BL.epoch_blocks(spark, layout, M.init_model(r, K), mu, M.rule_bias_model(LR, REG, REG, RATIO), K)
    BL.drop_blocks(spark, layout)
    return M.model_long(m1)


LAYOUT_ROWS = 100_000   # rows per block on the fixture, so that it has several
LAYOUT_EPOCHS = 3


def _chain(steps: int, args: tuple) -> list[str]:
    ctes = []
    for i in range(steps):
        ctes += step_ctes(f"m{i}", f"m{i + 1}", K, *args)
    return ctes


@register("user_major_fit", with_ratings(*_kept([*model_ctes(K), *_chain(LAYOUT_EPOCHS, (LR, REG, REG, RATIO, True, True, False))]))
          + model_long_sql(f"m{LAYOUT_EPOCHS}", K))
def q_user_major_fit(spark, sf_dir):
    """Several epochs over one layout: dealt out once, read by every epoch."""
    r = _stored(spark, sf_dir)
    tr = _train_of(r)
    mu = float(tr.agg(F.avg("rating")).first()[0])
    layout = BL.write_blocks(tr, rows_per_block=LAYOUT_ROWS)
    model = BL.fit_blocks(spark, tr, M.init_model(r, K), mu, M.rule_bias_model(LR, REG, REG, RATIO), K, LAYOUT_EPOCHS, layout)
    BL.drop_blocks(spark, layout)
    return M.model_long(model)


# ---- a bias per rated cell (M6b), total error (G11), sparse difference (J8) ----------

from ..operators import cell_bias as CB  # noqa: E402


def _cell_ctes(k: int, epochs: int, lr: float, init: str) -> list[str]:
    """c0..cn (cells with their bias) and m0..mn; the residual of a step is that of rating − b_ui."""
    ctes = [
        f"c0 AS (SELECT user_id, movie_id, CAST(sum(rating) AS BIGINT) AS rating, {CB.INITIAL_BIAS!r}::DOUBLE AS b_ui FROM ratings "
        f"WHERE {TRAIN_WHERE} GROUP BY user_id, movie_id)",
        "mu AS (SELECT 0.0::DOUBLE AS mu)",
        "ids AS (SELECT DISTINCT 'user' AS side, user_id AS id FROM c0 UNION ALL SELECT DISTINCT 'movie', CAST(movie_id AS BIGINT) FROM c0)",
        f"m0 AS (SELECT side, id, {init} AS f, 0.0::DOUBLE AS b FROM ids)",
    ]
    for i in range(epochs):
        ctes += [
            f"r{i} AS (SELECT user_id, movie_id, rating - b_ui AS rating FROM c{i})",
            *step_ctes(f"m{i}", f"m{i + 1}", k, lr, PY_REG, PY_REG, 0.0, False, True, False, rows=f"r{i}"),
            f"c{i + 1} AS (SELECT user_id, movie_id, c{i}.rating, b_ui + {lr!r}*(e - {PY_REG!r}*b_ui) AS b_ui "
            f"FROM c{i} JOIN s_m{i + 1} USING (user_id, movie_id))",
        ]
    return ctes


CELL_EPOCHS = 2


@register("epoch_cell_bias", with_ratings(*_kept(_cell_ctes(K, CELL_EPOCHS, PY_LR, oracle.f_list(K))))
          + "SELECT side, id, -1 AS partner, k, value FROM (" + model_long_sql(f"m{CELL_EPOCHS}", K) + ") WHERE k >= 0\n"
          + f"UNION ALL SELECT 'cell', user_id, movie_id, -1, round(b_ui, 6) FROM c{CELL_EPOCHS}")
def q_epoch_cell_bias(spark, sf_dir):
    """Two epochs with a bias per cell; the factors of both sides and the bias of every cell."""
    cells, model = FIT.fit_cell_bias(spark, _train_rows(spark, sf_dir), K, PY_LR, PY_REG, CELL_EPOCHS, init=None)
    factors = M.model_long(spark.read.parquet(model)).where(F.col("k") >= 0).select("side", "id", F.lit(-1).alias("partner"), "k", "value")
    own = spark.read.parquet(cells).select(F.lit("cell").alias("side"), F.col("user_id").alias("id"), F.col("movie_id").alias("partner"),
                                           F.lit(-1).alias("k"), F.round("b_ui", 6).alias("value"))
    return factors.unionByName(own)


ERROR_RUNS = ((K, PY_LR), (40, 0.0001))   # factors and rate of each run


def _total_error_sql() -> str:
    parts = []
    for k, lr in ERROR_RUNS:
        ctes = _cell_ctes(k, 1, lr, oracle.f_list(k))
        square = " + ".join(f"{1 if i == j else 2}*pow(sum(f[{i + 1}]*f[{j + 1}]), 2)" for i in range(k) for j in range(i, k))
        ctes += [scored_cte("t", "(SELECT user_id, movie_id, rating - b_ui AS rating, b_ui FROM c1)", "m1", k, False)]
        body = ",\n".join((oracle.RATINGS_CTE, *ctes))
        parts.append(f"(WITH {body}\nSELECT 'k{k}' AS run, round((SELECT sum(e*e + b_ui*b_ui) FROM t) "
                     f"+ (SELECT sum(g) FROM (SELECT side, {square} AS g FROM m1 GROUP BY side)), 3) AS total_error)")
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ")"


@register("total_error", _total_error_sql())
def q_total_error(spark, sf_dir):
    """One number per run, after one epoch of the model with a bias per cell, at a small and at the shipped width."""
    out = None
    for k, lr in ERROR_RUNS:
        cells, model = (spark.read.parquet(p) for p in FIT.fit_cell_bias(spark, _train_rows(spark, sf_dir), k, lr, PY_REG, 1, init=None))
        row = M.total_error(CB.scored_cells(cells, model, k), model, k).select(
            F.lit(f"k{k}").alias("run"), F.round("total_error", 3).alias("total_error"))
        out = row if out is None else out.unionByName(row)
    return out


def _merged_sql(where: str) -> str:
    return f"(SELECT user_id, movie_id, CAST(sum(rating) AS BIGINT) AS s FROM ratings WHERE {where} GROUP BY user_id, movie_id)"


@register("sparse_difference", with_ratings() + f"""SELECT user_id, movie_id, coalesce(x.s, 0) - coalesce(y.s, 0) AS difference
FROM {_merged_sql(f'category = {VALID_CATEGORY}')} x FULL JOIN {_merged_sql('category IN (1, 3, 4)')} y USING (user_id, movie_id)""")
def q_sparse_difference(spark, sf_dir):
    """Two rating matrices with different cells; those of either side alone are kept."""
    r = ratings(spark, sf_dir)
    return basic.sparse_difference(r.where(F.col("category") == VALID_CATEGORY), r.where(F.col("category").isin(1, 3, PROBE_CATEGORY)))


# ---- sinks: repeatable appends and ordered lines --------------------------------------

_SOURCES_SQL = "SELECT 'ratings' AS source, category FROM ratings UNION ALL SELECT 'probe/only', category FROM ratings WHERE category = 4"
_RERUN_SQL = "SELECT 'ratings' AS source, category FROM ratings WHERE category <> 6"


@register("report_append", with_ratings() + f"""SELECT 'first' AS run, source, count(*) AS entries, {REPORT_SQL} FROM ({_SOURCES_SQL}) GROUP BY source
UNION ALL SELECT '0002' AS run, source, count(*) AS entries, {REPORT_SQL} FROM ({_RERUN_SQL}) GROUP BY source""")
def q_report_append(spark, sf_dir):
    """K2: two runs append their reports, each repeated once; every (run, source) is there once, as written last."""
    r = materialize(ratings(spark, sf_dir).select("category"), "categories")   # six reports read it
    path = _scratch(spark, "reports")
    first = splits.split_report({"ratings": r, "probe/only": r.where(F.col("category") == PROBE_CATEGORY)})
    splits.append_report(splits.split_report({"ratings": r}), path, "0002")   # replaced by the repeated job below
    for _ in range(2):
        splits.append_report(first, path, "first")
        splits.append_report(splits.split_report({"ratings": r.where(F.col("category") != 6)}), path, "0002")
    return splits.read_reports(spark, path)


FILE_PARTS = 7   # part files of an ordered text file on the fixture


@register("prediction_file", with_ratings(NUMBERED_SQL, *model_ctes(K), *M4_SQL, scored_cte("s", "(SELECT * FROM d WHERE category = 5)", "m1", K, True))
          + "SELECT row_number() OVER (ORDER BY row_no) - 1 AS row_no, printf('%.5f', least(5.0, greatest(1.0, (SELECT mu FROM mu) + pred))) AS line FROM s")
def q_prediction_file(spark, sf_dir):
    """K7 + S4: the prediction file in several parts, read back by place: line k is the k-th test row."""
    from .scoring import score_file
    base = _scratch(spark, "predictions")
    r = _stored(spark, sf_dir)
    _one_epoch(r).write.parquet(f"{base}/factors")
    mu = float(_train_of(r).agg(F.avg("rating")).first()[0])
    score_file(spark, f"{base}/factors", positional.number_by(r, ORDER).where(F.col("category") == 5), mu, f"{base}/out", K, FILE_PARTS)
    return TX.lines(spark, f"{base}/out").select("row_no", F.col("value").alias("line"))


def _log_sql(run: str, lr: float) -> str:
    return f"""SELECT run, iteration, valid_rmse, probe_rmse,
  row_number() OVER (ORDER BY iteration) - 1 AS place FROM ({_fit_adaptive_sql(run, lr, 7)})"""


@register("iteration_log", _log_sql("fit_adaptive", LR))
def q_iteration_log(spark, sf_dir):
    """K6: the iteration log of a fit written twice as text lines, read back in the order of the lines."""
    base = _scratch(spark, "log")
    cfg = FIT.FitConfig(run="fit_adaptive", k=FIT_K, iterations=FIT_ITERATIONS, lr=LR)
    log = FIT.fit_adaptive(spark, ratings(spark, sf_dir), cfg).run_log
    for _ in range(2):
        FIT.write_run_log_csv(log, base)
    back = FIT.read_run_log_csv(spark, base)
    return back.select("run", "iteration", "valid_rmse", "probe_rmse", F.col("row_no").alias("place"))


_CSV_SQL = ", ".join(
    ["movie_id AS movie", "ratings", "printf('%.3f', rating_mean) AS rating_mean", "printf('%.3f', rating_var) AS rating_var", "first_rating", "last_rating"]
    + [f"viewdate{i}" for i in range(10)] + [f"printf('%.3f', ratingdate{i}) AS ratingdate{i}" for i in range(10)])


@register("summary_csv", f"SELECT {_CSV_SQL} FROM ({oracle.movie_summary_sql('category IN (1, 2, 3, 6)')})")
def q_summary_csv(spark, sf_dir):
    """K8: the summary as CSV with a header, read back under its schema; fractions as the text in the file."""
    base = _scratch(spark, "summary")
    profile.write_summary_csv(profile.movie_summary(_train(spark, sf_dir)), base)
    back = profile.read_summary_csv(spark, base)
    return back.select(*[F.col(c).cast("string").alias(c) if t.startswith("decimal") else F.col(c) for c, t in back.dtypes])


# ---- narrowing (P9), stamps (F12), a fit that meets NaN (F8) ----------------------------

@register("narrowed_records", with_ratings() + """SELECT user_id, movie_id, date, (rating + 200 * category) % 256 AS rating,
  (category + 250) % 256 AS category FROM ratings""")
def q_narrowed_records(spark, sf_dir):
    """Ratings and categories beyond a byte, written as records; what a byte keeps comes back."""
    base = _scratch(spark, "narrow")
    r = ratings(spark, sf_dir)
    B.write_ratings_bin(r.withColumn("rating", F.col("rating") + 200 * F.col("category")).withColumn("category", F.col("category") + 250), base, wide=True)
    return B.read_ratings_bin(spark, base).select(*ORDER)


@register("day_stamps", with_ratings() + """SELECT DISTINCT date, strftime(TIMESTAMP '1995-01-01' + to_days(date) + to_minutes(date), '%m%d-%H%M') AS stamp
FROM ratings""")
def q_day_stamps(spark, sf_dir):
    """the name stamp of a point of time on each rating day, in the session's time zone."""
    days = ratings(spark, sf_dir).select("date").distinct()
    at = F.expr("make_timestamp(1995, 1, 1, 0, 0, 0) + make_dt_interval(date, 0, date)")
    return days.select("date", FIT.stamp(at).alias("stamp"))
