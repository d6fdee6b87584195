"""Sampled bias fit (M9 G10 J7), re-aimed from a dense users × movies matrix to the rating table.

Rule per step (η learning rate, λ regularisation, B draws per entity):

* every user: draw B of the user's ratings with replacement; Σ = Σ_draws (r − μ − bu − bm);
  bu ← bu − η·(2λ·bu − 2Σ)  (all users from the old bm — users are independent);
* then every movie likewise, drawing raters and using the *new* bu;
* objective G10 = Σ_ratings (r − μ − bu − bm)² + λ·Σ_ratings bm² + λ·Σ_users bu²
  (λ·bm² is paid per rated cell, λ·bu² once per user, as in the reference);
* stop when the objective moves less than the threshold.

The reference draws partners uniformly from a dense matrix (every cell rated)
and builds that matrix with a cross product; here the cells are the ratings
and no pair of entities is ever enumerated. Draw d of entity x in a step is the rating
with the smallest integer key (hash of x, partner, date, rating, step and d; then partner, then rating): an
independent, repeatable uniform pick from x's ratings. The key is one long that
carries partner and rating, so a plain ``min`` finds the pick, with hash aggregates that
collapse a hot entity map-side. Draws do not depend on the biases: those of several steps
come from one pass over the ratings. A cell rated twice with equal date and rating counts once in draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import draw_key_sql

PARTNERS, RATINGS = 1 << 32, 1 << 8  # bounds of what a draw's key carries: the ranges of the record file


def _pick_sql(step: int, d: int) -> str:
    h = draw_key_sql("id", "partner", "date", "rating", str(step), str(d))
    return f"min(({h} div 256) * {PARTNERS * RATINGS} + partner * {RATINGS} + rating)"


def both_sides(ratings: DataFrame) -> DataFrame:
    """(side, id, partner, date, rating): every rating once as its user's and once as its movie's (``inline``)."""
    return ratings.select(F.inline(F.array(
        F.struct(F.lit("user").alias("side"), F.col("user_id").cast("long").alias("id"),
                 F.col("movie_id").cast("long").alias("partner"), F.col("date"), F.col("rating").cast("long").alias("rating")),
        F.struct(F.lit("movie").alias("side"), F.col("movie_id").cast("long").alias("id"),
                 F.col("user_id").cast("long").alias("partner"), F.col("date"), F.col("rating").cast("long").alias("rating")),
    )))


def by_entity(ratings: DataFrame) -> DataFrame:
    """``both_sides`` dealt out by ranges of entities, to be stored: a task that reads a part meets most entities whole.

    Draws then give about one partial row per entity, not one per rating. An entity with very many ratings is cut by partner.
    """
    return both_sides(ratings).repartitionByRange("side", "id", "partner").sortWithinPartitions("side", "id")


def draws(ratings: DataFrame, steps: list[int], batch: int) -> DataFrame:
    """(step, side, id, partner, rating): ``batch`` draws with replacement per step from each user's and movie's ratings."""
    return draws_of(both_sides(ratings), steps, batch)


def draws_of(two: DataFrame, steps: list[int], batch: int) -> DataFrame:
    """``draws`` from the rows of ``both_sides``: one partially aggregated ``groupBy(side, id)`` picks all draws of all ``steps``."""
    names = [(s, d, f"s{s}_{d}") for s in steps for d in range(1, batch + 1)]
    picked = two.groupBy("side", "id").agg(*[F.expr(f"{_pick_sql(s, d)} AS {n}") for s, d, n in names])
    flat = F.expr("inline(array(" + ", ".join(f"named_struct('step', {s}, 'key', {n})" for s, _, n in names) + "))")
    return picked.select("side", "id", flat).select(
        "step", "side", "id",
        F.expr(f"(key div {RATINGS}) % {PARTNERS}").alias("partner"),
        F.expr(f"key % {RATINGS}").cast("int").alias("rating"))


def init_biases(ratings: DataFrame, value: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """bu, bm = 0.1 for every user and movie seen (np.ones / 10)."""
    bu = ratings.select("user_id").distinct().withColumn("bu", F.lit(float(value)))
    bm = ratings.select("movie_id").distinct().withColumn("bm", F.lit(float(value)))
    return bu, bm


def objective(ratings: DataFrame, bu: DataFrame, bm: DataFrame, mu, reg: float) -> DataFrame:
    """G10 as one row ``objective``."""
    mu = mu if isinstance(mu, F.Column) else F.lit(float(mu))
    cells = ratings.join(bu, "user_id").join(bm, "movie_id")
    e = F.col("rating") - mu - F.col("bu") - F.col("bm")
    per_user = bu.select(F.lit(reg) * F.sum(F.col("bu") * F.col("bu"))).scalar()
    return cells.agg((F.sum(e * e) + F.lit(reg) * F.sum(F.col("bm") * F.col("bm")) + per_user).alias("objective"))


def objectives(ratings: DataFrame, tables: list[DataFrame], mu, reg: float) -> DataFrame:
    """G10 of several ``to_table`` states as one row o0, o1, ...: the biases of all of them go to a rating together.

    The states are joined entity by entity, so that one pass over the ratings does for all.
    """
    mu = mu if isinstance(mu, Column) else F.lit(float(mu))
    states = range(len(tables))
    users = movies = None
    for n, t in enumerate(tables):
        bu, bm = from_table(t)
        bu, bm = bu.withColumnRenamed("bu", f"bu{n}"), bm.withColumnRenamed("bm", f"bm{n}")
        users = bu if users is None else users.join(bu, "user_id")
        movies = bm if movies is None else movies.join(bm, "movie_id")
    cells = ratings.select("user_id", "movie_id", "rating").join(users, "user_id").join(movies, "movie_id")

    def e(n: int) -> Column:
        return F.col("rating") - mu - F.col(f"bu{n}") - F.col(f"bm{n}")

    per_user = [from_table(t)[0].select(F.lit(reg) * F.sum(F.col("bu") * F.col("bu"))).scalar() for t in tables]
    return cells.agg(*[
        (F.sum(e(n) * e(n)) + F.lit(reg) * F.sum(F.col(f"bm{n}") * F.col(f"bm{n}")) + per_user[n]).alias(f"o{n}") for n in states])


def _update(b: Column, total: Column, batch: int, lr: float, reg: float) -> Column:
    """b − η·(2λ·b − 2Σ), with Σ = Σ_draws (r − μ − b_partner) − B·b."""
    sm = total - F.lit(float(batch)) * b
    return F.when(total.isNull(), b).otherwise(b - F.lit(lr) * (F.lit(reg) * 2 * b - 2 * sm))


def step(drawn: DataFrame, bu: DataFrame, bm: DataFrame, mu, batch: int, lr: float, reg: float) -> tuple[DataFrame, DataFrame]:
    """One user pass then one movie pass over one step's draws; returns the new (bu, bm).

    Each side joins only its partners' biases (a table with one row per entity), sums its ``batch`` draws per
    entity, and updates with a left join on its own biases: nothing here is as large as the ratings.
    """
    mu = mu if isinstance(mu, Column) else F.lit(float(mu))
    ud = drawn.where(F.col("side") == "user").select(F.col("id").alias("user_id"), F.col("partner").cast("int").alias(
        "movie_id"), "rating").join(bm, "movie_id")
    us = ud.groupBy("user_id").agg(F.sum(F.col("rating") - mu - F.col("bm")).alias("t"))
    bu_new = bu.join(us, "user_id", "left").select("user_id", _update(F.col("bu"), F.col("t"), batch, lr, reg).alias("bu"))
    md = drawn.where(F.col("side") == "movie").select(F.col("id").cast("int").alias("movie_id"),
                                                      F.col("partner").alias("user_id"), "rating").join(bu_new, "user_id")
    ms = md.groupBy("movie_id").agg(F.sum(F.col("rating") - mu - F.col("bu")).alias("t"))
    bm_new = bm.join(ms, "movie_id", "left").select("movie_id", _update(F.col("bm"), F.col("t"), batch, lr, reg).alias("bm"))
    return bu_new, bm_new


def to_table(bu: DataFrame, bm: DataFrame) -> DataFrame:
    """(bu, bm) → one ``(side, id, b)`` table, written in one job."""
    return bu.select(F.lit("user").alias("side"), F.col("user_id").cast("long").alias("id"), F.col("bu").alias("b")) \
        .unionByName(bm.select(F.lit("movie").alias("side"), F.col("movie_id").cast("long").alias("id"),
                               F.col("bm").alias("b")))


def from_table(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    bu = t.where(F.col("side") == "user").select(F.col("id").alias("user_id"), F.col("b").alias("bu"))
    bm = t.where(F.col("side") == "movie").select(F.col("id").cast("int").alias("movie_id"), F.col("b").alias("bm"))
    return bu, bm
