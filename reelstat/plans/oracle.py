"""DuckDB-runnable SQL for the oracle check: the rating view and helpers.

The view body equals ``sources.tables.ratings``; only the day difference is
spelled the DuckDB way.
"""

RATINGS_CTE = """ratings AS (
  SELECT o_custkey AS user_id,
         CAST(l_partkey AS INTEGER) AS movie_id,
         CAST(datediff('day', TIMESTAMP '1995-01-01', l_shipdate) AS INTEGER) AS date,
         CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS INTEGER) AS rating,
         CAST(CASE WHEN h < 88 THEN 1 WHEN h < 91 THEN 2 WHEN h < 94 THEN 3
                   WHEN h < 96 THEN 4 WHEN h < 99 THEN 5 ELSE 6 END AS INTEGER) AS category
  FROM (SELECT *, (l_orderkey*31 + l_linenumber*17 + l_partkey*7) % 100 AS h FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey
)"""


def with_ratings(*ctes: str) -> str:
    """``WITH ratings AS (...), <ctes>`` prefix."""
    return "WITH " + ",\n".join((RATINGS_CTE,) + ctes) + "\n"


def movie_summary_sql(where: str) -> str:
    view = ", ".join(
        f"max(CASE WHEN rn = (CASE WHEN n*{i} > 10 THEN n*{i} // 10 - 1 ELSE 0 END) "
        f"THEN date - first END)::INTEGER AS viewdate{i - 1}"
        for i in range(1, 11)
    )
    rate = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN rn >= n*{i} // 10 AND rn < n*{i + 1} // 10 THEN rating END), 0) AS BIGINT)"
        f" / count(*) * 10 AS ratingdate{i}"
        for i in range(10)
    )
    return with_ratings(
        f"t AS (SELECT movie_id, date, user_id, rating FROM ratings WHERE {where})",
        """r AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY date, user_id, rating) - 1 AS rn,
                  count(*) OVER (PARTITION BY movie_id) AS n,
                  min(date) OVER (PARTITION BY movie_id) AS first FROM t)""",
    ) + f"""SELECT movie_id, count(*) AS ratings,
       CAST(sum(rating) AS BIGINT) / count(*) AS rating_mean,
       CAST(sum(rating*rating) AS BIGINT) / count(*)
         - (CAST(sum(rating) AS BIGINT) / count(*)) * (CAST(sum(rating) AS BIGINT) / count(*)) AS rating_var,
       min(date) AS first_rating, max(date) AS last_rating, {view}, {rate}
FROM r GROUP BY movie_id"""


# ---------------------------------------------------------------------------
# model chains (K factors, deterministic init; same operation order as Spark)
# ---------------------------------------------------------------------------

TRAIN_WHERE = "category IN (1, 2, 3, 6)"


def f_list(k: int, init_range: float = 0.05) -> str:
    return "[" + ", ".join(
        f"{init_range!r}::DOUBLE * ((id*31 + {j}*17) % 1000)::DOUBLE / 1000.0::DOUBLE" for j in range(k)) + "]"


def dot_sql(a: str, b: str, k: int) -> str:
    return "(" + " + ".join(f"{a}[{j + 1}]*{b}[{j + 1}]" for j in range(k)) + ")"


def model_ctes(k: int, init_range: float = 0.05, bias: float = 0.0, train_where: str = TRAIN_WHERE) -> list[str]:
    """train, mu, m0 (initial model over all rating ids)."""
    return [
        f"train AS (SELECT user_id, movie_id, rating FROM ratings WHERE {train_where})",
        "mu AS (SELECT avg(rating) AS mu FROM train)",
        "ids AS (SELECT DISTINCT 'user' AS side, user_id AS id FROM ratings "
        "UNION SELECT DISTINCT 'movie' AS side, CAST(movie_id AS BIGINT) AS id FROM ratings)",
        f"m0 AS (SELECT side, id, {f_list(k, init_range)} AS f, {float(bias)!r}::DOUBLE AS b FROM ids)",
    ]


def scored_cte(name: str, rows: str, model: str, k: int, use_bias: bool = True) -> str:
    pred = dot_sql("p", "q", k) + (" + bu + bm" if use_bias else "")
    return (
        f"{name} AS (SELECT x.*, p, q, bu, bm, {pred} AS pred, (x.rating - (SELECT mu FROM mu)) - ({pred}) AS e "
        f"FROM {rows} x "
        f"JOIN (SELECT id AS user_id, f AS p, b AS bu FROM {model} WHERE side = 'user') USING (user_id) "
        f"JOIN (SELECT CAST(id AS INTEGER) AS movie_id, f AS q, b AS bm FROM {model} WHERE side = 'movie') "
        f"USING (movie_id))"
    )


def step_ctes(src: str, dst: str, k: int, lr: float, reg_user: float, reg_movie: float, bias_ratio: float,
              use_bias: bool, per_rating: bool, reg_bias: bool, rows: str = "train") -> list[str]:
    """scored + gradients + update: model ``src`` → model ``dst``."""
    s, g = f"s_{dst}", f"g_{dst}"
    gq = ", ".join(f"sum(e*q[{j + 1}]) AS g{j}" for j in range(k))
    gp = ", ".join(f"sum(e*p[{j + 1}]) AS g{j}" for j in range(k))
    lam = f"(CASE WHEN side = 'user' THEN {reg_user!r} ELSE {reg_movie!r} END)"
    w = "coalesce(n, 0)::DOUBLE" if per_rating else "1.0::DOUBLE"
    f_new = "[" + ", ".join(
        f"f[{j + 1}] + {lr!r}*g{j} - {lr!r}*{lam}*{w}*f[{j + 1}]" for j in range(k)) + "]"
    if use_bias:
        b_new = f"b + {bias_ratio!r}*{lr!r}*coalesce(se, 0.0)"
        if reg_bias:
            b_new += f" - {lr!r}*{lam}*{w}*b"
    else:
        b_new = "b"
    return [
        scored_cte(s, rows, src, k, use_bias),
        f"{g} AS (SELECT 'user' AS side, user_id AS id, count(*) AS n, sum(e) AS se, {gq} FROM {s} GROUP BY user_id "
        f"UNION ALL SELECT 'movie' AS side, CAST(movie_id AS BIGINT) AS id, count(*) AS n, sum(e) AS se, {gp} "
        f"FROM {s} GROUP BY movie_id)",
        f"{dst} AS (SELECT side, id, CASE WHEN g0 IS NULL THEN f ELSE {f_new} END AS f, {b_new} AS b "
        f"FROM {src} LEFT JOIN {g} USING (side, id))",
    ]


def model_long_sql(model: str, k: int, digits: int = 6) -> str:
    parts = [f"SELECT side, id, {j} AS k, round(f[{j + 1}], {digits}) AS value FROM {model}" for j in range(k)]
    parts.append(f"SELECT side, id, -1 AS k, round(b, {digits}) AS value FROM {model}")
    return "\nUNION ALL ".join(parts)
