"""Ratings in a grid of user strips and movie strips, for the many passes of a fit.

A cell of the grid holds the ratings of one strip of users and one of movies. A pass over a model sends each factor row to the
cells of its strip, and gets one partial sum per entity and cell back: what moves grows with the entities times the strips of a side,
not with the ratings times the factors. The number of strips follows from the bytes that a cell may have. Entities with very
many ratings are dealt out over all strips by their partners, and their factor rows go to every cell.

A cell's sums are taken by NumPy over Arrow columns, factor by factor; each residual is added up in the order of ``functions.dot``.
Nulls keep their meaning: ratings without an id meet no model row, a residual with a null part counts as a row and adds nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

CELL_BYTES = 256_000_000  # of ratings, and of factor rows, in a cell
ROWS_PER_CELL = 250_000   # fewer are not dealt out only to keep all cores busy
HOT = 8                   # an entity with more than this fraction of a strip's ratings is dealt out over all strips


@dataclass(frozen=True)
class RatingGrid:
    """The stored rows (cell, user_id, movie_id, rating, sets): bit i of ``sets`` is set i of ``names``; set 0 is trained on."""

    rows: DataFrame
    side: int
    names: tuple[str, ...]
    labels: tuple[int, ...]      # of the cells: numbers that Spark deals out one to a task
    hot_users: tuple[int, ...]
    hot_movies: tuple[int, ...]

    def of(self, name: str) -> DataFrame:
        """(user_id, movie_id, rating) of one set."""
        return self.rows.where(F.col("sets").bitwiseAND(1 << self.names.index(name)) != 0).select("user_id", "movie_id", "rating")

    def scored(self, model: DataFrame, mu: float, use_bias: bool, k: int) -> GridScores:
        return GridScores(self, model, float(mu), use_bias, k)


def _side(rows: int, entities: int, k: int, cores: int) -> int:
    by_rows = math.ceil(math.sqrt(rows * 20 / CELL_BYTES))
    by_model = math.ceil(entities * 8 * (k + 4) / CELL_BYTES)
    busy = min(math.ceil(math.sqrt(cores)), math.ceil(math.sqrt(rows / ROWS_PER_CELL)))
    return max(1, by_rows, by_model, busy)


def _labels(spark, n: int) -> tuple[int, ...]:
    """``n`` numbers that hash partitioning into ``n`` partitions deals out one to each."""
    found = spark.range(40 * n).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p"), F.col("id").cast("int").alias("id"))
    first = {r["p"]: r["id"] for r in found.groupBy("p").agg(F.min("id").alias("id")).collect()}
    rest = iter(range(40 * n, 41 * n))
    return tuple(first[p] if p in first else next(rest) for p in range(n))


def _strip(key: str, hot: tuple[int, ...], partner: str, side: int) -> Column:
    own = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(side))
    spread = F.pmod(F.xxhash64(F.col(partner).cast("long"), F.lit(key)), F.lit(side))
    return F.when(F.col(key).isin(*hot), spread).otherwise(own) if hot else own


def deal(ratings: DataFrame, k: int, sets: dict[str, Column]) -> RatingGrid:
    """Store the rows of ``ratings`` (user_id, movie_id, rating, ...) that are in any of ``sets``, each once, for passes of ``k`` factors."""
    spark = ratings.sparkSession
    bits = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(sets.values())), F.lit(0))
    rows = materialize(ratings.select("user_id", "movie_id", "rating", bits.alias("sets")).where(F.col("sets") != 0), "grid-rows")
    counts = {key: materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), f"grid-{key}") for key in ("user_id", "movie_id")}
    total = rows.count()
    side = _side(total, sum(c.count() for c in counts.values()), k, spark.sparkContext.defaultParallelism)
    # at most HOT * side of a kind
    often = F.col("n") * HOT * side > total
    hot = {key: tuple(r[key] for r in c.where(often & F.col(key).isNotNull()).select(key).collect()) if side > 1 else () for key, c in counts.items()}
    labels = _labels(spark, side * side)
    cell = _strip("user_id", hot["user_id"], "movie_id", side) * side + _strip("movie_id", hot["movie_id"], "user_id", side)
    named = F.element_at(F.array(*[F.lit(x) for x in labels]), (cell + 1).cast("int"))
    stored = materialize(rows.select(named.alias("cell"), "user_id", "movie_id", "rating", "sets"), "grid")
    return RatingGrid(stored, side, tuple(sets), labels, hot["user_id"], hot["movie_id"])


@dataclass(frozen=True)
class GridScores:
    """The ratings of a grid scored by a model with one row per entity: their sums, as ``gradients`` and ``rmse`` ask for them."""

    grid: RatingGrid
    model: DataFrame
    mu: float
    use_bias: bool
    k: int

    def _sent(self) -> DataFrame:
        """The model's rows in the cells that need them."""
        g = self.grid
        strips = F.sequence(F.lit(0), F.lit(g.side - 1))
        own = F.pmod(F.xxhash64("id"), F.lit(g.side)).cast("int")
        user = F.col("side") == "user"
        cells = F.when(user, F.transform(strips, lambda s: own * g.side + s)).otherwise(F.transform(strips, lambda s: s * g.side + own))
        for kind, hot in ((user, g.hot_users), (~user, g.hot_movies)):
            if hot:
                cells = F.when(kind & F.col("id").isin(*hot), F.sequence(F.lit(0), F.lit(g.side * g.side - 1))).otherwise(cells)
        named = F.element_at(F.array(*[F.lit(x) for x in g.labels]), F.col("place") + 1)
        sent = self.model.where(F.col("id").isNotNull()).select(user.alias("is_user"), "id", "f", "b", F.explode(cells).alias("place"))
        return sent.select(named.alias("cell"), "is_user", "id", F.col("b").cast("double").alias("b"), *[F.col("f")[j].alias(f"f{j}") for j in range(self.k)])

    def sums(self, gradients: bool = True) -> DataFrame:
        """(side, id, n, se, g, ss, ne): of every entity with rows in set 0, and ss, ne of set ``id`` under the side ``set``.

        n counts the rows, ne those with a residual; se, g and ss are null without any.
        """
        k, mu, use_bias, sets = self.k, self.mu, self.use_bias, len(self.grid.names)
        names = ["side", "id", "n", "ne", "se", "ss", *(f"g{j}" for j in range(k))]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.float64()] * (k + 2)]
        schema = pa.schema(list(zip(names, kinds)))

        def run(rows: pa.Table, sent: pa.Table) -> pa.Table:
            def column(table, name):
                """(values, where null)."""
                c = table[name].combine_chunks()
                return c.fill_null(0).to_numpy(zero_copy_only=False), c.is_null().to_numpy(zero_copy_only=False)

            is_user = sent["is_user"].to_numpy()
            ids = sent["id"].to_numpy()
            own = {s: np.flatnonzero(is_user == s) for s in (True, False)}
            own = {s: x[np.argsort(ids[x])] for s, x in own.items()}
            key = {s: ids[x] for s, x in own.items()}
            at, met = {}, np.ones(rows.num_rows, bool)
            for s, name in ((True, "user_id"), (False, "movie_id")):
                asked = rows[name].to_numpy()
                at[s] = np.minimum(np.searchsorted(key[s], asked), max(len(key[s]) - 1, 0))
                met &= key[s][at[s]] == asked if len(key[s]) else False
            at = {s: x[met] for s, x in at.items()}
            rating, void = (x[met] for x in column(rows, "rating"))
            flags = rows["sets"].to_numpy()[met]
            empty = np.zeros(sent.num_rows, bool)

            def pair(name):
                """A model column for the user and the movie of each row."""
                values, null = column(sent, name)
                np.logical_or(empty, null, out=empty)
                return values[own[True]][at[True]], values[own[False]][at[False]]

            with np.errstate(all="ignore"):
                pred = np.zeros(len(rating))
                for j in range(k):
                    p, q = pair(f"f{j}")
                    pred = p * q if j == 0 else pred + p * q
                if use_bias:
                    bu, bm = pair("b")
                    pred = pred + bu + bm
                e = (rating - mu) - pred
                valid = ~void & ~empty[own[True]][at[True]] & ~empty[own[False]][at[False]]
                out = {name: [] for name in names}

                def add(side, n, ne, se, ss, g, which):
                    out["side"].append(pa.array([side] * len(which), pa.string()))
                    none = ne == 0
                    for name, values in zip(names[1:], (which, n, ne, se, ss, *g)):
                        whole = name in ("id", "n", "ne")
                        out[name].append(pa.array(values, pa.int64()) if whole else pa.array(values, pa.float64(), mask=none))

                squares = e * e
                for i in range(sets):
                    mine = valid & (flags >> i & 1 == 1)
                    ne = np.array([np.count_nonzero(mine)])
                    add("set", ne, ne, np.zeros(1), np.array([squares[mine].sum()]), [np.zeros(1)] * k, np.array([i]))
                if gradients:
                    trained = flags & 1 == 1
                    kept = trained & valid
                    at_kept, e_kept, squares = {s: x[kept] for s, x in at.items()}, e[kept], squares[kept]
                    sizes = {s: len(x) for s, x in own.items()}
                    total = {s: np.bincount(at[s][trained], minlength=sizes[s]) for s in own}
                    some = {s: np.flatnonzero(total[s]) for s in own}
                    summed = {s: lambda w, s=s: np.bincount(at_kept[s], w, minlength=sizes[s])[some[s]] for s in own}
                    g = {True: [], False: []}
                    for j in range(k):
                        values, _ = column(sent, f"f{j}")
                        for s in own:
                            g[s].append(summed[s](e_kept * values[own[not s]][at_kept[not s]]))
                    for s, side in ((True, "user"), (False, "movie")):
                        ne = np.bincount(at_kept[s], minlength=sizes[s])[some[s]]
                        add(side, total[s][some[s]], ne, summed[s](e_kept), summed[s](squares), g[s], key[s][some[s]])
            return pa.Table.from_arrays([pa.chunked_array(out[name], kind) for name, kind in zip(names, kinds)], schema=schema)

        cells = len(self.grid.labels)
        rows = self.grid.rows.where(F.col("user_id").isNotNull() & F.col("movie_id").isNotNull()).select(
            "cell", F.col("user_id").cast("long").alias("user_id"), F.col("movie_id").cast("long").alias("movie_id"), F.col("rating").cast("double").alias("rating"), "sets")
        parts = rows.repartition(cells, "cell").groupBy("cell").cogroup(self._sent().repartition(cells, "cell").groupBy("cell")).applyInArrow(
            run, "side string, id long, n long, ne long, se double, ss double, " + ", ".join(f"g{j} double" for j in range(k)))
        return parts.groupBy("side", "id").agg(
            F.sum("n").alias("n"), F.sum("se").alias("se"), F.array(*[F.sum(f"g{j}") for j in range(k)]).alias("g"),
            F.sum("ss").alias("ss"), F.sum("ne").alias("ne"))

    def rmses(self, sums: DataFrame) -> dict[str, float]:
        """G5 of every set, from the rows of ``sums``; NaN for a set without a residual."""
        found = {r["id"]: r["ss"] / r["ne"] for r in sums.where(F.col("side") == "set").collect() if r["ne"]}
        return {name: math.sqrt(found[i]) if i in found and not math.isnan(found[i]) else float("nan") for i, name in enumerate(self.grid.names)}
