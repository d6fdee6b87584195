"""Fit loops (M8 M10 M11 M12 G12 G13 W6 K4 K5 K6) as driver loops over immutable model tables.

Every epoch's model is written to the session's checkpoint folder
(``spark.checkpoint.dir``) and read back: lineage stays one epoch deep, a lost
executor replays at most one epoch, rollback is "keep the previous path" and
best-model keeping is "remember the best path". The rows of the guarded and the threshold fit are
dealt out once in a grid of user and movie strips (``operators.grid``). One pass over it gives a model's
RMSEs and the gradients of the next step; a step that is rolled back leaves the gradients it started from, so that
the next one, at a lower rate, needs no pass of its own.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import grid as G
from ..operators import model as M
from ..operators.basic import merge_duplicates
from ..session import forget, materialize, scratch_path


@dataclass
class FitConfig:
    """Defaults are the reference trainer's constants; the step rule is a batch step."""

    run: str = "run10"
    comment: str = "deterministic init [0, 0.05]"
    k: int = S.N_FACTORS
    iterations: int = S.N_ITERATIONS
    lr: float = S.LEARNING_RATE
    reg_user: float = S.REG_USER
    reg_movie: float = S.REG_MOVIE
    bias_ratio: float = S.BIAS_RATIO
    dec: float = S.LEARNING_DEC
    inc: float = S.LEARNING_INC
    up: float = S.LEARNING_UP
    down: float = S.LEARNING_DOWN
    tune_freq: int = 300000
    threshold: float = S.THRESHOLD
    init_range: float = S.INIT_RANGE
    include_valid: bool = True        # the reference also trains on the validation rows
    mu: float | None = None           # None: the train mean (G1); the reference used 3.60861
    rule: Callable[..., M.StepRule] | None = None  # lr -> StepRule; default: the bias model (M4)

    def step_rule(self, lr: float) -> M.StepRule:
        if self.rule is not None:
            return self.rule(lr)
        return M.rule_bias_model(lr, self.reg_user, self.reg_movie, self.bias_ratio)


@dataclass
class FitResult:
    run_log: DataFrame
    run_params: DataFrame
    final_model: str
    best_model: str | None
    best_probe_rmse: float | None
    mu: float
    log_rows: list = field(default_factory=list)


class _Store:
    """Model tables under <checkpoint dir>/reelstat-runs/<run>-<id>/."""

    def __init__(self, spark: SparkSession, run: str):
        self.spark = spark
        self.base = scratch_path(spark, "reelstat-runs", f"{run}-{uuid.uuid4().hex[:8]}")

    def save(self, model: DataFrame, name: str) -> str:
        path = f"{self.base}/{name}"
        model.write.mode("overwrite").parquet(path)
        return path

    def load(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)


def materialize_sets(rows: DataFrame, store: _Store, name: str, sets: dict[str, "F.Column"]) -> dict[str, DataFrame]:
    """Several row sets in one pass: one table partitioned by set.

    A row belonging to several sets (validation rows are also trained on) is
    written once per set; each returned frame prunes to its partition. Rows are not bound to
    buckets: a model side under the broadcast threshold joins without a shuffle, and
    above it the join shuffles the rows by key and AQE splits a user that holds too many of them.
    """
    labels = F.filter(F.array(*[F.when(cond, F.lit(label)) for label, cond in sets.items()]), lambda x: x.isNotNull())
    path = f"{store.base}/{name}"
    rows.select(F.explode(labels).alias("set"), "user_id", "movie_id", "rating").write.mode("overwrite").partitionBy("set").parquet(path)
    t = store.load(path)
    return {label: t.where(F.col("set") == label).drop("set") for label in sets}


def holdout_rmse(rows: DataFrame, model: DataFrame, mu: float, use_bias: bool = True, k: int | None = None) -> float:
    """RMSE of the model on all rows of a holdout set (unclamped)."""
    return M.rmse_value(M.scored_all(rows, model, mu, use_bias, k))


def param_values(cfg: FitConfig) -> dict[str, str]:
    """K5: the parameters under their output labels (fixed values)."""
    return {
        "comment": cfg.comment,
        "SVD_dim": str(cfg.k),
        "REGULAR_U": f"{cfg.reg_user:.8f}",
        "REGULAR_M": f"{cfg.reg_movie:.8f}",
        "LEARNING_DEC": f"{cfg.dec:.8f}",
        "LEARNING_INC": f"{cfg.inc:.8f}",
        "LEARNING_DWN": f"{cfg.down:.8f}",
        "LEARNING_UP": f"{cfg.up:.8f}",
        "TUNE_FREQ": str(cfg.tune_freq),
        "LEARNING_RATE": f"{cfg.lr:.8f}",
        "ITERATIONS": str(cfg.iterations),
    }


def params_frame(spark: SparkSession, cfg: FitConfig, extra: dict[str, str] | None = None) -> DataFrame:
    """K5: ``run_params`` rows (run, key, value), written before training."""
    kv = param_values(cfg) | (extra or {})
    return spark.createDataFrame([(cfg.run, k, v) for k, v in kv.items()], S.RUN_PARAMS)


def choose_rate(train: DataFrame, valid: DataFrame, model: DataFrame, mu: float, cfg: FitConfig, lr: float):
    """M10 + G12: one step each at lr·up, lr/down and lr from the same snapshot; keep the best.

    Only a rate that alone has the least RMSE wins; on ties the current one stays. Returns (new_lr, candidates).
    """
    cands = []
    for label, rate in (("up", lr * cfg.up), ("down", lr / cfg.down), ("same", lr)):
        trial = M.epoch(train, model, mu, cfg.step_rule(rate), cfg.k)
        cands.append((label, rate, holdout_rmse(valid, trial, mu, cfg.step_rule(rate).use_bias, cfg.k)))
    least = min(r for _, _, r in cands)
    winners = [rate for _, rate, r in cands if r == least]
    return (winners[0] if len(winners) == 1 else lr), cands


def fit_adaptive(spark: SparkSession, ratings: DataFrame, cfg: FitConfig) -> FitResult:
    """M12 (C++ loop) with M8 guarded steps, M10 rate probes, M11 best-model keeping.

    ``ratings`` has the canonical columns incl. category. Train = categories
    1, 2, 3, 6 (2 excluded unless ``include_valid``); valid = category 2;
    probe = category 4.
    """
    t_start = time.time()
    store = _Store(spark, cfg.run)
    train_cats = [c for c in S.TRAIN_CATEGORIES if cfg.include_valid or c != S.VALID_CATEGORY]
    cat = F.col("category")
    grid = G.deal(ratings, cfg.k, {
        "train": cat.isin(*train_cats), "valid": cat == S.VALID_CATEGORY, "probe": cat == S.PROBE_CATEGORY})
    mu = cfg.mu if cfg.mu is not None else float(grid.of("train").agg(F.avg("rating")).first()[0])
    use_bias = cfg.step_rule(cfg.lr).use_bias

    params = params_frame(spark, cfg, {"mu": repr(mu)})
    params.write.mode("append").parquet(f"{store.base}/run_params")

    path = store.save(M.init_model(ratings, cfg.k, cfg.init_range), "epoch=0")
    model = store.load(path)
    lr = cfg.lr

    def looked_at(model: DataFrame, steps_follow: bool) -> tuple[dict[str, float], DataFrame]:
        """One pass: a model's RMSE on every set, and the gradients that any step from it takes, at whatever rate."""
        s = M.scored(grid, model, mu, use_bias, cfg.k)
        sums = materialize(s.sums(gradients=steps_follow), "fit-sums")
        return s.rmses(sums), sums

    r0, sums = looked_at(model, cfg.iterations > 0)
    last, kept_probe = r0["valid"], r0["probe"]
    best_rmse, best_path = math.inf, None
    log = []
    for i in range(cfg.iterations):
        lr_used = lr
        grads = sums.where(F.col("side") != "set").drop("ss", "ne")
        new_path = store.save(M.apply_gradients(model, grads, cfg.step_rule(lr)), f"epoch={i + 1}")
        new_model = store.load(new_path)
        rn, new_sums = looked_at(new_model, i + 1 < cfg.iterations)
        new = rn["valid"]
        if new > last or math.isnan(new):          # M8: roll back, slow down (F8: NaN test)
            accepted = False
            lr *= cfg.dec                          # the kept model's RMSEs are still `last`, `kept_probe`, its gradients `sums`
            forget(new_sums)
        else:
            accepted = True
            lr *= cfg.inc
            gain = last - new
            last, kept_probe = new, rn["probe"]
            model, path = new_model, new_path
            forget(sums)
            sums = new_sums
            if gain < cfg.threshold:               # the stopping step is not logged
                break
        p = kept_probe
        log.append((cfg.run, i + 1, lr_used, last, p, accepted))
        if p < best_rmse:                          # M11 / G13: strict <, earliest best kept
            best_rmse, best_path = p, path
        if (i + 1) % cfg.tune_freq == 0:           # M10
            lr, _ = choose_rate(grid.of("train"), grid.of("valid"), model, mu, cfg, lr)
    run_log = spark.createDataFrame(log, S.RUN_LOG)
    run_log.write.mode("append").parquet(f"{store.base}/run_log")
    final = store.save(model, "final")
    if best_path is not None:
        store.save(store.load(best_path), "best")
    # What the reference encodes in model file names, as rows
    extra = {
        "stamp": file_stamp(spark, t_start),
        "seconds": f"{time.time() - t_start:.0f}",
        "mu_bips": str(math.floor(mu * 10000)),
        "valid_rmse_bips": str(math.floor(last * 10000)) if not math.isnan(last) else "nan",
        "best_probe_rmse_bips": str(math.floor(best_rmse * 10000)) if best_path else "",
        "final_model": final,
        "best_model": f"{store.base}/best" if best_path else "",
    }
    params = params.unionByName(spark.createDataFrame([(cfg.run, k, v) for k, v in extra.items()], S.RUN_PARAMS))
    params.write.mode("overwrite").parquet(f"{store.base}/run_params")
    return FitResult(run_log, params, final, best_path, None if best_path is None else best_rmse, mu, log)


def fit_threshold(spark: SparkSession, ratings: DataFrame, k: int = 10, lr: float = 0.0005, reg: float = 0.001,
                  max_loops: int = 30, stop: float = 1e-4, init_constant: float = 0.1,
                  run: str = "python") -> tuple[DataFrame, str]:
    """M12 (Python loop): per-rating rule (M6 re-aimed), ≤ max_loops − 1 steps, stop at |ΔRMSE| < stop.

    Repeated (user, movie) cells are summed first (G8). The rate is a tenth of a sequential pass's 0.005:
    a batch step adds up all of an entity's ratings before it moves. RMSE is measured on the training rows themselves (non-zero ratings, P5).
    Every step also sums up the squared residuals that it started from, so the RMSE after a step comes with the next one and
    costs no scoring of its own; the step taken past the last is left aside.
    Returns the log (run, iteration, rmse_before, rmse_after) and the model path.
    """
    store = _Store(spark, run)
    cells = merge_duplicates(ratings.where(F.col("rating") != 0)).select("user_id", "movie_id", "rating")
    train = store.load(store.save(cells, "train"))
    grid = G.deal(train, k, {"train": F.lit(True)})
    mu = float(train.agg(F.avg("rating")).first()[0])
    path = store.save(M.init_model(train, k, constant=init_constant, bias=0.0), "epoch=0")
    rule = M.rule_per_rating(lr, reg)
    log, old = [], None
    for i in range(max_loops):
        model = store.load(path).select("side", "id", "f", "b")
        if i + 1 < max_loops:
            next_path = store.save(M.epoch(grid, model, mu, rule, k, squares=True), f"epoch={i + 1}")
            new = M.rmse_of_sums(store.load(next_path))
        else:
            next_path, new = path, M.rmse_value(M.scored(grid, model, mu, k=k))
        if i:
            log.append((run, i, old, new))
            if abs(old - new) < stop:
                break
        old, path = new, next_path
    path = store.save(store.load(path).select("side", "id", "f", "b"), "final")
    frame = spark.createDataFrame(log, "run string, iteration int, rmse_before double, rmse_after double")
    return frame, path


def rmse_changes(run_log: DataFrame) -> DataFrame:
    """Change of valid RMSE between logged iterations (window per run — a run has few rows)."""
    w = Window.partitionBy("run").orderBy("iteration")
    return run_log.withColumn("delta_valid", F.col("valid_rmse") - F.lag("valid_rmse").over(w))


def best_iteration(run_log: DataFrame) -> DataFrame:
    """Per run, the earliest iteration with the lowest probe RMSE."""
    return run_log.groupBy("run").agg(
        F.min_by("iteration", F.struct("probe_rmse", "iteration")).alias("best_iteration"),
        F.min("probe_rmse").alias("best_probe_rmse"))


def stamp(ts: Column) -> Column:
    """the ``%m%d-%H%M`` stamp of a timestamp in the session's time zone."""
    return F.date_format(ts, "MMdd-HHmm")


def file_stamp(spark: SparkSession, ts: float) -> str:
    """F12 of a point in time in seconds, as used in model names."""
    return spark.range(1).select(stamp(F.timestamp_seconds(F.lit(float(ts))))).first()[0]


DRAW_BLOCK = 10


def fit_bias_sgd(spark: SparkSession, ratings: DataFrame, threshold: float = 0.01, steps: int = 100,
                 batch: int = 3, lr: float = 0.1, reg: float = 0.5, run: str = "bias") -> tuple[DataFrame, str]:
    """M9 loop: sampled bias steps until the objective (G10) moves less than ``threshold``.

    Every rating is stored once per side, by ranges of entities. The draws of ``DRAW_BLOCK`` steps at a time are picked in one pass
    over these rows and written by step; each step then is one job writing one ``(side, id, b)`` table to the checkpoint
    folder (lineage one step deep). The objectives of a block's steps come from one pass over the ratings, as no step
    needs them: steps of a block past the one that stops the loop are left aside. The objective
    after a step is the next step's "before". Returns the log (run, step,
    objective_before, objective_after) and the path of the last biases.
    """
    from ..operators import bias_fit as BF

    store = _Store(spark, run)
    rows = store.load(store.save(ratings.select("user_id", "movie_id", "date", "rating"), "rows"))
    mu = float(rows.agg(F.avg("rating")).first()[0])
    sides = store.load(store.save(BF.by_entity(rows), "sides"))

    path = store.save(BF.to_table(*BF.init_biases(rows)), "step=0")
    before, log = None, []
    for first in range(1, steps + 1, DRAW_BLOCK):
        block = list(range(first, min(first + DRAW_BLOCK, steps + 1)))
        drawn_path = f"{store.base}/draws={first}"
        BF.draws_of(sides, block, batch).write.partitionBy("step").parquet(drawn_path)
        drawn = store.load(drawn_path)
        paths = [path]
        for i in block:
            bu, bm = BF.from_table(store.load(paths[-1]))
            moved = BF.step(drawn.where(F.col("step") == i), bu, bm, mu, batch, lr, reg)
            paths.append(store.save(BF.to_table(*moved), f"step={i}"))
        asked = paths if before is None else paths[1:]
        found = [float(x) for x in BF.objectives(rows, [store.load(p) for p in asked], mu, reg).first()]
        if before is None:
            before = found.pop(0)
        for i, path, after in zip(block, paths[1:], found):
            log.append((run, i, before, after))
            stopped = abs(after - before) < threshold
            before = after
            if stopped:
                break
        if stopped:
            break
    frame = spark.createDataFrame(log, "run string, step int, objective_before double, objective_after double")
    return frame, path


def run_log_lines(run_log: DataFrame) -> DataFrame:
    """K6 body: ``%d, %.7f, %.7f`` (iteration, valid RMSE, probe RMSE) per logged step."""
    return run_log.select(
        "run", "iteration",
        F.format_string("%d, %.7f, %.7f", "iteration", "valid_rmse", "probe_rmse").alias("line"))


def write_run_log_csv(run_log: DataFrame, path: str) -> None:
    """K6: the iteration log as text lines in order of iteration, a folder ``run=<run>`` for each run.

    A run's lines replace those it wrote before and leave other runs' alone, so that a repeated job logs once. Parts are
    cut by ranges of (run, iteration): a run's files in path order are its log.
    """
    run_log_lines(run_log).orderBy("run", "iteration").select("run", F.col("line").alias("value")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("run").text(path)


def read_run_log_csv(spark: SparkSession, path: str) -> DataFrame:
    """K6 read back: (run, iteration, valid_rmse, probe_rmse, row_no); ``row_no`` counts lines over all files in path order."""
    from ..operators.positional import number_lines

    f = F.split("value", ", ")
    logged = number_lines(spark.read.schema("value string, run string").text(path))   # the folder's name as text, whatever it looks like
    return logged.select("run", f[0].cast("int").alias("iteration"), f[1].cast("double").alias("valid_rmse"),
                         f[2].cast("double").alias("probe_rmse"), "row_no")


def fit_cell_bias(spark: SparkSession, ratings: DataFrame, k: int, lr: float = 0.0005, reg: float = 0.001, epochs: int = 2,
                  init: float | None = 0.1, run: str = "cells") -> tuple[str, str]:
    """``epochs`` batch steps of the model with a bias per cell; returns the paths of the last cells and factors.

    The state is as large as the ratings (a bias per cell) and is written anew every epoch beside the factors.
    """
    from ..operators import cell_bias as CB

    store = _Store(spark, run)
    cells_path = store.save(CB.init_cells(ratings), "cells=0")
    model_path = store.save(M.init_model(store.load(cells_path), k, constant=init), "epoch=0")
    for i in range(1, epochs + 1):
        cells, model = store.load(cells_path), store.load(model_path)
        new_cells, new_model = CB.epoch(cells, model, lr, reg, k)
        cells_path, model_path = store.save(new_cells, f"cells={i}"), store.save(new_model, f"epoch={i}")
    return cells_path, model_path
