"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to a no-op sink (full evaluation, nothing collected). After one
warm-up pass of the whole set on the sf0.01 tables, every query runs twice at
the target scale: ``queries`` holds the faster (warm) run, ``cold_queries`` the
first one (which also pays first-time code generation for the plan shape).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from reelstat.operators import model as M  # noqa: E402
from reelstat.plans import catalog as C  # noqa: E402
from reelstat.session import local_session  # noqa: E402
from reelstat.sources.tables import ratings  # noqa: E402


def _epoch_k40(spark, sf_dir):
    """One M4 step at the reference's width (K = 40) on the train split."""
    r = ratings(spark, sf_dir)
    tr = r.where(F.col("category").isin(1, 2, 3, 6)).select("user_id", "movie_id", "rating")
    return M.epoch(tr, M.init_model(r, 40), C.basic.global_mean(tr), M.rule_bias_model(C.LR), 40)


HEADLINE = {
    "movie_summary": lambda s, d: C.q_movie_summary(s, d),
    "movie_summary_sparse": lambda s, d: C.q_movie_summary_sparse(s, d),
    "split_report": lambda s, d: C.q_split_report(s, d),
    "split_route": lambda s, d: C.q_split_route(s, d),
    "positional_zip": lambda s, d: C.q_positional_zip(s, d),
    "epoch_bias_model_k40": _epoch_k40,
    "epoch_bias_model": lambda s, d: C.QUERIES["epoch_bias_model"](s, d),
    "rmse_probe": lambda s, d: C.QUERIES["rmse_probe"](s, d),
    "bias_minibatch_step": lambda s, d: C.QUERIES["bias_minibatch_step"](s, d),
    "score_clamped": lambda s, d: C.QUERIES["score_clamped"](s, d),
}


def run(spark, fn, sf_dir):
    t = time.time()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus) if cpus.isdigit() else 16)))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="reelstat-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    n_rows = ratings(spark, sf_dir).count()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    for name, fn in HEADLINE.items():  # warm-up (JIT, code caches) on small tables
        run(spark, fn, warm_dir)
    cold, times = {}, {}
    for name, fn in HEADLINE.items():
        first, second = run(spark, fn, sf_dir), run(spark, fn, sf_dir)
        cold[name], times[name] = round(first, 3), round(min(first, second), 3)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_sec": {k: round(n_rows / v) for k, v in times.items() if v > 0},
        "cold_queries": cold,
        "cold_total_sec": round(sum(cold.values()), 3),
        "input_rows": n_rows,
        "sf": sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
