"""Plan-shape checks for the scale properties the design relies on."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelstat.operators import model as M, profile
from reelstat.plans import fit
from reelstat.sources.tables import ratings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_windows_never_see_raw_rows(spark):
    """Every Window in the summary runs over an aggregate (histogram), never over scanned rows."""
    r = ratings(spark, SF_SMALL).where(F.col("category").isin(1, 2, 3, 6))
    lp = profile.movie_summary(r, checkpoint=False)._jdf.queryExecution().optimizedPlan()
    # walk the optimized logical plan: below each Window, an Aggregate must come before any relation
    windows = []

    def check(node, seen_window):
        name = node.nodeName()
        if name == "Window":
            seen_window = True
            windows.append(node)
        if name == "Aggregate":
            seen_window = False
        if name in ("LogicalRelation", "LogicalRDD") and seen_window:
            raise AssertionError("window over raw rows")
        children = node.children()
        for i in range(children.size()):
            check(children.apply(i), seen_window)
    check(lp, False)
    assert len(windows) >= 3   # dates per movie, buckets per block, keys per bucket


def test_epoch_one_aggregation_shuffle_and_one_rating_scan(spark):
    r = ratings(spark, SF_SMALL)
    train = r.where("category in (1,2,3,6)").select("user_id", "movie_id", "rating")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(M.epoch(train, M.init_model(r, 4), 3.0, M.rule_bias_model(0.002), 4))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    partial = re.findall(r"HashAggregate\(keys=\[side#\d+, id#\d+L\], functions=\[partial_count", plan)
    assert len(partial) == 1, plan   # one partial (map-side) aggregate on (side, id)
    assert plan.count("FileScan parquet") >= 1
    # the gradient pass reads lineitem once (the model init reads it again for the ids)
    assert len(re.findall(r"functions=\[partial_count\(1\), partial_sum", plan)) == 1


def test_no_forced_broadcast_of_growing_tables():
    """Only offset tables (one row per split / partition) carry a broadcast hint."""
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "reelstat"
    hits = []
    for p in root.rglob("*.py"):
        if p.parent.name == "llm":
            continue  # its broadcasts stand behind size checks of their own
        for line in p.read_text().splitlines():
            if "F.broadcast(" in line:
                hits.append((p.name, line.strip()))
    assert hits and all(name == "positional.py" and "offsets" in line for name, line in hits), hits


def test_a_hot_user_is_split_in_the_epoch_join(spark, tmpdir_fresh):
    """With broadcasting off (as at scale), a user with a third of the train rows is read by several tasks."""
    n = 60_000
    rows = spark.range(n).selectExpr("if(id % 3 = 0, 7, id) AS user_id", "cast(id % 500 AS int) AS movie_id", "cast(1 + id % 5 AS int) AS rating")
    store = fit._Store(spark, "hot")
    train = fit.materialize_sets(rows, store, "rows", {"train": F.lit(True)})["train"]
    model = store.load(store.save(M.init_model(train, 3), "m"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.files.maxPartitionBytes": "64k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        scored = M.scored(train, model, 3.0, k=3)
        scored.write.mode("overwrite").parquet(f"{tmpdir_fresh}/scored")
        scored.collect()
        assert "skew=true" in scored._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
