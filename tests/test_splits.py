from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelstat.operators import splits
from reelstat.schema import RATINGS
from reelstat.sources.tables import ratings


def test_route_labels(spark):
    rows = [(1, 1, 1, 3, c) for c in (0, 1, 2, 3, 4, 5, 6, 7)]
    got = {r.category: r.split for r in splits.route(spark.createDataFrame(rows, RATINGS)).collect()}
    assert got == {0: "train", 1: "train", 2: "train", 3: "train", 4: "probe", 5: "test", 6: "train"}


def test_report_reconciles(spark):
    r = ratings(spark, SF_SMALL)
    rep = splits.split_report(r).collect()[0]
    parts = sum(rep[label] for label, _ in splits.REPORT_LABELS) + rep.invalid
    assert parts == rep.entries == r.count()
    # fixed fixture counts at sf0.001
    assert (rep.train_1, rep.train_2, rep.train_3, rep.probe, rep.test, rep.train_6) == (5251, 181, 188, 134, 193, 53)


def test_report_counts_invalid(spark):
    rows = [(1, 1, 1, 3, c) for c in (0, 7, 1)]
    rep = splits.split_report(spark.createDataFrame(rows, RATINGS)).collect()[0]
    assert rep.invalid == 2 and rep.train_1 == 1 and rep.entries == 3


def test_write_splits_partition_pruning(spark, tmpdir_fresh):
    r = ratings(spark, SF_SMALL)
    out = f"{tmpdir_fresh}/splits"
    splits.write_splits(r, out)
    probe = spark.read.parquet(out).where(F.col("split") == "probe")
    assert probe.count() == 134
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan
