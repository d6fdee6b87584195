"""The reference's programs as Spark jobs, one function each, composed from the operators.

| program                         | function            |
| ------------------------------- | ------------------- |
| text → binary splitter + report | ``split_job``       |
| movie summary CSV               | ``summary_job``     |
| record dumper                   | ``dump_job``        |
| file chunker                    | ``chunk_job``       |
| factor trainer                  | ``train_job``       |
| predictor (probe RMSE, dumps)   | ``predict_job``     |
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile, splits
from ..schema import SPLITS
from ..session import scratch_path
from ..sources import binary, text
from . import fit, scoring


def split_job(spark: SparkSession, pairs: Sequence[tuple[str, str]], out: str, report: str,
              fmt: str = "ratings_bin") -> DataFrame:
    """Entry 1: each (data, index) text pair → ``out/<n>.<split>`` record files + one report row each.

    Pairs are read as one union in one pass; ``fmt='parquet'`` writes one table partitioned by
    pair and split instead (K1).
    """
    parts = [text.read_split_input(spark, data, index).withColumn("pair", F.lit(n)) for n, (data, index) in enumerate(pairs)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # one pass over the text into a table partitioned by (pair, split), rows that are routed nowhere
    # included; the outputs and the report read only that table
    staged = scratch_path(spark, "reelstat-tables", f"routed-{uuid.uuid4().hex}")
    u.withColumn("split", F.coalesce(splits.split_of("category"), F.lit("none"))).write.partitionBy("pair", "split").parquet(staged)
    table = spark.read.parquet(staged)
    if fmt == "parquet":
        table.where(F.col("split") != "none").write.mode("overwrite").partitionBy("pair", "split").parquet(out)
    else:
        for n in range(len(pairs)):
            for s in SPLITS:
                rows = table.where((F.col("pair") == n) & (F.col("split") == s)).orderBy("row_no")
                binary.write_ratings_bin(rows, f"{out}/{n}.{s}")
    rep = splits.split_report({str(d): table.where(F.col("pair") == n) for n, (d, _) in enumerate(pairs)})
    splits.write_report(rep, report)
    return rep


def summary_job(spark: SparkSession, train_path: str, out_csv: str) -> DataFrame:
    """Entry 2: a train record file (or folder) → the 26-column movie summary CSV."""
    summary = profile.movie_summary(binary.read_ratings_bin(spark, train_path))
    profile.write_summary_csv(summary, out_csv)
    return summary


def dump_job(spark: SparkSession, base: str, out: str) -> DataFrame:
    """Record dumper: ``base.train`` / ``.probe`` / ``.test`` as labelled text lines (U1 + K9)."""
    parts = {s: binary.read_ratings_bin(spark, f"{base}.{s}") for s in SPLITS}
    dump = splits.split_dump(parts)
    text.dump_lines(dump, out)
    return dump


def chunk_job(spark: SparkSession, path: str, out: str, chunk: int = 5_000_000) -> None:
    """File chunker: a text file split every ``chunk`` lines (K3)."""
    text.write_chunks(spark, path, out, chunk)


def train_job(spark: SparkSession, train_path: str, probe_path: str, cfg: fit.FitConfig) -> fit.FitResult:
    """Entry 3: the guarded factor fit on record files (train holds categories 1, 2, 3, 6; probe 4)."""
    r = binary.read_ratings_bin(spark, train_path).unionByName(binary.read_ratings_bin(spark, probe_path))
    return fit.fit_adaptive(spark, r.drop("row_no"), cfg)


def predict_job(spark: SparkSession, model_path: str, probe_path: str, test_path: str, mu: float,
                out: str | None = None, k: int | None = None) -> float:
    """Predictor: probe RMSE of a saved model; optionally the test predictions in file order (K7)."""
    model = spark.read.parquet(model_path)
    probe = binary.read_ratings_bin(spark, probe_path)
    rmse = fit.holdout_rmse(probe, model, mu, True, k)
    if out:
        scoring.score_file(spark, model_path, binary.read_ratings_bin(spark, test_path), mu, out, k)
    return rmse
