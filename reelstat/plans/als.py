"""Cross-check solver: Spark MLlib ALS on centred ratings.

ALS weights λ by each entity's rating count, like the per-rating rule of the
batch steps, so its holdout RMSE is a sanity bound for the factor fits.
Block-partitioned by MLlib; its lineage is cut every ``checkpoint_interval``
iterations into the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def als_fit(train: DataFrame, k: int = 10, reg: float = 0.05, iterations: int = 10, mu: float | None = None,
            checkpoint_interval: int = 5, seed: int = 42):
    """Fit ALS on ``rating − μ``; returns (model, μ)."""
    checkpoint_dir(train.sparkSession)
    if mu is None:
        mu = float(train.agg(F.avg("rating")).first()[0])
    data = train.select(F.col("user_id").cast("int").alias("user"), F.col("movie_id").alias("item"),
                        (F.col("rating") - F.lit(mu)).alias("r"))
    als = ALS(rank=k, maxIter=iterations, regParam=reg, userCol="user", itemCol="item", ratingCol="r",
              coldStartStrategy="drop", checkpointInterval=checkpoint_interval, seed=seed)
    return als.fit(data), mu


def als_rmse(model, holdout: DataFrame, mu: float) -> DataFrame:
    """Holdout RMSE of an ALS model (rows of unseen ids dropped, as ``coldStartStrategy='drop'``)."""
    data = holdout.select(F.col("user_id").cast("int").alias("user"), F.col("movie_id").alias("item"),
                          (F.col("rating") - F.lit(mu)).alias("r"))
    pred = model.transform(data)
    return pred.agg(F.sqrt(F.avg((F.col("prediction") - F.col("r")) ** 2)).alias("rmse"),
                    F.count(F.lit(1)).alias("n"))
