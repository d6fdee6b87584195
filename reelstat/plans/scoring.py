"""Scoring job (M13 + M14 + K7 + K10): load a saved model, score rows in input order, write predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model as M
from ..schema import INIT_RANGE
from ..sources.text import prediction_lines, write_predictions


def predictions(rows: DataFrame, model: DataFrame, mu: float, k: int | None = None,
                clamp: tuple[float, float] = (1.0, 5.0), use_bias: bool = True,
                init_range: float = INIT_RANGE) -> DataFrame:
    """``(row_no, prediction)``: μ + prediction clamped to [1, 5] (P10 + P8), one per input row.

    An id the model never saw scores with its initial factors (the same
    deterministic init the fit starts from) and zero bias. ``k`` is read from the model
    if it is not given.
    """
    if "rating" not in rows.columns:
        rows = rows.withColumn("rating", F.lit(None).cast("int"))
    s = M.scored_all(rows, model, mu, use_bias, k, init_range)
    return s.select("row_no", M.predicted_rating(s, mu, clamp).alias("prediction"))


def score_file(spark: SparkSession, model_path: str, rows: DataFrame, mu: float, out: str,
               k: int | None = None, parts: int | None = None) -> None:
    """The model at ``model_path`` (a ``factors`` table) scores ``rows`` into ``out``, one line per row."""
    write_predictions(predictions(rows, spark.read.parquet(model_path), mu, k), out, parts=parts)


def true_rating_file(rows: DataFrame, out: str) -> None:
    """The true ratings of numbered rows as ``%.5f`` lines, in input order."""
    write_predictions(rows.select("row_no", F.col("rating").cast("double").alias("prediction")), out)


def prediction_text(rows: DataFrame, model: DataFrame, mu: float, k: int | None = None) -> DataFrame:
    """``(row_no, line)`` — the K7 file body as a DataFrame."""
    return prediction_lines(predictions(rows, model, mu, k))
