"""Holdout routing on a stream of rating records (P3 + G3 + K1 on ``readStream``).

The reference is batch-only; routing and the category histogram are stateless
or simply keyed, so the same column expressions run unchanged on a streaming
source: new rating files landing in a folder are routed into the split-
partitioned table, and the histogram is a keyed running count in the state
store (one row per category — bounded state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.splits import split_of
from ..schema import RATINGS
from ..session import scratch_path


def rating_stream(spark: SparkSession, folder: str, max_files: int = 64) -> DataFrame:
    """Parquet rating files arriving in ``folder`` (canonical schema)."""
    return spark.readStream.schema(RATINGS).option("maxFilesPerTrigger", max_files).parquet(folder)


def routed(stream: DataFrame) -> DataFrame:
    return stream.withColumn("split", split_of("category")).where(F.col("split").isNotNull())


def category_counts(stream: DataFrame) -> DataFrame:
    """G3 as a running aggregate: (category, entries)."""
    return stream.groupBy("category").agg(F.count(F.lit(1)).alias("entries"))


def start_routing(spark: SparkSession, folder: str, out: str, name: str = "routing",
                  available_now: bool = True) -> StreamingQuery:
    """Route arriving files into ``out`` partitioned by split (exactly-once file sink)."""
    ckpt = scratch_path(spark, "reelstat-streams", name)
    w = (routed(rating_stream(spark, folder)).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).partitionBy("split").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
