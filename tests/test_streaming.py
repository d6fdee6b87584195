from pyspark.sql import functions as F

from conftest import SF_SMALL
from reelstat.sources.tables import ratings
from reelstat.streaming import routing


def test_stream_routing_equals_batch(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/in"
    r = ratings(spark, SF_SMALL)
    r.where("category <= 3").write.parquet(src)                       # first batch of files
    q = routing.start_routing(spark, src, f"{tmpdir_fresh}/out", name=f"t-{tmpdir_fresh.split('-')[-1]}")
    q.awaitTermination(120)
    r.where("category > 3").write.mode("append").parquet(src)         # files arriving later
    q = routing.start_routing(spark, src, f"{tmpdir_fresh}/out", name=f"t-{tmpdir_fresh.split('-')[-1]}")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmpdir_fresh}/out")
    got = {x.split: x["count"] for x in out.groupBy("split").count().collect()}
    assert got == {"train": 5251 + 181 + 188 + 53, "probe": 134, "test": 193}


def test_stream_category_counts(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/in2"
    r = ratings(spark, SF_SMALL)
    r.write.parquet(src)
    name = f"counts_{tmpdir_fresh.split('-')[-1]}"
    q = (routing.category_counts(routing.rating_stream(spark, src)).writeStream.format("memory").queryName(name)
         .outputMode("complete").trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {x.category: x.entries for x in spark.table(name).collect()}
    want = {x.category: x["count"] for x in r.groupBy("category").count().collect()}
    assert got == want
