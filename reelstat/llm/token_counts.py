"""Token counts through a cache of digests.

The cache is a Parquet table (tokenizer, digest, n_tokens), partitioned by ``tokenizer``: the digest of the model file and of the way
it is used, so that another version of either never meets old counts. ``digest`` is that of the normalised content;
the normalisation changes nothing that the tokenizer sees (null is empty; the space mark is a space, which the model cannot tell apart).

One call hashes all texts, joins the digests to the stored counts, picks one row of each
distinct missing digest, encodes the texts of these rows only, appends their counts, and joins the counts to all
rows. Digests that many rows share are joined apart (see ``with_counts``), so that no task gets all copies of a text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm.common import written
from reelstat.session import scratch_path

RULE = "sentencepiece-ids-1"  # part of the version: library, no begin or end ids, no sampling
MARK = "▁"
HOT_SHARE = 2_000  # a digest on more than this fraction of the rows is hot: fewer than this many digests can be
CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def tokenizer_version(model: bytes, rule: str = RULE) -> str:
    """The digest of a model file and of the counting rule."""
    return hashlib.sha256(hashlib.sha256(model).digest() + rule.encode()).hexdigest()


def content_digest(text) -> F.Column:
    """SHA-256 of the normalised content."""
    return F.unhex(F.sha2(F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" ")), 256))


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts under ``path``; a cache nobody has written yet is empty."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def encode_counts(texts: DataFrame, model: bytes) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text); a row that repeats its id and text within a batch is encoded once."""
    shared = texts.sparkSession.sparkContext.broadcast(model)  # about a megabyte
    schema = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        encode = SentencePieceProcessor(model_proto=shared.value).encode
        for batch in batches:
            different = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            counts = [len(encode(text)) for text in different.values()]
            yield pa.RecordBatch.from_arrays([pa.array(different, pa.binary()), pa.array(counts, pa.int64())], schema=schema)

    return texts.select("digest", "text").mapInArrow(count, "digest binary, n_tokens long")


def with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Written ``rows`` with the ``n_tokens`` of written ``counts`` (a row per digest), an equi-join on the digest.

    A digest on more than a ``HOT_SHARE``-th of the rows is one of fewer than ``HOT_SHARE`` such digests: their counts are
    broadcast, with that bound, and only the rows of other digests are dealt out by digest.
    """
    n = rows.count()
    copies = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") * HOT_SHARE > n)
    hot = written(copies.select("digest").join(counts, "digest"), "hot-counts")
    if hot.isEmpty():
        return rows.join(counts, "digest")
    met = rows.join(F.broadcast(hot.withColumnRenamed("n_tokens", "hot_tokens")), "digest", "left")
    rest = met.where("hot_tokens is null").drop("hot_tokens").join(counts, "digest")
    return rest.unionByName(met.where("hot_tokens is not null").withColumnRenamed("hot_tokens", "n_tokens").select(*rest.columns))


def count_tokens(docs: DataFrame, model_path: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens), a row per row of ``docs``; counts not yet in the cache are appended to it.

    A null text counts as empty: 0 bytes and tokens. Repeated rows, also of one id with different texts, each give a row of
    their own content. Other columns are not looked at; an empty table gives no rows and appends nothing.
    Two jobs that append the same digest at once store equal counts twice, which reading allows for.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = f.read()
    version = tokenizer_version(model)
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), content_digest(F.col(text_col)).alias("digest")
    )
    rows = written(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "text-digests")
    stored = open_cache(spark, cache_path).where(F.col("tokenizer") == version).select("digest", "n_tokens")
    missing = written(
        rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(stored, "digest", "left_anti"), "missing-digests"
    )
    if not missing.isEmpty():
        carriers = missing.withColumnsRenamed({"digest": "d", "doc_id": "i"})
        texts = keyed.join(carriers, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i"))).select("digest", "text")
        encode_counts(texts, model).withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache_path)
        stored = open_cache(spark, cache_path).where(F.col("tokenizer") == version).select("digest", "n_tokens")
    needed = stored.join(rows.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    counts = written(needed, "token-counts")
    return with_counts(rows, counts).select("doc_id", "n_bytes", "n_tokens")


def fresh_cache(spark: SparkSession) -> str:
    """A new place for a cache in the shared folder."""
    return scratch_path(spark, "reelstat-tables", f"llm-token-cache-{uuid.uuid4().hex}")
