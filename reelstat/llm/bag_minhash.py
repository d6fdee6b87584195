"""Near-duplicate documents by BagMinHash signatures of word-shingle multisets.

A shingle of weight w (how often it occurs) owns the part [0, w) of a weight axis. On the axis lie
Poisson points in time, the same for every text that has the shingle; a point counts if its place is
below w. Each point falls on one of the signature's components, which keeps the earliest
time it gets. Two texts then agree on a component with the probability of their
weighted Jaccard similarity. The axis is divided in doubling blocks
[0, 1), [1, 2), [2, 4), ..., each a process of its own with the block's length as rate, so that a
weight costs its logarithm; and points come in the order of time, so that a shingle stops as soon as
its next point is later than every component of its text.

Equal texts share one signature. Signatures are banded, bucket members verified by
their exact multiset overlap, and links joined to classes (see ``linking``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import docs_of, written
from reelstat.llm.linking import link_classes, shared_buckets, small
from reelstat.llm.shingles import WORDS, counted, mix, occurrences, overlaps, shingles
from reelstat.session import forget

SIMILARITY = 0.8
BANDS = 32
ROWS = 6  # a pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8**6)**32 > 0.9999
# longer keys for members of large buckets: similarity 0.8 shares one with probability 0.999, 0.6 with 0.2, 0.5 with 0.02
FINE_BANDS = 100
FINE_ROWS = 12
CHUNK_BYTES = 2_000_000


def signatures(texts: list[str], size: int = BANDS * ROWS, words: int = WORDS) -> np.ndarray:
    """(texts, size) earliest times; a text without words has infinities."""
    owner, number, weight = counted(*shingles(texts, words))
    times = np.full(len(texts) * size, np.inf)
    # one process per shingle and block of its weight: block 0 is [0, 1), block k is [2**(k-1), 2**k)
    blocks = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    pick = np.repeat(np.arange(len(owner)), blocks)
    block = np.arange(len(pick)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0).astype(np.float64)
    length = np.maximum(begin, 1.0)
    owner, limit = owner[pick], weight[pick].astype(np.float64)
    state = mix(number[pick] + (block.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    clock = np.zeros(len(pick))
    while len(state):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        place = mix(state ^ np.uint64(0xA0761D6478BD642F))
        clock = clock - np.log(((state >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / length
        component = (place % np.uint64(size)).astype(np.int64)
        counts = begin + length * ((place >> np.uint64(32)).astype(np.float64) * 2.0**-32) < limit
        np.minimum.at(times, owner[counts] * size + component[counts], clock[counts])
        latest = times.reshape(-1, size).max(axis=1)
        go_on = clock < latest[owner]
        if not go_on.all():
            owner, limit, begin, length = owner[go_on], limit[go_on], begin[go_on], length[go_on]
            state, clock = state[go_on], clock[go_on]
    return times.reshape(len(texts), size)


def band_keys(times: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(texts, bands) bucket keys, different for each band."""
    bits = times.view(np.uint64).reshape(len(times), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(times), bands)).copy()
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return keys.view(np.int64)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text) > CHUNK_BYTES:
            yield begin, k
            begin, held = k, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def node(text: Column | str = "text") -> Column:
    """What names a text: 128 bits of its digest. Rows of one id with different texts are different nodes."""
    return F.substring(F.unhex(F.sha2(F.col(text) if isinstance(text, str) else text, 256)), 1, 16)


def sign(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, node, size, keys) of each text: its name, number of shingles and band keys (none without words)."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("size", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _chunks(texts):
                owner, _ = shingles(texts[a:b])
                sizes = np.bincount(owner, minlength=b - a)
                keys = band_keys(signatures(texts[a:b], bands * rows), bands, rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.where(sizes > 0, bands, 0)))), pa.int32()),
                    pa.array(keys[sizes > 0].ravel(), pa.int64()),
                )
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(2), pa.array(sizes, pa.int64()), lists], schema=schema
                )

    return docs.select("doc_id", "text", node().alias("node")).mapInArrow(
        run, "doc_id long, node binary, size long, keys array<long>"
    )


def occurrence_tokens(texts: DataFrame) -> DataFrame:
    """(id, token): the numbers of the occurrences of the word shingles of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _chunks(texts):
                owner, number = occurrences(texts[a:b])
                ids = batch.column(0).slice(a, b - a).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([ids, pa.array(number.view(np.int64))], names=["id", "token"])

    return texts.select("node", "text").mapInArrow(run, "id binary, token long")


def overlap(left: Column, right: Column) -> Column:
    """Exact multiset Jaccard similarity of two texts' word shingles."""

    @F.arrow_udf("double")
    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = left.to_pylist(), right.to_pylist()
        out = [overlaps(a[i:j], b[i:j]) for i, j in _chunks([x + y for x, y in zip(a, b)])]
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return compare(left, right)


def classes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, node, class_id, links, kept) of every row of (doc_id, text); see ``near_duplicates``."""
    signed = written(sign(docs), "signatures")
    firsts = written(signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "texts")
    copied = written(firsts.where("copies > 1").select("node", "first", F.lit(True).alias("many")), "copied")
    # one row per text: rows that are not a copy, and of copies those of the least id
    single = signed.join(small(copied), "node", "left").where("many is null or first <=> doc_id")
    rows = single.select(F.explode("keys").alias("h"), F.col("node").alias("id"), "size")
    members = written(shared_buckets(rows).distinct(), "members")  # equal rows give a text's keys more than once
    wanted = written(members.select("id").distinct().join(firsts.select(F.col("node").alias("id"), "first"), "id"), "wanted")
    named = docs.select("doc_id", "text", node().alias("node"))
    mine = (F.col("node") == F.col("id")) & F.col("doc_id").eqNullSafe(F.col("first"))
    texts = written(named.join(small(wanted), mine, "left_semi").dropDuplicates(["node"]).select("node", "text"), "texts")

    def verify(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        scored = pairs.join(a, "a").join(b, "b").select("a", "b", overlap(F.col("text_a"), F.col("text_b")).alias("s"))
        return scored.where(F.col("s") >= SIMILARITY).select("a", "b")

    def of(ids: DataFrame) -> DataFrame:
        return texts.join(small(ids.withColumnRenamed("id", "node")), "node", "left_semi")

    def tokens(ids: DataFrame) -> DataFrame:
        return occurrence_tokens(of(ids))

    def refine(ids: DataFrame) -> DataFrame:
        fine = sign(of(ids).select(F.lit(0).cast("long").alias("doc_id"), "text"), FINE_BANDS, FINE_ROWS)
        return fine.select(F.explode(F.array_distinct("keys")).alias("h"), F.col("node").alias("id"))

    links, classes = link_classes(members, verify, SIMILARITY, tokens=tokens, refine=refine)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degrees = ends.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    placed = firsts.select("node", "first").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = written(placed, "placed")
    # a class is named by its least id; of several texts under that id one stands for it
    heads = placed.groupBy("root").agg(F.min(F.struct("first", "node")).alias("head"))
    of_text = placed.join(heads, "root").join(degrees, "node", "left").select(
        "node", F.col("head.first").alias("class_id"), (F.col("head.node") == F.col("node")).alias("is_head"), F.coalesce("links", F.lit(0)).cast("long").alias("links")
    )
    of_text = written(of_text, "text-classes")
    forget(members, texts, placed)
    return signed.select("doc_id", "node").join(of_text, "node").select(
        "doc_id", "node", "class_id", "links", (F.col("is_head") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), links (verified near copies found) and kept, a row per row of ``docs``.

    Equal texts are one class, and so are texts joined by a chain of links of similarity ``SIMILARITY`` or more.
    A null text counts as empty; empty texts are equal. Rows of one id with different texts are texts of their own. ``kept`` marks
    the rows with the text that stands for its class, one of those under the class's least id; equal rows are marked alike.
    Other columns are not looked at; an empty table gives no rows.
    """
    return classes_of(docs_of(docs, id_col, text_col)).drop("node")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate class, with all their columns.

    The text that stands for a class stays; of equal rows one stays.
    """
    classes = written(classes_of(docs_of(docs, id_col, text_col)).select("doc_id", "node", "kept"), "near-classes")
    gone = written(classes.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("node").alias("gone")).distinct(), "near-copies")
    kept = classes.where("kept").groupBy("doc_id", "node").count().where("count > 1")
    again = written(kept.select(F.col("doc_id").alias("again_id"), F.col("node").alias("again")), "repeated-rows")
    own = node(F.coalesce(F.col(text_col), F.lit("")))
    same = lambda i, n: F.col(id_col).eqNullSafe(F.col(i)) & (own == F.col(n))
    left = docs.join(small(gone), same("gone_id", "gone"), "left_anti")
    if again.isEmpty():
        return left
    repeated = left.join(small(again), same("again_id", "again"), "left_semi").dropDuplicates([id_col, text_col])
    return left.join(small(again), same("again_id", "again"), "left_anti").unionByName(repeated)
