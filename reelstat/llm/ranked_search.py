"""Top documents per query by integer BM25 scores, exact, with MaxScore bounds over term pairs.

The index is partitioned by documents: a block holds some thousand of them with the postings of all query terms, each
posting with its impact (what the term adds to the document's score, before its weight). Blocks also hold, for pairs
of terms that stand in one query, the intersection list of the pair: the documents with both terms, and the greatest joint
impact of any of them. Blocks and lists are computed once and written.

A query is evaluated block by block. A document's score is at most the sum of its terms' greatest impacts (MaxScore); a pair
tightens this, since a document has both terms, then the joint maximum bounds it, or one of them. Terms are paired off, and pairs and
single terms whose bounds together stay below the threshold are not looked up to find documents (``plan``); of some
pairs only the intersection list is. What is found is then scored exactly, from the greatest bound to the least,
and dropped as soon as its bound is below the threshold. The threshold is the 10th best joint score of any of the query's
lists over the whole corpus, a lower bound of its 10th best score, and in each task the 10th best score so far if that is more.
Skipping is only done strictly below the threshold, so that ties and their order are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import written
from reelstat.llm.spans import byte_set, byte_sizes, joined, parts, word_bounds, word_numbers

TOP = 10
ITEM_BYTES = 4_000_000  # queries are taken in groups of so many bytes of text; each group is one run over the corpus
BATCH_BYTES = 4_000_000
BLOCK_POSTINGS = 500_000  # a block ends with the document that reaches so many postings
PAIR_SHARE = 16  # a pair has a list if its rarer term is in at most this fraction of the documents; else its bound is the sum
MERGE_WAYS = 256
NO_ID = -(1 << 63)  # stands for a null id inside blocks; it comes first among equal scores

_APART = ~byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Queries:
    """A group of queries: the numbers of all their terms in order, and each query's terms as places in them."""

    items: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]

    @staticmethod
    def of(rows: list) -> Queries:
        items, numbers = [], []
        for item, text in rows:
            raw, _ = joined(pa.array([text], pa.string()))
            items.append(item)
            numbers.append(np.unique(word_numbers(raw, *word_bounds(raw, _APART))))
        vocabulary = np.unique(np.concatenate([*numbers, np.empty(0, np.uint64)]))
        return Queries(items, vocabulary, [np.searchsorted(vocabulary, n) for n in numbers])


@dataclass
class Weights:
    """What the whole corpus says: the numbers of documents and terms, and the weight and frequency of each term."""

    documents: int
    length: int
    weight: np.ndarray
    df: np.ndarray

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 10 + (90 * n * self.documents) // max(self.length, 1)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def pair_off(queries: Queries, w: Weights) -> tuple[np.ndarray, list[list[tuple[int, ...]]]]:
    """(pairs with a list, each query's groups): a query's terms by falling weight, two and two.

    A group is (term,), (term, term) without a list, or (term, term, number of the pair).
    """
    numbers: dict[tuple[int, int], int] = {}
    groups = []
    for terms in queries.terms:
        there = terms[w.df[terms] > 0]
        order = there[np.lexsort((there, -w.weight[there]))].tolist()
        mine: list[tuple[int, ...]] = []
        for a, b in zip(order[0::2], order[1::2]):
            a, b = min(a, b), max(a, b)
            if min(w.df[a], w.df[b]) * PAIR_SHARE <= w.documents:
                mine.append((a, b, numbers.setdefault((a, b), len(numbers))))
            else:
                mine.append((a, b))
        groups.append(mine + [(t,) for t in order[len(order) // 2 * 2 :]])
    return np.array(list(numbers), np.int64).reshape(-1, 2), groups


# ---- blocks ---------------------------------------------------------------------

BLOCK = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
     ("places", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64())), ("documents", pa.int64()), ("length", pa.int64())]
)
BLOCK_SQL = "doc_ids array<long>, n array<long>, terms array<int>, counts array<int>, places array<int>, tf array<long>, documents long, length long"


def _row(schema: pa.Schema, *values) -> pa.RecordBatch:
    """One row; arrays become list values."""
    columns = []
    for value, field in zip(values, schema):
        if pa.types.is_list(field.type):
            flat = pa.array(np.ascontiguousarray(value), field.type.value_type)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        else:
            columns.append(pa.array([int(value)], field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _blocked(held: list, documents: int, length: int) -> pa.RecordBatch:
    ids, n, place, term, tf = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((place, term))
    terms, counts = np.unique(term, return_counts=True)
    return _row(BLOCK, ids, n, terms, counts, place[order], tf[order], documents, length)


def index_blocks(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Blocks of documents with the postings (place in the block, occurrences) of the terms in ``vocabulary``, written.

    ``documents`` and ``length`` count all documents with a term and all their terms, also those without a query term.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held, size, taken, documents, length = [], 0, 0, 0, 0
        for batch in batches:
            column = batch.column(1)
            for a, b in parts(byte_sizes(column), BATCH_BYTES):
                raw, ends = joined(column.slice(a, b - a))
                starts, stops = word_bounds(raw, _APART)
                owner = np.searchsorted(ends, starts, side="right")
                n = np.bincount(owner, minlength=b - a)
                documents, length = documents + int((n > 0).sum()), length + len(starts)
                number = word_numbers(raw, starts, stops)
                at = np.minimum(np.searchsorted(known, number), max(len(known) - 1, 0))
                hit = known[at] == number if len(known) else np.zeros(len(number), bool)
                keys, tf = np.unique(owner[hit] * len(known) + at[hit], return_counts=True)
                mine, term = np.divmod(keys, max(len(known), 1))
                kept, place = np.unique(mine, return_inverse=True)
                ids = batch.column(0).slice(a, b - a).take(pa.array(kept)).to_numpy(zero_copy_only=False).astype(np.int64)
                held.append((ids, n[kept], place + taken, term, tf))
                size, taken = size + len(keys), taken + len(kept)
                if size >= BLOCK_POSTINGS:
                    yield _blocked(held, documents, length)
                    held, size, taken, documents, length = [], 0, 0, 0, 0
        if documents:
            yield _blocked(held, documents, length)

    return written(docs.mapInArrow(run, BLOCK_SQL), "index-blocks")


def corpus_weights(blocks: DataFrame, size: int) -> Weights:
    """Weights of the ``size`` terms of the vocabulary: one number per term reaches the driver."""
    sums = blocks.agg(F.sum("documents").alias("d"), F.sum("length").alias("l")).first()
    n = sums["d"] or 0
    df = np.zeros(size, np.int64)
    found = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df"))
    for row in found.toLocalIterator():
        df[row["terms"]] = row["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    return Weights(n, sums["l"] or 0, weight, df)


IMPACTS = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())),
     ("impacts", pa.list_(pa.int32())), ("greatest", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int32())), ("met", pa.list_(pa.int32())),
     ("pair_places", pa.list_(pa.int32())), ("joint", pa.list_(pa.int64())), ("joint_greatest", pa.list_(pa.int64()))]
)
IMPACTS_SQL = (
    "doc_ids array<long>, terms array<int>, counts array<int>, places array<int>, impacts array<int>, greatest array<int>, "
    "pairs array<int>, met array<int>, pair_places array<int>, joint array<long>, joint_greatest array<long>"
)


def _cut(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def pair_lists(blocks: DataFrame, w: Weights, pairs: np.ndarray) -> DataFrame:
    """Blocks with impacts in place of occurrences, and with the intersection lists of ``pairs``, written.

    A list has its documents' places, their joint weighted impacts and the greatest of these.
    """
    shared = blocks.sparkSession.sparkContext.broadcast((w, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, pairs = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                ids, n, terms, counts, places, tf = (batch.column(c)[k].values.to_numpy() for c in range(6))
                impacts = w.impacts(tf, n[places])
                cut = _cut(counts)
                greatest = np.maximum.reduceat(impacts, cut[:-1]) if len(terms) else impacts
                slot = np.full(len(w.weight), -1, np.int64)
                slot[terms] = np.arange(len(terms))
                here = np.flatnonzero((slot[pairs] >= 0).all(axis=1))
                found, met, lists, joints, best = [], [], [], [], []
                for p in here.tolist():
                    a, b = pairs[p]
                    x, y = slot[a], slot[b]
                    if counts[x] > counts[y]:
                        a, b, x, y = b, a, y, x
                    short, long_ = places[cut[x] : cut[x + 1]], places[cut[y] : cut[y + 1]]
                    at = np.minimum(np.searchsorted(long_, short), len(long_) - 1)
                    both = np.flatnonzero(long_[at] == short)
                    if len(both):
                        joint = w.weight[a] * impacts[cut[x] + both] + w.weight[b] * impacts[cut[y] + at[both]]
                        found.append(p), met.append(len(both)), lists.append(short[both]), joints.append(joint), best.append(joint.max())
                none = [np.empty(0, np.int64)]
                yield _row(IMPACTS, ids, terms, counts, places, impacts, greatest, found, met, np.concatenate(lists or none),
                           np.concatenate(joints or none), best)

    return written(blocks.mapInArrow(run, IMPACTS_SQL), "index-impacts")


def _best(scores: np.ndarray, top: int) -> np.ndarray:
    return -np.sort(-(np.partition(scores, len(scores) - top)[-top:] if len(scores) > top else scores))


def thresholds(index: DataFrame, w: Weights, groups: list, top: int) -> np.ndarray:
    """For each query the greatest ``top``-th best score of any of its pairs' lists or single terms over all blocks, else 0.

    Tasks give the best ``top`` of each list they meet; a row per list reaches the driver.
    """
    shared = index.sparkSession.sparkContext.broadcast(w.weight)
    schema = pa.schema([("is_pair", pa.bool_()), ("key", pa.int32()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        best: dict[tuple[bool, int], np.ndarray] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                terms, counts, impacts, pairs, met, joint = (batch.column(c)[k].values.to_numpy() for c in range(6))
                lists = [(False, terms, _cut(counts), impacts), (True, pairs, _cut(met), joint)]
                for is_pair, keys, cut, scores in lists:
                    for key, a, b in zip(keys.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                        mine = _best(scores[a:b] if is_pair else scores[a:b] * weight[key], top)
                        before = best.get((is_pair, key))
                        best[is_pair, key] = mine if before is None else _best(np.concatenate((before, mine)), top)
        sizes = [len(v) for v in best.values()]
        keys = [k for k, n in zip(best, sizes) for _ in range(n)]
        scores = np.concatenate([*best.values(), np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.int32()), pa.array(scores, pa.int64())], schema=schema)

    found = index.select("terms", "counts", "impacts", "pairs", "met", "joint").mapInArrow(run, "is_pair boolean, key int, score long")
    order = Window.partitionBy("is_pair", "key").orderBy(F.desc("score"))
    last = found.withColumn("r", F.row_number().over(order)).where(F.col("r") == top).select("is_pair", "key", "score")
    known = {(r["is_pair"], r["key"]): r["score"] for r in last.toLocalIterator()}
    out = np.zeros(len(groups), np.int64)
    for q, mine in enumerate(groups):
        for group in mine:
            out[q] = max([out[q], *(known.get((False, t), 0) for t in group[:2]), known.get((True, group[2]), 0) if len(group) == 3 else 0])
    return out


# ---- evaluation -------------------------------------------------------------------


class Block:
    """One row of the index."""

    def __init__(self, columns: list[np.ndarray], w: Weights):
        self.ids, terms, counts, self.places, self.impacts, greatest, pairs, met, self.pair_places, self.joint, joint_greatest = columns
        cut, pair_cut = _cut(counts), _cut(met)
        self.of_term = {t: (a, b) for t, a, b in zip(terms.tolist(), cut[:-1].tolist(), cut[1:].tolist())}
        self.of_pair = {p: (a, b) for p, a, b in zip(pairs.tolist(), pair_cut[:-1].tolist(), pair_cut[1:].tolist())}
        self.bound = dict(zip(terms.tolist(), (greatest * w.weight[terms]).tolist()))
        self.pair_bound = dict(zip(pairs.tolist(), joint_greatest.tolist()))

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.of_term[term]
        return self.places[a:b], self.impacts[a:b]


def plan(groups: list[tuple[int, ...]], block: Block, threshold: int, use_pairs: bool = True) -> tuple[list, list[np.ndarray]]:
    """((bound, terms) of each group by falling bound, the lists whose documents are to be scored).

    A document that stands in none of the lists reaches at most the bounds that were set aside: the full bound of a
    group that is not looked up at all, the bound of one term of a pair of which only the intersection is. Their sum stays below
    ``threshold``.
    """
    bounds = []
    for group in groups:
        here = [t for t in group[:2] if t in block.bound]
        if not here:
            continue
        single, total = max(block.bound[t] for t in here), sum(block.bound[t] for t in here)
        if use_pairs and len(group) == 3 and len(here) == 2:
            joint = block.pair_bound.get(group[2], 0)
            bounds.append((max(single, joint), single, here, group[2]))
        else:
            bounds.append((total, None, here, None))
    bounds.sort(key=lambda x: x[0])
    aside, lists = 0, []
    for bound, single, here, pair in bounds:
        if aside + bound < threshold:
            aside += bound
        elif pair is not None and aside + single < threshold:
            aside += single
            if pair in block.of_pair:
                a, b = block.of_pair[pair]
                lists.append(block.pair_places[a:b])
        else:
            lists.extend(block.postings(t)[0] for t in here)
    return [(bound, here) for bound, _, here, _ in reversed(bounds)], lists


def evaluate(groups: list, block: Block, weight: np.ndarray, threshold: int, use_pairs: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores) of all documents of the block that score ``threshold`` or more, and how many were looked at."""
    order, lists = plan(groups, block, threshold, use_pairs)
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    flags = np.zeros(len(block.ids), bool)
    for places in lists:
        flags[places] = True
    found = np.flatnonzero(flags)
    looked_at = len(found)
    scores = np.zeros(looked_at, np.int64)
    left = sum(bound for bound, _ in order)
    for bound, here in order:
        for term in here:
            places, impacts = block.postings(term)
            if len(places) < len(found):
                at = np.minimum(np.searchsorted(found, places), len(found) - 1)
                hit = found[at] == places
                scores[at[hit]] += impacts[hit] * weight[term]
            elif len(found):
                at = np.minimum(np.searchsorted(places, found), len(places) - 1)
                hit = places[at] == found
                scores[hit] += impacts[at[hit]] * weight[term]
        left -= bound
        alive = scores + left >= threshold
        if not alive.all():
            found, scores = found[alive], scores[alive]
    return found, scores, looked_at


def search_blocks(index: DataFrame, w: Weights, groups: list, floor: np.ndarray, top: int) -> DataFrame:
    """(query, doc_id, score): of each task at least its documents among each query's ``top``."""
    shared = index.sparkSession.sparkContext.broadcast((w, groups, floor))
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, groups, floor = shared.value
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        best = [none] * len(groups)
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block([batch.column(c)[k].values.to_numpy() for c in range(len(IMPACTS))], w)
                for q, mine in enumerate(groups):
                    ids, scores = best[q]
                    threshold = max(int(floor[q]), int(scores[-1]) if len(scores) >= top else 0, 1)
                    found, reached, _ = evaluate(mine, block, w.weight, threshold)
                    if len(found):
                        ids, scores = np.concatenate((ids, block.ids[found])), np.concatenate((scores, reached))
                        order = np.lexsort((ids, -scores))[:top]
                        best[q] = ids[order], scores[order]
        sizes = [len(s) for _, s in best]
        columns = [np.repeat(np.arange(len(best), dtype=np.int32), sizes), *(np.concatenate([*x, none[0]]) for x in zip(*best))]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return index.mapInArrow(run, "query int, doc_id long, score long")


def _groups_of(items: DataFrame) -> Iterator[list]:
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1])
        if size >= ITEM_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each query's ``top`` documents with a score above 0, ties by ascending doc_id.

    A null text has no terms; such a document is not counted and never found, such an item gives no rows. Rows of ``docs`` that
    repeat an id are documents of their own and can each be ranked. Rows of ``items`` that are equal are one query; different
    texts under one item_id are queries of their own, each with its ranks. Other columns are not looked at. An empty table on either
    side gives no rows. Items are taken in groups of ``ITEM_BYTES`` of text, each searched over all documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("text <> ''")
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null").distinct().orderBy("item_id", "text")
    item_type = items.schema[item_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    for group in _groups_of(wanted):
        queries = Queries.of(group)
        blocks = index_blocks(rows, queries.vocabulary)
        w = corpus_weights(blocks, len(queries.vocabulary))
        pairs, groups = pair_off(queries, w)
        index = pair_lists(blocks, w, pairs)
        found = search_blocks(index, w, groups, thresholds(index, w, groups, top), top)
        # tasks' results are merged in two steps, so that no task sorts those of all others
        best = [F.desc("score"), "doc_id"]
        some = Window.partitionBy("query", "way").orderBy(*best)
        ways = found.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS))).withColumn("r", F.row_number().over(some))
        ranked = ways.where(F.col("r") <= top).drop("r").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best)))
        names = spark.createDataFrame([(q, item) for q, item in enumerate(queries.items)], f"query int, item_id {item_type}")
        # as many names as queries in the group, which is bounded by its bytes
        named = ranked.where(F.col("rank") <= top).join(F.broadcast(names), "query").select(
            "item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score"
        )
        out = out.unionByName(written(named, "ranked"))
    return out
