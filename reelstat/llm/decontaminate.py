"""Benchmark decontamination: SimHash fingerprints of item-sized windows, multi-index Hamming search, exact check.

Each benchmark item and each window of a document with as many words as an item has a 64-bit SimHash of its
five-word shingles, weighted by their IDF over all items. A fingerprint is cut into ``BLOCKS`` blocks; of two fingerprints within
``RADIUS`` bits at least one block is within ``RADIUS // BLOCKS`` bits, so an index of all blocks and their
neighbours finds every pair within the radius. Pairs found are kept when their weighted Jaccard similarity is
``SIMILARITY`` or more.

A window's similarity is at most the share of its weight that lies in shingles of any item, so only windows whose
share reaches ``SIMILARITY`` get a fingerprint; that loses nothing. Benchmarks of any size are taken in blocks of
about ``BLOCK_ITEMS`` items, each a pass over the documents with a broadcast index of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import docs_of, written
from reelstat.llm.linking import small
from reelstat.llm.shingles import WORDS, mix, shingles, word_numbers

SIMILARITY = 0.8
BITS = 64
BLOCKS = 5
RADIUS = 19  # 3.4 deviations above the mean distance of two sets of similarity 0.8
BLOCK_ITEMS = 2000
CHUNK_BYTES = 2_000_000
FILTER_BITS = 20

_EDGES = [round(k * BITS / BLOCKS) for k in range(BLOCKS + 1)]


def fingerprints(votes: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the runs of ``size`` shingles from ``begin`` on; votes: (shingles, 64) weighted signs."""
    sums = np.concatenate((np.zeros((1, BITS)), np.cumsum(votes, axis=0)))
    above = (sums[begin + size] - sums[begin]) > 1e-9
    return np.packbits(above, axis=1, bitorder="little").view(np.uint64)[:, 0]


def signs(numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(mix(numbers ^ np.uint64(0x5851F42D4C957F2D)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (bits.astype(np.float64) * 2.0 - 1.0) * weights[:, None]


def block_values(prints: np.ndarray, block: int) -> np.ndarray:
    low, high = _EDGES[block], _EDGES[block + 1]
    return ((prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)).astype(np.int64)


def neighbours(width: int, radius: int) -> np.ndarray:
    """All masks of up to ``radius`` set bits."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)], np.int64)


class HammingIndex:
    """Items by the neighbours of each of their blocks: lists every item within ``RADIUS`` of a fingerprint."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.tables = []
        for block in range(BLOCKS):
            width = _EDGES[block + 1] - _EDGES[block]
            values = block_values(prints, block)[:, None] ^ neighbours(width, RADIUS // BLOCKS)[None, :]
            items = np.repeat(np.arange(len(prints)), values.shape[1])
            order = np.argsort(values.ravel(), kind="stable")
            starts = np.searchsorted(values.ravel()[order], np.arange((1 << width) + 1))
            self.tables.append((starts, items[order].astype(np.int32)))

    def near(self, print_: np.uint64) -> np.ndarray:
        value = np.array([print_], np.uint64)
        found = []
        for block, (starts, items) in enumerate(self.tables):
            v = block_values(value, block)[0]
            found.append(items[starts[v] : starts[v + 1]])
        ids = np.unique(np.concatenate(found))
        return ids[np.bitwise_count(self.prints[ids] ^ print_) <= RADIUS]


class Items:
    """One block of benchmark items whose shingles are ``words`` words long."""

    def __init__(self, words: int, rows: list[tuple[int, int, list[int], list[float]]], unseen: float):
        self.words, self.unseen = words, unseen
        self.ids = [r[0] for r in rows]
        self.sizes = np.array([len(r[2]) for r in rows])
        pairs = [(np.array(r[2], np.int64).view(np.uint64), np.array(r[3])) for r in rows]
        every = np.concatenate([p[0] for p in pairs])
        order = np.argsort(every, kind="stable")
        item = np.repeat(np.arange(len(rows)), self.sizes)[order]
        self.keys, first = np.unique(every[order], return_index=True)
        self.weights = np.concatenate([p[1] for p in pairs])[order][first]
        self.begins = np.concatenate((first, [len(every)]))
        self.items = item
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[(self.keys & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        prints = np.array([fingerprints(signs(n, w), np.array([0]), len(n))[0] for n, w in pairs], np.uint64)
        # windows are compared with items of their own size only
        self.by_size = {
            int(size): (at := np.flatnonzero(self.sizes == size), HammingIndex(prints[at])) for size in np.unique(self.sizes)
        }
        self.bags = [dict(zip(*np.unique(n, return_counts=True))) for n, _ in pairs]
        self.weight_of = dict(zip(self.keys.tolist(), self.weights.tolist()))

    def similarity(self, numbers: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window's shingles and an item's, by multiplicity and weight."""
        bag = self.bags[item]
        common = total = 0.0
        own = dict(zip(*np.unique(numbers, return_counts=True)))
        for number, n in own.items():
            w, m = self.weight_of.get(int(number), self.unseen), bag.get(number, 0)
            common += w * min(n, m)
            total += w * max(n, m)
        total += sum(self.weight_of[int(k)] * m for k, m in bag.items() if k not in own)
        return common / total if total else 0.0

    def matches(self, texts: list[str]) -> Iterator[tuple[int, int, float, int, int]]:
        """(text index, item id, similarity, first word, words) of the most similar window of each text and item."""
        owner, numbers = shingles(texts, self.words)
        maybe = np.flatnonzero(self.seen[(numbers & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, numbers[maybe]), len(self.keys) - 1)
        true = self.keys[at] == numbers[maybe]
        hits, at = maybe[true], at[true]
        if not len(hits):
            return
        cuts = np.flatnonzero(np.diff(owner[hits], prepend=-1))
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        for a, b in zip(cuts, [*cuts[1:], len(hits)]):
            text = int(owner[hits[a]])
            begin, end = bounds[text], bounds[text + 1]
            own = numbers[begin:end]
            weights = np.full(len(own), self.unseen)
            weights[hits[a:b] - begin] = self.weights[at[a:b]]
            known = np.zeros(len(own))
            known[hits[a:b] - begin] = self.weights[at[a:b]]
            whole, known = np.concatenate(([0.0], np.cumsum(weights))), np.concatenate(([0.0], np.cumsum(known)))
            items = np.unique(np.concatenate([self.items[self.begins[k] : self.begins[k + 1]] for k in np.unique(at[a:b])]))
            best: dict[int, tuple[float, int, int]] = {}
            for size in np.unique(self.sizes[items]):
                run = min(int(size), len(own))
                begins = np.arange(len(own) - run + 1)
                share = known[begins + run] - known[begins] >= SIMILARITY * (whole[begins + run] - whole[begins]) - 1e-9
                begins = begins[share]
                if not len(begins):
                    continue
                low, high = begins[0], begins[-1] + run
                prints = fingerprints(signs(own[low:high], weights[low:high]), begins - low, run)
                candidates, index = self.by_size[int(size)]
                for start, print_ in zip(begins, prints):
                    for k in index.near(print_):
                        item = int(candidates[k])
                        similar = self.similarity(own[start : start + run], item)
                        if similar >= SIMILARITY and similar > best.get(item, (0.0,))[0]:
                            best[item] = (similar, int(start), run + self.words - 1)
            for item, (similar, start, length) in best.items():
                yield text, self.ids[item], similar, start, length


def index_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words, numbers, weights): each item's shingles in order and their IDF weights, written."""
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.int64()), ("place", pa.int64()), ("number", pa.int64())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.lower() for t in batch.column(1).to_pylist()]
            owner, numbers = shingles(texts)
            sizes = np.bincount(word_numbers(texts)[1], minlength=len(texts))
            ids = np.array(batch.column(0).cast(pa.int64()).to_pylist(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[owner], pa.int64()), pa.array(np.minimum(sizes, WORDS)[owner], pa.int64()),
                 pa.array(np.arange(len(owner)), pa.int64()), pa.array(numbers.view(np.int64), pa.int64())],
                schema=schema,
            )

    source = docs_of(items, id_col, text_col).dropDuplicates(["doc_id"])
    n = source.count()
    places = written(source.mapInArrow(split, "item_id long, words long, place long, number long"), "item-shingles")
    frequent = places.groupBy("number").agg(F.count_distinct("item_id").alias("df"))
    weighted = places.join(frequent, "number").withColumn("weight", F.log1p(F.lit(float(n)) / F.col("df")))
    ordered = F.array_sort(F.collect_list(F.struct("place", "number", "weight")))  # one item's shingles
    return written(
        weighted.groupBy("item_id", "words")
        .agg(ordered.alias("x"))
        .select("item_id", "words", F.col("x.number").alias("numbers"), F.col("x.weight").alias("weights")),
        "items",
    )


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): each pair of a document and an item found in it, once.

    Letters are compared in lower case, words by white space. The most similar window is given, the first of equals.
    Null or wordless texts and items match nothing; of items that repeat an id any one is taken, of documents that do
    the most similar window. An empty benchmark gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    source = docs_of(docs, id_col, text_col)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]
    )
    ddl = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    indexed = index_items(items, item_id_col, item_text_col)
    n = indexed.count()
    unseen = math.log1p(float(n))

    def scan(groups):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = [Items(words, rows, unseen) for words, rows in groups.value]
            for batch in batches:
                ids = batch.column(0).cast(pa.int64()).to_pylist()
                texts = [t.lower() for t in batch.column(1).to_pylist()]
                rows, begin = [], 0
                while begin < len(texts):
                    end, held = begin, 0
                    while end < len(texts) and (end == begin or held + len(texts[end]) <= CHUNK_BYTES):
                        held += len(texts[end])
                        end += 1
                    for block in blocks:
                        rows += [(ids[begin + t], *found) for t, *found in block.matches(texts[begin:end])]
                    begin = end
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        return source.mapInArrow(run, ddl)

    found = None
    passes = -(-n // BLOCK_ITEMS)
    for k in range(passes):
        block = indexed.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k)
        by_words: dict[int, list] = {}
        for row in block.collect():  # about BLOCK_ITEMS items
            by_words.setdefault(row["words"], []).append((row["item_id"], row["words"], row["numbers"], row["weights"]))
        part = scan(spark.sparkContext.broadcast(sorted(by_words.items())))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], ddl)
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("first"), "n_words")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "m.similarity", (-F.col("m.first")).alias("first_word"), "m.n_words"
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns."""
    found = contaminated(docs, items, id_col, text_col).select(F.col("doc_id").alias("found")).distinct()
    return docs.join(small(written(found, "contaminated")), docs[id_col] == F.col("found"), "left_anti")
