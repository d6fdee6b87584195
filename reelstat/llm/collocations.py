"""Phrases whose words stand together more often than their parts alone would, per language, by prefix-free parsing.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, and these at spaces and tabs into words. The parse cuts a
text before every trigger, a word whose own bytes say so, one in ``TRIGGER``: what a chunk holds depends on its own words only,
so that passages shared by many documents give the same chunks wherever they stand. A chunk is followed by the up to
``LONGEST - 1`` words of its last piece that come after it; an n-gram belongs to the chunk in whose own part it starts,
so that overlaps are assigned once. The dictionary is the table of distinct chunks with their parse frequencies, and all counting is
done in it: an n-gram of a chunk counts as often as the chunk was parsed.

Counting goes level by level, for a phrase is not more frequent than its parts. Words are counted first, then numbers (64 bits) of the
bigrams of frequent words, then, spelled out, the bigrams whose number is frequent and the trigrams of two such bigrams. The levels are
passed on as Bloom filters of a fixed size, built by Spark from the frequent entries; what one lets through by
mistake is counted exactly and drops out then. So nothing that grows with the corpus passes through the driver or is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import written
from reelstat.llm.filters import Filter, build_filter
from reelstat.llm.shingles import mix
from reelstat.llm.spans import byte_set, byte_sizes, joined, parts, slices, word_bounds, word_numbers

LONGEST = 3
LEAST = 10  # a candidate's least frequency
TOP = 2_000  # phrases reported per language
TRIGGER = 32  # words of a chunk on average
ABSORBED = 50  # percent of a phrase's occurrences that lie in one longer candidate drop it
SCALE = 1_000_000
BATCH_BYTES = 2_000_000

SPACE, BREAK, OVERLAP = 0x20, 0x0A, 0x09  # within chunks: between words, between pieces, before the following words
_BREAKS = byte_set((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
_APART = _BREAKS | byte_set((0x20, 0x20), (0x09, 0x09))


def chunks_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(chunks, text of each): words divided by a space, pieces by a line feed, a tab before the following words."""
    raw, text_ends = joined(texts)
    starts, ends = word_bounds(raw, _APART)
    if not len(starts):
        return pa.array([], pa.string()), np.empty(0, np.int64)
    owner = np.searchsorted(text_ends, starts, side="right")
    piece = np.searchsorted(np.flatnonzero(_BREAKS[raw]), starts)  # a line feed ends every text, so a piece is in one text
    # the same words with one separator after each
    kept = ~_APART[raw]
    kept[ends] = True
    clean = raw[kept]
    to = np.cumsum(ends - starts + 1)
    clean[to - 1] = np.where(np.append(piece[1:] != piece[:-1], True), BREAK, SPACE)
    first = np.flatnonzero(triggers(raw, starts, ends) | np.diff(owner, prepend=-1).astype(bool))  # first word of each chunk
    after = np.append(first[1:], len(starts))  # first word that is no longer its own
    follow = after.copy()
    for _ in range(LONGEST - 1):
        more = follow < len(starts)
        more[more] = piece[follow[more]] == piece[after[more] - 1]
        follow += more
    a, b, e = to[first] - (ends - starts + 1)[first], to[after - 1], to[follow - 1]
    until = np.where(follow > after, e, b) - 1  # without the separator at the end
    whole = clean.tobytes()
    data = np.frombuffer(bytearray().join([whole[x:y] for x, y in zip(a.tolist(), until.tolist())]), np.uint8)
    offsets = np.concatenate(([0], np.cumsum(until - a)))
    data[(offsets[:-1] + (b - 1 - a))[follow > after]] = OVERLAP
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)), owner[first]


def triggers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words start a chunk: one of ``TRIGGER`` of the numbers that a word's length and five of its bytes give."""
    size = ends - starts
    number = size.astype(np.uint64)
    for quarter in range(5):
        number = (number << np.uint64(8)) | raw[starts + (size - 1) * quarter // 4]
    return mix(number) % np.uint64(TRIGGER) == 0


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The dictionary (lang, chunk, times): distinct chunks of all texts and how often each was parsed, written."""
    schema = pa.schema([("lang", pa.string()), ("chunk", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in parts(byte_sizes(batch.column(1)), BATCH_BYTES):
                chunks, owner = chunks_of(batch.column(1).slice(x, y - x))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x).take(pa.array(owner)), chunks], schema=schema)

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = rows.where("text <> ''").mapInArrow(run, "lang string, chunk string")
    return written(chunks.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("times")), "chunks")


class Grams:
    """The words of a batch of dictionary rows, and which n-grams start at each."""

    def __init__(self, langs: list[str], chunks: pa.Array, times: np.ndarray):
        raw, ends = joined(chunks)
        self.starts, self.ends = word_bounds(raw, _APART)
        self.chunk = np.searchsorted(ends, self.starts, side="right")
        self.times = times[self.chunk]
        self.piece = np.searchsorted(np.flatnonzero(raw == BREAK), self.starts)
        tab = np.flatnonzero(raw == OVERLAP)
        cut = ends.copy()  # where the own part of each chunk ends; it has one tab at most
        cut[np.searchsorted(ends, tab, side="right")] = tab
        self.own = self.starts < cut[self.chunk]
        names, of_rows = np.unique(np.array(langs, object), return_inverse=True)
        raw[raw == OVERLAP] = SPACE
        self.raw, self.names, self.lang = raw, names, of_rows[self.chunk]
        salts = mix(word_numbers(*_flat([n.encode("utf-8", "surrogatepass") for n in names])) + np.uint64(1))  # no word's number
        self.numbers = mix(word_numbers(raw, self.starts, self.ends) + salts[self.lang])

    def at(self, n: int) -> np.ndarray:
        """First words of the n-grams that belong to their chunk."""
        i = np.flatnonzero(self.own)
        i = i[i + n <= len(self.starts)]
        return i[self.piece[i] == self.piece[i + n - 1]]

    def pair_numbers(self, i: np.ndarray) -> np.ndarray:
        """A number for each bigram of a language."""
        return mix(self.numbers[i] * np.uint64(0x9E3779B97F4A7C15) + self.numbers[i + 1])

    def spelled(self, i: np.ndarray, n: int, key: np.ndarray) -> pa.RecordBatch:
        """(lang, n, phrase, f) of the n-grams that start at words ``i``, equal ``key`` summed."""
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        f = np.zeros(len(first), np.int64)
        np.add.at(f, back, self.times[i])
        one = i[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.names, pa.string()).take(pa.array(self.lang[one])), pa.array(np.full(len(one), n, np.int32)),
             slices(self.raw, self.starts[one], self.ends[one + n - 1]), pa.array(f)],
            schema=SPELLED,
        )


SPELLED = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(w) for w in words])
    return np.frombuffer(b"".join(words) + b"\n", np.uint8), np.concatenate(([0], ends[:-1])).astype(np.int64), ends


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    for batch in batches:
        lang, chunk, times = (batch.column(c) for c in ("lang", "chunk", "times"))
        for a, b in parts(byte_sizes(chunk), BATCH_BYTES):
            yield Grams(lang.slice(a, b - a).to_pylist(), chunk.slice(a, b - a), times.slice(a, b - a).to_numpy())


def count_phrases(dictionary: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, n) of all word occurrences, (lang, n, phrase, f) of the phrases of up to three words with f >= ``least``), written."""
    spark = dictionary.sparkSession

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _grams(batches):
            i = np.flatnonzero(g.own)
            yield g.spelled(i, 1, g.numbers[i])

    schema = "lang string, n int, phrase string, f long"
    counted = written(dictionary.mapInArrow(words, schema).groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f")), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("total"))
    frequent = counted.where(F.col("f") >= least)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = Grams(batch.column(0).to_pylist(), batch.column(1), np.ones(batch.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(g.numbers.view(np.int64))], names=["number"])

    common = spark.sparkContext.broadcast(build_filter(frequent.select("lang", "phrase").mapInArrow(numbered, "number long")))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Filter(common.value)
        for g in _grams(batches):
            held = words.holds(g.numbers)
            i = g.at(2)
            i = i[held[i] & held[i + 1]]
            numbers, back = np.unique(g.pair_numbers(i), return_inverse=True)
            f = np.zeros(len(numbers), np.int64)
            np.add.at(f, back, g.times[i])
            yield pa.RecordBatch.from_arrays([pa.array(numbers.view(np.int64)), pa.array(f)], names=["number", "f"])

    often = dictionary.mapInArrow(pairs, "number long, f long").groupBy("number").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    paired = spark.sparkContext.broadcast(build_filter(often.select("number")))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bigrams, words = Filter(paired.value), Filter(common.value)
        for g in _grams(batches):
            follows = np.flatnonzero(g.piece[1:] == g.piece[:-1])
            follows = follows[words.holds(g.numbers[follows])]
            number = g.pair_numbers(follows)
            kept = bigrams.holds(number)
            follows, number = follows[kept], number[kept]
            of_word = np.zeros(len(g.starts) + 1, np.uint64)
            of_word[follows] = number
            starts = np.zeros(len(g.starts) + 1, bool)
            starts[follows] = True
            i = follows[g.own[follows]]
            yield g.spelled(i, 2, of_word[i])
            i = i[starts[i + 1]]
            yield g.spelled(i, 3, mix(of_word[i] * np.uint64(0xD6E8FEB86659FD93) + of_word[i + 1]))

    spelled = dictionary.mapInArrow(phrases, schema).groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
    kept = written(spelled.where(F.col("f") >= least).unionByName(frequent), "phrases")
    common.destroy()
    paired.destroy()
    return totals, kept


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words.

    a is the phrase's frequency, l and r those of its two parts at the cut with the lowest
    score floor(10**6 * a * a / (l * r)), ties to the earlier cut, n the language's words. A phrase is left out if a longer candidate
    that contains it has at least half of its occurrences. Order: score and a descending, phrase ascending by its bytes.
    A null text is empty, a null language ``und``. Repeated rows each count; other columns are not looked at; a corpus
    without a frequent phrase, or without rows, gives no rows.
    """
    totals, counts = count_phrases(parse(docs, text_col, lang_col), least)
    words = F.split("phrase", " ")
    found = counts.where("n > 1").select("lang", F.col("n").alias("size"), "phrase", F.col("f").alias("a"), words.alias("w"))
    # a phrase of k words has k - 1 cuts, each with a left and a right part
    cut = found.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    part = counts.select("lang", "phrase", "f")
    sided = cut.join(part.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"])
    sided = sided.join(part.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"])
    # exact: frequencies below 10**15, so that products have at most 38 digits
    score = F.expr(f"(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast({SCALE} as decimal(7,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    scored = sided.withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "size")).alias("x")).select("lang", "phrase", "x.*")
    inside = found.where("size = 3").select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.array(*[F.array_join(F.slice("w", F.lit(s), F.lit(2)), " ") for s in (1, 2)])).alias("phrase"),
    )
    absorbed = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = lowest.join(absorbed, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * ABSORBED)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
