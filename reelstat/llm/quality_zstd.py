"""Quality rules by compression bands, with the base counts of a text.

A text is rejected when the zstandard ratio (raw bytes / compressed bytes) of the whole
document or of any of its fixed chunks leaves the band of its length class. Below
the band a text is close to incompressible (random characters, encoded data);
above it, it repeats itself. Longer inputs compress better, so each length class has limits of its own.

There are two bands. The outer one is fixed and holds for documents and chunks. The inner one comes from the corpus: the ratios of
all its documents are counted in classes of half an octave of length, and a document stays if it is within
``WIDTH`` robust deviations (from the quartiles, which a minority of bad texts does not move) of its class's median. Classes of fewer than
``LEAST_ROWS`` documents have the outer band only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import docs_of, written

CHUNK_BYTES = 8192
LEVEL = 3

# (shorter than so many bytes, least ratio, greatest ratio); prose of any of
# the corpus' languages lies well inside, and the last class has no end
BANDS = (
    (256, 0.20, 2.6),
    (512, 1.10, 2.8),
    (1024, 1.25, 3.0),
    (2048, 1.40, 3.2),
    (4096, 1.60, 3.4),
    (8192, 1.70, 3.6),
    (32768, 1.80, 3.9),
    (float("inf"), 1.80, 4.2),
)

CLASSES = 2  # per doubling of the length
LEAST_ROWS = 100
WIDTH = 5.0
LEAST_DEVIATION = 0.02
BINS = 1_000  # steps of 1 / BINS in which ratios are counted

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("n_bytes", pa.int64()),
        ("ratio", pa.float64()),
        ("chunk_ratio_min", pa.float64()),
        ("chunk_ratio_max", pa.float64()),
        ("verdict", pa.string()),
    ]
)
SPARK_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_bytes long, ratio double, chunk_ratio_min double, chunk_ratio_max double, "
    "verdict string"
)

_words = re.compile(r"[^\x20\x09-\x0D]+").findall
_symbols = re.compile(r"[#*$%&|<>]").findall


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window found at least twice in the text, each word once."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = len(number)
    if size < 2_000_000:
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # three ids no longer fit in one number
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1].astype(np.int64)
        windows = pairs[:-1] * size + ids[2:]
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    often = counts[where] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= often
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = Counter(x for x in text.split("\n") if _words(x))
    return sum(lines.values()) - len(lines)


def band(n_bytes: int, bands=BANDS) -> tuple[float, float]:
    return next((low, high) for below, low, high in bands if n_bytes < below)


def compression(raw: bytes, compressor: zstandard.ZstdCompressor, chunk_bytes: int = CHUNK_BYTES, bands=BANDS):
    """Whole ratio, least and greatest chunk ratio and the verdict of a text's bytes; an empty text has ratio 0.

    The last chunk takes what is left, unless that is under half a chunk: then it joins the one before.
    """
    if not raw:
        return 0.0, 0.0, 0.0, "empty"
    sized = [(len(raw), len(raw) / len(compressor.compress(raw)))]
    cuts = list(range(0, max(1, len(raw) - chunk_bytes // 2 + 1), chunk_bytes)) + [len(raw)]
    if len(cuts) > 2:
        for a, b in zip(cuts, cuts[1:]):
            sized.append((b - a, (b - a) / len(compressor.compress(raw[a:b]))))
    parts = [r for _, r in sized[1:]] or [sized[0][1]]
    verdict = "kept"
    for k, (size, ratio) in enumerate(sized):
        low, high = band(size, bands)
        if ratio < low or ratio > high:
            verdict = ("incompressible" if ratio < low else "repetitive") + ("_chunk" if k else "")
            break
    return sized[0][1], min(parts), max(parts), verdict


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands=BANDS) -> DataFrame:
    """One row per document: the base counts, ratios and ``kept``; ``verdict`` names the band that a text leaves.

    A null text counts as empty: no words, ratio 0, ``base_failed``. Repeated
    rows each give a row; other columns of ``docs`` are not looked at. Texts are taken whole, one at a time.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py()
                words = _words(text)
                n, repeats = len(words), repeated_words(words)
                failed = n < 50 or 100 * repeats > 50 * n
                raw = text.encode()
                ratio, low, high, verdict = compression(raw, compressor, bands=bands)
                rows.append(
                    (n, sum(map(len, words)), len(_symbols(text)), repeated_lines(text), repeats,
                     failed, not failed and verdict == "kept", len(raw), ratio, low, high, verdict)
                )
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), SCHEMA.types[1:])] if rows else [
                pa.array([], t) for t in SCHEMA.types[1:]
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], schema=SCHEMA)

    measured = written(docs_of(docs, id_col, text_col).mapInArrow(judge, SPARK_SCHEMA), "compression")
    limits = corpus_limits(measured)
    inner = measured.withColumn("length", length_class()).join(F.broadcast(limits), "length", "left")  # a row per length class
    verdict = (
        F.when(F.col("verdict") != "kept", F.col("verdict"))
        .when(F.col("ratio") > F.col("high"), F.lit("repetitive_for_corpus"))
        .when(F.col("ratio") < F.col("low"), F.lit("incompressible_for_corpus"))
        .otherwise(F.lit("kept"))
    )
    judged = inner.withColumn("verdict", verdict).withColumn("kept", F.col("kept") & (F.col("verdict") == "kept"))
    return judged.select(*[f.name for f in SCHEMA])


def length_class() -> Column:
    """The class of a length in bytes; null for an empty text."""
    return F.when(F.col("n_bytes") > 0, F.floor(F.log2("n_bytes") * CLASSES).cast("int"))


def corpus_limits(measured: DataFrame) -> DataFrame:
    """(length, low, high) of the length classes with ``LEAST_ROWS`` documents or more.

    Quartiles are read off exact counts of the ratios in steps of 1 / ``BINS``, so that they do not depend on the order of the rows.
    """
    bins = measured.groupBy(length_class().alias("length"), F.floor(F.col("ratio") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = written(bins.where("length is not null"), "ratio-bins")
    up_to = Window.partitionBy("length").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    total = bins.groupBy("length").agg(F.sum("n").alias("total")).where(F.col("total") >= LEAST_ROWS)
    ranked = bins.withColumn("so_far", F.sum("n").over(up_to)).join(total, "length")
    quartile = lambda q: F.min(F.when(F.col("so_far") * 4 >= F.col("total") * q, F.col("bin"))) / BINS
    found = ranked.groupBy("length").agg(quartile(1).alias("q1"), quartile(2).alias("q2"), quartile(3).alias("q3"))
    deviation = F.greatest(F.lit(LEAST_DEVIATION), (F.col("q3") - F.col("q1")) / 1.349)
    return found.select("length", (F.col("q2") - WIDTH * deviation).alias("low"), (F.col("q2") + WIDTH * deviation).alias("high"))
