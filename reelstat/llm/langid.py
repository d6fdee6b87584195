"""Language identification by interpolated Kneser-Ney character models.

One model per language, learned from a bounded sample of labelled documents.
Its tables are sorted arrays of n-gram hashes with a value per language, looked up
by binary search: for the n-grams of the highest order seen in training the whole
interpolated log-probability; for the shorter contexts their backoff
weights, so that unseen n-grams are evaluated order by order down to a uniform
share. A text gets the language of the lowest cross-entropy per character. It
is rejected when it has no letter or when that cross-entropy is above what held-back
training texts of its language reach (mean plus ``REJECT_SIGMAS`` deviations, wider for short texts).
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import docs_of

ORDER = 4
DISCOUNT_FLOOR = 0.05
# bound of the training sample: this many whole documents per language, about this many characters in all
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 12_000_000
LEAST_CHARS = 1_000  # of a language, however many there are
CALIBRATION_SHARE = 5  # every so many-th sampled document is held back for the rejection limit
REJECT_SIGMAS = 8.0
LEAST_DEVIATION = 0.15  # bits per character; keeps the limit clear of rare but clean prose
NO_LANGUAGE = "und"
BATCH_CHARS = 400_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def characters(text: str) -> np.ndarray:
    """Lower-cased letters as code points, each run of anything else one space; empty without a letter.

    ``ORDER - 1`` spaces stand before the text, so that its first character has a whole context, and one after it.
    """
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[raw]
    if not letter.any():
        return np.empty(0, np.uint32)
    chars = np.where(letter, raw, np.uint32(32))
    chars = np.concatenate(([np.uint32(32)], chars, [np.uint32(32)]))
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32)
    return np.concatenate((np.full(ORDER - 2, 32, np.uint32), chars[keep]))


def gram_keys(chars: np.ndarray, order: int) -> np.ndarray:
    """A hash for the ``order`` characters that end at each position from ``order - 1`` on."""
    n = len(chars) - order + 1
    key = np.full(max(n, 0), order, np.uint64)
    for k in range(order):
        key = (key ^ chars[k : k + n].astype(np.uint64)) * _MIX[k]
        key ^= key >> np.uint64(29)
    return key


@dataclass
class Models:
    languages: list[str]
    order: int
    keys: list[np.ndarray]  # by order: sorted hashes of the n-grams of any language
    logp: list[np.ndarray]  # by order: (n-grams, languages) interpolated log2 p(last | those before)
    context_keys: list[np.ndarray]  # by order of the context plus one
    backoff: list[np.ndarray]  # log2 of the share a context leaves to the shorter one
    limit: np.ndarray  # (languages, 2): mean and deviation of the cross-entropy of held-back texts
    floor: float

    def _find(self, table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
        return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)

    def log_probs(self, chars: np.ndarray) -> np.ndarray:
        """(positions, languages): log2 p of each character from the ``order - 1`` before it."""
        kinds, first, back = np.unique(gram_keys(chars, self.order), return_index=True, return_inverse=True)
        at, hit = self._find(self.keys[self.order], kinds)
        values = np.zeros((len(kinds), len(self.languages)), np.float32)
        values[hit] = self.logp[self.order][at[hit]]
        if not hit.all():
            offsets = first[~hit]
            values[~hit] = self._backed_off(np.stack([chars[offsets + k] for k in range(self.order)], axis=1))
        return values[back]

    def _lookup(self, grams: np.ndarray) -> np.ndarray:
        size = grams.shape[1]
        if size == 0:
            return np.full((len(grams), len(self.languages)), self.floor, np.float32)
        keys = _row_keys(grams)
        at, hit = self._find(self.keys[size], keys)
        values = np.zeros((len(grams), len(self.languages)), np.float32)
        values[hit] = self.logp[size][at[hit]]
        if not hit.all():
            values[~hit] = self._backed_off(grams[~hit])
        return values

    def _backed_off(self, grams: np.ndarray) -> np.ndarray:
        size = grams.shape[1]
        values = self._lookup(grams[:, 1:])
        if size > 1:
            at, hit = self._find(self.context_keys[size], _row_keys(grams[:, :-1]))
            values[hit] += self.backoff[size][at[hit]]
        else:
            values += self.backoff[1][0]
        return values

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): bits per character; texts without a letter get infinity."""
        out = np.full((len(texts), len(self.languages)), np.inf)
        group, held = [], 0
        for k, chars in enumerate(texts):
            if len(chars) > 1:
                group.append(k)
                held += len(chars)
            if group and (held >= BATCH_CHARS or k == len(texts) - 1):
                joined = np.concatenate([texts[i] for i in group])
                logp = self.log_probs(joined)
                ends = np.cumsum([len(texts[i]) for i in group])
                for i, end in zip(group, ends):
                    begin = end - len(texts[i])
                    out[i] = -logp[begin : end - self.order + 1].mean(axis=0, dtype=np.float64)
                group, held = [], 0
        return out

    def judge(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language (-1: no letter), its score, its bits per character and whether it is rejected."""
        bits = self.entropies(texts)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(texts)), best] if len(texts) else np.empty(0)
        sizes = np.array([len(x) for x in texts], float)
        none = ~np.isfinite(least)
        with np.errstate(invalid="ignore", over="ignore"):
            share = np.exp2(-(bits - least[:, None]) * np.minimum(sizes, 200.0)[:, None])
            score = np.where(none, 0.0, 1.0 / np.where(none, 1.0, share.sum(axis=1)))
        mean, deviation = self.limit[best, 0], self.limit[best, 1]
        allowed = mean + REJECT_SIGMAS * deviation * np.maximum(1.0, np.sqrt(500.0 / np.maximum(sizes, 1.0)))
        return np.where(none, -1, best), score, least, none | (least > allowed)

    def judge_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``judge`` of every text (null: empty), with the characters of about ``BATCH_CHARS`` at a time in memory."""
        parts, group, held = [], [], 0
        for text in texts:
            group.append(characters(text.as_py() or ""))
            held += len(group[-1])
            if held >= BATCH_CHARS:
                parts.append(self.judge(group))
                group, held = [], 0
        if group or not parts:
            parts.append(self.judge(group))
        return tuple(np.concatenate(x) for x in zip(*parts))


def _row_keys(grams: np.ndarray) -> np.ndarray:
    size = grams.shape[1]
    key = np.full(len(grams), size, np.uint64)
    for k in range(size):
        key = (key ^ grams[:, k].astype(np.uint64)) * _MIX[k]
        key ^= key >> np.uint64(29)
    return key


def _kinds(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows in the order of their hashes, and how often each occurs."""
    _, first, counts = np.unique(_row_keys(grams), return_index=True, return_counts=True)
    return grams[first], counts


def fit(samples: dict[str, list[str]], order: int = ORDER) -> Models:
    """Interpolated Kneser-Ney with one discount per order, estimated from n1 / (n1 + 2 n2)."""
    languages = sorted(samples)
    texts = {lang: [c for t in samples[lang] if len(c := characters(t)) > 1] for lang in languages}
    learn = {lang: [c for k, c in enumerate(v) if len(v) < 10 or k % CALIBRATION_SHARE] for lang, v in texts.items()}
    alphabet = len(np.unique(np.concatenate([c for v in learn.values() for c in v]))) + 1
    floor = -math.log2(alphabet)
    grams: list[list[np.ndarray]] = [[] for _ in range(order + 1)]
    counts: list[list[np.ndarray]] = [[] for _ in range(order + 1)]
    for lang in languages:
        top = [np.stack([c[k : len(c) - order + 1 + k] for k in range(order)], 1) for c in learn[lang] if len(c) >= order]
        g, n = _kinds(np.concatenate(top) if top else np.empty((0, order), np.uint32))
        grams[order].append(g)
        counts[order].append(n)
        for size in range(order - 1, 0, -1):  # continuation counts: in how many kinds does what follows the first character end
            g, n = _kinds(g[:, 1:])
            grams[size].append(g)
            counts[size].append(n)
    width = len(languages)
    keys, logp, context_keys, backoff = [[np.empty(0, np.uint64)] * (order + 1) for _ in range(4)]
    models = Models(languages, order, keys, logp, context_keys, backoff, np.zeros((width, 2)), floor)
    for size in range(1, order + 1):
        union = _kinds(np.concatenate(grams[size]))[0]  # in the order of their hashes
        table = _row_keys(union)
        contexts = np.unique(_row_keys(union[:, :-1])) if size > 1 else np.zeros(1, np.uint64)
        total = np.zeros((len(contexts), width))
        kinds = np.zeros((len(contexts), width))
        own = np.zeros((len(union), width))
        discount = np.zeros(width)
        for j in range(width):
            g, n = grams[size][j], counts[size][j].astype(float)
            if not len(g):
                continue
            n1, n2 = (n == 1).sum(), (n == 2).sum()
            discount[j] = max(DISCOUNT_FLOOR, n1 / (n1 + 2 * n2)) if n1 + n2 else DISCOUNT_FLOOR
            where = np.searchsorted(contexts, _row_keys(g[:, :-1])) if size > 1 else np.zeros(len(g), np.int64)
            np.add.at(total[:, j], where, n)
            np.add.at(kinds[:, j], where, 1.0)
            own[np.searchsorted(table, _row_keys(g)), j] = np.maximum(n - discount[j], 0.0)
        left = np.where(total > 0, discount * kinds / np.maximum(total, 1.0), 1.0)
        models.context_keys[size], models.backoff[size] = contexts, np.log2(left).astype(np.float32)
        lower = np.exp2(models._lookup(union[:, 1:]).astype(float)) if size > 1 else np.full((len(union), width), 2.0**floor)
        where = np.searchsorted(contexts, _row_keys(union[:, :-1])) if size > 1 else np.zeros(len(union), np.int64)
        p = own / np.maximum(total[where], 1.0) + left[where] * lower
        models.keys[size], models.logp[size] = table, np.log2(p).astype(np.float32)
    for j, lang in enumerate(languages):
        held = [c for k, c in enumerate(texts[lang]) if len(texts[lang]) < 10 or not k % CALIBRATION_SHARE]
        bits = models.entropies(held)[:, j] if held else np.array([-floor])
        weight = np.minimum([len(c) for c in held], 500) if held else np.ones(1)
        mean = float(np.average(bits, weights=weight))
        models.limit[j] = mean, max(LEAST_DEVIATION, math.sqrt(float(np.average((bits - mean) ** 2, weights=weight))))
    return models


def _drawn(docs: DataFrame, lang_col: str, id_col: str, text_col: str) -> tuple[DataFrame, int] | None:
    """((lang, text) of the sample and a little more, in the order of the id hashes; characters of each label); None without labels."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string")).alias("h")
    )
    # the largest groups first thin themselves out by hash, so that few rows reach the ranking
    sizes = labelled.groupBy("lang").count()
    many = {r["lang"]: r["count"] for r in sizes.collect()}
    if not many:
        return None
    each = max(LEAST_CHARS, SAMPLE_CHARS // len(many))
    share = F.create_map(*[F.lit(x) for lang, n in many.items() for x in (lang, min(1.0, 1.5 * SAMPLE_DOCS / n + 1e-9))])
    drawn = (
        labelled.withColumn("share", share[F.col("lang")])
        .where(F.col("share").isNotNull() & (F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30)))
        .withColumn("text", F.substring("text", 1, each))
        .orderBy("h")
        .limit(int(1.6 * SAMPLE_DOCS * len(many)) + 100)
    )
    return drawn.select("lang", "text"), each


def _within(rows: Iterable[tuple[str, str]], each: int) -> dict[str, list[str]]:
    """The texts per language that fit into the sample's bounds."""
    out: dict[str, list[str]] = {}
    held: dict[str, int] = {}
    for lang, text in rows:
        mine = out.setdefault(lang, [])
        if len(mine) < SAMPLE_DOCS and held.get(lang, 0) < each:
            mine.append(text)
            held[lang] = held.get(lang, 0) + len(text)
    return out


def training_sample(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> dict[str, list[str]]:
    """At most ``SAMPLE_DOCS`` labelled texts per language, those of the smallest id hashes, within ``SAMPLE_CHARS`` in all.

    Every label has its equal part of these characters, ``LEAST_CHARS`` at least; a text longer than that gives its beginning.
    """
    drawn = _drawn(docs, lang_col, id_col, text_col)
    return _within(drawn[0].toLocalIterator(), drawn[1]) if drawn else {}


def fit_sample(samples: dict[str, list[str]]) -> Models | None:
    """The models of the languages that have a text with ``ORDER`` characters of letters and spaces."""
    samples = {k: v for k, v in samples.items() if any(map(str.strip, v))}
    samples = {k: v for k, v in samples.items() if any(len(characters(t)) >= ORDER for t in v)}
    return fit(samples) if samples else None


def learn(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Models | None:
    """The models of the labelled rows of ``docs``; None if there are none with a letter.

    One task fits them from the bounded sample; only the finished tables come to the driver.
    """
    drawn = _drawn(docs, lang_col, id_col, text_col)
    if drawn is None:
        return None
    rows, each = drawn

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((lang, text) for b in batches for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        models = fit_sample(_within(pairs, each))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(models)], pa.binary())], names=["models"])

    found = rows.coalesce(1).mapInArrow(run, "models binary").collect()
    return pickle.loads(found[0]["models"]) if found else None


SCHEMA = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64()), ("rejected", pa.bool_())])


def predict(docs: DataFrame, models: Models | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, bits per character and ``rejected`` of every row.

    ``lang_pred`` is ``und`` (score 0, rejected) for a null text or one without a letter, and for every
    row when nothing could be learned. Repeated rows each give a row; no other column is looked at.
    """
    source = docs_of(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by SAMPLE_CHARS

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            n = len(batch)
            if models is None:
                best, score, bits, rejected = np.full(n, -1), np.zeros(n), np.full(n, np.inf), np.ones(n, bool)
                names = []
            else:
                best, score, bits, rejected = models.judge_all(batch.column(1))
                names = models.languages
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([names[k] if k >= 0 else NO_LANGUAGE for k in best], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array([float(b) if np.isfinite(b) else None for b in bits], pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                schema=SCHEMA,
            )

    return source.mapInArrow(judge, "doc_id long, lang_pred string, score double, bits double, rejected boolean")


def drop_rejected(docs: DataFrame, models: Models | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns. Without models a text needs a letter to stay."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array) -> pa.Array:
        if shared.value is None:
            return pa.array([len(characters(t.as_py() or "")) > 0 for t in texts], pa.bool_())
        return pa.array(~shared.value.judge_all(texts)[3], pa.bool_())

    return docs.where(accepted(F.col(text_col)))
