"""Word shingles as 64-bit numbers, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20240101)).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word ``[^\\x20\\x09-\\x0D]+`` of the texts, and the index of its text."""
    return word_spans(texts)[:2]


def word_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """``word_numbers``, the first and the next byte of each word, and the bytes they are places in."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b" ".join(coded) + b" "
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1))
    starts, ends = edge[0::2], edge[1::2]  # a space stands before the first byte and after the last
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), starts, ends, data
    power = np.full(len(raw), _BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTES[raw] * power)))
    inverse = np.full(len(raw), _INVERSE, np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    numbers = mix((sums[ends] - sums[starts]) * inverse[starts])
    text_ends = np.cumsum([len(c) + 1 for c in coded])
    return numbers, np.searchsorted(text_ends, starts, side="right"), starts, ends, data


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text index, number) of every run of ``words`` words, repeats included, in the order of the texts.

    A text of fewer words, but at least one, has its whole word sequence as its only shingle.
    """
    numbers, owner = word_numbers(texts)
    n = len(numbers)
    whole = np.zeros(0, np.uint64)
    at = np.zeros(0, np.int64)
    if n >= words:
        at = np.flatnonzero(owner[: n - words + 1] == owner[words - 1 :])
        whole = np.full(len(at), np.uint64(words), np.uint64)
        for k in range(words):
            whole = mix(whole * _BASE + numbers[at + k])
    sizes = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    if not len(short):
        return owner[at], whole
    begins = np.concatenate(([0], np.cumsum(sizes)))
    extra = []
    for t in short:
        x = np.full(1, np.uint64(sizes[t]), np.uint64)
        for k in range(begins[t], begins[t + 1]):
            x = mix(x * _BASE + numbers[k : k + 1])
        extra.append(x[0])
    owners = np.concatenate((owner[at], short))
    every = np.concatenate((whole, np.array(extra, np.uint64)))
    order = np.argsort(owners, kind="stable")
    return owners[order], every[order]


def counted(owners: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, number, multiplicity) of the different shingles of each text."""
    order = np.lexsort((numbers, owners))
    owners, numbers = owners[order], numbers[order]
    if not len(owners):
        return owners, numbers, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], (owners[1:] != owners[:-1]) | (numbers[1:] != numbers[:-1]))))
    return owners[first], numbers[first], np.diff(np.concatenate((first, [len(owners)])))


def occurrences(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text index, number) of each shingle's every occurrence, the k-th of a shingle with a number of its own.

    The multisets of shingles of two texts have as much in common as the sets of these numbers.
    """
    owner, number, weight = counted(*shingles(texts, words))
    pick = np.repeat(np.arange(len(owner)), weight)
    nth = np.arange(len(pick)) - np.repeat(np.cumsum(weight) - weight, weight)
    return owner[pick], mix(number[pick] + mix(nth.astype(np.uint64) + np.uint64(1)))


def overlaps(left: list[str], right: list[str], words: int = WORDS) -> np.ndarray:
    """Multiset Jaccard similarity of the word shingles of each pair of texts; two texts without words have 1."""
    n = len(left)
    a, b = counted(*shingles(left, words)), counted(*shingles(right, words))
    owners, numbers = np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1]))
    weights = np.concatenate((a[2], b[2])).astype(np.float64)
    order = np.lexsort((numbers, owners))
    owners, numbers, weights = owners[order], numbers[order], weights[order]
    both = np.flatnonzero((owners[1:] == owners[:-1]) & (numbers[1:] == numbers[:-1]))
    common = np.bincount(owners[both], np.minimum(weights[both], weights[both + 1]), minlength=n)
    total = np.bincount(owners, weights, minlength=n)
    return np.where(total > 0, common / np.maximum(total - common, 1e-300), 1.0)
