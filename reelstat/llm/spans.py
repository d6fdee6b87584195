"""Words of whole batches of texts as byte spans with 64-bit numbers, for any set of separating bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reelstat.llm.shingles import mix

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_BYTES = np.random.Generator(np.random.PCG64(20240717)).integers(1, 1 << 63, 256, dtype=np.uint64)
KEPT_POWERS = 1 << 23


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags: the bytes of the (first, last) ranges."""
    flags = np.zeros(256, bool)
    for first, last in ranges:
        flags[first : last + 1] = True
    return flags


_POWERS: dict[int, np.ndarray] = {}  # the longest yet, per base


def powers(n: int, base: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), np.uint64(base), np.uint64)
        known[:1] = 1
        known = np.cumprod(known)
        if n <= KEPT_POWERS:
            _POWERS[base] = known
    return known[:n]


def word_numbers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number of the bytes of each span, the same wherever they stand."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    terms = _BYTES[raw]
    terms *= powers(len(raw), _BASE)
    np.cumsum(terms, out=sums[1:])
    inverse = powers(len(raw), pow(_BASE, -1, 1 << 64))
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_bounds(raw: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and next byte of each maximal run of bytes that are not ``apart``; ``raw`` ends in such a byte."""
    flags = apart[raw]
    edge = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    if len(flags) and not flags[0]:
        edge = np.append(0, edge)
    return edge[0::2], edge[1::2]


def joined(texts: pa.Array, apart: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased (A-Z) bytes of all texts, each followed by ``apart``, and where each text ends; null is empty."""
    coded = texts.cast(pa.binary()).fill_null(b"").to_pylist()
    raw = np.frombuffer(apart.join([*coded, b""]).lower(), np.uint8).copy()
    return raw, np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + len(apart))


def byte_sizes(texts: pa.Array) -> np.ndarray:
    """How many bytes each text has; null has none."""
    return pc.fill_null(pc.binary_length(texts.cast(pa.binary())), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def parts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum to at most ``limit``; a larger one is a range of its own."""
    begin = held = 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield begin, k
            begin, held = k, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def slices(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string array, without a Python object each."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw[at]))
