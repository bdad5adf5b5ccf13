"""Words of whole batches of texts at once: hashes, word n-grams and sets of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tablewright.llm.common import byte_column, mix

_rng = np.random.default_rng(20240301)
_CODE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_GRAM = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Batches of documents are cut to about so many bytes of text; a longer text stays whole.
BATCH_BYTES = 4 << 20


def cut_batches(
    rows: Iterator[pa.RecordBatch], text: str = "text", size: int = BATCH_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches of about `size` bytes with the bytes of their texts and each text's bounds."""
    for batch in rows:
        data, offsets = byte_column(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes: differences of running sums, brought to the same power."""
    n = len(data)
    powers = np.full(n, _BASE)
    backs = np.full(n + 1, _BASE_INVERSE)
    if n:
        powers[0] = 1
    backs[0] = 1
    powers, backs = np.multiply.accumulate(powers), np.multiply.accumulate(backs)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * powers, out=running[1:])
    return mix((running[end] - running[start]) * backs[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each document's words begin (and the last ends).

    Words are runs without ASCII white space; no word crosses a document's end.
    """
    n = len(data)
    inside = ~space[data]
    fresh = np.zeros(n + 1, bool)
    fresh[offsets] = True
    begins = inside & (fresh[:n] | ~np.r_[False, inside[:-1]][:n])
    ends = inside & (fresh[1:] | ~np.r_[inside[1:], False][:n])
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each document's word n-grams, one document after another, and their bounds.

    A document with fewer words has one n-gram of all its words; one without words has none.
    """
    start, end, first = word_spans(data, offsets)
    w = span_hashes(data, start, end)
    padded = np.r_[w, np.zeros(words, np.uint64)]
    whole = sum((padded[j:j + len(w)] * _GRAM[j] for j in range(words)), np.zeros(len(w), np.uint64))
    whole = mix(whole)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(whole[a:b - words + 1]))
        elif b > a:
            short = sum((w[a + j:a + j + 1] * _GRAM[j] for j in range(b - a)), np.zeros(1, np.uint64))
            sets.append(mix(short + np.uint64(b - a)))
        else:
            sets.append(w[:0])
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate([w[:0], *sets]), np.r_[0, np.cumsum(sizes)]
