"""Words and word shingles of whole batches as 64-bit numbers.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r, with A-Z in lower case. A word's number is a random linear
function of its bytes, modulo 2^64, mixed; a shingle's number is one of its words' numbers. Two different words or shingles
of a corpus of 10^12 get the same number with a chance of about 10^-8 for any given pair of a query.
"""

from __future__ import annotations

import ctypes
import re
import sys
from collections.abc import Iterator

import numpy as np

#: Bytes that are worked on at once, and bytes that are hashed at once: hashing takes some 80 bytes of arrays for each of them.
GROUP_BYTES = 1 << 20
HASH_BYTES = 1 << 18
SHINGLE = 5

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_IS_SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACES = re.compile(rb"[\x20\x09-\x0d]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(4096)


def _hash_group(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, places of the first bytes, and endings (the last two bytes) of the words of one string."""
    buf = np.frombuffer(data + b" ", np.uint8)
    space = _IS_SPACE[buf]
    edge = np.diff(space.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(0, np.int32)
    ends = ends[-len(starts):]
    lengths = ends - starts
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    inside = np.flatnonzero(~space)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sums = np.add.reduceat(_BYTE[buf[inside]] * powers[place], np.cumsum(lengths) - lengths)
    last = _LOWER[buf[ends - 1]].astype(np.int32)
    before = np.where(lengths > 1, _LOWER[buf[np.maximum(ends - 2, 0)]], 0).astype(np.int32)
    return mix(sums + lengths.astype(np.uint64)), starts, before * 256 + last


def _parts(text: bytes, limit: int = GROUP_BYTES) -> Iterator[bytes]:
    """A long text cut at white space."""
    at = 0
    while len(text) - at > limit:
        found = _SPACES.search(text, at + limit)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def words_and_endings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' word numbers and endings, and where each text's words begin (one more entry than texts)."""
    out, tails, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], np.zeros(len(texts), dtype=np.int64)
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= HASH_BYTES):
            size += len(texts[to]) + 1
            to += 1
        if to == at + 1:
            for part in _parts(texts[at], HASH_BYTES):
                numbers, _, endings = _hash_group(part)
                out.append(numbers)
                tails.append(endings)
                counts[at] += len(numbers)
        else:
            numbers, starts, endings = _hash_group(b" ".join(texts[at:to]))
            out.append(numbers)
            tails.append(endings)
            begins = np.cumsum([0] + [len(t) + 1 for t in texts[at:to]])
            counts[at:to] = np.diff(np.searchsorted(starts, begins))
        at = to
    return np.concatenate(out), np.concatenate(tails), np.concatenate([[0], np.cumsum(counts)])


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' word numbers, and where each text's begin."""
    numbers, _, offsets = words_and_endings(texts)
    return numbers, offsets


def rolling_shingles(numbers: np.ndarray) -> np.ndarray:
    """Number of the shingle that begins at each word; the last ``SHINGLE - 1`` words begin none."""
    n = len(numbers) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = numbers[:n] * _PLACE[0]
    for k in range(1, SHINGLE):
        total = total + numbers[k : k + n] * _PLACE[k]
    return mix(total)


def rolling_short(numbers: np.ndarray, words: int) -> np.ndarray:
    """Number of the sequence of so many words, fewer than a shingle has, that begins at each word."""
    n = len(numbers) - words + 1
    if n <= 0 or not words:
        return np.zeros(0, np.uint64)
    total = np.full(n, words, dtype=np.uint64) * _PLACE[SHINGLE]
    for k in range(words):
        total = total + numbers[k : k + n] * _PLACE[k]
    return mix(total)


def slices(texts: list[bytes], limit: int = 4 * HASH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about so many bytes."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, ascending as signed numbers."""
    for low, high in slices(texts):
        numbers, offsets = word_numbers(texts[low:high])
        rolled = rolling_shingles(numbers).view(np.int64)
        for begin, end in zip(offsets[:-1], offsets[1:]):
            if end - begin >= SHINGLE:
                yield np.unique(rolled[begin : end - SHINGLE + 1])
            else:
                yield rolling_short(numbers[begin:end], int(end - begin)).view(np.int64)


def small(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow batches in parts of so many rows: long texts are held as Python objects a part at a time.

    Before the first one, what an earlier task of the worker process left goes back to the system, and behind the last one
    the task's own freed memory, since Spark keeps its worker processes.
    """
    give_back()
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
    give_back()


def give_back() -> None:
    """Hand memory that Arrow and the C library hold unused back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def byte_texts(column) -> list[bytes]:
    """An Arrow column of strings as bytes; null is empty."""
    import pyarrow as pa

    return [t or b"" for t in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]
