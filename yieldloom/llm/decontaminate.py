"""Benchmark decontamination: SimHash fingerprints of item-sized windows, found by multi-index Hamming blocks.

An item of w words (five at least) is compared with every window of w words of every text. Windows and items are bags of
five-word shingles; a window's fingerprint has the signs of the sum of its shingles' +-1 vectors. Fingerprints are cut
into ``BLOCKS`` blocks of eight bits: two that differ in at most ``RADIUS`` bits agree up to ``RADIUS // BLOCKS`` bits in
one block at least, so looking up each block's neighbours finds every fingerprint within the radius. What is found is
verified on the weighted shingles: the sum of least counts over the sum of greatest counts reaches the threshold.

Only windows that can reach the threshold are fingerprinted: they hold at least the share ``percent`` of an item's shingle
count in shingles of some item of that size, which is counted for all windows of a text by one running sum. Items of fewer
than five words are found as the whole sequence of their words.

Items are taken in blocks of bounded size (``BLOCK_SHINGLES``), each sent to the tasks that go once over all texts. A
fingerprint is probabilistic: a window at the threshold itself lies at about 11 +- 3 of 64 bits, so a radius of 23 misses
about one in 10,000 of those, and the windows beside it are tried as well.

Null or empty texts and items match nothing. Rows that repeat are each judged; a null ``doc_id`` or ``item_id`` is carried
as it is. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .words import SHINGLE, byte_texts, mix, rolling_shingles, rolling_short, small, word_numbers

BLOCKS = 8
RADIUS = 23
BITS = 64
#: Shingles of the items that are sent to the tasks at a time.
BLOCK_SHINGLES = 500_000
_BIT = np.arange(BITS, dtype=np.uint64)


def _votes(shingles: np.ndarray) -> np.ndarray:
    """Rows of +1 and -1, a column for each bit."""
    bits = (mix(shingles.view(np.uint64))[:, None] >> _BIT) & np.uint64(1)
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def _pack(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BIT).sum(axis=-1, dtype=np.uint64)


def fingerprint(shingles: np.ndarray) -> int:
    """SimHash of a bag of shingles."""
    return int(_pack(_votes(shingles).sum(axis=0, dtype=np.int64)[None, :])[0])


def block_neighbours(errors: int) -> list[list[int]]:
    """For each value of a block, the values within so many bits of it."""
    return [[b for b in range(256) if (a ^ b).bit_count() <= errors] for a in range(256)]


class Items:
    """Benchmark items of one block, by their number of words."""

    def __init__(self, rows: list[tuple], percent: int):
        self.percent = percent
        self.short: dict[int, dict[int, list]] = {}
        self.sizes: dict[int, dict] = {}
        numbers, offsets = word_numbers([(t or "").encode() for _, t in rows])
        near = block_neighbours(RADIUS // BLOCKS)
        known = []
        for (item_id, _), begin, end in zip(rows, offsets[:-1], offsets[1:]):
            own = numbers[begin:end]
            if not len(own):
                continue
            if len(own) < SHINGLE:
                self.short.setdefault(len(own), {}).setdefault(int(rolling_short(own, len(own))[0]), []).append(item_id)
                continue
            shingles = rolling_shingles(own)
            known.append(shingles)
            size = self.sizes.setdefault(len(own), {"ids": [], "prints": [], "bags": [], "blocks": [{} for _ in range(BLOCKS)]})
            mark, at = fingerprint(shingles), len(size["ids"])
            size["ids"].append(item_id)
            size["prints"].append(mark)
            size["bags"].append(np.unique(shingles, return_counts=True))
            for k in range(BLOCKS):
                for value in near[(mark >> (8 * k)) & 255]:
                    size["blocks"][k].setdefault(value, []).append(at)
        self.known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.known >> np.uint64(44)).astype(np.int64)] = True
        for words, size in self.sizes.items():
            size["prints"] = np.array(size["prints"], dtype=np.uint64)
            size["need"] = -(-percent * (words - SHINGLE + 1) // 100)

    def candidates(self, size: dict, mark: int) -> set[int]:
        """Items of this size within the radius of a fingerprint."""
        found: set[int] = set()
        for k in range(BLOCKS):
            found.update(size["blocks"][k].get((mark >> (8 * k)) & 255, ()))
        return {i for i in found if (int(size["prints"][i]) ^ mark).bit_count() <= RADIUS}

    def _ratio(self, bag: tuple[np.ndarray, np.ndarray], window: np.ndarray) -> tuple[int, int]:
        values, counts = np.unique(window, return_counts=True)
        both, at, there = np.intersect1d(values, bag[0], assume_unique=True, return_indices=True)
        least = int(np.minimum(counts[at], bag[1][there]).sum())
        return least, int(counts.sum() + bag[1].sum()) - least

    def matches(self, numbers: np.ndarray, rolled: np.ndarray) -> list[tuple]:
        """Best window of each item found in a text: ``(item_id, start, words, shared, total)``."""
        best: dict = {}

        def keep(item_id, start: int, words: int, shared: int, total: int) -> None:
            old = best.get(item_id)
            if old is None or shared * old[4] > old[3] * total:
                best[item_id] = (item_id, start, words, shared, total)

        if len(rolled) and len(self.known):
            hit = self.filter[(rolled >> np.uint64(44)).astype(np.int64)]
            some = np.flatnonzero(hit)
            if len(some):
                at = np.minimum(np.searchsorted(self.known, rolled[some]), len(self.known) - 1)
                hit[some] = self.known[at] == rolled[some]
            if hit.any():
                running = np.concatenate([[0], np.cumsum(hit)])
                for words, size in self.sizes.items():
                    n = words - SHINGLE + 1
                    if len(rolled) < n:
                        continue
                    starts = np.flatnonzero(running[n:] - running[:-n] >= size["need"])
                    self._windows(size, words, rolled, starts, keep)
        for words, wanted in self.short.items():
            whole = rolling_short(numbers, words)
            for start in np.flatnonzero(np.isin(whole, np.fromiter(wanted, np.uint64, len(wanted)))).tolist():
                for item_id in wanted[int(whole[start])]:
                    keep(item_id, start, words, 1, 1)
        return list(best.values())

    def _windows(self, size: dict, words: int, rolled: np.ndarray, starts: np.ndarray, keep) -> None:
        n = words - SHINGLE + 1
        for low in range(0, len(starts), 256):  # sums of one stretch at a time
            own = starts[low : low + 256]
            first, last = own[0], own[-1] + n
            if last - first > 8 * (256 + n):  # far apart: each by itself
                marks = [fingerprint(rolled[s : s + n]) for s in own]
            else:
                sums = np.cumsum(_votes(rolled[first:last]), axis=0, dtype=np.int32)
                sums = np.concatenate([np.zeros((1, BITS), np.int32), sums])
                marks = _pack(sums[own - first + n] - sums[own - first]).tolist()
            for start, mark in zip(own.tolist(), marks):
                for i in self.candidates(size, int(mark)):
                    shared, total = self._ratio(size["bags"][i], rolled[start : start + n])
                    if 100 * shared >= self.percent * total:
                        keep(size["ids"][i], start, words, shared, total)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items, read in blocks of a bounded number of words."""
    words = F.size(F.split(F.col("text"), " "))
    total = items.agg(F.sum(words)).first()[0] or 0
    count = max(1, -(-int(total) // BLOCK_SHINGLES))
    for k in range(count):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == k)
        yield [(r[0], r[1]) for r in part.select("item_id", "text").collect()]


def contaminated(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75
) -> DataFrame:
    """Rows ``(key, item_id, start_word, n_words, similarity)``: the best window of each item found in a text."""
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select("item_id", "text").filter("text is not null")
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, start_word long, n_words int, similarity double"
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    found = None
    for block in _blocks(items):

        def run(batches: Iterator[pa.RecordBatch], block: list[tuple] = block) -> Iterator[pa.RecordBatch]:
            wanted = Items(block, percent)
            for batch in small(batches):
                texts = byte_texts(batch.column(1))
                rows, out = [], []
                at = 0
                while at < len(texts):  # a slice of the batch at a time
                    to = min(len(texts), at + 256)
                    numbers, offsets = word_numbers(texts[at:to])
                    rolled = rolling_shingles(numbers)
                    for i, begin, end in zip(range(at, to), offsets[:-1], offsets[1:]):
                        for match in wanted.matches(numbers[begin:end], rolled[begin : max(begin, end - SHINGLE + 1)]):
                            rows.append(i)
                            out.append(match)
                    at = to
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
                    "item_id": pa.array([m[0] for m in out], item_type),
                    "start_word": pa.array([m[1] for m in out], pa.int64()),
                    "n_words": pa.array([m[2] for m in out], pa.int32()),
                    "similarity": pa.array([m[3] / m[4] for m in out], pa.float64()),
                })

        part = docs.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("doc_id", key)
