"""Best-fit packing of documents into token sequences, with vector capacities.

A document is its token ids and a final id; only what is longer than a sequence is cut. A piece demands tokens, one document
and attention cost (the square of its length) of a sequence, and all three follow from its length. So what is packed is the
histogram of lengths, which has no more rows than a sequence has tokens whatever the corpus: a sequence is opened and
filled with the length that has the largest weighted dot product with what is left of the capacities, or that leaves the
smallest weighted norm of them, among the lengths that fit under every constraint; weights are the shares of demand that
remain. The filling is repeated while its lengths last. The rule that needs fewer sequences is taken.

Pieces then get their places without meeting: they are numbered within their length, in blocks so that a common length is
spread over tasks, and the number says which filling, which of its copies and which place in it.

Cases: a null text is empty, and an empty text is the final id alone. Ids of documents may repeat or be null; each row is a
document. Rows that are equal in all columns are interchangeable. Very long texts are encoded in parts that end at white space,
which no token of the tokenizer spans. An empty table gives no rows. Other columns are not read. Strings of special
tokens inside a text are what the tokenizer file makes of them.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import save
from .words import GROUP_BYTES, _parts, byte_texts, small

#: Chunks between white space whose ids a task remembers, and the longest of them in bytes.
REMEMBERED, LONGEST_CHUNK = 600_000, 200
#: A word that the tokenizer's rules leave in one piece but for its case, and marks behind it that they take together.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{}~]*)")
#: The same in bytes for words of A-Z alone, whose letters stand for themselves in a byte-level vocabulary.
_PLAIN_ASCII = re.compile(rb"([A-Za-z]+)([!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{}~]*)")
#: Pieces of one length that are numbered in one go, and the most blocks a length is dealt into.
BLOCK_ROWS, MOST_BLOCKS = 100, 10_000


def _byte_letters() -> dict[int, int]:
    """Letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: 256 + i for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds. The defaults of documents and attention never bind before the tokens do."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None

    @property
    def vector(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        return np.array([self.tokens, documents, self.tokens**2 if self.attention is None else self.attention], dtype=np.int64)

    @property
    def longest(self) -> int:
        """Tokens of the longest piece that fits on its own."""
        return min(self.tokens, isqrt(int(self.vector[2])))


@dataclass(frozen=True)
class Filling:
    """Sequences that hold the same lengths: how many, and how often each length."""

    copies: int
    uses: tuple[tuple[int, int], ...]


class Numbers(dict):
    """Numbers chunks as they are met, and lists those met since it was last asked."""

    def __init__(self):
        super().__init__()
        self.met: list[bytes] = []
        self.first = 0

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = self.first + len(self.met)
        self.met.append(chunk)
        return number

    def taken(self) -> list[bytes]:
        met, self.met = self.met, []
        self.first += len(met)
        return met


class Encoder:
    """Ids of texts by a tokenizer file; chunks between white space are encoded once as long as they are remembered."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.tails: dict[bytes, list[int]] = {}
        self.flat, self.begins = array("I"), array("q", [0])

    def _coded(self, chunk: str) -> list[int]:
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def _learn(self, chunks: list[bytes]) -> None:
        """Plain words go to the tokenizer's model at once, which is what its rules would hand on; others through the rules."""
        tokenize, tails, ascii_word = self.tokenizer.model.tokenize, self.tails, _PLAIN_ASCII.fullmatch
        ids: list[int] = []
        ends: list[int] = []
        for chunk in chunks:
            found = ascii_word(chunk)
            if found:
                word, tail = found.groups()
                ids += [t.id for t in tokenize(word.lower().decode())]
            else:
                text = chunk.decode()
                found = _PLAIN.fullmatch(text)
                if found:
                    letters, marks = found.groups()
                    ids += [t.id for t in tokenize(letters.lower().encode().decode("latin-1").translate(_BYTE_LETTERS))]
                    tail = marks.encode()
                else:
                    ids += self._coded(text)
                    tail = b""
            if tail:
                if tail not in tails:
                    tails[tail] = self._coded(tail.decode())
                ids += tails[tail]
            ends.append(len(ids))
        self.begins.extend((np.array(ends, dtype=np.int64) + len(self.flat)).tolist())
        self.flat.extend(ids)

    def ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks in a row, and where each chunk's begin (one more entry)."""
        if len(self.numbers) > REMEMBERED:
            self._forget()
        known = self.numbers
        at = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        new = known.taken()
        self._learn(new)
        for chunk in new:
            if len(chunk) > LONGEST_CHUNK:
                del known[chunk]
        begins = np.array(self.begins)
        lengths = (begins[1:] - begins[:-1])[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(begins[at] - (ends - lengths), lengths) + np.arange(total)
        return np.array(self.flat, dtype=np.uint32)[place], np.concatenate([[0], ends]).astype(np.int64)

    def texts(self, texts: list[bytes], final: int) -> Iterator[np.ndarray]:
        """Each text's ids and the final id."""
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= GROUP_BYTES):
                size += len(texts[high])
                high += 1
            if high == low + 1:
                parts = [self.ids(part.split())[0] for part in _parts(texts[low])]
                yield np.concatenate([*parts, np.array([final], np.uint32)])
            else:
                chunks: list[bytes] = []
                bounds = [0]
                for text in texts[low:high]:
                    chunks += text.split()
                    bounds.append(len(chunks))
                ids, begins = self.ids(chunks)
                ends = begins[np.array(bounds)]
                for begin, end in zip(ends[:-1], ends[1:]):
                    yield np.append(ids[begin:end], np.uint32(final))
            low = high


def worker_encoder(path: str) -> Encoder:
    """The encoder of this worker process: Spark uses a process for many tasks, and their chunks are much the same."""
    import sys
    import types

    kept = sys.modules.setdefault("_packing_of_this_worker", types.ModuleType("_packing_of_this_worker")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def pieces(docs: DataFrame, tokenizer_path: str, longest: int, final: int = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: documents as tokens, cut only where longer than a sequence."""

    def tasks(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = worker_encoder(tokenizer_path)
        for batch in small(batches, 256):
            owner, piece, start, length, sums = [], [], [], [], []
            for row, ids in enumerate(encoder.texts(byte_texts(batch.column("text")), final)):
                ids = ids.astype("<u4", copy=False)
                for k, low in enumerate(range(0, len(ids), longest)):
                    part = ids[low : low + longest]
                    owner.append(row)
                    piece.append(k)
                    start.append(low)
                    length.append(len(part))
                    sums.append(zlib.crc32(part.tobytes()))
            own = batch.column("doc_id").take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own, pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, sums))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tasks, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def _filled(counts: np.ndarray, capacities: np.ndarray, rule: str) -> list[Filling]:
    """Fillings that use up ``counts`` (pieces by length) by one rule."""
    counts, out = counts.copy(), []
    lengths = np.flatnonzero(counts)[::-1]  # of equal scores the longest wins
    demand = np.stack([lengths, np.ones_like(lengths), lengths**2], axis=1)
    share = demand / capacities
    while len(lengths):
        left = counts[lengths]
        weights = left @ share
        weights = weights / weights.sum()
        room, free, open_ = capacities.copy(), left.copy(), np.arange(len(lengths))
        uses = np.zeros(len(lengths), dtype=np.int64)
        while True:
            open_ = open_[(demand[open_] <= room).all(axis=1) & (free[open_] > 0)]
            if not len(open_):
                break
            rest = room / capacities
            if rule == "dot product":
                best = open_[np.argmax(share[open_] @ (weights * rest))]
            else:
                best = open_[np.argmin(((rest - share[open_]) ** 2) @ weights)]
            uses[best] += 1
            free[best] -= 1
            room -= demand[best]
        used = np.flatnonzero(uses)
        copies = int((left[used] // uses[used]).min())
        out.append(Filling(copies, tuple((int(lengths[i]), int(uses[i])) for i in used)))
        counts[lengths[used]] -= copies * uses[used]
        alive = counts[lengths] > 0
        lengths, demand, share = lengths[alive], demand[alive], share[alive]
    return out


def fillings(histogram: dict[int, int], capacities: Capacities) -> list[Filling]:
    """The sequences for so many pieces of each length, by the rule that needs fewest."""
    counts = np.zeros(capacities.longest + 1, dtype=np.int64)
    for length, count in histogram.items():
        counts[length] = count
    found = [_filled(counts, capacities.vector, rule) for rule in ("norm", "dot product")]
    return min(found, key=lambda plan: sum(f.copies for f in plan))


def _places(plan: list[Filling]) -> dict[str, np.ndarray]:
    """Ranges of numbers within a length, ascending: where each begins, its filling's first sequence, uses and offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for filling in plan:
        offset = 0
        for length, uses in filling.uses:
            first = taken.get(length, 0)
            rows.append((length, first, sequence, uses, offset))
            taken[length] = first + uses * filling.copies
            offset += length * uses
        sequence += filling.copies
    rows.sort()
    names = ("length", "first", "sequence", "uses", "offset")
    return {name: np.array([r[i] for r in rows], dtype=np.int64) for i, name in enumerate(names)}


def numbered(rows: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds ``number``: 0, 1, .. within each length, in blocks of about ``BLOCK_ROWS`` rows."""
    blocks = [(length, min(MOST_BLOCKS, -(-count // BLOCK_ROWS))) for length, count in histogram.items()]
    # One row a length: no more than a sequence has tokens.
    known = F.broadcast(rows.sparkSession.createDataFrame(blocks, "length long, blocks long"))
    dealt = rows.join(known, "length").withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "blocks"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "block").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    joined = dealt.join(bases.select("length", "block", "base"), ["length", "block"])
    return joined.withColumn("number", F.row_number().over(inside) - 1 + F.col("base")).drop("block", "blocks", "base")


def packed(docs: DataFrame, tokenizer_path: str, capacities: Capacities = Capacities(), final: int = 0) -> DataFrame:
    """A row for each piece: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``."""
    rows = save(pieces(docs, tokenizer_path, capacities.longest, final), "pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    places = _places(fillings(histogram, capacities))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def tasks(batches: Iterator) -> Iterator:
        import pyarrow as pa

        # Lengths begin where their first range does; a number's range is the last of its length that begins at or below it.
        bounds = {int(n): (int(a), int(b)) for n, a, b in zip(*_runs(places["length"]))}
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.zeros(len(length), dtype=np.int64)
            for n in np.unique(length):
                low, high = bounds[int(n)]
                own = np.flatnonzero(length == n)
                at[own] = low + np.searchsorted(places["first"][low:high], number[own], side="right") - 1
            within = number - places["first"][at]
            copy, slot = np.divmod(within, places["uses"][at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(places["sequence"][at] + copy), pa.array(places["offset"][at] + slot * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return numbered(rows, histogram).select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(tasks, schema)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values in a row that are equal: value, begin, end."""
    begins = np.flatnonzero(np.diff(values, prepend=-1))
    return values[begins], begins, np.append(begins[1:], len(values))
