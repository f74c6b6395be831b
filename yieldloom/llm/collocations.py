"""Phrase collocation mining with stripes.

A stripe is a prefix with an associative counter of the words that follow it. Tasks build the stripes of their texts, so a
prefix and its followers leave a task once with a count each, and stripes of the same prefix are added elementwise: an
element (prefix, next word) has a place of its own in the shuffle, so the stripe of a hot prefix is spread over all tasks.
The merged structure has rows ``(lang, prefix, next, count)`` for prefixes of one and of two words:

* *extensions*: an element's count is the frequency of prefix and next word together;
* *prefix totals*: the element without next word counts the prefix itself, ends of pieces included;
* *subsumption maxima*: the largest elements by which a phrase is made longer, at its end or at its front.

Stripes of two-word prefixes are built in a second pass, only where both pairs of a triple can be frequent: a bit filter of
all frequent pairs, of at most ``FILTER_BITS``, tells tasks which surely are not. What it lets through too much is counted
and found too rare later, so results do not depend on its size.

Cases: a null text is empty, a null language is ``und``. Repeated rows count as often as they occur. Documents without words
and empty tables give no rows. Very long texts are worked on whole, their words held a document at a time. Other columns are
not read. Words are compared as bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import save
from .interim import release

#: Positions whose stripes a task holds before they are handed on.
HELD = 1 << 19
#: Bytes of text that are split at once.
SPLIT_BYTES = 1 << 20
FILTER_BITS = 1 << 27
#: Bits a frequent pair gets in the filter, room permitting.
PAIR_BITS = 16
BUCKET_BITS = 1 << 15
#: Words of the vocabulary of a task have numbers below this; three make one code.
WORD_BITS = 21
#: Multipliers of the pair hash, small enough for sums of three 32-bit checksums to stay within 63 bits.
FIRST, SECOND, LANGUAGE = 334_214_467, 271_828_183, 314_159_265
MARK = b"."
_PIECES = bytes(MARK[0] if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class Vocabulary(dict):
    """Numbers of words in order of appearance; the mark between pieces is 0."""

    def __init__(self):
        super().__init__({MARK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _word_runs(texts: Iterator[tuple[str, str | None]]) -> Iterator[tuple[str, bytes]]:
    """Texts joined by language, in portions; pieces end in two marks."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in texts:
        if not text:
            continue
        held.setdefault(lang, []).append(text.encode().translate(_PIECES))
        sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
        if sizes[lang] >= SPLIT_BYTES:
            yield lang, MARK.join(held.pop(lang))
            sizes[lang] = 0
    for lang, parts in held.items():
        yield lang, MARK.join(parts)


class Stripes:
    """One language's positions within a task, as codes of up to three words."""

    def __init__(self):
        self.words, self.codes, self.held = Vocabulary(), [], 0

    def add(self, run: bytes) -> np.ndarray:
        """Numbers of the words of a run, each piece followed by two marks."""
        return np.array(list(map(self.words.__getitem__, run.replace(MARK, b" . . ").split() + [MARK, MARK])), dtype=np.int64)

    def keep(self, codes: np.ndarray) -> None:
        self.codes.append(codes)
        self.held += len(codes)

    @property
    def full(self) -> bool:
        return self.held >= HELD or len(self.words) >= (1 << WORD_BITS) - SPLIT_BYTES

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes = np.concatenate(self.codes)
        self.codes = []
        return np.unique(codes, return_counts=True)


def _stripe_batches(lang: str, stripes: Stripes, codes: np.ndarray, counts: np.ndarray, two: bool) -> Iterator:
    """Arrow batches of stripes: rows of a prefix with its followers and their counts."""
    import pyarrow as pa

    words = pa.array(list(stripes.words), pa.binary())
    words = pa.concat_arrays([pa.array([b""], pa.binary()), words.slice(1)]).cast(pa.string())
    mask = (1 << WORD_BITS) - 1
    first = np.flatnonzero(np.diff(codes >> WORD_BITS, prepend=-1))
    for low in range(0, len(first), 50_000):
        begins = first[low : low + 50_000]
        begin, end = begins[0], first[low + 50_000] if low + 50_000 < len(first) else len(codes)
        prefix = codes[begins] >> WORD_BITS
        offsets = pa.array(np.append(begins, end) - begin, pa.int32())
        w1 = words.take(pa.array(prefix >> WORD_BITS if two else prefix))
        w2 = words.take(pa.array(prefix & mask if two else np.zeros(len(prefix), np.int64)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(begins)),
                w1,
                w2,
                pa.ListArray.from_arrays(offsets, words.take(pa.array(codes[begin:end] & mask))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[begin:end])),
            ],
            names=["lang", "w1", "w2", "nexts", "counts"],
        )


_STRIPE = "lang string, w1 string, w2 string, nexts array<string>, counts array<long>"


def _texts(batches: Iterator) -> Iterator[tuple[str, str | None]]:
    from .words import small

    for batch in small(batches):
        yield from zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist())


def _merged(stripes: DataFrame) -> DataFrame:
    """Stripes added elementwise: rows ``(lang, w1, w2, next, count)``."""
    elements = stripes.select("lang", "w1", "w2", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
    return elements.groupBy("lang", "w1", "w2", F.col("e.nexts").alias("next")).agg(F.sum("e.counts").alias("count"))


def word_stripes(docs: DataFrame) -> DataFrame:
    """Merged stripes of one-word prefixes; the empty next word holds a prefix' total."""

    def tasks(batches: Iterator) -> Iterator:
        held: dict[str, Stripes] = {}

        def out(lang: str) -> Iterator:
            own = held.pop(lang)
            codes, counts = own.counted()
            pairs = codes & ((1 << WORD_BITS) - 1) > 0
            totals = np.bincount(codes >> WORD_BITS, counts, len(own.words)).astype(np.int64)
            present = np.flatnonzero(totals)
            codes, counts = np.concatenate([present << WORD_BITS, codes[pairs]]), np.concatenate([totals[present], counts[pairs]])
            order = np.argsort(codes, kind="stable")
            yield from _stripe_batches(lang, own, codes[order], counts[order], two=False)

        for lang, run in _word_runs(_texts(batches)):
            own = held.setdefault(lang, Stripes())
            ids = own.add(run)
            codes = ids[:-1] << WORD_BITS | ids[1:]
            own.keep(codes[ids[:-1] > 0])
            if own.full:
                yield from out(lang)
        for lang in list(held):
            yield from out(lang)

    return _merged(docs.mapInArrow(tasks, _STRIPE)).drop("w2")


def _pair_place(lang, first, second, bits: int):
    """Place of a pair in the filter, the same on columns of checksums and on arrays."""
    return (first * FIRST + second * SECOND + lang * LANGUAGE) % bits


def pair_filter(pairs: DataFrame) -> np.ndarray:
    """Bit filter of pairs ``(lang, w1, next)``; at most ``FILTER_BITS`` reach the driver, a bucket a row."""
    wanted = pairs.count() * PAIR_BITS
    bits = BUCKET_BITS
    while bits < min(wanted, FILTER_BITS):
        bits *= 2
    # Places are numbered from 1 by Spark's bitmap functions.
    place = _pair_place(F.crc32(F.col("lang").cast("binary")), F.crc32(F.col("w1").cast("binary")), F.crc32(F.col("next").cast("binary")), bits) + 1
    buckets = pairs.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for row in buckets.collect():
        low = (row["bucket"] - 1) * (BUCKET_BITS // 8)
        out[low : low + len(row["map"])] = np.frombuffer(bytes(row["map"]), np.uint8)
    return out


def pair_stripes(docs: DataFrame, maybe: np.ndarray) -> DataFrame:
    """Merged stripes of two-word prefixes, of triples both of whose pairs pass the filter."""
    bits = len(maybe) * 8
    shared = docs.sparkSession.sparkContext.broadcast(maybe)

    def tasks(batches: Iterator) -> Iterator:
        held: dict[str, Stripes] = {}
        sums: dict[str, np.ndarray] = {}
        table = shared.value

        def checksums(lang: str, own: Stripes) -> np.ndarray:
            known = sums.get(lang, np.zeros(0, np.int64))
            if len(known) < len(own.words):
                words = list(own.words)[len(known) :]
                known = sums[lang] = np.concatenate([known, np.fromiter(map(zlib.crc32, words), np.int64, len(words))])
            return known

        def out(lang: str) -> Iterator:
            own = held.pop(lang)
            sums.pop(lang, None)
            yield from _stripe_batches(lang, own, *own.counted(), two=True)

        for lang, run in _word_runs(_texts(batches)):
            own = held.setdefault(lang, Stripes())
            ids = own.add(run)
            crc = checksums(lang, own)[ids]
            place = _pair_place(zlib.crc32(lang.encode()), crc[:-1], crc[1:], bits)
            hit = (table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool) & (ids[:-1] > 0) & (ids[1:] > 0)
            at = np.flatnonzero(hit[:-1] & hit[1:])
            own.keep(ids[at] << 2 * WORD_BITS | ids[at + 1] << WORD_BITS | ids[at + 2])
            if own.full:
                yield from out(lang)
        for lang in list(held):
            yield from out(lang)

    return _merged(docs.mapInArrow(tasks, _STRIPE))


def _score(a: str, left: str, right: str) -> F.Column:
    """Exact ``floor(1000000 * a * a / (l * r))`` of counts; at most a million, since no part is rarer than the phrase."""
    a, left, right = (f"cast({c} as decimal(16,0))" for c in (a, left, right))
    return F.expr(f"({a} * {a} * cast(1000000 as decimal(7,0))) div ({left} * {right})")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, subsumed: int = 50) -> DataFrame:
    """Each language's best phrases of two and three words: ``(lang, rank, phrase, a, l, r, n, score)``.

    ``a`` is the phrase's frequency, at least ``least``; ``l`` and ``r`` are those of its parts at the cut of lowest score
    (of equal ones the first). A phrase inside a longer one of ``subsumed`` percent of its frequency or more is left out.
    Counts may reach 10^16.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    # Totals and frequent elements are all that later steps read.
    stripes = save(word_stripes(texts).filter((F.col("next") == "") | (F.col("count") >= least)), "word-stripes")
    totals = stripes.filter("next = ''").select("lang", F.col("w1").alias("w"), "count")
    whole = totals.groupBy("lang").agg(F.sum("count").alias("n"))
    frequent = totals.filter(F.col("count") >= least)
    pairs = stripes.filter(F.col("next") != "")
    release(docs.sparkSession)
    longer = save(pair_stripes(texts, pair_filter(pairs)).filter(F.col("count") >= least), "frequent-triples")
    first, last = (frequent.select("lang", F.col("w").alias(w), F.col("count").alias(f)) for w, f in (("w1", "f1"), ("next", "f2")))
    pairs = save(pairs.join(first, ["lang", "w1"]).join(last, ["lang", "next"]), "pairs-and-parts")

    # A pair is subsumed by the largest triple that lengthens it at either end.
    ends = longer.select("lang", "w1", F.col("w2").alias("next"), "count").unionByName(longer.select("lang", F.col("w2").alias("w1"), "next", "count"))
    largest = ends.groupBy("lang", "w1", "next").agg(F.max("count").alias("longest"))
    kept = pairs.join(largest, ["lang", "w1", "next"], "left").filter(~(F.lit(100) * F.col("longest") >= F.lit(subsumed) * F.col("count")) | F.col("longest").isNull())
    two = kept.select("lang", F.concat_ws(" ", "w1", "next").alias("phrase"), F.col("count").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r")).withColumn("score", _score("a", "l", "r"))

    front = pairs.select("lang", "w1", F.col("next").alias("w2"), F.col("f1").alias("l1"), F.col("count").alias("l2"))
    back = pairs.select("lang", F.col("w1").alias("w2"), "next", F.col("count").alias("r1"), F.col("f2").alias("r2"))
    three = longer.withColumnRenamed("count", "a").join(front, ["lang", "w1", "w2"]).join(back, ["lang", "w2", "next"])
    three = three.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    cut = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "next").alias("phrase"), "a",
        F.when(cut, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(cut, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return best.join(whole, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
