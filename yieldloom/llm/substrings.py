"""Substring deduplication by content-defined chunking.

A gear hash rolls over a text's words: it is doubled, and the next word's number is added. A chunk ends where the hash's low
four bits are below three, so an end depends on four words alone, and chunks find their places again behind an insertion.
Chunks of one or two words say little and are joined to the next one. Chunks are compared by digest.

Where a window of ``passage_words`` words stands in two documents, its chunks stand in both: all but those that begin in its
first ``SETTLES`` words, where what lies before still decides, or end with the text. Windows with a chunk that no other
document holds are therefore out. The digests of all other windows are compared, with every document that holds them, so a
passage is found whoever else holds its parts. Runs of windows that share the other document are a passage. Results are exact
up to 64-bit hashes.

The first document by id keeps a passage, the others repeat it. Null or empty texts hold no passage, and rows without a
``doc_id`` are not compared. Rows that repeat are the same document. Passages that occur within one document only
are no matter of this operator. Columns other than the two named are not read, an empty table gives no passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import save
from .interim import release
from .words import byte_texts, mix, small, word_numbers

GEAR_BITS, GEAR_BELOW = 4, 3
SHORT = 3
#: Words after which the ends of chunks no longer depend on what lies before a window.
SETTLES = GEAR_BITS + SHORT - 1
LONGEST_CHUNK = 4096

_RNG = np.random.default_rng(7)
_PLACE = _RNG.integers(1, 2**63, LONGEST_CHUNK, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = int(_RNG.integers(1, 2**62)) * 4 + 3
_BACK = pow(_STEP, -1, 2**64)


def chunk_ends(numbers: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Ends (one behind the last word) of all chunks of texts that begin at ``begins``."""
    gear = np.zeros(len(numbers), dtype=np.uint64)
    for back in range(GEAR_BITS):
        gear[back:] += numbers[: len(numbers) - back] << np.uint64(back)
    cut = (gear & np.uint64(2**GEAR_BITS - 1)) < GEAR_BELOW
    for back in range(GEAR_BITS - 1):  # the first words of a text have no full hash
        at = begins + back
        cut[at[at < len(cut)]] = False
    cut[begins[begins > 0] - 1] = True
    if len(cut):
        cut[-1] = True
    ends = np.flatnonzero(cut) + 1
    # A chunk without an end in sight (one word again and again) is cut at a fixed length.
    sizes = np.diff(ends, prepend=0)
    if len(sizes) and sizes.max() > LONGEST_CHUNK:
        more = [np.arange(e - n + LONGEST_CHUNK, e, LONGEST_CHUNK) for e, n in zip(ends, sizes) if n > LONGEST_CHUNK]
        ends = np.sort(np.concatenate([ends, *more]))
    return ends


def joined_ends(ends: np.ndarray, text_ends: np.ndarray) -> np.ndarray:
    """Ends without those of short chunks, other than a text's last."""
    long = np.diff(ends, prepend=0) >= SHORT
    return ends[long | np.isin(ends, text_ends)]


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, start, words, digest)`` in words of each text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            numbers, offsets = word_numbers(byte_texts(batch.column(1)))
            if not len(numbers):
                continue
            filled = np.flatnonzero(np.diff(offsets))
            ends = joined_ends(chunk_ends(numbers, offsets[:-1][filled]), offsets[1:][filled])
            sizes = np.diff(ends, prepend=0)
            begins = ends - sizes
            place = np.arange(len(numbers)) - np.repeat(begins, sizes)
            digest = mix(np.add.reduceat(numbers * _PLACE[place % LONGEST_CHUNK], begins) + sizes.astype(np.uint64))
            doc = np.searchsorted(offsets, begins, side="right") - 1
            keep = sizes >= SHORT
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).take(pa.array(doc[keep])),
                "start": pa.array((begins - offsets[doc])[keep].astype(np.int32)),
                "words": pa.array(sizes[keep].astype(np.int32)),
                "digest": pa.array(digest[keep].view(np.int64)),
            })

    return docs.mapInArrow(run, f"doc_id {kind}, start int, words int, digest long")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _windows(docs: DataFrame, shared: DataFrame, passage_words: int) -> DataFrame:
    """Rows ``(doc_id, start, digest)`` of all windows without a chunk of their document's own."""
    known = shared.groupBy("doc_id").agg(F.collect_set("start").alias("known"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for i, (text, own) in enumerate(zip(byte_texts(batch.column(1)), batch.column(2))):
                numbers = word_numbers([text])[0]
                n = len(numbers)
                if n < passage_words:
                    continue
                ends = joined_ends(chunk_ends(numbers, np.zeros(1, np.int64)), np.array([n]))
                begins = np.concatenate([[0], ends[:-1]])
                alone = ends < n
                if own.is_valid:
                    alone &= ~np.isin(begins, np.asarray(own.values))
                # A window that begins from end - passage_words to begin - SETTLES holds the chunk.
                first = np.maximum(ends[alone] - passage_words, 0)
                behind = begins[alone] - SETTLES + 1
                some = behind > first
                marks = np.zeros(n + 1, dtype=np.int64)
                np.add.at(marks, first[some], 1)
                np.add.at(marks, behind[some], -1)
                starts = np.flatnonzero(np.cumsum(marks)[: n - passage_words + 1] == 0)
                if not len(starts):
                    continue
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers * _powers(_STEP, n), dtype=np.uint64)])
                digest = mix((sums[starts + passage_words] - sums[starts]) * _powers(_BACK, n)[starts])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).take(pa.array(np.full(len(starts), i))),
                    "start": pa.array(starts.astype(np.int32)), "digest": pa.array(digest.view(np.int64)),
                })

    texts = docs.join(known, "doc_id", "left").select("doc_id", "text", "known")
    return texts.mapInArrow(run, f"doc_id {kind}, start int, digest long")


def repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text", passage_words: int = 50) -> DataFrame:
    """Rows ``(key, start_word, n_words, other, keeps)``: passages that another document holds as well.

    ``other`` is the smallest document that holds each of the passage's windows of ``passage_words`` words, or the greatest
    for the document that keeps them; ``keeps`` is true in the first document by id. Passages with different ``other``
    may overlap.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null and text is not null")
    chunks = save(_chunks(docs), "chunks")
    held = chunks.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low <> high")
    shared = save(chunks.join(held.select("digest"), "digest").select("doc_id", "start"), "shared-chunks")
    release(spark)
    windows = save(_windows(docs, shared, passage_words), "windows")
    release(spark)
    held = windows.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low <> high")
    held = save(held, "shared-windows")
    release(spark)
    keeps = F.col("low") == F.col("doc_id")
    met = windows.join(held, "digest").select("doc_id", "start", F.when(keeps, F.col("high")).otherwise(F.col("low")).alias("other"), keeps.alias("keeps"))
    order = Window.partitionBy("doc_id", "other", "keeps").orderBy("start")
    runs = met.withColumn("run", F.col("start") - F.dense_rank().over(order)).groupBy("doc_id", "other", "keeps", "run")
    runs = runs.agg(F.min("start").cast("long").alias("start_word"), (F.max("start") - F.min("start") + passage_words).cast("long").alias("n_words"))
    return runs.select(F.col("doc_id").alias(key), "start_word", "n_words", "other", "keeps")


def without_repeats(df: DataFrame, passages: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the repeated passages cut out of the texts of documents that do not keep them."""
    cuts = passages.filter(~F.col("keeps")).groupBy(key).agg(
        F.collect_list(F.struct("start_word", (F.col("start_word") + F.col("n_words")).alias("end_word"))).alias("cuts__")
    )
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    kept = F.filter(words, lambda w, i: ~F.exists("cuts__", lambda c: (i >= c["start_word"]) & (i < c["end_word"])))
    cut = F.when(F.col("cuts__").isNull(), F.col(text)).otherwise(F.array_join(kept, ""))
    return df.join(cuts, key, "left").withColumn(text, cut).select(*df.columns)
