"""Language-model scores by a class bigram model (Brown classes).

Chance of a word behind another: chance of its class behind the other's class, times chance of the word in its class.

* Counts: all words of all training texts, by number. Words that make up at least ``HEAD_SHARE`` of all words (so at most
  1 / ``HEAD_SHARE``) form the head, which every task holds; the others are joined.
* Core: the ``UNITS`` most frequent words are units of their own; all others begin as units by their last two bytes (the
  ``ENDINGS`` most frequent of these, and one for the rest). Exchange clustering moves one unit at a time to the class that
  raises the bigram likelihood most, until a pass moves none. The end of a text is a class of its own, and stands before a
  text's first word.
* All other training words, however rare, then move out of their unit: for each its neighbours' classes are counted over all
  training texts, in Spark, and it goes to the class that raises the bigram likelihood most; all of them at once, against the
  core's table. Only words that no training text holds are left to their last two bytes.
* Class bigrams are counted again with these classes, over all training texts. A text's other than head words get their classes
  by a join.
* Smoothing: class transitions are smoothed towards the class frequencies. Of each known word ``DISCOUNT`` occurrences go
  to the unknown words of its class, which count as one word, so the chances behind any word sum to one.

A null text is empty and has its end alone. A row without a key is a training text. Rows that repeat count and score
alike. With no training text the base score is that of an empty vocabulary, and so is the model's. Columns other than
those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import save
from .interim import release
from .words import byte_texts, small, words_and_endings

HEAD_SHARE = 2.0**-19
UNITS, ENDINGS, CLASSES = 1000, 200, 64
PASSES = 12
NEAR = np.dtype([("place", "u1"), ("n", "<u4")])
TOWARDS, DISCOUNT = 5.0, 0.75


@dataclass
class Model:
    """What every task needs to score; the head is sorted by number."""

    head: np.ndarray
    head_counts: np.ndarray
    head_units: np.ndarray  # -1: by its ending
    ending_units: np.ndarray  # by ending
    classes: np.ndarray  # of units; the last unit is the end of a text, before it one unit a class for words placed by their neighbours
    transitions: np.ndarray  # log10
    in_class: np.ndarray  # words of a class, with repeats
    kinds: np.ndarray  # different words of a class
    train_tokens: int
    train_kinds: int
    ends: int

    @property
    def end(self) -> int:
        return len(self.classes) - 1

    def look_up(self, numbers: np.ndarray) -> np.ndarray:
        """Places in the head, -1 for other words."""
        if not len(self.head):
            return np.full(len(numbers), -1)
        at = np.minimum(np.searchsorted(self.head, numbers), len(self.head) - 1)
        return np.where(self.head[at] == numbers, at, -1)

    def units(self, place: np.ndarray, endings: np.ndarray) -> np.ndarray:
        own = np.where(place >= 0, self.head_units[place], -1) if len(self.head) else np.full(len(endings), -1)
        return np.where(own >= 0, own, self.ending_units[endings])

    def emission(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log10 chance of words with such counts in their classes; 0 counts as unknown."""
        n = self.in_class[classes] + 0.5
        return np.log10(np.where(counts > 0, counts - DISCOUNT, DISCOUNT * self.kinds[classes] + 0.5) / n)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.train_tokens + self.train_kinds + 1.0))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 7 == 2, F.lit(False))


def _chunks(column, rows: int = 512) -> Iterator[tuple[int, list[bytes]]]:
    for low in range(0, len(column), rows):
        yield low, byte_texts(column.slice(low, rows))


def _word_counts(training: DataFrame) -> DataFrame:
    """Rows ``(word, ending, n)`` of all words of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            words, endings, counts = (np.concatenate(x) for x in zip(*kept))
            values, first, where = np.unique(words, return_index=True, return_inverse=True)
            return values, endings[first], np.bincount(where, weights=counts, minlength=len(values)).astype(np.int64)

        def out(part: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(part[0].view(np.int64)), "ending": pa.array(part[1]), "n": pa.array(part[2])})

        for batch in batches:
            for _, texts in _chunks(batch.column(0)):
                numbers, endings, _ = words_and_endings(texts)
                values, first, counts = np.unique(numbers, return_index=True, return_counts=True)
                kept.append((values, endings[first], counts))
                size += len(values)
                if size > 1_000_000:
                    kept = [merged()]
                    size = len(kept[0][0])
                    if size > 500_000:
                        yield out(kept.pop())
                        size = 0
        if kept:
            yield out(merged())

    parts = training.select("text").mapInArrow(run, "word long, ending int, n long")
    return parts.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


def _bigrams(training: DataFrame, model: Model) -> np.ndarray:
    """Counts of units behind units over all training texts."""
    size = len(model.classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for _, texts in _chunks(batch.column(0)):
                numbers, endings, offsets = words_and_endings(texts)
                units = model.units(model.look_up(numbers), endings)
                line = np.insert(units, offsets[1:], model.end)  # an end behind each text
                before = np.concatenate([[model.end], line[:-1]])
                pairs = before * size + line
                values, n = np.unique(pairs, return_counts=True)
                counts[values] += n
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(some), "n": pa.array(counts[some])})

    found = training.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(size * size)
    table[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(size, size)


def exchange(bigrams: np.ndarray, classes: int, passes: int = PASSES) -> np.ndarray:
    """Classes of units from their bigram counts; the last unit keeps a class of its own, the last."""
    units = len(bigrams)
    own = np.full(units, classes, dtype=np.int64)
    order = np.argsort(-(bigrams.sum(0) + bigrams.sum(1))[:-1], kind="stable")
    own[order] = np.arange(units - 1) % classes
    member = np.zeros((units, classes + 1))
    member[np.arange(units), own] = 1
    table = member.T @ bigrams @ member
    into, out_of = bigrams.T @ member, bigrams @ member  # of each unit, by class before and behind

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    for _ in range(passes):
        moved = 0
        for u in order.tolist():
            a, s = own[u], bigrams[u, u]
            right, left = out_of[u].copy(), into[u].copy()
            right[a] -= s
            left[a] -= s
            if right.sum() + left.sum() == 0:
                continue
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= s
            rows, columns = table.sum(1), table.sum(0)
            both = right + left + s
            diagonal = np.diagonal(table)
            gain = (f(table + right) - f(table)).sum(1) + (f(table + left[:, None]) - f(table)).sum(0)
            gain += f(diagonal + both) - f(diagonal + right) - f(diagonal + left) + f(diagonal)
            gain -= f(rows + right.sum() + s) - f(rows) + f(columns + left.sum() + s) - f(columns)
            gain[classes] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-6:
                b = a
            table[b] += right
            table[:, b] += left
            table[b, b] += s
            if b != a:
                own[u] = b
                into[:, a] -= bigrams[u]
                into[:, b] += bigrams[u]
                out_of[:, a] -= bigrams[:, u]
                out_of[:, b] += bigrams[:, u]
                moved += 1
        if not moved:
            break
    return own


def _neighbours(training: DataFrame, model: Model) -> DataFrame:
    """Rows ``(word, ending, near)`` of all training words without a unit of their own: counts of the classes behind them (by class)
    and before them (by class, behind these), as ``NEAR`` records a task."""
    classes = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        size = 0

        def merged() -> tuple:
            words, endings, places, counts = (np.concatenate(x) for x in zip(*kept))
            values, first, where = np.unique(words, return_index=True, return_inverse=True)
            codes, at = np.unique(where * (2 * classes) + places, return_inverse=True)
            n = np.bincount(at, weights=counts, minlength=len(codes)).astype(np.int64)
            return values[codes // (2 * classes)], endings[first][codes // (2 * classes)], codes % (2 * classes), n

        def out(part: tuple) -> pa.RecordBatch:
            words, endings, places, counts = part
            first = np.flatnonzero(np.append(np.ones(min(len(words), 1), bool), words[1:] != words[:-1]))
            ends = (np.append(first, len(words)) * NEAR.itemsize).tolist()
            packed = np.zeros(len(words), NEAR)
            packed["place"], packed["n"] = places, counts
            held = packed.tobytes()
            return pa.RecordBatch.from_pydict({
                "word": pa.array(words[first].view(np.int64)), "ending": pa.array(endings[first].astype(np.int32)),
                "near": pa.array([held[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
            })

        for batch in batches:
            for _, texts in _chunks(batch.column(0)):
                numbers, endings, offsets = words_and_endings(texts)
                place = model.look_up(numbers)
                line = np.insert(model.classes[model.units(place, endings)], offsets[1:], model.classes[model.end])
                at = np.arange(len(numbers)) + np.repeat(np.arange(len(texts)), np.diff(offsets))
                before = np.concatenate([[model.classes[model.end]], line[:-1]])
                free = np.flatnonzero(~((place >= 0) & (model.head_units[place] >= 0)) if len(model.head) else np.ones(len(numbers), bool))
                near = np.concatenate([line[at[free] + 1], before[at[free]] + classes])
                kept.append((np.tile(numbers[free], 2), np.tile(endings[free], 2), near, np.ones(len(near), np.int64)))
                size += len(near)
                if size > 1_500_000:
                    kept = [merged()]
                    size = len(kept[0][0])
                    if size > 750_000:
                        yield out(kept.pop())
                        size = 0
        if kept:
            yield out(merged())

    found = training.select("text").mapInArrow(run, "word long, ending int, near binary")
    return found.groupBy("word").agg(F.first("ending").alias("ending"), F.collect_list("near").alias("near"))


def best_classes(table: np.ndarray, own: np.ndarray, starts: np.ndarray, places: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For words of classes ``own`` the class that raises the bigram likelihood of ``table`` most, each moved alone.

    A word's neighbours are ``places`` and ``n`` from its start on, see ``_neighbours``.
    """

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    width = len(table)
    logs, logs_of = f(table), np.repeat(np.arange(len(own)), np.diff(np.append(starts, len(places))))
    behind = places < width
    other = np.where(behind, places, places - width)
    # The entries of the table that an occurrence beside such a class would add to, for each class the word may go to.
    held = np.where(behind[:, None], table.T[other], table[other])[:, : width - 1]
    gain = f(held + n[:, None]) - np.where(behind[:, None], logs.T[other], logs[other])[:, : width - 1]
    here = (np.arange(len(places)), own[logs_of])
    gain[here] = f(held[here]) - f(np.maximum(held[here] - n, 0))
    total = np.add.reduceat(gain, starts, axis=0)
    times = np.add.reduceat(np.where(behind, n, 0), starts)[:, None]
    at = (np.arange(len(own)), own)
    for sums in (table.sum(1)[: width - 1], table.sum(0)[: width - 1]):
        lost = f(sums + times) - f(sums)
        lost[at] = f(sums[own]) - f(np.maximum(sums[own] - times[:, 0], 0))
        total -= lost
    best = total.argmax(1)
    return np.where(total[np.arange(len(own)), best] > total[at] + 1e-6, best, own)


def _placed(training: DataFrame, model: Model, table: np.ndarray) -> DataFrame:
    """Rows ``(word, ending, n, cls)`` of all training words without a unit of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                near = part.column(2)
                held = near.flatten().to_pylist()
                records = np.frombuffer(b"".join(held), NEAR)
                word = np.repeat(np.repeat(np.arange(part.num_rows), near.value_lengths().to_numpy()), [len(x) // NEAR.itemsize for x in held])
                # What several tasks counted of a word is added up.
                codes, at = np.unique(word * (2 * len(table)) + records["place"], return_inverse=True)
                n = np.bincount(at, weights=records["n"], minlength=len(codes)).astype(np.int64)
                places, starts = codes % (2 * len(table)), np.searchsorted(codes, np.arange(part.num_rows) * (2 * len(table)))
                own = model.classes[model.ending_units[part.column(1).to_numpy()]]
                found = best_classes(table, own, starts, places, n)
                times = np.add.reduceat(np.where(places < len(table), n, 0), starts)
                yield pa.RecordBatch.from_pydict({"word": part.column(0), "ending": part.column(1), "n": pa.array(times), "cls": pa.array(found.astype(np.int32))})

    return _neighbours(training, model).mapInArrow(run, "word long, ending int, n long, cls int")


def fit(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the counts ``(word, ending, n, cls)`` of all training words."""
    model, counts = _fit_words(training)
    texts = training.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(False).alias("held_out"))
    _fit_transitions(model, save(_classed(texts, model, counts), "training-classes"))
    return model, counts


def _fit_transitions(model: Model, classed: DataFrame) -> None:
    """Class transitions from all training texts' classes."""
    width = CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width * width, dtype=np.int64)
        for batch in batches:
            before, line, _ = _steps(batch.column(0))
            counts += np.bincount(before * width + line, minlength=width * width)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(some), "n": pa.array(counts[some])})

    found = classed.filter(~F.col("held_out")).select("classes").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(width * width)
    table[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    table = table.reshape(width, width)
    share = (table.sum(0) + 1e-3) / (table.sum() + 1e-3 * width)
    model.transitions = np.log10((table + TOWARDS * share) / (table.sum(1, keepdims=True) + TOWARDS))


def _steps(classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of texts' words and ends, those before them, and where each text begins, from a column of bytes."""
    held = classes.to_pylist()
    ends = np.cumsum([len(x) for x in held], dtype=np.int64)
    line = np.insert(np.frombuffer(b"".join(held), np.uint8).astype(np.int64), ends, CLASSES)
    before = np.concatenate([[CLASSES], line[:-1]])
    return before[: len(line)], line, np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])[:-1]


def _fit_words(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model without its transitions, and the counts of all training words with their classes."""
    texts = training.select("text")
    counts = save(_word_counts(texts), "word-counts")
    release(training.sparkSession)
    ends = texts.count()
    sums = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    words, kinds = int(sums[0] or 0), int(sums[1])
    head = counts.filter(F.col("n") >= max(1.0, words * HEAD_SHARE)).orderBy("word").toArrow()
    numbers = head.column("word").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(numbers)
    numbers, head_counts = numbers[order], head.column("n").to_numpy().astype(np.int64)[order]
    endings = head.column("ending").to_numpy()[order]
    top = np.lexsort((numbers, -head_counts))[:UNITS]
    head_units = np.full(len(numbers), -1)
    head_units[top] = np.arange(len(top))

    by_ending = counts.groupBy("ending").agg(F.sum("n").alias("n")).toArrow()
    ending_tokens = np.zeros(65536)
    ending_tokens[by_ending.column("ending").to_numpy()] = by_ending.column("n").to_numpy()
    np.subtract.at(ending_tokens, endings[top], head_counts[top])
    frequent = np.argsort(-ending_tokens, kind="stable")[:ENDINGS]
    ending_units = np.full(65536, len(top) + ENDINGS)
    ending_units[frequent] = len(top) + np.arange(len(frequent))

    size = len(top) + ENDINGS + 2
    zero = np.zeros(0)
    model = Model(numbers, head_counts, head_units, ending_units, np.zeros(size, np.int64), zero, zero, zero, words + ends, kinds + (ends > 0), ends)
    bigrams = _bigrams(texts, model)
    model.classes = exchange(bigrams, CLASSES)
    member = np.zeros((size, CLASSES + 1))
    member[np.arange(size), model.classes] = 1
    placed = save(_placed(texts, model, member.T @ bigrams @ member), "word-classes")
    release(training.sparkSession)
    core = pa.table({
        "word": numbers[top].view(np.int64), "ending": endings[top].astype(np.int32), "n": head_counts[top],
        "cls": model.classes[: len(top)].astype(np.int32),
    })
    if len(top):
        placed = placed.unionByName(training.sparkSession.createDataFrame(core))
    others = placed.filter(F.col("n") >= max(1.0, words * HEAD_SHARE)).select("word", "cls").toArrow()
    at = model.look_up(others.column("word").to_numpy().astype(np.int64).view(np.uint64))
    found = others.column("cls").to_numpy()[at >= 0]
    at = at[at >= 0]
    free = model.head_units[at] < 0
    model.head_units[at[free]] = size - 1 + found[free]
    model.classes = np.concatenate([model.classes[:-1], np.arange(CLASSES), model.classes[-1:]])
    by_class = placed.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).toArrow()
    model.in_class, model.kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    model.in_class[by_class.column("cls").to_numpy()] = by_class.column("n").to_numpy()
    model.kinds[by_class.column("cls").to_numpy()] = by_class.column("kinds").to_numpy()
    return model, placed


def _classed(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Rows ``(doc_id, held_out, n_tokens, n_known, base, emitted, classes)``: each text's words' classes as bytes, and the sums of
    their chances in them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        end_base = m.base(np.array([m.ends]))[0]
        for batch in batches:
            for low, texts in _chunks(batch.column(1)):
                numbers, endings, offsets = words_and_endings(texts)
                place = m.look_up(numbers)
                classes = m.classes[m.units(place, endings)]
                inside = place >= 0
                own = m.head_counts[place] if len(m.head) else np.zeros(len(place), np.int64)
                emitted = np.where(inside, m.emission(np.where(inside, own, 1), classes), 0.0)
                base = np.where(inside, m.base(own), 0.0)
                running = [np.concatenate([[0.0], np.cumsum(x)]) for x in (emitted, base, inside)]
                sums = [r[offsets[1:]] - r[offsets[:-1]] for r in running]
                doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
                # Other words once for each text, with their places in it; these have the class of their ending for now.
                rest = np.flatnonzero(~inside)
                order = rest[np.lexsort((numbers[rest], doc[rest]))]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (numbers[order][1:] != numbers[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                first = order[new]
                begins = np.append(np.flatnonzero(new), len(order)).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=len(texts)))]).astype(np.int32)
                places = pa.ListArray.from_arrays(pa.array(begins), pa.array((order - offsets[doc[order]]).astype(np.int32)))
                rare = pa.StructArray.from_arrays(
                    [pa.array(numbers[first].view(np.int64)), places, pa.array(classes[first].astype(np.int32))], names=["word", "places", "cls"]
                )
                line = classes.astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(low, len(texts)), "held_out": batch.column(2).slice(low, len(texts)),
                    "n_tokens": pa.array(np.diff(offsets) + 1), "n_known": pa.array(sums[2].astype(np.int64) + (m.ends > 0)),
                    "base": pa.array(sums[1] + end_base), "emitted": pa.array(sums[0]),
                    "classes": pa.array([line[a:b] for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
                    "rare": pa.ListArray.from_arrays(pa.array(ends), rare),
                })

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, emitted double, classes binary"
    parts = docs.select("doc_id", "text", "held_out").mapInArrow(run, schema + ", rare array<struct<word:long,places:array<int>,cls:int>>")
    parts = save(parts, "text-scores").withColumn("row", F.monotonically_increasing_id())
    release(docs.sparkSession)

    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.places", "r.cls")
    met = rare.join(counts.select("word", "n", F.col("cls").alias("placed")), "word", "left")
    one = F.struct("places", F.coalesce("placed", "cls").alias("cls"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
    found = met.groupBy("row").agg(F.collect_list(one).alias("found"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in small(batches):
            columns = {c: batch.column(c) for c in batch.schema.names}
            held = columns["classes"].to_pylist()
            begins = np.concatenate([[0], np.cumsum([len(x) for x in held], dtype=np.int64)])
            line = np.frombuffer(b"".join(held), np.uint8).copy()
            words = columns.pop("found")
            sizes = words.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            words = words.flatten()
            doc = np.repeat(np.arange(len(held)), sizes)
            places, classes, n = words.field(0), words.field(1).to_numpy(), words.field(2).to_numpy()
            times = places.value_lengths().to_numpy()
            line[np.repeat(begins[doc], times) + places.flatten().to_numpy()] = np.repeat(classes, times)

            def added(x: np.ndarray) -> np.ndarray:
                return np.bincount(doc, weights=times * x, minlength=len(held))

            line = line.tobytes()
            columns["n_known"] = pa.array(columns["n_known"].to_numpy() + added(n > 0).astype(np.int64))
            columns["base"] = pa.array(columns["base"].to_numpy() + added(m.base(n)))
            columns["emitted"] = pa.array(columns["emitted"].to_numpy() + added(m.emission(n, classes)))
            columns["classes"] = pa.array([line[a:b] for a, b in zip(begins[:-1], begins[1:])], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return parts.drop("rare").join(found, "row", "left").drop("row").mapInArrow(fill, schema)


def scores(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one for each row of ``df``."""
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    model, counts = _fit_words(docs.filter(~F.col("held_out")))
    classed = save(_classed(docs, model, counts), "text-classes")
    release(df.sparkSession)
    _fit_transitions(model, classed)
    kind = docs.schema["doc_id"].dataType.simpleString()
    transitions, train_tokens = model.transitions, model.train_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            before, line, begins = _steps(batch.column(5))
            total = np.add.reduceat(transitions[before, line], begins)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(np.full(batch.num_rows, train_tokens, np.int64)),
                batch.column(4), pa.array(total + batch.column(6).to_numpy()),
            ], names=["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = classed.select("doc_id", "held_out", "n_tokens", "n_known", "base", "classes", "emitted")
    out = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.mapInArrow(run, out).withColumnRenamed("key", key)
