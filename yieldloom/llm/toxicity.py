"""Toxicity of texts behind disguises: noisy-channel restoration, then scoring of the restored text.

* Language model: words of the whole corpus are counted; those that make up at least ``WORD_SHARE`` of all words (so at most
  1 / ``WORD_SHARE`` of them) give a character model of order ``ORDER``, with interpolated orders below.
* Channel: a token whose letters are mixed with other characters or repeated, and letters written one by one, become a
  lattice: look-alike characters may stand for letters, a repeated letter or a foreign character for nothing, and between
  single letters a word may end. A Viterbi search over all contexts of the character model finds the likeliest text
  behind it. Plain words are looked at as well if a letter is doubled and they are not common words.
* Score: features are words and word beginnings. Their chance of a toxic document is learned from labelled documents, from
  a bounded sample (``SAMPLE`` rows by hash of the id), in which near copies (equal least shingle) count once. A feature is used
  when its association is beyond chance among a million features. A text's raw score is the greatest chance of any feature
  in it or in its restored tokens. Raw scores are calibrated to the toxic share that the sample shows at each of them, by a
  monotone fit; texts without features are one of its steps.

Null or empty texts score as texts without features. Rows that repeat score alike. Labels of a document that has two count
twice; a null label is none. Without labelled rows every score is 0. Only the named columns are read.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from string import ascii_lowercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import save
from .words import byte_texts, shingle_sets, small

SAMPLE = 12_000
WORD_SHARE = 2.0**-17
ORDER = 5
#: Words and tokens a task remembers; beyond this it starts anew.
REMEMBERED = 200_000
BEGINNINGS = (3, 4, 5, 6)
LEAST_G = 24.0
LEAST_PURITY = 0.5

# Letters that other characters stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
WILD = "*#%?•"
VOWELS = "aeiou"
LETTERS = re.compile(r"[^\W\d_]+")
ONE_BY_ONE = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
DRAWN_OUT = re.compile(r"([^\W\d_])\1\1|(?:([^\W\d_])\2){3}")
DOUBLED = re.compile(r"([^\W\d_])\1")


class CharModel:
    """Interpolated character model of words."""

    def __init__(self, words: dict[str, int]):
        self.words = frozenset(words)
        self.counts: Counter = Counter()
        self.totals: Counter = Counter()
        for word, n in words.items():
            padded = " " + word + " "
            for i in range(1, len(padded)):
                for k in range(min(i, ORDER - 1) + 1):
                    context = padded[i - k : i]
                    self.counts[context + padded[i]] += n
                    self.totals[context] += n
        self.known: dict[tuple[str, str], float] = {}
        self.taken: dict[tuple[str, str], tuple[float, str]] = {}

    def forget(self) -> None:
        """Drop chances and steps computed so far."""
        self.known.clear()
        self.taken.clear()

    def step(self, state: str, letters: str) -> tuple[float, str]:
        """Log chance of letters (none, one, or a blank and one) behind a state, and the state after them.

        A state is the longest ending of a context that the model has counts for. Longer contexts give every
        further character the same chance, so paths that meet in a state need not be told apart.
        """
        found = self.taken.get((state, letters))
        if found is None:
            own, total = state, 0.0
            for c in letters:
                total += self.log(own, c)
                own = " " if c == " " else (own + c)[-(ORDER - 1) :]
            while own and own not in self.totals:
                own = own[1:]
            if len(self.taken) > REMEMBERED:
                self.taken.clear()
            found = self.taken[state, letters] = total, own
        return found

    def log(self, context: str, c: str) -> float:
        """Log chance of a character behind up to ``ORDER - 1`` others."""
        found = self.known.get((context, c))
        if found is None:
            chance = 1e-4
            for k in range(len(context) + 1):
                own = context[len(context) - k :]
                total = self.totals.get(own, 0)
                if not total:
                    break
                weight = total / (total + 20.0)
                chance = (1 - weight) * chance + weight * self.counts.get(own + c, 0) / total
            if len(self.known) > REMEMBERED:
                self.known.clear()
            found = self.known[context, c] = math.log(chance)
        return found


def _options(unit: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """What each observed character may stand for, with its log chance in the channel."""
    out = []
    last = ""
    for c in unit:
        if c.isalpha():
            options = [(c, -0.1)]
            if c == last:
                options.append(("", -1.0))
            if spaced:
                options.append((" " + c, -2.0))
        elif c in LOOKS_LIKE:
            letters = LOOKS_LIKE[c]
            options = [(x, math.log(0.6 / len(letters))) for x in letters] + [("", -4.0)]
            if spaced:
                options += [(" " + x, math.log(0.6 / len(letters)) - 2.0) for x in letters]
        elif c in WILD:
            options = [("", -1.5)] + [(x, -3.0 if x in VOWELS else -4.0) for x in ascii_lowercase]
        else:
            options = [("", -0.7)]
        out.append(options)
        last = c if not c.isspace() else last
    return out


def likeliest(unit: str, model: CharModel, spaced: bool = False) -> tuple[float, str]:
    """Likeliest text behind a disguised unit in lower case, with its log chance; no path through the lattice is cut."""
    observed = re.sub(r"[\s._\-]+", "", unit) if spaced else unit
    # A state's best path: its log chance, and its letters as a chain that paths with a common start share.
    paths: dict[str, tuple[float, tuple | None]] = {model.step("", " ")[1]: (0.0, None)}
    step = model.step
    for options in _options(observed, spaced):
        grown: dict[str, tuple[float, tuple | None]] = {}
        for state, (score, chain) in paths.items():
            for letters, chance in options:
                gained, own = step(state, letters)
                total = score + chance + gained
                held = grown.get(own)
                if held is None or total > held[0]:
                    grown[own] = total, (chain, letters) if letters else chain
        paths = grown
    score, _, chain = max(((score + model.log(state, " "), state, chain) for state, (score, chain) in paths.items()), key=lambda p: p[:2])
    parts = []
    while chain is not None:
        chain, letters = chain
        parts.append(letters)
    return score, "".join(reversed(parts)).strip()


def restore(unit: str, model: CharModel, spaced: bool = False) -> str:
    """Likeliest text behind a disguised unit in lower case."""
    return likeliest(unit, model, spaced)[1]


def disguised(token: str, common: frozenset[str] = frozenset()) -> str | None:
    """The part of a token that needs restoring; none for plain words, numbers and punctuation."""
    core = token.strip(".,;:\"'()[]{}…")
    core = re.sub(r"^([^\w\s])\1+|([^\w\s])\2+$", "", core)  # a run of one sign around a word
    if core.isalpha():
        return core if DRAWN_OUT.search(core) or (core not in common and DOUBLED.search(core)) else None
    letters = sum(c.isalpha() for c in core)
    likely = sum(c.isalpha() or c in LOOKS_LIKE or c in WILD for c in core)
    if letters < 1 or likely < 3 or letters * 5 < len(core):
        return None
    return core


def features_of(word: str) -> Iterator[str]:
    """A word, and its beginnings."""
    yield word + " "
    for n in BEGINNINGS:
        if len(word) >= n:
            yield word[:n]


def monotone(steps: list[tuple[float, int, int]]) -> list[tuple[float, float]]:
    """Rising toxic shares from ``(raw score, toxic, others)``, as ``(least raw score, share)``."""
    blocks: list[list[float]] = []
    for raw, pos, neg in sorted(steps):
        blocks.append([raw, pos, neg])
        while len(blocks) > 1 and blocks[-2][1] * (blocks[-1][1] + blocks[-1][2]) >= blocks[-1][1] * (blocks[-2][1] + blocks[-2][2]):
            _, pos, neg = blocks.pop()
            blocks[-1][1] += pos
            blocks[-1][2] += neg
    return [(raw, (pos + 0.25) / (pos + neg + 1.25)) for raw, pos, neg in blocks]


class Scorer:
    """Scores texts; remembers what tokens are worth."""

    def __init__(self, chances: dict[str, float], model: CharModel):
        self.chances, self.model = chances, model
        self.curve: list[tuple[float, float]] = []
        self.tokens: dict[str, float] = {}

    def forget(self) -> None:
        """Drop what tokens are worth; a worker process keeps the scorer for later tasks."""
        self.tokens.clear()
        self.model.forget()

    def _word(self, word: str) -> float:
        return max((self.chances.get(f, 0.0) for f in features_of(word)), default=0.0)

    def _token(self, token: str) -> float:
        found = self.tokens.get(token)
        if found is None:
            if len(self.tokens) > REMEMBERED:
                self.tokens.clear()
            found = max((self._word(w) for w in LETTERS.findall(token)), default=0.0)
            core = disguised(token, self.model.words)
            if core:
                found = max([found, *(self._word(w) for w in restore(core, self.model).split())])
            self.tokens[token] = found
        return found

    def score(self, text: str) -> float:
        """Calibrated chance that a text is toxic."""
        if not self.curve:
            return 0.0
        # Among texts of one calibrated score those with the higher raw score come first.
        raw = self.raw(text)
        share = self.curve[max(0, bisect.bisect_right(self.curve, (raw, 2.0)) - 1)][1]
        return min(1.0, share + 1e-6 * raw)

    def raw(self, text: str) -> float:
        lower = text.lower()
        best = max(map(self._token, set(lower.split())), default=0.0)
        for m in ONE_BY_ONE.finditer(lower):
            seen = {c for c in m[0] if not c.isspace()}
            if len(seen) > 1 and any(c.isalpha() for c in seen) and sum(c.isalpha() or c in LOOKS_LIKE for c in m[0]) >= 3:
                for word in restore(m[0], self.model, spaced=True).split():
                    best = max(best, self._word(word))
        return round(best, 4)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(toxic, text)``: a bounded sample of labelled documents that are not held out, near copies once."""
    usable = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    sample = usable.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    sample = save(sample, "label-sample")  # SAMPLE rows at most: small enough to send to all tasks
    rows = save(docs.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text")), "labelled")

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            marks = [int(s[0]) if len(s) else 0 for s in shingle_sets(byte_texts(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], names=[*batch.schema.names, "mark"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    toxic = rows.schema["toxic"].dataType.simpleString()
    marked = rows.mapInArrow(least, f"doc_id {kind}, toxic {toxic}, text string, mark long")
    once = marked.groupBy("mark", "toxic").agg(F.min_by("text", F.struct("doc_id", "text")).alias("text"))
    return save(once.select(F.col("toxic").cast("int").alias("toxic"), "text"), "training")


def _feature_counts(training: DataFrame) -> DataFrame:
    """Rows ``(feature, pos, neg)``: documents that hold a feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 4096):
            pos, neg = Counter(), Counter()
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(LETTERS.findall(text.lower()))
                (pos if toxic else neg).update({f for w in words for f in features_of(w)})
            names = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(names, pa.string()),
                "pos": pa.array([pos[n] for n in names], pa.int64()), "neg": pa.array([neg[n] for n in names], pa.int64()),
            })

    parts = training.mapInArrow(run, "feature string, pos long, neg long")
    return parts.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _common_words(docs: DataFrame) -> dict[str, int]:
    """Words that make up at least ``WORD_SHARE`` of all words of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return made

        for batch in small(batches):
            for text in byte_texts(batch.column(0)):
                counts.update(text.lower().split())
                if len(counts) > 2 * REMEMBERED:
                    yield out()
        yield out()

    counted = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = save(counted, "word-counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    common = counted.filter(F.col("n") >= max(1.0, total * WORD_SHARE)).orderBy("word").collect()
    words: Counter = Counter()
    for r in common:
        for part in LETTERS.findall(bytes(r["word"]).decode("utf-8", "replace").lower()):
            words[part] += r["n"]
    return dict(words)


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """A scorer from the corpus and the labelled rows that are not held out."""
    training = _training(docs, labels)
    sizes = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        scorer = Scorer({}, CharModel({}))
        scorer.curve = [(0.0, 1.0 if pos else 0.0)]
        return scorer
    p = F.lit(pos / (pos + neg))
    hits = F.col("pos") + F.col("neg")
    surprise = F.col("pos") * F.log(F.col("pos") / (hits * p)) + F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (hits * (1 - p)))).otherwise(0.0)
    found = _feature_counts(training).filter("pos > 0").withColumn("g", 2 * surprise)
    # The labelled sample is bounded, and so are its features; those in use are few.
    used = found.filter((F.col("g") >= LEAST_G) & (F.col("pos") >= LEAST_PURITY * hits)).orderBy("feature").collect()
    chances = {r["feature"]: (r["pos"] + 0.25) / (r["pos"] + r["neg"] + 1.25) for r in used}
    words = _common_words(docs)
    scale = max(1, sum(words.values()) // 1_000_000)
    for r in used:  # whole words among the features are part of the language as well
        if r["feature"].endswith(" "):
            word = r["feature"].strip()
            words[word] = max(words.get(word, 0), scale * r["pos"])
    scorer = Scorer(chances, CharModel(words))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            scores = [scorer.raw(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(0), "raw": pa.array(scores, pa.float64())})

    steps = training.mapInArrow(raw, "toxic int, raw double").groupBy("raw").agg(
        F.count_if(F.col("toxic") == 1).alias("pos"), F.count_if(F.col("toxic") != 1).alias("neg")
    )
    scorer.curve = monotone([tuple(r) for r in steps.collect()])
    return scorer


def scored(df: DataFrame, scorer: Scorer, text: str = "text", column: str = "score") -> DataFrame:
    """``df`` with a column of scores."""
    names = df.columns
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in small(batches):
            scores = [own.score(t or "") for t in batch.column(names.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*names, column])
        own.forget()

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kind}, `{column}` double")


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(key, held_out, score, predicted)``, one for each row of ``docs``."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    scorer = fit(rows, labels)
    out = scored(rows, scorer)
    return out.select(
        F.col("doc_id").alias(key), held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
