"""Secret scans by grammar inference.

Three fixed patterns find labelled credentials. Their distinct values, as sequences of character classes, are counted as a
prefix tree for each kind; states whose next characters and ends are statistically alike (a Hoeffding bound) are merged,
with everything below them, into a probabilistic automaton. All other long tokens with letters and digits are candidates:
one whose likelihood of format under some kind's automaton is at least that of nearly all labelled values of the kind is
found as well, as kind ``format``.

Sizes: all values count, in Spark. A prefix that fewer than a fixed share of a kind's values have is no state of its own;
it continues in the state of its last class, whose counts cover every position of every value. So at most
``STATES_SHARE`` states a depth reach the driver, however large the corpus is.

Spans are code points, end exclusive. Null or empty texts hold nothing. Rows that repeat are judged alike. Without any
labelled value there is no automaton, and only the patterns count. Columns other than the key and the text are not read by
the scan; ``redact`` keeps them all.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import save
from .words import small

# The kinds and their patterns. Keywords are in either case, by ASCII letters alone.
KINDS = ["assign", "access", "hex", "format"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{15,}")
#: Character classes: first character, and how many there are.
CLASSES = {"a": 6, "g": 20, "A": 6, "G": 20, "0": 10}
_FROM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_TO = "a" * 6 + "g" * 20 + "A" * 6 + "G" * 20 + "0" * 10
_CLASS_OF = str.maketrans(_FROM, _TO)
END = "$"

DEPTH = 24
STATES_SHARE = 200
LEAST_STATE = 20
ALPHA = 0.05
#: Share of the labelled values that may look less likely than a candidate.
QUANTILE = 0.02


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(kind, start, end, value)`` of the fixed patterns, each kind leftmost and without overlaps."""
    found = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return found


def candidates(text: str, spans: list[tuple]) -> list[tuple[int, int, int, str]]:
    """Other long tokens with letters and digits."""
    found = []
    for m in CANDIDATE.finditer(text):
        token = m[0].rstrip(".")
        end = m.start() + len(token)
        if len(token) >= 16 and any(c.isdigit() for c in token) and any(c.isalpha() for c in token):
            if not any(s < end and m.start() < e for _, s, e, _ in spans):
                found.append((3, m.start(), end, token))
    return found


class Automaton:
    """Probabilistic deterministic automaton: ``moves[state][class] = (state, count)``, ``ends[state]``."""

    def __init__(self, prefixes: dict[str, tuple[int, int]], tails: dict[str, dict[str, int]]):
        """``prefixes``: visits and ends of the prefix tree's states and their children; ``tails``: classes that follow a class."""
        self.moves: dict[str, dict[str, list]] = {}
        self.ends: dict[str, int] = {}
        states = {p for p, (n, _) in prefixes.items() if n >= self._least(prefixes) and len(p) <= DEPTH}
        states.add("")
        for last, follow in tails.items():
            self.moves["~" + last] = {c: ["~" + c, n] for c, n in follow.items() if c != END}
            self.ends["~" + last] = follow.get(END, 0)
        for p in states:
            self.moves[p], self.ends[p] = {}, prefixes.get(p, (0, 0))[1]
        for p, (n, _) in prefixes.items():
            if p and p[:-1] in states:
                self.moves[p[:-1]][p[-1]] = [p if p in states else "~" + p[-1], n]
        self._infer(sorted("~" + c for c in tails))

    @staticmethod
    def _least(prefixes: dict[str, tuple[int, int]]) -> float:
        return max(LEAST_STATE, prefixes.get("", (0, 0))[0] / STATES_SHARE)

    def _visits(self, s: str) -> int:
        return self.ends[s] + sum(n for _, n in self.moves[s].values())

    def _alike(self, a: str, b: str, seen: set) -> bool:
        """Whether next classes and ends of two states, and of the states below them, have equal chances."""
        if a == b or (a, b) in seen:
            return True
        seen.add((a, b))
        n, m = self._visits(a), self._visits(b)
        if not n or not m:
            return True
        bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        if abs(self.ends[a] / n - self.ends[b] / m) > bound:
            return False
        for c in self.moves[a].keys() | self.moves[b].keys():
            x, y = self.moves[a].get(c), self.moves[b].get(c)
            if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > bound:
                return False
            if x and y and not self._alike(x[0], y[0], seen):
                return False
        return True

    def _fold(self, into: str, state: str) -> None:
        """Add a tree state's counts, and those below it, to another state."""
        if into == state:
            return
        self.ends[into] += self.ends[state]
        for c, (target, n) in self.moves[state].items():
            own = self.moves[into].get(c)
            if own is None:
                self.moves[into][c] = [target, n]
            else:
                own[1] += n
                if not target.startswith("~") and target != own[0]:
                    self._fold(own[0], target)

    def _infer(self, red: list[str]) -> None:
        """Merge states in order of depth into the states kept so far."""
        red = [*red, ""]
        kept = set(red)
        while True:
            blue = sorted({t for s in kept for t, _ in self.moves[s].values() if t not in kept}, key=lambda s: (len(s), s))
            if not blue:
                break
            state = blue[0]
            target = next((r for r in red if self._alike(r, state, set())), None)
            if target is None:
                red.append(state)
                kept.add(state)
                continue
            for s in kept:
                for move in self.moves[s].values():
                    if move[0] == state:
                        move[0] = target
            self._fold(target, state)
        self.moves = {s: self.moves[s] for s in red}
        self.ends = {s: self.ends[s] for s in red}

    def score(self, value: str) -> float:
        """Log10 likelihood of a value, for each of its characters and its end."""
        state, total = "", 0.0
        symbols = len(CLASSES) + 7
        for c in value.translate(_CLASS_OF):
            moves = self.moves.get(state, {})
            n = self.ends.get(state, 0) + sum(m for _, m in moves.values())
            target, count = moves.get(c, ("~" + c, 0))
            total += math.log10((count + 0.1) / (n + 0.1 * symbols) / CLASSES.get(c, 1))
            state = target
        n = self.ends.get(state, 0) + sum(m for _, m in self.moves.get(state, {}).values())
        total += math.log10((self.ends.get(state, 0) + 0.1) / (n + 0.1 * symbols))
        return total / (len(value) + 1)


def _classes(value: Column) -> Column:
    return F.translate(value, _FROM, _TO)


def fit(labelled: DataFrame) -> dict[int, tuple[Automaton, float]]:
    """Automata and least scores by kind, from rows ``(kind, value)``."""
    values = save(labelled.select("kind", "value").distinct(), "labelled-values")
    coded = values.withColumn("classes", _classes(F.col("value"))).withColumn("n", F.length("value"))
    prefixes = coded.select(
        "kind", "classes", "n", F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(DEPTH + 1)))).alias("k")
    )
    counts = prefixes.groupBy("kind", F.expr("substring(classes, 1, k)").alias("prefix")).agg(
        F.count(F.lit(1)).alias("visits"), F.count_if(F.col("k") == F.col("n")).alias("ends")
    )
    totals = values.groupBy("kind").agg(F.count(F.lit(1)).alias("all"))
    least = F.greatest(F.lit(LEAST_STATE), F.col("all") / STATES_SHARE)
    states = save(counts.join(F.broadcast(totals), "kind").withColumn("state", F.col("visits") >= least), "prefix-tree")
    parents = states.filter("state").select("kind", F.col("prefix").alias("parent"))
    wanted = states.withColumn("parent", F.expr("substring(prefix, 1, greatest(length(prefix) - 1, 0))"))
    wanted = wanted.join(parents, ["kind", "parent"], "left_semi").unionByName(wanted.filter("prefix = ''"))
    tree: dict[int, dict[str, tuple[int, int]]] = {}
    for r in wanted.select("kind", "prefix", "visits", "ends").distinct().collect():
        tree.setdefault(r["kind"], {})[r["prefix"]] = (r["visits"], r["ends"])
    places = coded.select("kind", "classes", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"))
    follow = F.when(F.col("k") < F.col("n"), F.expr("substring(classes, k + 1, 1)")).otherwise(END)
    tails: dict[int, dict[str, dict[str, int]]] = {}
    for r in places.groupBy("kind", F.expr("substring(classes, k, 1)").alias("last"), follow.alias("next")).count().collect():
        tails.setdefault(r["kind"], {}).setdefault(r["last"], {})[r["next"]] = r["count"]
    automata = {k: Automaton(tree[k], tails.get(k, {})) for k in tree}
    if not automata:
        return {}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            kinds, own = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yield pa.RecordBatch.from_pydict({"kind": batch.column(0), "score": pa.array([automata[k].score(v) for k, v in zip(kinds, own)], pa.float64())})

    limits = values.select("kind", "value").mapInArrow(scored, "kind int, score double")
    limits = limits.groupBy("kind").agg(F.percentile_approx("score", QUANTILE, 10_000).alias("least")).collect()
    return {r["kind"]: (automata[r["kind"]], r["least"]) for r in limits}


def likely(value: str, automata: dict[int, tuple[Automaton, float]]) -> float | None:
    """How far a candidate's best score lies above what its format needs; null if below for all kinds."""
    over = [a.score(value) - least for a, least in automata.values()]
    return max(over) if over and max(over) >= 0 else None


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(key, spans)``: base spans and candidates as an array of (kind, start, end, value)."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = []
            for own in batch.column(1).to_pylist():
                spans = base_spans(own)
                spans += candidates(own, spans)
                found.append([{"kind": k, "start": s, "end": e, "value": v} for k, s, e, v in spans])
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "spans": pa.array(found, span)})

    out = rows.mapInArrow(run, f"key {kind}, spans array<struct<kind:int,start:int,end:int,value:string>>")
    return out.withColumnRenamed("key", key)


def labelled_values(scanned: DataFrame) -> DataFrame:
    """Labelled credentials ``(kind, value)`` of scanned rows."""
    return scanned.select(F.explode("spans").alias("s")).filter("s.kind < 3").select("s.kind", "s.value")


def found_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(key, spans)``: all spans found, as an array of (kind, start, end, value, over), in order."""
    scanned = save(scan(df, key, text), "secret-spans")
    automata = fit(labelled_values(scanned))
    kind = scanned.schema[key].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("over", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = []
            for spans in batch.column(1).to_pylist():
                for s in spans:
                    s["over"] = likely(s["value"], automata) if s["kind"] == 3 else None
                out.append(sorted((s for s in spans if s["kind"] < 3 or s["over"] is not None), key=lambda s: (s["start"], s["kind"])))
            yield pa.RecordBatch.from_pydict({key: batch.column(0), "spans": pa.array(out, span)})

    return scanned.mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind:int,start:int,end:int,value:string,over:double>>")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""

    def written(spans: Column) -> Column:
        name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), spans["kind"] + 1)
        return F.concat_ws(":", name, spans["start"], spans["end"])

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        key, *[count(k) for k in range(len(KINDS))],
        F.sha2(F.array_join(F.transform(base, written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", written), ",").alias("spans"),
    )


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret's span replaced by a mark; overlapping spans by one. Null stays null."""
    numbered = df.select(F.lit(0).alias("key"), text)
    automata = fit(labelled_values(scan(numbered, "key", text)))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = []
            for own in batch.column(names.index(text)).to_pylist():
                spans = base_spans(own) if own else []
                if own:
                    spans += [c for c in candidates(own, spans) if likely(c[3], automata) is not None]
                parts, at = [], 0
                for _, start, end, _ in sorted(spans, key=lambda s: s[1]):
                    if start >= at:
                        parts += [own[at:start], mark]
                    at = max(at, end)
                out.append("".join([*parts, own[at:]]) if spans else own)
            columns = [pa.array(out, pa.string()) if n == text else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, df.schema)
