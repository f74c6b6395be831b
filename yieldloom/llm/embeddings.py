"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are drawn from the vectors and kept apart, so a dense ball of near copies has few of them, not its
share of all. A vector is described by the pivots nearest to it in their order, its permutation. An inverted list belongs to
every two pivots whose positions in the permutation multiply to at most twice its length, so the foremost pivots meet many
others and the hindmost only the foremost. Vectors that stand in one list share at least two pivots so placed; they are
the candidates, and are verified by their cosine in double precision. Candidates of several lists are judged in the first.

How many pivots there are and how long permutations are is measured: pairs of the sample are brought to the threshold's
cosine exactly, and the most pivots with the shortest length are taken at which ``WANTED`` of these hardest pairs would meet. Vectors
with a common direction get fewer pivots and longer permutations that way; a vector stands in 104 lists of pivots at most.

Order inside a dense ball is noise, so balls have an exact way as well. Vectors within twice the threshold's angle of a pivot
are covered by its cell, and all within three times that angle stand in the cell; whatever a covered vector links with does
(triangle inequality), so a covered vector needs no other list. Cells are kept, those with most links first, while a vector
stands in ``MOST_CELLS`` of them on average and the sample shows that a cell is sparse or that its pairs are often links; a
crowded region without many links is left to the permutations, so cells cannot grow into comparing everything.

The sample is bounded: twice the square root of the number of vectors, between ``PIVOTS_LEAST`` and ``PIVOTS_MOST``. All
vectors are indexed. ``recall`` measures the share of links found on a table.

A list of more than ``BLOCK`` vectors is cut into blocks, and each two blocks meet in a task of their own, so no list is too
large and none is capped. Equal vectors of a label are one node with a count. Tasks return link counts and a spanning
forest of what they found, not pairs.

Vectors that are null, empty or zero, or hold null or non-finite components, and those without a label, link with nothing;
so do vectors of different length. A null id is carried along and never names a component unless it is alone in it, when
the component is null. Rows that repeat are copies of each other. Columns other than the three named are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import save
from .graph import components

PIVOTS_LEAST, PIVOTS_MOST = 256, 4096
# Lengths of a permutation that are tried, and the share of pairs at the threshold that has to meet.
LENGTHS, WANTED = (16, 24, 32), 0.95
# Cells a vector stands in on average; a cell with more vectors of the sample than SPARSE needs this share of links.
MOST_CELLS, SPARSE, OFTEN = 8, 8, 0.1
BLOCK = 1000


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1)[:, None]
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def nodes_of(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """Rows ``(vec_id, label, vector, node)``; ``node`` is null for what links with nothing."""
    kept = df.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)
    return kept.withColumn("node", F.when(usable, F.xxhash64("label", "vector")))


def _apart(vectors: np.ndarray, most: int, reach: float) -> np.ndarray:
    """The first ``most`` of the vectors that lie no nearer to an earlier one than the cosine ``reach``."""
    kept = np.zeros((min(most, len(vectors)), vectors.shape[1]))
    n = 0
    for v in vectors:
        if n < most and not (n and (kept[:n] @ v).max() >= reach):
            kept[n] = v
            n += 1
    return kept[:n]


@dataclass(frozen=True)
class Index:
    """Pivots of the permutations and their length; centres of the cells with the cosines of covering and of reach."""

    pivots: np.ndarray
    length: int
    centres: np.ndarray
    covering: float
    reach: float


def _permutations(units: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; equally near ones by number."""
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, :length]


def _pivot_pairs(permutations: np.ndarray, n_pivots: int, length: int) -> np.ndarray:
    """Numbers of the inverted lists each permutation stands in."""
    first, second = np.triu_indices(permutations.shape[1], 1)
    placed = (first + 1) * (second + 1) <= 2 * length
    one, two = permutations[:, first[placed]].astype(np.int64), permutations[:, second[placed]].astype(np.int64)
    return np.minimum(one, two) * n_pivots + np.maximum(one, two)


def _wider(least: float, times: float) -> float:
    """Cosine of so many times the angle whose cosine is ``least``."""
    return math.cos(min(math.pi, times * math.acos(max(-1.0, min(1.0, least)))))


def _cells(sample: np.ndarray, centres: np.ndarray, least: float, reach: float) -> np.ndarray:
    """The centres whose cells are kept."""
    rated = []
    for at, centre in enumerate(centres):
        members = sample[sample @ centre >= reach]
        n, some = len(members), members[:256]
        links = (np.count_nonzero(some @ some.T >= least) - len(some)) / max(1, len(some) * (len(some) - 1))
        if n <= SPARSE or links >= OFTEN:
            rated.append((-links, at, n / len(sample)))
    rated.sort()
    shares = np.cumsum([share for _, _, share in rated])
    return centres[sorted(at for (_, at, _), total in zip(rated, shares) if total <= MOST_CELLS)]


def _at_threshold(sample: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose cosine is the threshold: neighbours in the sample, the second turned towards the first."""
    other = np.roll(sample, 1, axis=0)
    cosine = (sample * other).sum(axis=1)
    use = np.abs(cosine) < least
    one, other, cosine = sample[use], other[use], cosine[use]
    rest = other - cosine[:, None] * one
    rest /= np.sqrt((rest * rest).sum(axis=1))[:, None]
    return one, least * one + math.sqrt(max(0.0, 1 - least * least)) * rest


def _meeting(one: np.ndarray, two: np.ndarray, pivots: np.ndarray, length: int) -> float:
    """Share of the pairs that stand in a common inverted list."""
    a, b = (_pivot_pairs(_permutations(x, pivots, length), len(pivots), length) for x in (one, two))
    return float(np.mean([np.isin(x, y).any() for x, y in zip(a, b)]))


def index_of(nodes: DataFrame, least: float) -> Index:
    """Index drawn from a bounded sample of the nodes of the commonest length, the same for the same rows."""
    covering, reach = _wider(least, 2) + 1e-9, _wider(least, 3) - 1e-9
    sizes = nodes.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return Index(np.zeros((0, 1)), LENGTHS[0], np.zeros((0, 1)), covering, reach)
    wanted = min(PIVOTS_MOST, max(PIVOTS_LEAST, math.isqrt(sizes["count"])))
    drawn = nodes.filter(F.size("vector") == sizes["size"]).orderBy(F.xxhash64("node"), "node").limit(2 * wanted).select("vector").collect()
    return fitted(_unit(np.array([r[0] for r in drawn], dtype=np.float64)), wanted, least)


def fitted(sample: np.ndarray, wanted: int, least: float) -> Index:
    """Index of unit vectors with at most ``wanted`` pivots."""
    covering, reach = _wider(least, 2) + 1e-9, _wider(least, 3) - 1e-9
    apart = _apart(sample, wanted, covering)
    centres = _cells(sample, apart, least, reach)
    # A common direction leaves few vectors so far apart; then pivots may lie nearer to each other.
    for times in (1.0, 0.5, 0.0):
        if 2 * len(apart) >= min(wanted, len(sample)):
            break
        apart = _apart(sample, wanted, _wider(least, times) if times else 2.0)
    open_ones = sample[(sample @ centres.T).max(axis=1) < covering] if len(centres) else sample
    one, two = _at_threshold(open_ones[:800], least)
    n = len(apart)
    while len(one):
        for length in LENGTHS:
            if _meeting(one, two, apart[:n], length) >= WANTED:
                return Index(apart[:n], length, centres, covering, reach)
        if n <= 2 * LENGTHS[-1]:
            break
        n //= 2
    return Index(apart[:n], LENGTHS[-1] if len(one) else LENGTHS[0], centres, covering, reach)


def _described(nodes: DataFrame, index: Index) -> DataFrame:
    """Adds ``lists``, ascending: cells first, then, if not covered, those of pairs of pivots in the permutation.

    Lists are numbered: cells from 0, lists of pivots behind them, and one behind all these for what has no pivots.
    """
    n_cells, n_pivots = len(index.centres), len(index.pivots)
    last = n_cells + n_pivots * n_pivots

    def lists_of(unit: np.ndarray) -> list[list[int]]:
        cosine = unit @ index.centres.T
        inside = cosine >= index.reach
        covered = (cosine >= index.covering).any(axis=1)
        pairs = n_cells + np.sort(_pivot_pairs(_permutations(unit, index.pivots, index.length), n_pivots, index.length), axis=1)
        return [
            np.flatnonzero(inside[i]).tolist() + ([] if covered[i] else pairs[i].tolist() or [last]) for i in range(len(unit))
        ]

    def run(batches):
        for batch in batches:
            vectors = [np.asarray(v.values, dtype=np.float64) for v in batch.column("vector")]
            # A vector of another length than the pivots: one list for all of these, judged like the others.
            lists: list[list[int]] = [[last]] * len(vectors)
            fit = [i for i, v in enumerate(vectors) if len(v) == index.pivots.shape[1]]
            for low in range(0, len(fit), 512):
                part = fit[low : low + 512]
                for i, found in zip(part, lists_of(_unit(np.array([vectors[i] for i in part])))):
                    lists[i] = found
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*batch.schema.names, "lists"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{kind}, lists array<int>")


def _judge(least: float):
    def exact(a: np.ndarray, b: np.ndarray) -> float:
        return float(np.dot(a, b) / (math.sqrt(np.dot(a, a)) * math.sqrt(np.dot(b, b))))

    def run(table: pa.Table) -> pa.Table:
        """Link counts and a spanning forest of one list, or of two blocks of it."""
        n = table.num_rows
        here = table.column("list")[0].as_py()
        node = np.array(table.column("node").to_pylist(), dtype=np.int64)
        copies = np.array(table.column("copies").to_pylist(), dtype=np.int64)
        block = np.array(table.column("block").to_pylist(), dtype=np.int64)
        one, two = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        vectors = [np.asarray(v, dtype=np.float64) for v in table.column("vector").to_pylist()]
        size = np.array([len(v) for v in vectors])
        earlier = [[x for x in names if x < here] for names in table.column("lists").to_pylist()]
        root = np.arange(n)

        def padded(rows: np.ndarray, filler: int) -> np.ndarray:
            out = np.full((len(rows), max(len(earlier[i]) for i in rows)), filler, dtype=np.int64)
            for k, i in enumerate(rows):
                out[k, : len(earlier[i])] = earlier[i]
            return out

        def tie(a: np.ndarray, b: np.ndarray) -> None:
            nonlocal root
            while True:
                x, y = root[a], root[b]
                differ = x != y
                if not differ.any():
                    return
                a, b, x, y = a[differ], b[differ], x[differ], y[differ]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root = root[root]

        links = np.zeros(n, dtype=np.int64)
        for length in np.unique(size):
            rows = np.flatnonzero(size == length)
            left, right = rows[block[rows] == one], rows[block[rows] == two]
            if not len(left) or not len(right):
                continue
            raw = np.array([vectors[i] for i in right])
            unit = _unit(raw)
            own = padded(right, -1)
            for at in range(0, len(left), 256):
                part = left[at : at + 256]
                mine = _unit(np.array([vectors[i] for i in part]))
                cosine = mine @ unit.T
                a, b = np.nonzero(cosine >= least - 1e-9)
                if one == two:
                    keep = part[a] < right[b]
                    a, b = a[keep], b[keep]
                near = np.abs(cosine[a, b] - least) <= 1e-9
                if near.any():
                    good = ~near
                    for k in np.flatnonzero(near):
                        good[k] = exact(vectors[part[a[k]]], raw[b[k]]) >= least
                    a, b = a[good], b[good]
                other = padded(part, -2)
                step = max(1, 4_000_000 // max(1, other.shape[1] * own.shape[1]))
                for low in range(0, len(a), step):
                    x, y = a[low : low + step], b[low : low + step]
                    # Judged here only if no earlier list holds both.
                    fresh = ~(other[x][:, :, None] == own[y][:, None, :]).any(axis=(1, 2))
                    x, y = x[fresh], y[fresh]
                    np.add.at(links, part[x], copies[right[y]])
                    np.add.at(links, right[y], copies[part[x]])
                    tie(part[x], right[y])
        some = np.flatnonzero(links)
        return pa.table({
            "node": pa.array(node[some]), "other": pa.array(node[root[some]], pa.int64()), "links": pa.array(links[some]),
        })

    return run


def linked(df: DataFrame, least: float, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows ``(key, n_links, component_id, kept)``, one for each row of ``df``."""
    rows = nodes_of(df, key, vector, label)
    usable = rows.filter("node is not null")
    nodes = usable.groupBy("node", "label", "vector").agg(F.count(F.lit(1)).alias("copies"))
    nodes = save(nodes.select("node", "label", "vector", "copies"), "vectors")
    described = save(_described(nodes, index_of(nodes, least)), "permutations")
    # Lists are counted and looked up by narrow rows; only vectors that meet another one are dealt out.
    places = described.select("node", "label", F.explode("lists").alias("list"))
    sizes = places.groupBy("label", "list").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = places.join(sizes, ["label", "list"]).select("node", "list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    shared = shared.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("list", "blocks"))).alias("shared"))
    met = described.select("node", "label", "vector", "copies").join(shared, "node").withColumn("lists", F.col("shared.list"))
    met = met.select("*", F.inline("shared")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))
    found = met.select("label", "list", "low", "high", "block", "node", "copies", "vector", "lists").groupBy("label", "list", "low", "high")
    found = save(found.applyInArrow(_judge(least), "node long, other long, links long"), "vector-links")

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    copies = nodes.select("node", "copies")
    placed = (
        rows.select("vec_id", "node")
        .join(copies, "node", "left")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = placed.filter("root is not null").groupBy("root").agg(F.min("vec_id").alias("smallest"))
    out = placed.join(smallest, "root", "left").withColumn("component_id", F.coalesce("smallest", "vec_id"))
    return out.select(
        F.col("vec_id").alias(key),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def recall(df: DataFrame, least: float, sample: int = 200, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[int, int]:
    """Links found and links there are, by brute force, of a sample of the rows."""
    rows = nodes_of(df, key, vector, label).filter("node is not null and vec_id is not null")
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    vectors = [np.array(r["vector"], dtype=np.float64) for r in drawn]
    labels = [r["label"] for r in drawn]

    def run(batches):
        for batch in batches:
            links = 0
            for v, own in zip(batch.column("vector"), batch.column("label").to_pylist()):
                v = np.asarray(v.values, dtype=np.float64)
                alike = [_unit(w[None, :])[0] for w, name in zip(vectors, labels) if name == own and len(w) == len(v)]
                if alike:
                    links += int((np.array(alike) @ _unit(v[None, :])[0] >= least).sum())
            yield pa.RecordBatch.from_pydict({"links": pa.array([links], pa.int64())})

    there = rows.select("label", "vector").mapInArrow(run, "links long").agg(F.sum("links")).first()[0] or 0
    ids = df.sparkSession.createDataFrame([(r["vec_id"],) for r in drawn], df.select(F.col(key)).schema)
    found = linked(df, least, key=key, vector=vector, label=label).join(ids, key, "left_semi").agg(F.sum("n_links")).first()[0] or 0
    return found, there - len(drawn)
