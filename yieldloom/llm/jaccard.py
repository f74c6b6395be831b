"""Near-duplicate documents by an exact Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles. Two documents link when their sets' Jaccard ratio reaches the
threshold. Under one global order of shingles, similar sets x and y share at least l shingles of their l-prefixes, the
first ``n - need + l`` shingles, for every l up to the overlap ``need`` of that pair of sizes. Each document chooses its own l
(``MOST_SHARED`` at most) from the estimated cost of its candidates (the length of its prefix, and the shingles in it that
very many documents hold), and a pair must share the smaller l of both inside both prefixes before it is verified.

* Global order: shingles that more than a fixed share of all prefix rows hold come last (at most ``1 / COSTLY_SHARE`` of
  them, so the broadcast list is bounded), the others by their number. Order changes cost, never the result.
* Hub rounds: one document of each shingle, likely in the middle of its copies and another each round, is its hub. A document is compared with the hubs that it
  meets most often; whatever links joins a component. So a group of thousands of near copies needs a few comparisons a
  member, not all its pairs. Shingles that only one component holds are then done with. Rounds go on while they pay.
* Exact rest: all pairs of different components that share enough prefix shingles are verified on their whole sets. In
  each shingle the most frequent component is met by the others only.

Documents with equal sets are one node throughout. Null or empty texts have no shingles and link with nothing. Rows
without ``doc_id`` get their shingle count, a null component, and take no part in links. Rows that repeat stay; an id
with several texts has one row for each, placed by its own text. Columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import save
from .interim import release
from .graph import components
from .words import byte_texts, shingle_sets, small

#: A shingle is costly from this share of all prefix rows on, and from this number of documents on.
COSTLY_SHARE = 2.0**-20
COSTLY_LEAST = 16
#: Greatest l a document chooses: more gives fewer pairs to verify, but more common shingles to meet in.
MOST_SHARED = 3
#: So many pairs at most are sent to all tasks, by their document ids; beyond that texts are dealt out by id.
SENT_IDS = 1_000_000
#: A set is made from its text once for so many sets that it is compared with.
LISTED = 1024
#: Costly shingles in its prefix that make all shingles of a document count.
COSTLY_SEVERAL = 4
#: Rounds of comparisons with hubs, at most, and hubs that a document meets in later rounds. The result depends on neither:
#: the exact rest judges whatever they leave.
HUB_ROUNDS, HUBS = 3, 4


def _need(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """Shingles that sets of these sizes share at least; more than the smaller one has if they can't link."""
    return F.ceil((n + m) * percent / (100 + percent) - 1e-9).cast("int")


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can link at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _set_number(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many of the rows hold, ascending, with their counts: at most ``1 / COSTLY_SHARE`` of them."""
    from pyspark.sql import Observation

    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    counts = save(rows.groupBy("shingle").count().filter(F.col("count") >= COSTLY_LEAST), "shingle-counts")
    least = max(COSTLY_LEAST, math.ceil(seen.get["rows"] * COSTLY_SHARE))
    found = counts.filter(F.col("count") >= least).toArrow()
    shingles = found.column("shingle").to_numpy().astype(np.int64)
    order = np.argsort(shingles)
    return shingles[order], found.column("count").to_numpy()[order].astype(np.int32)


def _costly(docs: DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that very many documents hold, with their counts.

    First all documents' plain prefixes are counted. Then, in the documents that hold several costly ones there, the
    shingles that come into the prefix when those go to its end: being of the same passages or copies, they are as frequent.
    """
    if docs.isEmpty():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rows_of(known: np.ndarray | None) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(known)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = sent.value
            for batch in small(batches):
                parts, size = [], 0
                for s in shingle_sets(byte_texts(batch.column(0))):
                    size_of = len(s) - _need(len(s), percent) + 1 if len(s) else 0
                    hot = 0 if first is None else int(_is_in(s[:size_of], first).sum())
                    if first is None:
                        parts.append(s[:size_of])
                    elif hot >= min(COSTLY_SEVERAL, size_of) > 0:
                        longer = size_of * size_of / (size_of - hot + 0.5) * 1.2 + 8
                        parts.append(s[size_of : int(min(len(s), longer))])
                    else:
                        continue
                    size += len(parts[-1])
                    if size > 500_000:
                        yield pa.RecordBatch.from_pydict({"shingle": pa.array(np.concatenate(parts))})
                        parts, size = [], 0
                if size:
                    yield pa.RecordBatch.from_pydict({"shingle": pa.array(np.concatenate(parts))})

        return docs.select("text").mapInArrow(run, "shingle long")

    shingles, counts = _frequent(rows_of(None))
    release(docs.sparkSession)
    if not len(shingles):
        return shingles, counts
    more, more_counts = _frequent(rows_of(shingles))
    old = ~_is_in(shingles, more)
    shingles, counts = np.concatenate([shingles[old], more]), np.concatenate([counts[old], more_counts])
    order = np.argsort(shingles)
    return shingles[order], counts[order]


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values the ascending array holds."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _signatures(docs: DataFrame, percent: int, costly: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Rows ``(doc_id, n, node, ell, base, heat, prefix)``.

    ``base`` + l is the length of the l-prefix, ``heat`` the share of costly shingles in thousandths: among near copies
    the one with the fewest changes has the most.
    """
    sent = docs.sparkSession.sparkContext.broadcast(costly)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def prefix_of(s: np.ndarray) -> tuple[int, int, int, np.ndarray]:
        n, need = len(s), _need(len(s), percent)
        base = n - need
        shingles, counts = sent.value
        hot = _is_in(s, shingles)
        if hot.any():
            rank = counts[np.searchsorted(shingles, s[hot])]
            s = np.concatenate([s[~hot], s[hot][np.argsort(rank, kind="stable")]])
        stuck = max(0, base + 1 - int(n - hot.sum()))
        ell = min(need, MOST_SHARED, 1 + int(math.log2(1 + (base + 1) / 8)) + stuck)
        return ell, base, 1000 * int(hot.sum()) // n, s[: base + ell]

    def of_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, nodes, ells, bases, heats, prefixes = [], [], [], [], [], []
        for s in shingle_sets(byte_texts(batch.column(1))):
            ell, base, heat, prefix = prefix_of(s) if len(s) else (0, 0, 0, s)
            sizes.append(len(s))
            nodes.append(_set_number(s) if len(s) else None)
            ells.append(ell)
            bases.append(base)
            heats.append(heat)
            prefixes.append(prefix)
        ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n": pa.array(sizes, pa.int32()), "node": pa.array(nodes, pa.int64()),
            "ell": pa.array(ells, pa.int32()), "base": pa.array(bases, pa.int32()), "heat": pa.array(heats, pa.int32()),
            "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes))),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1024):
            yield of_rows(batch)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n int, node long, ell int, base int, heat int, prefix array<long>")


def _whole_sets(docs: DataFrame, nodes: DataFrame, few: bool) -> DataFrame:
    """Rows ``(node, n, shingles, others)`` for rows ``(doc_id, node, others)``, from the documents of these ids."""

    def of_sets(parts: list[tuple[np.ndarray, int, list[int]]]) -> pa.RecordBatch:
        sets, numbers, others = zip(*parts)
        sizes = np.array([len(s) for s in sets], np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.RecordBatch.from_pydict({
            "node": pa.array(numbers, pa.int64()), "n": pa.array(sizes),
            "shingles": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets))),
            "others": pa.array(others, pa.list_(pa.int64())),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            parts: list[tuple[np.ndarray, int, list[int]]] = []
            size = 0
            numbers, others = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for s, node, to in zip(shingle_sets(byte_texts(batch.column(0))), numbers, others):
                if len(s) and _set_number(s) == node:  # an id may have other texts
                    parts.append((s, node, to))
                    size += len(s)
                if size > 500_000:
                    yield of_sets(parts)
                    parts, size = [], 0
            if parts:
                yield of_sets(parts)

    texts = docs.select("doc_id", "text").join(F.broadcast(nodes) if few else nodes, "doc_id").select("text", "node", "others")
    return texts.mapInArrow(run, "node long, n int, shingles array<long>, others array<long>")


def _verified(docs: DataFrame, first: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs ``(a, b)`` whose whole sets reach the threshold.

    The sets are made from the texts for this one use and not written: ``a``'s goes from the text to each ``b``, so only one
    join deals out sets. ``first`` has rows ``(node, doc_id)``.
    """
    few = pairs.count() <= SENT_IDS
    place = F.row_number().over(Window.partitionBy("a").orderBy("b"))
    lists = pairs.withColumn("part", F.floor((place - 1) / LISTED)).groupBy(F.col("a").alias("node"), "part")
    lists = lists.agg(F.collect_list("b").alias("others")).join(first, "node").select("doc_id", "node", "others")
    ends = pairs.select(F.col("b").alias("node")).distinct().join(first, "node")
    ends = ends.select("doc_id", "node", F.array().cast("array<long>").alias("others"))
    left = _whole_sets(docs, lists, few)
    left = left.select(F.col("node").alias("a"), F.explode("others").alias("b"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = _whole_sets(docs, ends, few)
    right = right.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    shared = left.join(right, "b").select("a", "b", (F.col("na") + F.col("nb")).alias("both"), F.size(F.array_intersect("sa", "sb")).alias("shared"))
    return shared.filter(F.col("shared") * 100 >= (F.col("both") - F.col("shared")) * percent).select("a", "b").distinct()


def _contested(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """Prefix rows with their component, without the shingles that one component alone holds."""
    plain = rows.select("shingle", "node", "n", "ell", "heat", "pos")
    if links is None:
        return plain.withColumn("root", F.col("node"))
    placed = plain.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    shared = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return placed.join(shared.select("shingle"), "shingle")


def _links(docs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Links that give the right components: not every pair of a component is among them."""
    keyed = signatures.filter("node is not null and doc_id is not null")
    rows = keyed.select("node", F.posexplode("prefix").alias("pos", "shingle"))
    shared = rows.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    shared = save(shared.select("shingle"), "shared-shingles")
    release(docs.sparkSession)
    live = rows.join(shared, "shingle").dropDuplicates(["shingle", "node"])
    facts = keyed.select("node", "n", "ell", "heat").distinct()
    live = save(live.join(facts, "node"), "shared-prefixes")
    release(docs.sparkSession)

    first = save(keyed.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "first-documents")
    open_rows, links = _contested(live, None), None
    alike = _sizes_fit(F.col("n"), F.col("hub.n"), percent)
    alike &= F.col("pos") < F.col("n") - _overlap(F.col("n"), F.col("hub.n"), percent) + F.col("ell")
    for turn in range(HUB_ROUNDS):
        if turn:
            open_rows = save(_contested(open_rows, links), "open-prefixes")
            release(docs.sparkSession)
        # Documents in the middle of a group of copies first, and others each turn.
        luck = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(200)) if turn else F.lit(0)
        hub = F.max(F.struct((F.col("heat") + luck).alias("lot"), F.xxhash64("node", F.lit(turn)).alias("tie"), "node", "root", "n")).alias("hub")
        hubs = open_rows.groupBy("shingle").agg(hub)
        met = open_rows.join(hubs, "shingle").filter((F.col("hub.root") != F.col("root")) & alike)
        counts = met.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count(F.lit(1)).alias("times"), F.first("ell").alias("ell"))
        counts = counts.filter("times * 2 >= ell")
        # The hubs met most often; sorted lists of bounded length, cut before the shuffle.
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("times"), "hub"))
        best = counts.withColumn("place", place).filter(F.col("place") <= (HUBS if turn else 1))
        pairs = save(best.select(F.col("node").alias("a"), F.col("hub").alias("b")), "hub-pairs")
        release(docs.sparkSession)
        found = save(_verified(docs, first, pairs, percent), "links")
        news = found.count()
        if not news:
            break
        links = found if links is None else links.unionByName(found)
        release(docs.sparkSession)
        if news * 25 < pairs.count():
            break
    open_rows = _contested(open_rows, links)

    # Each shingle's most frequent component is met by the others, and never by itself.
    largest = open_rows.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("held"))
    largest = largest.groupBy("shingle").agg(F.max(F.struct("held", "root")).alias("largest"))
    open_rows = open_rows.join(largest.select("shingle", F.col("largest.root").alias("largest")), "shingle")
    open_rows = save(open_rows, "open-prefixes")
    release(docs.sparkSession)
    x, y = open_rows.filter("root <> largest").alias("x"), open_rows.alias("y")
    need = _overlap(F.col("x.n"), F.col("y.n"), percent)
    ell = F.least("x.ell", "y.ell")
    met = x.join(y, F.col("x.shingle") == F.col("y.shingle")).filter(
        (F.col("x.root") != F.col("y.root"))
        & _sizes_fit(F.col("x.n"), F.col("y.n"), percent)
        & ((F.col("y.root") == F.col("y.largest")) | (F.col("x.node") < F.col("y.node")))
        & (F.col("x.pos") < F.col("x.n") - need + ell) & (F.col("y.pos") < F.col("y.n") - need + ell)
    )
    low, high = F.least("x.node", "y.node"), F.greatest("x.node", "y.node")
    counts = met.groupBy(low.alias("a"), high.alias("b")).agg(F.count(F.lit(1)).alias("times"), F.first(ell).alias("ell"))
    pairs = save(counts.filter("times >= ell").select("a", "b"), "rest-pairs")
    release(docs.sparkSession)
    found = save(_verified(docs, first, pairs, percent), "links")
    release(docs.sparkSession)
    return found if links is None else links.unionByName(found)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """Rows ``(key, n_shingles, component_id)``, one for each row of ``df``."""
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    signatures = save(_signatures(docs, percent, _costly(docs, percent)), "signatures")
    release(df.sparkSession)
    roots = components(_links(docs, signatures, percent))
    plain = signatures.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "node")
    placed = plain.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    out = placed.join(smallest, "root", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id"))
    return out.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"))
