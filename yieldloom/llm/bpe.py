"""Byte-level BPE encoding and decoding by DuckDB queries inside each task.

Texts are cut by the tokenizer's pattern. The distinct pieces of a batch become token-position rows of an in-process
DuckDB; a recursive query joins neighbours with the merge table and contracts each piece's leftmost pair of least rank
until no pair is left. Decoding joins ids with the vocabulary and puts the bytes together by an ordered aggregate.

The rank file is a bounded parameter: each task reads it by its path, which every executor must have. Pieces that are
tokens as a whole are looked up, as the format asks. Pieces of more than ``LONG_PIECE`` bytes (a text without breaks)
would need as many rounds as they have bytes; the tokenizer library encodes these one by one, with equal results.

A null text is empty and has no ids. Ids that the vocabulary lacks decode to nothing. Repeated rows stay; columns other
than the key and the text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import small

LONG_PIECE = 512
#: Known pieces that a worker keeps for later batches and tasks; beyond this it starts anew.
KNOWN_PIECES = 500_000
#: Pieces that one encoding query takes, and rows of all its rounds, which its recursion keeps: a piece has at most as many
#: rounds as bytes, so a query takes pieces up to this sum of squared lengths. Token rows that one decoding query aggregates.
QUERY_PIECES = 10_000
QUERY_ROWS = 3_000_000
DECODE_ROWS = 400_000

ENCODE = """
WITH RECURSIVE parts AS (
    SELECT piece, pos, id, pos + 1 AS following, 0 AS round FROM start
    UNION ALL
    SELECT p.piece, p.pos, CASE WHEN p.pos = best.pos THEN best.merged ELSE p.id END,
        CASE WHEN p.pos = best.pos THEN best.beyond ELSE p.following END, p.round + 1
    FROM parts p JOIN (
        SELECT one.piece, min(m.merged) AS merged,
            arg_min(one.pos, m.merged::BIGINT * 4294967296 + one.pos) AS pos,
            arg_min(two.pos, m.merged::BIGINT * 4294967296 + one.pos) AS gone,
            arg_min(two.following, m.merged::BIGINT * 4294967296 + one.pos) AS beyond
        FROM parts one
        JOIN parts two ON two.pos = one.following AND two.piece = one.piece
        JOIN merges m ON m.first = one.id AND m.second = two.id
        GROUP BY one.piece
    ) best ON best.piece = p.piece
    WHERE p.pos <> best.gone
)
SELECT piece, id FROM parts WHERE (piece, round) IN (SELECT (piece, max(round)) FROM parts GROUP BY piece) ORDER BY piece, pos
"""

DECODE = """
SELECT doc, string_agg(chars, '' ORDER BY pos) AS chars FROM ids JOIN vocabulary USING (id) GROUP BY doc
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Numbers(dict):
    """Numbers pieces as they are met."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class Tokenizer:
    """A DuckDB with the merge table and the vocabulary, and the pieces that the task has met so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.pattern_text = pattern
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        pairs = [
            (self.ranks[token[:cut]], self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        merges = np.array(pairs, dtype=np.int32).reshape(-1, 3)
        self._table("merges", first=merges[:, 0], second=merges[:, 1], merged=merges[:, 2])
        # One character for each byte, so that an ordered aggregate of text puts bytes together.
        self._table("vocabulary", id=pa.array(list(self.ranks.values()), pa.int32()), chars=[t.decode("latin-1") for t in self.ranks])
        self.of_byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        self.long = None
        self.forget()

    def _table(self, name: str, **columns) -> None:
        rows = pa.table(columns)
        self.con.register("given", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def forget(self) -> None:
        """Drop the pieces met so far; the merge table and the vocabulary stay."""
        self.number = Numbers()
        self.ends = np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int32)

    def _encode_long(self, piece: bytes) -> list[int]:
        if self.long is None:
            import tiktoken

            self.long = tiktoken.Encoding("own", pat_str=self.pattern_text, mergeable_ranks=self.ranks, special_tokens={})
        return self.long._encode_single_piece(piece)

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces not met before and append their ids to the known ones."""
        raw = [p.encode("utf-8") for p in pieces]
        whole = np.fromiter((self.ranks.get(piece, -1) for piece in raw), np.int64, len(raw))
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        counts = np.ones(len(raw), dtype=np.int64)
        long = {int(i): self._encode_long(raw[i]) for i in np.flatnonzero((whole < 0) & (lengths > LONG_PIECE))}
        for i, ids in long.items():
            counts[i] = len(ids)
        rest = np.flatnonzero((whole < 0) & (lengths <= LONG_PIECE))
        squares = np.cumsum(lengths[rest] ** 2)
        contracted, begin = [], 0
        while begin < len(rest):
            taken = squares[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(squares, taken + QUERY_ROWS, side="right")))
            ids, counts[rest[begin:end]] = self._contracted([raw[i] for i in rest[begin:end]])
            contracted.append(ids)
            begin = end
        # Every piece's ids behind those of the piece before.
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]), dtype=np.int32)
        begins = ends - counts
        flat[begins[whole >= 0]] = whole[whole >= 0]
        for i, ids in long.items():
            flat[begins[i] : ends[i]] = ids
        if contracted:
            ids = np.concatenate(contracted)
            sizes = counts[rest]
            flat[np.repeat(begins[rest] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(ids))] = ids
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])

    def _contracted(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces by the recursive query, one piece's behind the other's, and how many each has."""
        lengths = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        start = pa.table({
            "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths),
            "pos": np.arange(len(data), dtype=np.int32),  # over all pieces, so that a place names a row
            "id": self.of_byte[data],
        })
        self.con.register("start", start)
        found = self.con.execute(ENCODE).fetchnumpy()
        self.con.unregister("start")
        return np.asarray(found["id"]), np.bincount(found["piece"], minlength=len(pieces))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.number) > KNOWN_PIECES:
            self.forget()
        number, known = self.number, len(self.number)
        cut = []
        for text in texts:
            pieces = self.pattern.findall(text)
            cut.append(np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces)))
        if len(number) > known:
            new = list(number)[known:]
            for at in range(0, len(new), QUERY_PIECES):
                self._learn(new[at : at + QUERY_PIECES])
        out = []
        for pieces in cut:
            begin = self.ends[pieces]
            counts = self.ends[pieces + 1] - begin
            total = int(counts.sum())
            offset = np.repeat(begin - (np.cumsum(counts) - counts), counts)
            out.append(self.flat[offset + np.arange(total)])
        return out

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids."""
        out = [b""] * len(lists)
        at = 0
        while at < len(lists):
            to, rows = at, 0
            while to < len(lists) and (to == at or rows + len(lists[to]) <= DECODE_ROWS):
                rows += len(lists[to])
                to += 1
            parts = lists[at:to]
            sizes = np.array([len(x) for x in parts])
            ids = pa.table({
                "doc": np.repeat(np.arange(at, to, dtype=np.int32), sizes),
                "pos": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
                "id": np.concatenate(parts).astype(np.int32),
            })
            self.con.register("ids", ids)
            for doc, chars in self.con.execute(DECODE).fetchall():
                out[doc] = chars.encode("latin-1")
            self.con.unregister("ids")
            at = to
        return out


def worker_tokenizer(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of this worker process: Spark uses a process for many tasks, and the tables take time to load."""
    import sys
    import types

    kept = sys.modules.setdefault("_bpe_of_this_worker", types.ModuleType("_bpe_of_this_worker")).__dict__
    if (path, pattern) not in kept:
        kept[path, pattern] = Tokenizer(path, pattern)
    return kept[path, pattern]


def _slices(texts: list, limit: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about so many characters."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _list_array(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """Rows ``(key, ids)``; with ``decoded`` also the bytes that the ids give again."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for batch in small(batches):
            tokenizer = tokenizer or worker_tokenizer(path, pattern)
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in _slices(texts):
                ids = tokenizer.encode(texts[begin:end])
                columns = {"key": keys.slice(begin, end - begin), "ids": _list_array(ids)}
                if decoded:
                    columns["decoded"] = pa.array(tokenizer.decode(ids), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
    out = rows.mapInArrow(run, f"key {kind}, ids array<int>" + ", decoded binary" * decoded)
    return out.withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows ``(key, decoded)``: the bytes of each list of ids."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = None
        for batch in small(batches):
            tokenizer = tokenizer or worker_tokenizer(path, pattern)
            lists = [np.array([i for i in x if i is not None], dtype=np.int32) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": batch.column(0), "decoded": pa.array(tokenizer.decode(lists), pa.binary())})

    return rows.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


def digest(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of ids, and digests of the ids as decimal text and of the decoded bytes."""
    return coded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
