"""Token ids packed into rows of fixed length by best fit decreasing.

Each task encodes its own documents, cuts documents longer than a row into
row-long pieces and a rest, and packs the pieces of a window of bounded size:
longest first, each into the row with the least room that still holds it,
found by a segment tree over the amounts of room. Nothing is shuffled; a row's
documents come from one window, so at most a few rows a window stay part-full.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from fleetspark.llm.common import column_names, small_batches, table
from fleetspark.llm.pretokens import fill, pre_tokens

TOKENIZER = "byte_bpe_50k.json"
ROW = 2048
WINDOW = 4 << 20
SCHEMA = ("pack_id long, n_tokens int, ids binary, positions binary, cu_seqlens array<int>, "
          "doc_ids array<long>, doc_starts array<int>")

_known: dict[str, dict[str, bytes]] = {}


class RoomTree:
    """Segment tree over amounts of room 0..top; each node counts the open rows
    below it. ``at_least`` finds the least amount that holds a piece."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        i = room + self.leaves
        while i:
            self.open[i] += n
            i >>= 1

    def at_least(self, need: int) -> int | None:
        i = need + self.leaves
        if self.open[i]:
            return need
        while i > 1 and (i & 1 or not self.open[i + 1]):  # up until a right sibling has rows
            i >>= 1
        if i <= 1:
            return None
        i += 1
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit(lengths: list[int], top: int) -> list[list[int]]:
    """Rows as lists of piece numbers; every length is 1..top."""
    tree, waiting, rows = RoomTree(top), defaultdict(list), []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        room = tree.at_least(lengths[k])
        if room is None:
            row, room = len(rows), top
            rows.append([])
        else:
            row = waiting[room].pop()
            tree.add(room, -1)
        rows[row].append(k)
        if room > lengths[k]:
            waiting[room - lengths[k]].append(row)
            tree.add(room - lengths[k], 1)
    return rows


def _encoded(path: str, texts: list[str], kind: type) -> list[np.ndarray]:
    """Ids of each text, from the worker's cache of pre-tokens."""
    codec, known = pre_tokens(path), _known.setdefault(path, {})
    split = [codec.of(t) for t in texts]
    fill(known, {}, set().union(*(s for s in split if s is not None)),
         lambda asked: [np.array(x, kind).tobytes() for x in codec.ids(asked)])
    whole = iter(codec.ids([t for t, s in zip(texts, split, strict=True) if s is None]))
    return [np.array(next(whole), kind) if s is None
            else np.frombuffer(b"".join(map(known.__getitem__, s)), kind) for s in split]


def pack_documents(docs: DataFrame, path: str, row: int = ROW, pad: int = 0, window: int = WINDOW) -> DataFrame:
    """Packed id rows of all texts of ``docs`` (doc_id, text).

    ids and positions are little-endian vectors of exactly ``row`` entries
    (uint16, uint32 for vocabularies over 65,536): one row of an id matrix,
    filled up with ``pad`` after n_tokens. positions restart at 0 with each
    piece; cu_seqlens holds the pieces' bounds, from 0 to n_tokens; doc_ids and
    doc_starts tell whose tokens a piece holds and from which one on, so that
    every document can be put together again. Null and empty texts have no
    tokens and make no piece; a null doc_id and repeated rows are packed like
    any other. An empty table gives no rows. Further columns are ignored."""
    small_batches(docs.sparkSession)

    def packed(pieces: list[tuple[int | None, int, np.ndarray]], first: int, kind: type) -> Iterator[dict]:
        for n, members in enumerate(best_fit([len(p[2]) for p in pieces], row)):
            own = [pieces[k] for k in members]
            bounds = np.cumsum([0, *(len(p[2]) for p in own)])
            ids, positions = np.full(row, pad, kind), np.zeros(row, kind)
            for p, a, b in zip(own, bounds, bounds[1:], strict=False):
                ids[a:b], positions[a:b] = p[2], np.arange(b - a)
            yield {"pack_id": first + n, "n_tokens": int(bounds[-1]), "ids": ids.tobytes(),
                   "positions": positions.tobytes(), "cu_seqlens": bounds.tolist(),
                   "doc_ids": [p[0] for p in own], "doc_starts": [p[1] for p in own]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype("<u4" if pre_tokens(path).wide else "<u2")
        next_id, held, pieces = TaskContext.get().partitionId() << 33, 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, held, pieces
            rows = list(packed(pieces, next_id, kind))
            next_id, held, pieces = next_id + len(rows), 0, []
            for i in range(0, len(rows), 512):
                yield pa.RecordBatch.from_pylist(rows[i:i + 512], schema=out)

        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), _encoded(path, [t or "" for t in b.column(1).to_pylist()], kind),
                                strict=True):
                for start in range(0, len(ids), row):
                    pieces.append((doc, start, ids[start:start + row]))
                held += len(ids)
                if held >= window:
                    yield from flush()
        yield from flush()

    out = pa.schema([("pack_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary()),
                     ("cu_seqlens", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())),
                     ("doc_starts", pa.list_(pa.int32()))])
    return column_names(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def unpack(row: dict, wide: bool = False) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, first token's number, ids) of each piece of a packed row."""
    ids = np.frombuffer(row["ids"], "<u4" if wide else "<u2")
    for doc, start, a, b in zip(row["doc_ids"], row["doc_starts"], row["cu_seqlens"], row["cu_seqlens"][1:], strict=False):
        yield doc, start, ids[a:b]


def op2_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
