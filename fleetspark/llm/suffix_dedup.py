"""Removal of long repeated byte strings by a distributed suffix sort.

1. Anchors. Of the positions where a window (a string of ``length`` bytes)
   starts, each has one anchor: the least hash among its first STRIDE
   positions. Equal windows have their anchor at the same place, so sorting
   the suffixes at anchors, with the bytes to their left, finds all equal
   windows; an anchor serves a contiguous range of window starts.
2. Filter. The suffix at an anchor begins with ``length - STRIDE + 1`` bytes
   that its windows share; anchors whose beginning occurs once in the corpus
   (by 64-bit fingerprints, counted by one grouped aggregation) are unique and
   stop here.
3. Merge sort. Each task sorts its own suffixes into runs, equal ones as one
   entry with a count, and exchanges them front-coded: an entry is the length
   of the prefix it shares with the entry before, and the rest. The sort key
   starts with the fingerprint, whose range decides the receiving task: equal
   beginnings meet, and ranges are even without a sample. The receiver merges
   the runs with a loser tree that never re-compares known prefixes.
4. Windows. Along the merged order, neighbours' common prefixes and common
   left contexts give each entry's repeated windows. A beginning with more
   anchors than GROUP (known from the count of step 2) takes no part in the
   runs: its windows go out from where the text is read, once per different
   entry of a run, as 128-bit digests, and a grouped count finds the equal
   ones. So no task receives more of one beginning than GROUP entries (some 60 MB).
5. Removal. Repeated windows are laid over their texts.

Equal texts are one text with a count: all of a text that occurs twice and is
long enough goes. Only texts with anchors left are read a second time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, column_names, map_rows, small_batches, table
from fleetspark.llm.suffix_runs import common, decoded, front_coded, merged

LENGTH = 400
STRIDE = 256
GRAM = 16
RUN_BYTES = 48 << 20
WINDOWS = 20_000
PART_ENTRIES = 60_000
GROUP = 65_536
PAIRS = 12
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def anchors(data: bytes, length: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window start, last window start) of all windows of ``data``."""
    n = len(data) - length + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    for k, c in enumerate(_C):  # grams of 2, 4, 8 and 16 bytes
        h = h[:-(1 << k)] * c + h[1 << k:]
    h ^= h >> np.uint64(29)
    h *= _C[0]
    place = np.uint64(max(1, len(data).bit_length()))
    h = (h >> place << place) | np.arange(len(h), dtype=np.uint64)  # of equal hashes, the leftmost
    span = 1
    while span < stride:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    at = (h[:n] & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], first, np.r_[first[1:] - 1, n - 1]


def _extract(length: int, stride: int):
    fixed = length - stride + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc, digest, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                p, lo, hi = anchors(data, length, stride)
                found = [{"p": x, "lo": y, "hi": z, "mark": xxhash.xxh3_64_intdigest(data[x:x + fixed]) - (1 << 63)}
                         for x, y, z in zip(p.tolist(), lo.tolist(), hi.tolist(), strict=True)]
                for k, v in zip(out, (row, doc, digest, len(data), hashlib.sha256(data).hexdigest(), found), strict=True):
                    out[k].append(v)
                row += 1
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    spot = pa.struct([("p", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("mark", pa.int64())])
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.string()), ("n_bytes", pa.int64()),
                        ("sha", pa.string()), ("spots", pa.list_(spot))])
    return run, ("row long, doc_id long, digest string, n_bytes long, sha string, "
                 "spots array<struct<p:int,lo:int,hi:int,mark:long>>")


def _class(key: bytes, left: bytes) -> bytes:
    return xxhash.xxh3_128_digest(len(left).to_bytes(4, "little") + left + key)


def _runs(length: int, bounds: list[int]):
    """Sorted front-coded runs of a task's suffixes, the windows of those with a
    large beginning (offset, digest, count), and who holds what."""
    columns = ("part", "run", "block", "digest", "p", "cls", "o", "window", "n")

    def batch(rows: int, /, **given: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c: given.get(c, [None] * rows) for c in columns}, schema=schema)

    def windows(entries: dict[tuple[bytes, bytes], int]) -> Iterator[pa.RecordBatch]:
        cls, o, window, n = [], [], [], []
        for (k, left), count in entries.items():
            name, whole = _class(k, left), left + k[8:]
            for at in range(len(whole) - length + 1):
                cls.append(name)
                o.append(len(left) - at)
                window.append(xxhash.xxh3_128_digest(whole[at:at + length]))
                n.append(count)
            if len(cls) > WINDOWS:
                yield batch(len(cls), cls=cls, o=o, window=window, n=n)
                cls, o, window, n = [], [], [], []
        yield batch(len(cls), cls=cls, o=o, window=window, n=n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], int] = {}
        large: dict[tuple[bytes, bytes], int] = {}
        number, size = TaskContext.get().partitionId() << 20, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, large, number, size
            yield from windows(large)
            order = sorted(held)
            parts = [bisect_right(bounds, int.from_bytes(k[:8], "big")) for k, _ in order]
            start = 0
            while start < len(order):
                end = bisect_right(parts, parts[start])
                block = front_coded((k, left, held[k, left]) for k, left in order[start:end])
                yield batch(1, part=[parts[start]], run=[number], block=[block])
                start = end
            held, large, number, size = {}, {}, number + 1, 0

        for b in batches:
            who: list[tuple[str, int, bytes]] = []
            for digest, text, found in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for spot in found:
                    p, lo, hi, mark = spot["p"], spot["lo"], spot["hi"], spot["mark"]
                    key, left = (mark + (1 << 63)).to_bytes(8, "big") + data[p:hi + length], data[lo:p]
                    into = large if spot["large"] else held
                    into[key, left] = into.get((key, left), 0) + 1
                    size += len(key) + len(left) + 150
                    who.append((digest, p, _class(key, left)))
                if size > RUN_BYTES:
                    yield from flush()
            yield batch(len(who), digest=[w[0] for w in who], p=[w[1] for w in who], cls=[w[2] for w in who])
        yield from flush()

    schema = pa.schema([("part", pa.int32()), ("run", pa.int64()), ("block", pa.binary()), ("digest", pa.string()),
                        ("p", pa.int32()), ("cls", pa.binary()), ("o", pa.int32()), ("window", pa.binary()), ("n", pa.int64())])
    return run, "part int, run long, block binary, digest string, p int, cls binary, o int, window binary, n long"


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def repeated_offsets(entries: list[tuple[bytes, int, bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """For sorted (key, prefix shared with the one before, left, count) entries of
    one beginning: the ranges of offsets o for which the window of the last o
    bytes of left and length - o bytes from the anchor also is elsewhere."""
    m = len(entries)
    size = [len(e[0]) - 8 for e in entries]
    least, most = [length - s for s in size], [len(e[2]) for e in entries]
    out: list[list[tuple[int, int]]] = [[(least[i], most[i])] if entries[i][3] > 1 else [] for i in range(m)]
    if m <= PAIRS:
        back = [e[2][::-1] for e in entries]
        for i in range(m):
            shared = size[i]
            for j in range(i + 1, m):
                shared = min(shared, entries[j][1] - 8)
                a = max(length - shared, least[i], least[j])
                b = min(common(back[i], back[j]), most[i], most[j])
                if a <= b:
                    out[i].append((a, b))
                    out[j].append((a, b))
        return [_joined(x) for x in out]
    top = max(most)
    lefts = np.zeros((m, top + 1), np.uint8)
    for i, e in enumerate(entries):
        lefts[i, 1:most[i] + 1] = np.frombuffer(e[2][::-1], np.uint8)
    shared = np.array([e[1] - 8 for e in entries])
    shared[0] = 0
    low, high, often = np.array(least), np.array(most), np.array([e[3] > 1 for e in entries])
    hashed = np.zeros(m, np.uint64)
    hits = [[] for _ in range(m)]
    for o in range(top + 1):
        if o:
            hashed = (hashed ^ (hashed >> np.uint64(31))) * _C[1] + (lefts[:, o].astype(np.uint64) + np.uint64(1)) * _C[3]
        here = np.flatnonzero((low <= o) & (o <= high))
        if len(here) < 2:
            continue
        segment = np.cumsum(shared < length - o).astype(np.uint64)
        mixed = (hashed[here] ^ (segment[here] * _C[0])) * _C[2]
        _, inverse, counts = np.unique(mixed, return_inverse=True, return_counts=True)
        for i in here[(counts[inverse] > 1) & ~often[here]]:
            hits[i].append(o)
    return [_joined(out[i] + [(o, o) for o in hits[i]]) for i in range(m)]


def _merge(length: int, stride: int):
    """Merges a part's runs; ranges of repeated offsets by class."""
    fixed = 8 + length - stride + 1

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        runs = [decoded(b) for b in pdf.sort_values("run")["block"]]
        out: list[tuple] = []
        waiting: list[tuple[bytes, int, bytes, int]] = []

        def close() -> None:
            if len(waiting) > 1 or waiting and waiting[0][3] > 1:
                for e, ranges in zip(waiting, repeated_offsets(waiting, length), strict=True):
                    if ranges:
                        cls = _class(e[0], e[2])
                        out.extend((cls, a, b) for a, b in ranges)

        for entry in merged(runs):
            if waiting and entry[1] >= fixed:
                last = waiting[-1]
                if entry[1] == len(entry[0]) == len(last[0]) and entry[2] == last[2]:
                    waiting[-1] = (last[0], last[1], last[2], last[3] + entry[3])
                    continue
                waiting.append(entry)
            else:
                close()
                waiting = [entry]
        close()
        return pd.DataFrame(out, columns=["cls", "a", "b"]).astype({"a": "int32", "b": "int32"})

    return run, "cls binary, a int, b int"


def _ranges(cols: dict[str, list]) -> dict[str, list]:
    """Offsets of a class as ranges."""
    found = [(cls, a, b) for cls, offsets in zip(cols["cls"], cols["offsets"], strict=True) for a, b in _joined([(o, o) for o in offsets])]
    return {k: [f[i] for f in found] for i, k in enumerate(("cls", "a", "b"))}


def _removed(cols: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("digest", "n_removed", "n_spans", "kept_sha256")}
    for digest, text, ranges in zip(cols["digest"], cols["text"], cols["ranges"], strict=True):
        data = text.encode("utf-8", "surrogatepass")
        kept, removed, at = hashlib.sha256(), 0, 0
        spans = _joined([(r["a"], r["b"] - 1) for r in ranges])
        for a, b in spans:
            kept.update(data[at:a])
            removed, at = removed + b + 1 - a, b + 1
        kept.update(data[at:])
        for k, v in zip(out, (digest, removed, len(spans), kept.hexdigest()), strict=True):
            out[k].append(v)
    return out


def _repeats(docs: DataFrame, length: int, stride: int, group: int, scratch: Scratch):
    """(rows, copies, texts with repeats and their byte ranges). rows: one per row
    of docs; copies: count by text digest; the last is None without repeats."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = column_names(docs, "doc_id", "text").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    extract, schema = _extract(length, stride)
    every = scratch.save(texts.mapInArrow(extract, schema))
    copies = scratch.save(every.groupBy("digest").agg(F.min("row").alias("row"), F.min("doc_id").alias("one"), F.count(F.lit(1)).alias("n")))
    placed = (every.join(copies.select("row", "one"), "row").select("digest", "one", F.explode("spots").alias("spot"))
              .select("digest", "one", "spot", F.col("spot.mark").alias("mark")))
    # (written first, so that the join has an exchange of its own and a very common mark can be split)
    twice = scratch.save(placed.groupBy("mark").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                         .select("mark", (F.col("m") > group).alias("large")))
    spot = F.struct("spot.p", "spot.lo", "spot.hi", "spot.mark", "large")
    survivors = scratch.save(placed.join(twice, "mark").groupBy("digest", "one").agg(F.collect_list(spot).alias("found")))
    entries, large = survivors.agg(F.sum(F.size(F.filter("found", lambda x: ~x["large"]))),
                                   F.sum(F.size(F.filter("found", lambda x: x["large"])))).first()
    if not (entries or large):
        return every, copies, None
    # One row of each text: equal rows of its least doc_id are one after the join below.
    again = (texts.join(survivors.select(F.col("digest").alias("d"), "one", "found"),
                        (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("one")))
             .select("digest", "text", "found"))
    again = scratch.save(again)
    parts = max(1, -(-entries // PART_ENTRIES))
    bounds = [(i << 64) // parts for i in range(1, parts)]
    runs, schema = _runs(length, bounds)
    sorted_runs = scratch.save(again.mapInArrow(runs, schema))
    merge, schema = _merge(length, stride)
    found = scratch.save(sorted_runs.where("block is not null").select("part", "run", "block")
                         .groupBy("part").applyInPandas(merge, schema))
    ranges = found
    if large:
        windows = sorted_runs.where("window is not null").select("cls", "o", "window", "n")
        equal = windows.groupBy("window").agg(F.sum("n").alias("all")).where("all > 1").select("window")
        offsets = windows.join(equal, "window").groupBy("cls").agg(F.collect_set("o").alias("offsets"))
        ranges = found.union(map_rows(offsets, _ranges, "cls binary, a int, b int"))
    covered = (sorted_runs.where("digest is not null").select("digest", "p", "cls").join(ranges, "cls")
               .groupBy("digest").agg(F.collect_list(F.struct((F.col("p") - F.col("b")).alias("a"),
                                                              (F.col("p") - F.col("a") + length).alias("b"))).alias("ranges")))
    return every, copies, again.select("digest", "text").join(covered, "digest")


def remove_repeats(docs: DataFrame, length: int = LENGTH, stride: int = STRIDE, group: int = GROUP) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes (UTF-8),
    n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes that
    remain), touched (whether any byte is removed).

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else in the texts, the same text included; matches overlap, never
    cross texts and are judged on the input. A null text is empty. Repeated
    rows are copies of each other and so go whole if long enough. Null ids and
    equal ids with different texts are texts like any other; further columns
    are ignored. ``stride`` is a power of two below ``length`` - GRAM + 2."""
    if stride & (stride - 1) or stride + GRAM - 1 > length:
        raise ValueError(f"stride {stride} does not fit strings of {length} bytes")
    every, copies, touched = _repeats(docs, length, stride, group, scratch := Scratch(docs.sparkSession, "suffixes"))
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    rows = every.select("doc_id", "digest", "n_bytes", "sha").join(copies.select("digest", "n"), "digest")
    if touched is None:
        rows = rows.withColumns({"n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"), "kept_sha256": F.col("sha")})
    else:
        cut = scratch.save(map_rows(touched, _removed, "digest string, n_removed long, n_spans long, kept_sha256 string")
                           .dropDuplicates(["digest"]))
        rows = rows.join(cut, "digest", "left")
    out = rows.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
    return out.withColumn("touched", F.col("n_removed") > 0)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
