"""Alignment of two tokenizers over the bytes of the same texts.

The tokens of each tokenizer make a token-byte incidence matrix in compressed
rows (CSR). Row products of one matrix with the transposed other (Gustavson:
a row of the product is the sum of the rows that its entries name) give the
links: of whole tokens the bytes they share, of last bytes the tokens that end
together; products of token-group incidence give the tokens of one group.
Both tokenizers cut a text before a space that follows another character, so
texts are aligned by such segments, those of a batch in one product,
and each different segment of a batch is encoded and aligned once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, column_names, small_batches, table
from fleetspark.llm.pieces import MARK, NORMAL, UNUSED, USER_DEFINED, PieceModel

TOKENIZER, MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
KINDS = ("overlap", "end", "group")
#: Bytes of text that one output batch holds, unless a single text is longer.
BATCH_BYTES = 4 << 20
#: Segments that are encoded as one text.
JOINED = 2_000
#: Most rows of the broadcast table of frequent pairs.
FREQUENT = 1 << 18
CLOSED_END = re.compile("[^\\s\u180e]\\Z")
SEGMENT_START = re.compile("(?<=[^\\s\u180e])(?= )")


# --- incidence matrices -------------------------------------------------------------

class Csr(NamedTuple):
    """Compressed rows: row i has the columns indices[starts[i]:starts[i + 1]]."""
    starts: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    n_cols: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def by_rows(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n_rows: int, n_cols: int) -> Csr:
    """The matrix of entries whose rows ascend."""
    starts = np.zeros(n_rows + 1, np.int64)
    np.cumsum(np.bincount(rows, minlength=n_rows), out=starts[1:])
    return Csr(starts, cols, values, n_cols)


def token_bytes(lengths: np.ndarray) -> Csr:
    """Tokens that follow each other over a run of bytes."""
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64), int(starts[-1]))


def last_bytes(m: Csr) -> Csr:
    """Of each token only its last byte."""
    n = len(m.starts) - 1
    return Csr(np.arange(n + 1), m.indices[m.starts[1:] - 1], np.ones(n, np.int64), m.n_cols)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.indices, kind="stable")
    return by_rows(m.indices[order], m.rows()[order], m.values[order], m.n_cols, len(m.starts) - 1)


def product(a: Csr, b: Csr) -> Csr:
    """a times b, row by row: each entry (i, k) of a brings row k of b to row i."""
    reach = np.diff(b.starts)[a.indices]
    total = int(reach.sum())
    at = np.arange(total) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(b.starts[a.indices], reach)
    key = np.repeat(a.rows(), reach) * b.n_cols + b.indices[at]
    found, place = np.unique(key, return_inverse=True)
    sums = np.bincount(place, weights=np.repeat(a.values, reach) * b.values[at], minlength=len(found)).astype(np.int64)
    return by_rows(found // b.n_cols, found % b.n_cols, sums, len(a.starts) - 1, b.n_cols) if total else \
        Csr(np.zeros(len(a.starts), np.int64), np.empty(0, np.int64), np.empty(0, np.int64), b.n_cols)


class Links(NamedTuple):
    """Groups as the number of tokens of each side; links (row, column, value) by kind."""
    a_groups: np.ndarray
    b_groups: np.ndarray
    by_kind: dict[str, Csr]


def align(a_lengths: np.ndarray, b_lengths: np.ndarray, kinds: tuple[str, ...] = KINDS) -> Links:
    """Links of two tokenizations, given by token lengths, of the same bytes."""
    a, b = token_bytes(a_lengths), token_bytes(b_lengths)
    a_end, b_end = last_bytes(a), last_bytes(b)
    end = product(a_end, transposed(b_end))
    cut = np.zeros(a.n_cols + 1, np.int64)
    cut[a_end.indices[end.rows()] + 1] = 1  # bytes after which both cut
    group = np.cumsum(cut)[:-1]
    n = int(group[-1]) + 1 if len(group) else 0
    ones = np.ones
    a_in = Csr(np.arange(len(a_lengths) + 1), group[a_end.indices], ones(len(a_lengths), np.int64), n)
    b_in = Csr(np.arange(len(b_lengths) + 1), group[b_end.indices], ones(len(b_lengths), np.int64), n)
    found = {"end": end}
    if "overlap" in kinds:
        found["overlap"] = product(a, transposed(b))
    if "group" in kinds:
        found["group"] = product(a_in, transposed(b_in))
    return Links(np.bincount(a_in.indices, minlength=n), np.bincount(b_in.indices, minlength=n), {k: found[k] for k in kinds})


# --- tokenizers -----------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def splits_at_spaces(path: str) -> bool:
    """Whether a tokenizers file is a byte-level BPE over the published pre-tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (spec["model"]["type"] == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True))


class Pair:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str, kinds: tuple[str, ...]):
        import sentencepiece
        from tokenizers import Tokenizer

        self.kinds = kinds
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters = byte_alphabet()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        m = PieceModel(path_b)
        self.b_bytes = [bytes([self._byte(p)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, (p, _, _) in enumerate(m.pieces)]
        self.a_length, self.b_length = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        usable = [p for p, _, kind in m.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)]
        self.mark = next((i for i, (p, _, _) in enumerate(m.pieces) if p == MARK), None)
        self.cuts = (splits_at_spaces(path_a) and m.dummy_prefix and m.escape and not m.charsmap and not m.squeeze
                     and self.mark is not None and not any(MARK in p.lstrip(MARK) for p in usable))

    @staticmethod
    def _byte(piece: str) -> int:
        return int(piece[3:-1], 16)

    def segments(self, text: str) -> list[str]:
        """Parts of " " + text that both tokenizers encode alone as in the text."""
        if not text:
            return []
        return SEGMENT_START.split(" " + text) if self.cuts else [" " + text]

    def columns(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each column's values and where each text's begin; a text that does not
        come back has none. Every different segment is encoded and aligned once."""
        split = [self.segments(t) for t in texts]
        groups = self._groups(list(dict.fromkeys(chain.from_iterable(split))))
        place = {s: i for i, s in enumerate(chain.from_iterable(groups))}
        used = np.fromiter(map(place.__getitem__, chain.from_iterable(split)), np.int64)
        good, layouts = self._aligned(groups)
        text = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        whole = np.bincount(text[~good[used]], minlength=len(texts)) == 0
        stays = whole[text]
        used, text = used[stays], text[stays]
        out = []
        for starts, columns in layouts:
            reach = (starts[1:] - starts[:-1])[used]
            at = np.arange(reach.sum()) + np.repeat(starts[used] - np.cumsum(reach) + reach, reach)
            begins = np.zeros(len(texts) + 1, np.int64)
            np.cumsum(np.bincount(text, weights=reach, minlength=len(texts)), out=begins[1:])
            out += [(values[at], begins) for values in columns]
        return out

    def _groups(self, segments: list[str]) -> list[list[str]]:
        """Segments that can be encoded as one text: after one that ends in a
        space nothing would be cut."""
        if not self.cuts:
            return [[s] for s in segments]
        alone = [s for s in segments if not CLOSED_END.search(s)]
        joined = [s for s in segments if CLOSED_END.search(s)] if alone else segments
        return [joined[i:i + JOINED] for i in range(0, len(joined), JOINED)] + [[s] for s in alone]

    def _encoded(self, group: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "".join(group)
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = [self.mark] if text == " " and self.cuts else self.b.encode(text[1:])
        return np.array(a, np.int32), np.array(b, np.int32)

    def _tokens(self, group: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of both sides, how many each segment has, and whether it comes
        back; a group that does not is tried segment by segment."""
        raw = [s.encode() for s in group]
        ends, whole, out = np.cumsum([len(r) for r in raw]), b"".join(raw), []
        for ids, entries, lengths in zip(self._encoded(group), (self.a_bytes, self.b_bytes), (self.a_length, self.b_length), strict=True):
            if b"".join(map(entries.__getitem__, ids.tolist())) != whole:
                break
            at = np.cumsum(lengths[ids])
            last = np.searchsorted(at, ends)
            if (at[last] != ends).any():
                break
            out += [ids, np.diff(last, prepend=-1)]
        else:
            return [(*out, np.ones(len(group), bool))]
        if len(group) > 1:
            return [x for s in group for x in self._tokens([s])]
        none, zero = np.empty(0, np.int32), np.zeros(1, np.int64)
        return [(none, zero, none, zero, np.zeros(1, bool))]

    def _aligned(self, groups: list[list[str]]) -> tuple[np.ndarray, list[tuple[np.ndarray, list[np.ndarray]]]]:
        """Which segments come back, and by layout (where each segment's values
        begin) the columns in their order."""
        parts = [x for g in groups for x in self._tokens(g)]
        none = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool))
        a_ids, a_n, b_ids, b_n, good = map(np.concatenate, zip(none, *parts, strict=True))
        a_at, b_at = (np.concatenate([[0], np.cumsum(n)]) for n in (a_n, b_n))
        links = align(self.a_length[a_ids], self.b_length[b_ids], self.kinds)
        # a segment's last byte ends a token on both sides, so no group or link crosses segments
        g_at = np.searchsorted(np.cumsum(links.a_groups), a_at, "right")
        g_at[0] = 0
        layouts = [(a_at, [a_ids]), (b_at, [b_ids]), (g_at, [links.a_groups, links.b_groups])]
        for kind in self.kinds:
            m = links.by_kind[kind]
            layouts.append((m.starts[a_at], [a_ids[m.rows()], b_ids[m.indices], m.values]))
        return good, [(at, [np.asarray(x, np.int32) for x in columns]) for at, columns in layouts]


@functools.cache
def pair(path_a: str, path_b: str, kinds: tuple[str, ...]) -> Pair:
    return Pair(path_a, path_b, kinds)


# --- on Spark ---------------------------------------------------------------------------

def _columns(kinds: tuple[str, ...]) -> list[str]:
    return ["a_ids", "b_ids", "a_groups", "b_groups", *(f"{k}_{x}" for k in kinds for x in ("a", "b", "value"))]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts, at most BATCH_BYTES of text (or one text) together."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and size + len(t or "") > BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1])
        if ids:
            yield ids, texts


def _align_batches(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, kinds: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    both = pair(path_a, path_b, kinds)
    for ids, texts in _slices(batches):
        arrays = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values)) for values, at in both.columns(texts)]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *arrays], ["doc_id", *_columns(kinds)])


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id; a_ids and b_ids, the
    ids of a space and the text by the tokenizers file ``path_a`` and of the
    text by the SentencePiece model ``path_b`` (which adds the space itself),
    without special tokens; a_groups and b_groups, how many tokens each group
    has on either side (a group ends where tokens of both end); and for each of
    ``kinds`` the links in order of A, then B, as the ids {kind}_a, {kind}_b
    and {kind}_value. ``overlap``: tokens that share bytes (value: how many),
    ``end``: tokens that end together, ``group``: tokens of one group (value 1).

    Texts that are null, empty, or that either side's tokens do not give back
    byte by byte have empty arrays. Null ids and repeated rows come back as
    they are, an empty table gives no rows, further columns are ignored. Both
    files are present on all workers."""
    names = _columns(kinds)
    schema = "doc_id long, " + ", ".join(f"{n} array<int>" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _align_batches(batches, path_a, path_b, kinds)

    return _ids_and_texts(docs).mapInArrow(run, schema)


def _ids_and_texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return column_names(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and starts of a column of arrays."""
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


@functools.cache
def _written(n: int) -> list[str]:
    """Ids as text, each followed by its mark: a comma, a bar, a semicolon."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(n)]


def write_groups(a_ids: np.ndarray, b_ids: np.ndarray, a_groups: np.ndarray, b_groups: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: the groups' ids in order."""
    if not len(a_ids):
        return ""
    n = int(max(a_ids.max(), b_ids.max())) + 1
    n = 1 << (n - 1).bit_length()
    a_last, b_last = np.cumsum(a_groups), np.cumsum(b_groups)
    marks_a, marks_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    marks_a[a_last - 1], marks_b[b_last - 1] = 1, 2
    line = np.empty(len(a_ids) + len(b_ids), np.int64)
    line[np.arange(len(a_ids)) + np.repeat(b_last - b_groups, a_groups)] = a_ids + n * marks_a
    line[np.arange(len(b_ids)) + np.repeat(a_last, b_groups)] = b_ids + n * marks_b
    return "".join(map(_written(n).__getitem__, line.tolist()))[:-1]


DIGEST = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, counts array<int>")


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (a, a_at), (b, b_at), (ga, g_at), (gb, _) = (_flat(batch.column(i)) for i in range(1, 5))
        (la, l_at), (lb, _) = (_flat(batch.column(i)) for i in range(5, 7))
        keys = la.astype(np.int64) << 32 | lb
        digests, pairs, counts = [], [], []
        for i in range(batch.num_rows):
            g = slice(g_at[i], g_at[i + 1])
            text = write_groups(a[a_at[i]:a_at[i + 1]], b[b_at[i]:b_at[i + 1]], ga[g], gb[g])
            digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
            p, n = np.unique(keys[l_at[i]:l_at[i + 1]], return_counts=True)
            pairs.append(p)
            counts.append(n)
        at = pa.array(np.cumsum([0, *map(len, pairs)]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(np.diff(x)) for x in (a_at, b_at, g_at, l_at)), pa.array(digests, pa.string()),
             pa.ListArray.from_arrays(at, pa.array(np.concatenate([np.empty(0, np.int64), *pairs]))),
             pa.ListArray.from_arrays(at, pa.array(np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int32)))],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts"])


def digest_links(docs: DataFrame, path_a: str, path_b: str, kind: str = "end") -> DataFrame:
    """Of the rows of ``align_tokenizers`` with links of one kind: doc_id, n_a,
    n_b, n_groups, n_links, groups_sha256 ('' without tokens), and the different
    linked id pairs (a << 32 | b) with how often each occurs. Both steps run in
    one worker, so the aligned rows do not travel."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digest_batches(_align_batches(batches, path_a, path_b, (kind,)))

    return _ids_and_texts(docs).mapInArrow(run, DIGEST)


def pair_counts(digested: DataFrame) -> DataFrame:
    """pair, n (links of all rows that hold it), best: whether no pair of the
    same B id has more."""
    counted = digested.select(F.explode(F.arrays_zip("pairs", "counts")).alias("e")).groupBy(
        F.col("e.pairs").alias("pair")).agg(F.sum("e.counts").alias("n"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counted.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counted.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent_pairs(counts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (ascending) with at least 2 ** k links, their n and best, for
    the least k that leaves at most ``most`` of them."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()
    kept, least = 0, 64
    for k, n in sorted(sizes, reverse=True):
        if kept + n > most:
            break
        kept, least = kept + n, k
    top = counts.where(F.floor(F.log2("n")).cast("int") >= least).toArrow()
    pairs = top["pair"].to_numpy()
    order = np.argsort(pairs)
    return pairs[order], top["n"].to_numpy()[order], top["best"].to_numpy()[order]


def link_counts(digested: DataFrame, scratch: Scratch, most: int = FREQUENT) -> DataFrame:
    """``digested`` (a written table, with a unique ``row``) without pairs, plus
    n_best and count_sum: its links whose pair is the best of its B id, and the
    sum of its links' pair counts. Frequent pairs are broadcast, the others'
    counts are joined."""
    spark = digested.sparkSession
    counts = scratch.save(pair_counts(digested))
    frequent = spark.sparkContext.broadcast(frequent_pairs(counts, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = frequent.value
        for batch in batches:
            (pairs, at), (times, _) = _flat(batch.column(1)), _flat(batch.column(2))
            place = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))

            def total(values: np.ndarray) -> np.ndarray:
                sums = np.concatenate([[0], np.cumsum(values)])
                return (sums[at[1:]] - sums[at[:-1]]).astype(np.int64)

            known = np.where(hit, n[place], 0) if len(keys) else np.zeros(len(pairs), np.int64)
            rest_at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[~hit], minlength=batch.num_rows))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total(times * (known if not len(keys) else np.where(hit, best[place], False)))),
                 pa.array(total(times * known)), pa.ListArray.from_arrays(rest_at, pa.array(pairs[~hit])),
                 pa.ListArray.from_arrays(rest_at, pa.array(times[~hit].astype(np.int32)))],
                ["row", "n_best", "count_sum", "pairs", "counts"])

    sums = scratch.save(digested.select("row", "pairs", "counts").mapInArrow(
        run, "row long, n_best long, count_sum long, pairs array<long>, counts array<int>"))
    rest = (sums.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("e"))
            .select("row", F.col("e.pairs").alias("pair"), F.col("e.counts").alias("times")).join(counts, "pair")
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    return (digested.drop("pairs", "counts").join(sums.select("row", "n_best", "count_sum"), "row").join(rest, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).drop("more_best", "more_sum"))


def alignment_digest(docs: DataFrame, path_a: str, path_b: str, kind: str = "end", most: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of
    every row of ``docs``, from its alignment and the corpus's pair counts."""
    scratch = Scratch(docs.sparkSession, "alignment")
    digested = scratch.save(digest_links(docs, path_a, path_b, kind)
                            .withColumn("row", F.monotonically_increasing_id()))
    return link_counts(digested, scratch, most).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(MODEL))
