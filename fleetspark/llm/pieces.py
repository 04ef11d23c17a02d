"""SentencePiece models rebuilt on the tokenizers library.

The model protobuf is parsed here (its few fields, by the public wire format);
the tokenizers library gets the rebuilt normaliser, the metaspace marker, the
model (unigram scores, or BPE merges ranked by the merged piece's score) and
byte fallback. Where no piece holds the marker behind another character,
pieces never cross the place before a marker, so texts are cut there and each
distinct segment is encoded once per worker, in multithreaded batches. Every
newly encoded segment is compared with the sentencepiece library; where the
two differ (ties between equal scores), the sentencepiece ids stand.
"""

from __future__ import annotations

import codecs
import functools
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fleetspark.llm.common import WorkerCache, column_names, map_rows, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Field numbers and kinds of the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
KNOWN_BYTES = 96 << 20  # of a worker's known segments, about
ENCODED = 10_000  # segments that the tokenizers library encodes at once
THREADS = 2  # of one worker (its share of an executor's cores)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value, shift = 0, 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(tag & 7)
        n = varint() if n is None else n
        yield tag >> 3, data[i:i + n]
        i += n


class PieceModel:
    """What a SentencePiece model file holds."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[tuple[str, float, int]] = []
        trainer, norm = b"", b""
        for field, value in _fields(data):
            if field == 1:
                p = dict(_fields(value))
                self.pieces.append((p[1].decode(), struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0], p.get(3, NORMAL)))
            elif field == 2:
                trainer = value
            elif field == 3:
                norm = value
        t, n = dict(_fields(trainer)), dict(_fields(norm))
        self.kind = t.get(3, UNIGRAM)
        self.byte_fallback = bool(t.get(35, 0))
        self.charsmap = n.get(2, b"")
        self.dummy_prefix, self.squeeze, self.escape = (bool(n.get(k, 1)) for k in (3, 4, 5))
        self.unk = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


codecs.register_error("mark_each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class PieceCodec:
    """Encodes and decodes like the model's own library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        from tokenizers import Tokenizer, models, normalizers

        m = self.model = PieceModel(path)
        usable = {p: i for i, (p, _, kind) in enumerate(m.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
        if m.kind == BPE:
            merges = sorted((-score, cut, p[:cut], p[cut:]) for p, score, kind in m.pieces if kind == NORMAL
                            for cut in range(1, len(p)) if p[:cut] in usable and p[cut:] in usable)
            core = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, [x[2:] for x in merges],
                              unk_token=m.pieces[m.unk][0], fuse_unk=True, byte_fallback=m.byte_fallback)
        elif m.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in m.pieces], m.unk, m.byte_fallback)
        else:
            raise ValueError(f"model kind {m.kind} is neither unigram nor BPE")
        self.core = Tokenizer(core)
        self.charsmap = normalizers.Precompiled(m.charsmap) if m.charsmap else None
        self.cuts = m.escape and MARK in usable and not any(MARK in p.lstrip(MARK) for p in usable)
        self.segments = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.bytes = [b"" if kind == CONTROL else bytes([int(p[3:-1], 16)]) if kind == BYTE
                      else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode() for p, _, kind in m.pieces]
        self.known = WorkerCache(KNOWN_BYTES)
        self.lossy: set[str] = set()  # known segments that do not decode to themselves
        self.own = None
        if m.dummy_prefix and m.escape and not m.charsmap and not m.squeeze:
            import sentencepiece

            self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.differed = 0

    def normalise(self, text: str) -> str:
        """The text the model sees, markers in place of spaces."""
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if self.model.dummy_prefix and text:
            text = " " + text
        return text.replace(" ", MARK) if self.model.escape else text

    def _ids(self, segments: list[str]) -> list[list[int]]:
        ids = [e.ids for i in range(0, len(segments), ENCODED)
               for e in self.core.encode_batch_fast(segments[i:i + ENCODED], add_special_tokens=False)]
        if self.own is not None:
            marked = [k for k, s in enumerate(segments) if s.startswith(MARK)]
            ours = self.own.encode([segments[k][1:].replace(MARK, " ") for k in marked], num_threads=1)
            for k, right in zip(marked, ours, strict=True):
                # (a lone marker is the prefix of an empty text, which has no pieces)
                if segments[k] != MARK and ids[k] != right:
                    ids[k], self.differed = right, self.differed + 1
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, int32."""
        return self.encode_checked(texts)[0]

    def encode_checked(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether they decode to it. Where texts are cut
        into segments as they are, a text comes back if its segments do (each
        is decoded once per worker) and it holds no marker of its own."""
        if not self.cuts:
            ids = [np.array(x, np.int32) for x in self._ids([self.normalise(t) for t in texts])]
            return ids, [self.decode(x) == t for x, t in zip(ids, texts, strict=True)]
        split = [self.segments.findall(self.normalise(t)) for t in texts]
        if self.known.claim().bytes > KNOWN_BYTES:
            self.known.empty()
        if not self.known:
            self.lossy.clear()
        missing = sorted(set().union(*split).difference(self.known))
        for segment, found in zip(missing, self._ids(missing), strict=True):
            self.known[segment] = np.array(found, np.int32).tobytes()
            self.known.bytes += 220 + 4 * (len(segment) + len(found))
            if b"".join(map(self.bytes.__getitem__, found)) != segment.replace(MARK, " ").encode("utf-8", "surrogatepass"):
                self.lossy.add(segment)
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, s)), np.int32) for s in split]
        plain = self.model.dummy_prefix and not self.charsmap and not self.model.squeeze
        return ids, [MARK not in t and (not self.lossy or self.lossy.isdisjoint(s)) if plain else self.decode(x) == t
                     for x, t, s in zip(ids, texts, split, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; each byte that is not UTF-8 becomes a replacement mark."""
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode(errors="mark_each_byte")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


@functools.cache
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_pieces(docs: DataFrame, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``keep`` columns, ids (array<int>), n_tokens, and round_trip:
    whether decoding the ids gives the text back. One row per row of ``docs``
    (doc_id, text); a null text is empty and has no ids. Without begin and end
    pieces. ``path`` names a SentencePiece model present on all workers. Null
    ids and repeated rows come back as they are; other columns are ignored."""
    picked = column_names(docs, "doc_id", *keep, "text")
    kinds = dict(picked.dtypes)

    def run(cols: dict[str, list]) -> dict[str, list]:
        texts = [t or "" for t in cols["text"]]
        ids, back = codec(path).encode_checked(texts)
        offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        values = np.concatenate([np.empty(0, np.int32), *ids])
        return {c: cols[c] for c in ("doc_id", *keep)} | {
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), "n_tokens": [len(x) for x in ids],
            "round_trip": back}

    schema = "doc_id long, " + "".join(f"`{c}` {kinds[c]}, " for c in keep) + "ids array<int>, n_tokens long, round_trip boolean"
    return map_rows(picked, run, schema)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of ``encoded`` (doc_id, ids); null ids give an empty text."""
    return map_rows(column_names(encoded, "doc_id", "ids"), lambda cols: {
        "doc_id": cols["doc_id"], "text": [codec(path).decode(np.array(x or [], np.int64)) for x in cols["ids"]]},
        "doc_id long, text string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
