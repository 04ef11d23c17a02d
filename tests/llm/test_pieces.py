"""Piece ids against the sentencepiece library, and round trips."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as proto

from fleetspark.llm.pieces import BYTE, CONTROL, NORMAL, UNKNOWN, PieceCodec, decode_pieces, encode_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a", " a", "a ", "  a   b  ", "\n\n a\tb", "<s> </s> <unk> <0x0A>", "▁ ▁▁a", "aaaaaaa aaaaa", "日本語 🙂", "\x00", "é" * 50,
         "word " * 9000, "1234567890", " ", "   "]


def test_against_the_library(spark):
    own = sentencepiece.SentencePieceProcessor(model_file=PATH)
    df = spark.createDataFrame([(i, t, 1, "e") for i, t in enumerate(TEXTS)] + [(90, None, 1, "e"), (None, "x", 1, "e")],
                               "doc_id long, text string, n_tokens int, ids string")
    got = encode_pieces(df, PATH).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "x" if r.doc_id is None else TEXTS[r.doc_id] if r.doc_id < 90 else ""
        assert list(r.ids) == own.encode(text) and r.n_tokens == len(r.ids)
        assert r.round_trip == (own.decode(own.encode(text)) == text)
    back = {r.doc_id: r.text for r in decode_pieces(encode_pieces(df, PATH), PATH).collect()}
    assert all(back[i] == own.decode(own.encode(t)) for i, t in enumerate(TEXTS)) and back[90] == ""
    assert encode_pieces(df.limit(0), PATH).collect() == []


CODEC, OWN = PieceCodec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ab\nthe,.1é▁"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(text):
    ids = CODEC.encode([text])[0]
    assert ids.tolist() == OWN.encode(text)
    assert CODEC.decode(ids) == OWN.decode(ids.tolist())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(3, 31999), max_size=20))
def test_decoding_any_ids(ids):
    assert CODEC.decode(np.array(ids, np.int64)) == OWN.decode(ids)


def test_unigram_model_by_scores(tmp_path):
    """A model written by hand: unigram scores, byte fallback."""
    model = proto.ModelProto()
    pieces = [("<unk>", 0, UNKNOWN), ("<s>", 0, CONTROL), ("</s>", 0, CONTROL)]
    pieces += [(f"<0x{i:02X}>", 0, BYTE) for i in range(256)]
    pieces += [(p, s, NORMAL) for p, s in (("▁", -2.0), ("a", -3.0), ("b", -3.1), ("ab", -4.0), ("▁a", -3.5), ("▁ab", -5.0),
                                            ("aba", -4.5), ("ba", -6.0))]
    for piece, score, kind in pieces:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = True
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.remove_extra_whitespaces = False
    (tmp_path / "u.model").write_bytes(model.SerializeToString())
    path = str(tmp_path / "u.model")
    own, codec = sentencepiece.SentencePieceProcessor(model_file=path), PieceCodec(path)
    codec.own = None
    for text in ("ab", "abab ab", "a b  aba", "bbabaab", "xé ab", ""):
        assert codec.encode([text])[0].tolist() == own.encode(text)
