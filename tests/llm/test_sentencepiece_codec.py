import struct

import pytest
import sentencepiece

from starmill.llm import sentencepiece_codec as sp
from starmill.llm.queries import PIECE_MODEL

PATH = PIECE_MODEL.removeprefix("file://")
ODD = ["", " ", "  a  b  ", "\n\n x", "a▁b", "<s> hi </s>", "日本語 テスト🎉", "\x00\x01", "\ttab", "x" * 3000, "ééé " * 500]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return f.read()


def field(number, kind, value):
    def varint(n):
        out = b""
        while True:
            out += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out

    head = varint(number << 3 | kind)
    return head + (varint(value) if kind == 0 else struct.pack("<f", value) if kind == 5 else varint(len(value)) + value)


def hand_made(model_type, pieces, byte_fallback=True, extra_spaces=False):
    """A small model file written by hand; nothing is trained."""
    out = b""
    for piece, score, kind in pieces:
        out += field(1, 2, field(1, 2, piece.encode()) + field(2, 5, score) + field(3, 0, kind))
    out += field(2, 2, field(3, 0, model_type) + field(35, 0, int(byte_fallback)))
    return out + field(3, 2, field(1, 2, b"identity") + field(3, 0, 1) + field(4, 0, int(extra_spaces)) + field(5, 0, 1))


@pytest.fixture(scope="module")
def unigram():
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = {"▁": -2.5, "▁the": -3.0, "▁a": -3.5, "t": -5.0, "h": -5.1, "e": -4.9, "he": -4.2, "th": -4.4, "in": -4.0, "i": -5.2,
             "n": -5.3, "a": -4.8, "b": -6.0, "ing": -4.1, "g": -6.1, "▁in": -3.9, "é": -6.5, "thing": -6.2}
    return hand_made(1, pieces + [(w, s, 1) for w, s in words.items()])


def test_parse(model):
    spec = sp.parse(model)
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert len(spec.pieces) == lib.vocab_size() and spec.model_type == sp.BPE and spec.byte_fallback
    assert all(lib.id_to_piece(k) == spec.pieces[k][0] for k in range(len(spec.pieces)))
    assert all(abs(lib.get_score(k) - spec.pieces[k][1]) < 1e-6 for k in range(300, 32000, 97))


@pytest.mark.parametrize("which", ["model", "unigram"])
def test_parity_with_the_library(which, request, corpus):
    data = request.getfixturevalue(which)
    lib, codec = sentencepiece.SentencePieceProcessor(model_proto=data), sp.Codec.of(data)
    texts = ODD + [t or "" for _, t in corpus] + ["the thing in a bang thein inginging athe"]
    want = lib.encode(texts)
    assert codec.encode(texts) == want
    assert codec.decode(want) == lib.decode(want)
    assert codec.encode(texts[::-1]) == want[::-1]  # remembered words give the same


@pytest.mark.parametrize("which", ["model", "unigram"])
def test_words_apart_or_together(which, request):
    codec = sp.Codec(request.getfixturevalue(which))
    apart = codec.encode(ODD)
    codec.by_word = False
    assert codec.encode(ODD) == apart


def test_blanks_that_are_folded(unigram):
    pieces = [(p, s, k) for p, s, k in sp.parse(unigram).pieces]
    data = hand_made(1, pieces, extra_spaces=True)
    lib, codec = sentencepiece.SentencePieceProcessor(model_proto=data), sp.Codec(data)
    texts = ["  the   thing ", "a", "the thing", "   "]
    assert codec.encode(texts) == lib.encode(texts)
    assert codec.encode_arrays(texts)[2].tolist() == [False, True, True, False]


def test_no_byte_fallback(unigram):
    pieces = [(p, s, k) for p, s, k in sp.parse(unigram).pieces if k != sp.BYTE]
    data = hand_made(1, pieces, byte_fallback=False)
    lib, codec = sentencepiece.SentencePieceProcessor(model_proto=data), sp.Codec(data)
    texts = ["the z thing", "zz", "a the"]
    assert codec.encode(texts) == lib.encode(texts)
    assert codec.encode_arrays(texts)[2].tolist() == [False, False, True]


def test_rows(frame, odd_corpus, model):
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    from starmill.llm.rows import identified

    coded = sp.encode(identified(frame(odd_corpus)), PIECE_MODEL)
    assert sorted((r.ids for r in coded.collect())) == sorted(lib.encode([t or "" for _, t in odd_corpus]))
    assert not coded.filter("NOT round_trip").count()
    back = sp.decode(coded, PIECE_MODEL)
    assert back.columns == [*coded.columns, "decoded"]
    assert sorted(r.decoded for r in back.collect()) == sorted(t or "" for _, t in odd_corpus)
    assert sp.token_digests(frame([]), PIECE_MODEL).count() == 0


def test_round_trip_is_that_of_the_decoder(model):
    """A decoder that leaves the blank marks in place gives no text of two words back."""
    from tokenizers import decoders

    codec, texts = sp.Codec(model), ["two words", "one", "", "é 🎉  x"]
    assert codec.encode_arrays(texts)[2].tolist() == [True] * 4
    codec.tokenizer.decoder = decoders.Fuse()
    assert codec.encode_arrays(texts)[2].tolist() == [False, False, True, False]
