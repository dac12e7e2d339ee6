"""SentencePiece ids, spans and decoding against the library; other character maps against its normaliser."""

import os

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from hearthrate.llm import pieces
from hearthrate.llm.pieces import Codec, encode_pieces, model_bytes

TRICKY = [
    "", " ", "  a  b ", "▁x y", "a▁ b", "héllo\n\n\tworld 日本語 🎉🎉 \x00 z", "ab" * 3000, " " * 500, "<s> </s> <unk> <0x41>", "▁" * 7,
    "  ﬁ ㍿  ①Ａ x  ", "é ﬀ ½", None,
]


@pytest.fixture(scope="module")
def model():
    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def test_ids_spans_and_decoding(documents, docs_of, model, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = docs_of(enumerate(TRICKY)).union(documents.selectExpr("doc_id + 1000", "text"))
    rows = encode_pieces(texts, model).collect()
    assert len(rows) == len(TRICKY) + documents.count()
    for r in rows:
        text = r.text or ""
        ids = library.encode(text)
        assert list(r.ids) == ids
        assert r.decoded == library.decode(ids)
        # Bytes of an unknown character have a byte each here; the library gives the last one the whole character.
        want = library.encode(text, return_type="proto").pieces
        assert all((a, b) == (p.begin, p.end) for a, b, p in zip(r.piece_starts, r.piece_ends, want) if not library.is_byte(p.id))
        assert list(r.piece_starts[1:]) == list(r.piece_ends[:-1])
        assert (r.piece_starts[0], r.piece_ends[-1]) == (0, len(text.encode())) if ids else not text


def test_forgetting_units_changes_nothing(model, monkeypatch):
    texts = [t for t in TRICKY if t] * 3
    whole = Codec(model).encode(texts)
    monkeypatch.setattr(pieces, "_KNOWN_UNITS", 2)
    small = Codec(model)
    for t in texts:
        part = small.encode([t])
        assert part.ids.tolist() == Codec(model).encode([t]).ids.tolist()
    assert whole.ids.tolist() == sum((small.encode([t]).ids.tolist() for t in texts), [])


@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("name", ["nfkc.bin", "nmt_nfkc_cf.bin"])
def test_compiled_character_maps(model, name, squeeze):
    folder = os.path.join(os.path.dirname(sentencepiece.__file__), "package_data")
    spec = proto.ModelProto.FromString(model)
    with open(os.path.join(folder, name), "rb") as file:
        spec.normalizer_spec.precompiled_charsmap = file.read()
    spec.normalizer_spec.remove_extra_whitespaces = squeeze
    codec = Codec(spec.SerializeToString())
    for text in filter(None, TRICKY):
        assert codec.normalise(text)[0] == codec.library.normalize(text)
        got = codec.encode([text])
        assert got.ids.tolist() == codec.library.encode(text)
        size = len(text.encode())
        assert all(0 <= a <= b <= size for a, b in zip(got.starts.tolist(), got.ends.tolist()))


def test_edges(docs_of, model):
    assert encode_pieces(docs_of([]), model).collect() == []
    out = encode_pieces(docs_of([(1, None), (1, None), (None, "a")]).selectExpr("*", "1 AS ids", "2 AS units"), model)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "piece_ends", "piece_starts", "text", "units"]
    assert [len(r.ids) for r in out.collect()] == [0, 0, 1]
